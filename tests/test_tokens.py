import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import tokens
from tests.conftest import rows


def vertical(docs, *texts):
    return [v for *_, v in rows(tokens.vertical_paragraph(docs(*texts)))]


def sentences(docs, text):
    """Sentences as lists of tokens."""
    found = {}
    for r in tokens.token_table(docs(text)).collect():
        found.setdefault((r.par_pos, r.sent_pos), []).append((r.tok_pos, r.tok))
    return [[t for _, t in sorted(found[k])] for k in sorted(found)]


def test_vertical_marks(docs):
    assert vertical(docs, "Hi!") == ["<p>\n<s>\nHi\n<g/>\n!\n</s>\n</p>\n"]


def test_sentences_and_abbreviations(docs):
    got = sentences(docs, 'Dr. Smith went. He left!\n"Ok?" Yes.')
    assert [" ".join(s) for s in got] == ["Dr . Smith went .", "He left !", '" Ok ? "', "Yes ."]


def test_abbreviations_in_a_row_and_inside_words(docs):
    assert len(sentences(docs, "Mr. Dr. Who came. Then")) == 2
    assert len(sentences(docs, "The FirSt. Then")) == 2
    assert len(sentences(docs, "(Main St.) The end")) == 1


def test_words_with_joiners(docs):
    assert sentences(docs, "it's 3.5 well-known -x- a.") == [["it's", "3.5", "well-known", "-", "x", "-", "a", "."]]


def test_blanks_of_all_kinds_separate(docs):
    got = tokens.token_table(docs("  a b　c d e\tf\r"))
    assert [r[1:] for r in rows(got, "tok_pos", "tok", "glue")] == [(t, False) for t in "abcdef"]


def test_control_characters_end_tokens_and_vanish(docs):
    got = rows(tokens.token_table(docs("\x07a\x07b \x07c\x00\n\x07 \n\x1f")), "par_pos", "tok", "glue")
    assert got == [(0, "a", False), (0, "b", True), (0, "c", False)]


def test_many_control_characters_take_linear_time(docs):
    text = "a" + "\x00" * 200_000 + "b" + " \x01" * 100_000 + "c"
    assert rows(tokens.token_table(docs(text)), "tok", "glue") == [("a", False), ("b", True), ("c", False)]


def test_positions_count_kept_paragraphs(docs):
    got = rows(tokens.paragraph_split(docs("\n \na\n\n \nb\n")), "par_pos", "par")
    assert got == [(0, "a"), (1, "b")]
    assert [r[1] for r in rows(tokens.paragraph_hash(docs("\n \na\n\n \nb\n")))] == [0, 1]


def test_markup_like_text_is_text(docs):
    assert sentences(docs, "<p> x </s>") == [["<", "p", ">", "x", "<", "/", "s", ">"]]


def test_empty_and_null_texts_have_no_rows(docs):
    df = docs("", None, " \n\t")
    for operator in (tokens.paragraph_split, tokens.token_table, tokens.vertical_paragraph, tokens.paragraph_hash):
        assert operator(df).count() == 0


def test_head_tokens(spark):
    df = spark.createDataFrame(
        [(1, "Hello, world. Again"), (2, "Unknown"), (3, " "), (4, None)], "doc_id int, title string"
    )
    got = rows(tokens.head_tokens(df))
    assert [r[2] for r in got] == ["Hello", ",", "world", ".", "Again"]
    assert {r[0] for r in got} == {1}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZé1 .!?'\"- \t\x07\n(", max_size=40), min_size=1, max_size=20))
def test_tokens_rebuild_the_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    toks = tokens.token_table(df).collect()
    pars = rows(tokens.paragraph_split(df))
    for doc_id, par_pos, par in pars:
        mine = sorted((r.sent_pos, r.tok_pos, r.tok, r.glue) for r in toks if (r.doc_id, r.par_pos) == (doc_id, par_pos))
        # Blanks become one space; control characters vanish.
        flat = re.sub(r"[\x00-\x08\x0e-\x1f\x7f-\x9f]", "", par)
        joined = "".join(("" if glue else " ") + tok for *_, tok, glue in mine)
        assert joined.strip() == re.sub(r"\s+", " ", flat).strip()
    assert {(r.doc_id, r.par_pos) for r in toks} == {(d, p) for d, p, _ in pars}


def test_same_for_any_partitioning(docs):
    df = docs(*[f"Text {i}. More!\nline {i % 3}" for i in range(40)])
    one, many = df.repartition(1), df.repartition(8)
    assert rows(tokens.token_table(one)) == rows(tokens.token_table(many))


def test_text_is_cut_once(docs):
    """The chain of regex passes occurs once in the plan."""
    df = docs("a").withColumn("text", F.col("text"))
    plan = tokens.token_table(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\\p{Lu}") == 1
