import pytest
from pyspark.sql import functions as F

from corpusloom.operators import annotate, tokens
from corpusloom.plans import corpus
from corpusloom.staging import stage
from tests.conftest import rows


def documents(spark, *entries):
    return spark.createDataFrame(list(entries), "doc_id string, uri string, title string, text string")


def lines(spark, *entries):
    """Vertical text of one document with fixed tags."""
    toks = annotate.token_markup(documents(spark, *entries))
    toks = toks.withColumn("pos", F.lit("P")).withColumn("lemma", F.lit("L"))
    long_way = rows(annotate.vertical_document(annotate.vertical_lines(toks)))
    assert rows(annotate.vertical_text(toks)) == long_way
    return dict(long_way)


def test_golden_document(spark):
    got = lines(spark, ("D", "U", "Hello world", "Hi!"))["D"]
    assert got == (
        'L\tHello\t<doc id="D" uri="U" title="Hello world"><head>\t\tP\n'
        "L\tworld\t\t</head>\tP\n"
        "\n"
        "L\tHi\t<p><s>\t\tP\n"
        "L\t!\t\t</s></p></doc>\tP\n"
        "\n"
    )


def test_only_the_head_remains(spark):
    got = lines(spark, ("D", "U", "Hello world", ""))["D"]
    assert got.endswith("L\tworld\t\t</head></doc>\tP\n\n")


def test_one_token_title_merges_marks(spark):
    got = lines(spark, ("D", "U", "Hi", ""))["D"]
    assert got == 'L\tHi\t<doc id="D" uri="U" title="Hi"><head>\t</head></doc>\tP\n\n'


def test_no_title(spark):
    got = lines(spark, ("D", "U", "Unknown", "a b c"))["D"]
    assert got == (
        'L\ta\t<doc id="D" uri="U" title="Unknown"><p><s>\t\tP\n'
        "L\tb\t_\t_\tP\n"
        "L\tc\t\t</s></p></doc>\tP\n\n"
    )


def test_sentences_and_paragraphs(spark):
    df = documents(spark, ("D", "U", "Unknown", "A b. C.\nD"))
    got = rows(annotate.token_markup(df), "tok", "before", "after")
    marks = {tok: (before, after) for tok, before, after in got if tok != "."}
    assert marks["A"][0].endswith("<p><s>") and marks["C"][0] == "<s>" and marks["D"] == ("<p><s>", "</s></p></doc>")
    ends = sorted(after for tok, _, after in got if tok == ".")
    assert ends == ["</s>", "</s></p>"]


def test_attributes_stay_on_one_line(spark):
    got = lines(spark, ("D", "U\tV", "a\nb\tc", "x"))["D"]
    assert '<doc id="D" uri="U V" title="a b c">' in got


def test_nothing_left(spark):
    assert lines(spark, ("D", "U", "Unknown", ""), ("E", "U", "Unknown", None)) == {}


@pytest.fixture(scope="module")
def lexicon(spark):
    tagged = spark.createDataFrame([
        ("run", "VB", "run"), ("run", "VB", "run"), ("run", "NN", "run"),
        ("tie", "B", "x"), ("tie", "A", "z"), ("tie", "A", "y"),
        ("walking", "VBG", "walk"), ("talking", "VBG", "talk"), ("king", "NN", "king"), ("The", "DT", "the"),
    ], "form string, pos string, lemma string")
    return stage(annotate.lexicon_fit(tagged), "lexicon")


def test_lexicon(lexicon):
    assert rows(lexicon) == [
        ("The", "DT", "the"), ("king", "NN", "king"), ("run", "VB", "run"), ("talking", "VBG", "talk"),
        ("tie", "A", "y"), ("walking", "VBG", "walk"),
    ]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_lookup_order(spark, lexicon, limit):
    """Form, lower-cased form, longest ending, unknown; broadcast and salted."""
    words = ["run", "Run", "The", "the", "jumping", "ing", "sing", "Balking", "xyz", "run", "g"]
    toks = spark.createDataFrame(list(enumerate(words)), "n int, tok string")
    got = [r[1:] for r in rows(annotate.annotate_tokens(toks, lexicon, limit=limit))]
    # Endings are shorter than the word: "ing" is tagged by "ng", "the" by "he".
    assert sorted(got) == sorted([
        ("run", "VB", "run"), ("Run", "VB", "run"), ("The", "DT", "the"), ("the", "DT", "the"),
        ("jumping", "VBG", "jumping"), ("ing", "VBG", "ing"), ("sing", "VBG", "sing"),
        ("Balking", "VBG", "Balking"), ("xyz", "UNK", "xyz"), ("run", "VB", "run"), ("g", "UNK", "g"),
    ])


def test_hook_loads_a_model_once_per_task(spark, docs):
    def make():
        calls = []

        def model(batch):
            calls.append(1)
            return batch.assign(up=batch["tok"].str.upper(), calls=len(calls))

        return model

    toks = tokens.token_table(docs("a b", "c")).select("doc_id", "tok")
    got = annotate.annotate_with(toks.coalesce(1), make, "doc_id bigint, tok string, up string, calls int")
    assert rows(got, "tok", "up") == [("a", "A"), ("b", "B"), ("c", "C")]


def test_conll(spark, lexicon):
    df = documents(spark, ("D", "U", "title", "The run. Xyz\nking"))
    got = dict(rows(corpus.conll_corpus(df, lexicon)))["D"]
    tail = "\t_\t_\t_\t_\t_\n"
    assert got == (
        f"1\tThe\tthe\tDT\tDT{tail}2\trun\trun\tVB\tVB{tail}3\t.\t.\tUNK\tUNK{tail}\n"
        f"1\tXyz\tXyz\tUNK\tUNK{tail}\n"
        f"1\tking\tking\tNN\tNN{tail}\n"
    )


def test_assembly_shuffles_documents_only(spark, lexicon):
    df = documents(spark, ("D", "U", "title", "x"))
    plan = corpus.vertical_corpus(df, lexicon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def moved(df, column="tok_pos"):
    """Whether any exchange of the plan carries ``column``."""
    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        children = node.children()
        below = [walk(children.apply(i)) for i in range(children.size())]
        return any(below) or (node.nodeName() == "Exchange" and column in names)

    return walk(df._jdf.queryExecution().executedPlan())


TEXTS = [
    ("D", "U", "A title", "The run. Run xyz\nking talking"), ("E", "V", None, "the the walking. Jumping"),
    ("F", "V", "Unknown", ""), ("D", "W", "Twice", "run again"), (None, "N", "No id", "King. The thing"),
]


def _annotated(docs, lexicon):
    return annotate.annotate_tokens(tokens.token_table(annotate.placed(docs, lexicon)), lexicon).drop(tokens.CHUNK)


def _lines(docs, lexicon):
    return annotate.vertical_lines(corpus.annotated(docs, lexicon, together=True)).drop(tokens.CHUNK)


@pytest.mark.parametrize("make", [_annotated, corpus.vertical_corpus, corpus.conll_corpus, _lines])
def test_large_lexicon_leaves_tokens_in_place(spark, lexicon, monkeypatch, make):
    """Only documents and the distinct forms of their chunks are shuffled; rows are those of a small lexicon."""
    df = documents(spark, *TEXTS[:3], TEXTS[4])
    want = make(df, lexicon)
    monkeypatch.setattr(annotate, "fits_broadcast", lambda *_: False)
    got = make(df, lexicon)
    assert not moved(got)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_large_lexicon_with_repeated_ids(spark, lexicon, monkeypatch):
    df = documents(spark, *TEXTS)
    want = rows(_annotated(df, lexicon))
    monkeypatch.setattr(annotate, "fits_broadcast", lambda *_: False)
    assert rows(_annotated(df, lexicon)) == want
