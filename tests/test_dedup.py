import random

import pytest

from corpusloom.functions import text as tx
from corpusloom.operators import dedup, tokens
from corpusloom.plans import corpus
from pyspark.sql import functions as F
from tests.conftest import rows

TEXTS = ["a\na\nb", "b\nc", "hot\nhot line", "a\nb\nc", "", "  a  \nnew", None, "\n \n"]


def brute(pars):
    """Verdicts by walking the rows in order."""
    seen, out = set(), []
    for doc_id, par_pos, key in sorted(pars):
        out.append((doc_id, par_pos, key, key in seen))
        seen.add(key)
    return out


def check(df):
    pars = tokens.paragraph_hash(df)
    want = brute(rows(pars))
    assert sorted(rows(dedup.dedup_first_seen(pars))) == want
    return want


def test_first_seen(docs):
    want = check(docs(*TEXTS))
    assert [v[3] for v in want if v[0] == 0] == [False, True, False]
    assert [v[3] for v in want if v[0] == 3] == [True, True, True]


def test_hot_line_in_every_document(docs):
    rng = random.Random(1)
    texts = ["\n".join(["boilerplate", str(rng.randrange(30)), str(i), "boilerplate"]) for i in range(300)]
    want = check(docs(*texts).repartition(8))
    assert sum(not v[3] for v in want) == len({v[2] for v in want})


def test_same_for_any_partitioning(docs):
    df = docs(*TEXTS)
    results = [rows(corpus.deduplicate(df.repartition(n))) for n in (1, 8)]
    assert results[0] == results[1]


def test_string_ids(docs):
    df = docs(*TEXTS).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    check(df)


def test_other_keys_are_refused(spark):
    pars = spark.createDataFrame([(1, 0, "not hex")], "doc_id int, par_pos int, key string")
    with pytest.raises(Exception, match="hexadecimal"):
        dedup.first_copies(pars).collect()


def test_keep_unique(docs):
    cut = tokens.segment_paragraphs(docs(*TEXTS))
    pars = cut.select("doc_id", "par_pos", tx.paragraph_key(F.col("seg")).alias("key"), F.col("seg").alias("par"))
    firsts = [v[:3] for v in brute(rows(pars, "doc_id", "par_pos", "key")) if not v[3]]
    assert sorted(r[:2] for r in rows(dedup.dedup_keep_unique(pars))) == [f[:2] for f in firsts]


def test_stats_and_completeness(docs):
    df = docs(*TEXTS)
    verdicts = dedup.dedup_first_seen(tokens.paragraph_hash(df))
    stats = {r[0]: r[1:] for r in rows(dedup.dup_stats(verdicts))}
    assert stats[0] == (3, 1) and stats[3] == (3, 3) and 4 not in stats
    joined = {r[0]: r[1:] for r in rows(dedup.doc_verdict_join(df, verdicts))}
    assert len(joined) == len(TEXTS) and all(r[2] for r in joined.values())
    partial = dedup.doc_verdict_join(df, verdicts.where("par_pos > 0"))
    assert not {r[0]: r[3] for r in rows(partial)}[0]


def test_reassemble(docs):
    got = {r[0]: r[1:] for r in rows(corpus.deduplicate(docs(*TEXTS)))}
    assert got[0] == ("a\nb", 3, 1)
    assert got[1] == ("c", 2, 1)
    assert got[3] == ("", 3, 3)
    assert got[4] == got[6] == got[7] == ("", 0, 0)
    assert got[5] == ("new", 2, 1)
    assert len(got) == len(TEXTS)


def test_result_holds_no_repeats(docs):
    once = corpus.deduplicate(docs(*TEXTS)).select("doc_id", "text")
    twice = corpus.deduplicate(once)
    assert rows(twice, "doc_id", "text") == rows(once)
    assert twice.where("n_dup > 0").count() == 0


def test_order_inside_long_documents(docs):
    lines = [f"line {i % 700}" for i in range(2000)]
    got = corpus.deduplicate(docs("\n".join(lines))).first()
    assert got.text.split("\n") == lines[:700] and got.n_dup == 1300


def test_verdicts_cut_the_text_once(docs, spark):
    """The exchange of the key table feeds both sides of the join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = dedup.dedup_first_seen(tokens.paragraph_hash(docs(*TEXTS)))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final
        assert final.count("\\p{Lu}") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
