from corpusloom.operators import langid
from corpusloom.plans import corpus
from corpusloom.sources import tables, warc
from corpusloom.staging import stage, stage_by
from tests.conftest import rows
from tests.test_warc import record, write


def test_from_archive_to_corpus(spark, tmp_path):
    """WARC to English articles without repeats, the repeated footer kept once."""
    footer = "all rights of this footer are reserved and it is the same on every page of the site we know here"
    german = " ".join(["der hund und die katze sind nicht im haus das ist so"] * 4)

    def page(title, *pars):
        body = "".join(f"<p>{p}</p>" for p in pars)
        return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}</body></html>".encode()

    english = "the cat and the dog are in the house and this is what they do all day with the others"
    path = write(
        tmp_path / "c.warc.gz",
        record(page("One", english + " one", footer), rid="1", uri="http://x/1"),
        record(page("Two", english + " two", footer), rid="2", uri="http://x/2"),
        record(page("Drei", german, german), rid="3", uri="http://x/3"),
        record(b"not html", rid="4", http="text/plain"),
        record(page("None", "short"), rid="5"),
    )
    training = spark.createDataFrame([("en", english), ("en", footer), ("de", german)], "lang string, text string")
    profile = stage(langid.langid_fit(training), "profile")
    records = tables.spread(warc.read_warc(spark, path))
    got = rows(corpus.clean_corpus(records, profile))
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in got] == [
        ("1", "http://x/1", "One", 2, 0), ("2", "http://x/2", "Two", 2, 1),
    ]
    assert got[0][3] == f"{english} one\n{footer}" and got[1][3] == f"{english} two"


def test_stored_documents_are_not_shuffled_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = spark.range(100).selectExpr("id as doc_id", "cast(id as string) as text")
        docs = stage_by(made.repartition("doc_id"), "docs", "doc_id")
        df = corpus.deduplicate(docs)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # One exchange by key, one of positions by document; none of the text.
        assert plan.count("Exchange hashpartitioning") == 2
        assert df.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
