import pytest

from corpusloom.operators import dedup, tokens
from corpusloom.plans import corpus
from corpusloom.streaming import dedup as streaming
from corpusloom.streaming.corpus import corpus_batch
from tests.conftest import rows

VERDICTS = "doc_id bigint, par_pos int, key string, dup boolean"
BATCHES = [["a\nb\na", "hot\nc"], ["a\nhot", "d\nhot\nd"], ["hot", "e\nb\n"], []]


@pytest.fixture
def batches(docs):
    """Micro-batches with rising document ids."""
    made, first = [], 0
    for texts in BATCHES:
        made.append(docs(*texts, first=first))
        first += len(texts)
    return made


def whole(batches):
    df = batches[0]
    for more in batches[1:]:
        df = df.unionByName(more)
    return df


@pytest.fixture
def folders(spark, tmp_path):
    streaming._open_seen(spark, str(tmp_path / "seen"))
    return str(tmp_path / "seen"), str(tmp_path / "out")


def test_batches_equal_the_whole(spark, batches, folders):
    for n, batch in enumerate(batches):
        streaming.dedup_batch(batch, "r1", n, *folders, "doc_id", "text")
    got = spark.read.schema(VERDICTS).parquet(folders[1]).drop("run", "batch_id")
    assert rows(got) == rows(dedup.dedup_first_seen(tokens.paragraph_hash(whole(batches))))


def test_replayed_batches_change_nothing(spark, batches, folders):
    for n in (0, 1, 1, 0, 2, 2, 3):
        streaming.dedup_batch(batches[n], "r1", n, *folders, "doc_id", "text")
    got = spark.read.schema(VERDICTS).parquet(folders[1]).drop("run", "batch_id")
    assert rows(got) == rows(dedup.dedup_first_seen(tokens.paragraph_hash(whole(batches))))


def test_compacted_table_goes_on(spark, batches, folders, tmp_path):
    seen, out = folders
    compact = str(tmp_path / "compact")
    for n in (0, 1, 2):
        streaming.dedup_batch(batches[n], "r1", n, seen, out, "doc_id", "text")
    streaming.compact_seen(spark, seen, compact)
    for n in (2, 3):
        streaming.dedup_batch(batches[n], "r1", n, compact, out, "doc_id", "text")
    got = spark.read.schema(VERDICTS).parquet(out).drop("run", "batch_id")
    assert rows(got) == rows(dedup.dedup_first_seen(tokens.paragraph_hash(whole(batches))))


def test_a_new_checkpoint_goes_on(spark, batches, folders):
    """A second run starts again at batch 0; nothing of the first is lost or seen anew."""
    for run, n in (("r1", 0), ("r1", 1), ("r2", 0), ("r2", 0), ("r2", 1)):
        batch = batches[n if run == "r1" else n + 2]
        streaming.dedup_batch(batch, run, n, *folders, "doc_id", "text")
    got = spark.read.schema(VERDICTS).parquet(folders[1]).drop("run", "batch_id")
    assert rows(got) == rows(dedup.dedup_first_seen(tokens.paragraph_hash(whole(batches))))


def test_documents(spark, batches, folders):
    for n, batch in enumerate(batches):
        streaming.documents_batch(batch, "r1", n, *folders, "doc_id", "text")
    got = spark.read.schema("doc_id bigint, text string, n_par int, n_dup int").parquet(folders[1])
    assert rows(got.drop("run", "batch_id")) == rows(corpus.deduplicate(whole(batches)))


def test_running_queries(spark, batches, tmp_path):
    """Both stream forms over files arriving one by one, then more of them."""
    source = str(tmp_path / "in")
    seen, out, cp = (str(tmp_path / n) for n in ("seen", "out", "cp"))

    def stream():
        return spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(source)

    def keys():
        streaming.stream_first_seen(stream()).writeStream.format("parquet").option(
            "checkpointLocation", cp + "k").trigger(availableNow=True).start(out + "k").awaitTermination()

    for n, batch in enumerate(batches[:3]):
        batch.coalesce(1).write.mode("append").parquet(source)
        if n != 1:
            streaming.stream_dedup(stream(), seen, out, cp).awaitTermination()
            keys()
    want = rows(dedup.dedup_first_seen(tokens.paragraph_hash(whole(batches))))
    got = spark.read.schema(VERDICTS).parquet(out).drop("run", "batch_id")
    assert rows(got) == want
    streaming.stream_dedup(stream(), seen, out + "2", cp + "2").awaitTermination()
    again = spark.read.schema(VERDICTS).parquet(out + "2")
    assert again.count() == len(want) and again.where("not dup").count() == 0
    assert rows(spark.read.schema("key string").parquet(out + "k")) == sorted({(v[2],) for v in want})


def test_corpus_batches_are_replayed_without_harm(spark, tmp_path):
    """Two runs over three batches, one replayed: the same text as without the replay."""
    long = " ".join(f"word{i}" for i in range(30))
    pages = [(f"p{i}", f"u{i}", "text/html", f"<head><title>t{i}</title></head><p>{long}</p><p>{long} {own}</p>")
             for i, own in enumerate(["a", "b", "a"])]
    make = lambda i: spark.createDataFrame([pages[i]], "doc_id string, uri string, content_type string, payload string")
    profile = spark.createDataFrame([("en", "", -9.0)], "lang string, gram string, logp double")
    lexicon = spark.createDataFrame([("a", "X", "a")], "form string, pos string, lemma string")

    def text(steps, name):
        seen, out = str(tmp_path / f"seen-{name}"), str(tmp_path / f"out-{name}")
        streaming._open_seen(spark, seen)
        for run, batch_id, page in steps:
            corpus_batch(make(page), run, batch_id, seen, out, profile, lexicon)
        return rows(spark.read.text(out), "value")

    plain = text([("r1", 0, 0), ("r1", 1, 1), ("r2", 0, 2)], "plain")
    assert plain == text([("r1", 0, 0), ("r1", 1, 1), ("r1", 1, 1), ("r2", 0, 2), ("r2", 0, 2)], "replayed")
    count = lambda word: sum(line[0].split("\t")[1:2] == [word] for line in plain)
    assert (count("word1"), count("a"), count("b"), count("t2")) == (3, 1, 1, 1)


def test_batches_read_what_their_keys_touch(spark, tmp_path, monkeypatch):
    """After a large first batch, small batches read a flat amount of the seen table, not all of it."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(streaming, "PART_BLOCKS", 1)
    seen, out = str(tmp_path / "seen"), str(tmp_path / "out")
    streaming._open_seen(spark, seen)

    def batch(first, docs, lines, word="p"):
        text = F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(lines - 1)), lambda x: F.concat(F.lit(word), (F.col("id") * lines + x).cast("string"))))
        return spark.range(first, first + docs).select(F.col("id").alias("doc_id"), text.alias("text"))

    streaming.dedup_batch(batch(0, 2000, 100), "r1", 0, seen, out, "doc_id", "text")
    reads = []
    for n in range(1, 9):
        streaming.dedup_batch(batch(10_000 + 10 * n, 2, 5, "q").unionByName(batch(n, 1, 5)), "r1", n, seen, out, "doc_id", "text")
        reads.append(streaming.LAST_READ["bytes"])
    stored = streaming._bytes_under(spark, [seen])
    assert max(reads) < stored / 3, (reads, stored)
    assert reads[-1] <= 1.5 * reads[1]
    got = spark.read.schema(VERDICTS).parquet(out).where("batch_id > 0")
    assert got.where("doc_id >= 10000 and dup").count() == 0 and got.where("doc_id < 10000 and not dup").count() == 0
    assert got.count() == 8 * 15


def test_one_archive_is_the_work_of_all_cores(spark, tmp_path):
    """Records that arrive in one partition are dealt out before their HTML is read."""
    long = " ".join(f"word{i}" for i in range(30))
    pages = [(f"p{i}", f"u{i}", "text/html", f"<head><title>t{i}</title></head><p>{long} {i}</p>") for i in range(64)]
    batch = spark.createDataFrame(pages, "doc_id string, uri string, content_type string, payload string").coalesce(1)
    profile = spark.createDataFrame([("en", "", -9.0)], "lang string, gram string, logp double")
    lexicon = spark.createDataFrame([("a", "X", "a")], "form string, pos string, lemma string")
    seen, out = str(tmp_path / "seen"), str(tmp_path / "out")
    streaming._open_seen(spark, seen)
    corpus_batch(batch, "r1", 0, seen, out, profile, lexicon)
    files = list((tmp_path / "seen-work" / "r1" / "articles").glob("*.parquet"))
    assert len(files) >= spark.sparkContext.defaultParallelism
    assert spark.read.text(out).where("value like '%<doc id=%'").count() == 64
