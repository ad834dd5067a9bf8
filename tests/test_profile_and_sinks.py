import glob
import time

from pyspark.sql import functions as F

from corpusloom.operators import lookup, profile
from corpusloom.sources import sinks, tables
from tests.conftest import rows


def test_stage_counts(spark):
    df = spark.range(10)
    got = profile.stage_counts(df, {"all": F.lit(True), "big": F.col("id") > 4, "none": F.col("id") < 2, "after": F.lit(True)})
    assert [tuple(r) for r in got.collect()] == [("all", 10, None), ("big", 5, 0.5), ("none", 0, 0.0), ("after", 0, None)]


def test_null_conditions_do_not_pass(spark):
    df = spark.createDataFrame([("en",), (None,)], "lang string")
    assert [r.n for r in profile.stage_counts(df, {"en": F.col("lang") == "en"}).collect()] == [1]


def test_observed_rows(spark, tmp_path):
    watch = profile.StageProfiler("d1")
    df = watch.watch("even", watch.watch("all", spark.range(10)).where("id % 2 = 0"))
    df.write.format("noop").mode("overwrite").save()
    table = watch.rows(spark)
    assert rows(table, "bolt_type", "num_elements") == [("all", 10), ("even", 5)]
    profile.write_profile(table, str(tmp_path / "p"))
    profile.write_profile(table, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert rows(profile.profile_by_stage(stored), "bolt_type", "elements", "n") == [("all", 20, 2), ("even", 10, 2)]


def test_stream_progress_rows(spark, tmp_path):
    spark.range(0, 120, 1, 120).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    log = profile.ProgressLog("d")
    spark.streams.addListener(log)
    run = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination()
    for _ in range(100):
        if len({row[2] for row in log.seen}) >= 120:
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    got = log.rows(spark).where("bolt_type = 'addBatch' and num_elements = 1")
    assert len(run.recentProgress) < 120 <= got.select("tuple_uuid").distinct().count()
    log.flush(spark, str(tmp_path / "p"))
    assert not log.seen and spark.read.parquet(str(tmp_path / "p")).where("bolt_type = 'addBatch'").count() >= 120


def test_files_roll_over(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.range(25).select(F.concat(F.lit("a\nb\n"), "id", F.lit("\n")).alias("vertical"))
    df = df.unionByName(spark.createDataFrame([("",), (None,)], "vertical string"))
    sinks.write_vertical(df.coalesce(1), path, docs_per_file=10)
    files = glob.glob(f"{path}/part-*")
    sizes = sorted(sum(line == "a\n" for line in open(f)) for f in files)
    assert sizes == [5, 10, 10]


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    table = spark.createDataFrame([("hot", 1), ("5", 2), ("7", 3), ("unused", 4)], "k string, v int")
    plain = rows(facts.join(table, "k", "left"), "id", "k", "v")
    for limit in (64 << 20, 0):
        assert rows(lookup.lookup(facts, table, ["k"], 16, limit), "id", "k", "v") == plain


def test_size_check_counts_bytes(spark):
    long = spark.createDataFrame([("x" * 1000,)], "form string")
    assert lookup.fits_broadcast(long, 16, 2000) and not lookup.fits_broadcast(long, 16, 1000)


def test_reports_keep_deployments_apart(spark):
    rows_ = [(d, "s", "b", 1, "h", None, 5) for d in ("d1", "d2", "d2")]
    table = spark.createDataFrame(rows_, profile.PROFILE_SCHEMA)
    assert rows(profile.profile_by_stage(table), "deployment_id", "n") == [("d1", 1), ("d2", 2)]
    assert rows(profile.profile_trace(table), "deployment_id", "tuple_uuid", "n") == [("d1", "b", 1), ("d2", "b", 2)]


def test_size_check_reads_no_further_than_the_bound(spark):
    assert lookup.fits_broadcast(spark.range(10), 1, 10)
    assert not lookup.fits_broadcast(spark.range(11), 1, 10)


def test_spread_leaves_wide_inputs_alone(spark):
    assert tables.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() >= 8
    wide = spark.range(100, numPartitions=50)
    assert tables.spread(wide) is wide
