"""Per-stage counts and timings as tables."""

from __future__ import annotations

import socket
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROFILE_SCHEMA = (
    "deployment_id string, bolt_type string, tuple_uuid string, num_elements bigint, "
    "hostname string, timestamp timestamp_ntz, time bigint"
)


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """``stage, n, selectivity``: rows left after each successive filter.

    All stages are counted in one pass; selectivity is the share of the stage
    before, null for the first one and after an empty one.
    """
    passed, counts = F.lit(True), []
    for condition in stages.values():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed))
    totals = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)])
    entries = [
        F.struct(
            F.lit(name).alias("stage"), F.col(f"n{i}").alias("n"),
            (F.try_divide(F.col(f"n{i}"), F.col(f"n{i - 1}")) if i else F.lit(None))
            .cast("double").alias("selectivity"),
        )
        for i, name in enumerate(stages)
    ]
    rows = totals.select(F.explode(F.array(*entries)).alias("s"))
    return rows.select("s.stage", "s.n", F.round("s.selectivity", 9).alias("selectivity"))


class StageProfiler:
    """Counts rows at named points of a plan while it runs.

    ``watch`` marks a point; the counts arrive with the action that runs the
    plan, without a pass of their own.  ``rows`` then gives one profiling row
    per point.
    """

    def __init__(self, deployment_id: str | None = None):
        self.deployment_id = deployment_id or str(uuid.uuid4())
        self.observations: list[tuple[str, Observation]] = []
        self.started = time.monotonic_ns()

    def watch(self, stage: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{stage}-{uuid.uuid4().hex}")
        self.observations.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def rows(self, spark: SparkSession) -> DataFrame:
        elapsed = time.monotonic_ns() - self.started
        return profile_rows(spark, self.deployment_id, {s: o.get["n"] for s, o in self.observations}, elapsed)


def profile_rows(
    spark: SparkSession, deployment_id: str, counts: dict[str, int], elapsed: int = 0, block: str = "all"
) -> DataFrame:
    """The profiling table for a handful of stage counts; time in nanoseconds."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    host = socket.gethostname()
    rows = [(deployment_id, stage, block, n, host, now, elapsed) for stage, n in counts.items()]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Profiling rows of streaming queries, one per phase and micro-batch.

    A query itself remembers its last hundred batches only; this listener gets
    every one.  Add it with ``spark.streams.addListener`` before the query
    starts.  ``rows`` gives what has come in, ``flush`` appends that to a
    Parquet table and forgets it, which a long run should do now and then.
    """

    def __init__(self, deployment_id: str | None = None):
        self.deployment_id = deployment_id or str(uuid.uuid4())
        self.host, self.seen = socket.gethostname(), []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
        self.seen += [(self.deployment_id, phase, str(p.batchId), p.numInputRows, self.host, at, millis * 1_000_000)
                      for phase, millis in p.durationMs.items()]

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.seen), PROFILE_SCHEMA)

    def flush(self, spark: SparkSession, path: str) -> None:
        taken, self.seen = self.seen, []
        if taken:
            write_profile(spark.createDataFrame(taken, PROFILE_SCHEMA), path)


def write_profile(df: DataFrame, path: str) -> None:
    """Append profiling rows to a Parquet table, one folder per deployment."""
    df.write.mode("append").partitionBy("deployment_id").parquet(path)


def write_profile_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append profiling rows to a database table of the caller."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def _summary() -> list[Column]:
    return [
        F.count("*").alias("n"), F.sum("time").alias("total"),
        F.round(F.avg("time"), 3).alias("avg"), F.max("time").alias("max"),
    ]


def profile_by_stage(profile: DataFrame) -> DataFrame:
    """``deployment_id, bolt_type, n, elements, total, avg, max``."""
    return profile.groupBy("deployment_id", "bolt_type").agg(
        F.sum("num_elements").alias("elements"), *_summary()
    )


def profile_by_host(profile: DataFrame) -> DataFrame:
    """``deployment_id, hostname, bolt_type, n, total, avg, max``: load per host."""
    return profile.groupBy("deployment_id", "hostname", "bolt_type").agg(*_summary())


def profile_by_time(profile: DataFrame, width: str = "1 hour") -> DataFrame:
    """``bucket, deployment_id, bolt_type, n, total, avg, max``: activity per time bucket."""
    bucket = F.window("timestamp", width)["start"].alias("bucket")
    return profile.groupBy(bucket, "deployment_id", "bolt_type").agg(*_summary())


def profile_trace(profile: DataFrame) -> DataFrame:
    """``deployment_id, tuple_uuid, first_seen, last_seen, n, total, avg, max``: one block's way."""
    return profile.groupBy("deployment_id", "tuple_uuid").agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), *_summary()
    )
