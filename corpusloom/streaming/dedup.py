"""First-seen deduplication of a document stream.

``stream_first_seen`` keeps keys in the state store and emits first copies.
``stream_dedup`` and ``stream_documents`` give a verdict for every copy: inside
a micro-batch by the exact batch operators, against earlier batches by a table
of keys seen so far.

The seen table is a log-structured set of segments.  Each batch stores its new
keys as a segment of level 0; every ``FANOUT`` segments of one level are merged
into one of the next.  A segment holds its keys and a blocked Bloom filter of
them, both partitioned by block range (``part``).  A batch reads, of each live
segment, the bitmaps of the parts its keys fall in, and the keys only of parts
where a bitmap may hit: what it reads grows with the batch and the number of
levels, not with the keys seen so far.

Rows carry their run and batch; a batch reads rows of earlier batches and of
other runs only, and a replayed batch overwrites its own segment, so every
batch takes effect exactly once, also after a start with a new checkpoint.  A
run is one checkpoint.  Two runs must not write to one table at the same time.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.operators.bloom import BloomSpec, _block, bloom_build, bloom_probe, bloom_spec
from corpusloom.operators.dedup import first_copies, keep_paragraphs
from corpusloom.operators.tokens import paragraph_hash
from corpusloom.staging import stage

SALTS = 64
SEEN_SCHEMA = "k binary, run string, batch_id bigint"
#: Segments merged into one of the next level, and Bloom blocks of 32,768 bits in one stored part.
FANOUT, PART_BLOCKS = 4, 16


def run_of(checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def part(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def stream_first_seen(sdf: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``: every paragraph key once, when it is first seen.

    State never expires.  A first pass on key and salt takes the weight of a
    very frequent paragraph off the task that owns its key: that task sees it
    at most ``SALTS`` times, ever.
    """
    keys = paragraph_hash(sdf, id, text).select(
        "key", F.pmod(F.xxhash64(id), F.lit(SALTS)).alias("salt")
    )
    return keys.dropDuplicates(["key", "salt"]).select("key").dropDuplicates(["key"])


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path, as Spark itself opens them."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _read_small(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_small(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _fs(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


class Segment(NamedTuple):
    """A stored run of seen keys: ``keys`` and ``bloom`` tables partitioned by ``part``."""

    path: str
    name: str
    level: int
    spec: BloomSpec
    replaces: tuple[str, ...]


def live_segments(spark: SparkSession, seen: str) -> list[Segment]:
    """Committed segments of a seen table that no other live one replaces.

    A segment is committed when its ``_spec`` file exists; it is written last.
    """
    fs, jpath = _fs(spark, seen)
    if not fs.exists(jpath):
        return []
    found = []
    for status in fs.listStatus(jpath):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith("L"):
            continue
        spec = _read_small(spark, f"{seen}/{name}/_spec")
        if spec is None:
            continue
        replaces = tuple(filter(None, (_read_small(spark, f"{seen}/{name}/_replaces") or "").split("\n")))
        found.append(Segment(f"{seen}/{name}", name, int(name[1:].split("-", 1)[0]), BloomSpec(*map(int, spec.split())), replaces))
    gone = {old for seg in found for old in seg.replaces}
    return [seg for seg in found if seg.name not in gone]


def _part(key: Column, spec: BloomSpec) -> Column:
    """The part of a hexadecimal key: its Bloom block, in groups of ``PART_BLOCKS``."""
    return F.floor(_block(key, spec) / PART_BLOCKS).cast("int")


#: Bytes of seen-table files read by the last batch, for tests and logs.
LAST_READ = {"bytes": 0}


def _bytes_under(spark: SparkSession, folders: list[str]) -> int:
    total = 0
    for folder in folders:
        fs, jpath = _fs(spark, folder)
        if fs.exists(jpath):
            total += fs.getContentSummary(jpath).getLength()
    return total


def _hits(spark: SparkSession, firsts: DataFrame, seen: str, run: str, batch_id: int) -> DataFrame | None:
    """Keys of ``firsts`` stored by earlier batches or other runs.

    Each live segment is asked through the Bloom bitmaps of the parts that the
    batch's keys fall in; keys are then read only from parts where one may hit.
    So a batch reads what its own keys touch, not the seen table.
    """
    found, read = [], []
    for seg in live_segments(spark, seen):
        probes = firsts.select("key").withColumn("part", _part(F.col("key"), seg.spec))
        parts = [r.part for r in probes.select("part").distinct().collect()]
        if not parts:
            continue
        read += [f"{seg.path}/bloom/part={p}" for p in parts]
        bloom = spark.read.option("basePath", f"{seg.path}/bloom").parquet(f"{seg.path}/bloom").where(F.col("part").isin(parts))
        maybe = stage(bloom_probe(probes, bloom.drop("part")).where("maybe_seen").select("key", "part"), "maybe")
        hot = [r.part for r in maybe.select("part").distinct().collect()]
        if not hot:
            continue
        read += [f"{seg.path}/keys/part={p}" for p in hot]
        keys = spark.read.schema(f"{SEEN_SCHEMA}, part int").option("basePath", f"{seg.path}/keys").parquet(f"{seg.path}/keys")
        keys = keys.where(F.col("part").isin(hot) & ((F.col("run") != run) | (F.col("batch_id") < batch_id)))
        found.append(keys.select("k").join(maybe.select(F.unhex("key").alias("k")), "k", "left_semi"))
    LAST_READ["bytes"] = _bytes_under(spark, read)
    if not found:
        return None
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return hits


def _open_seen(spark: SparkSession, path: str) -> None:
    """Make the seen table's folder before the first batch."""
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def _new_firsts(batch: DataFrame, run: str, batch_id: int, seen: str, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Keys of the batch and its first copies not seen in earlier batches.

    The tables of a batch are stored in the place of those of the batch before.
    """
    spark, work = batch.sparkSession, f"{seen}-work/{run}"
    pars = stage(paragraph_hash(batch, id, text), "keys", f"{work}/keys")
    firsts = first_copies(pars, id).withColumn("k", F.unhex("key"))
    firsts = stage(firsts, "firsts", f"{work}/firsts")
    hits = _hits(spark, firsts, seen, run, batch_id)
    new = firsts if hits is None else firsts.join(hits, "k", "left_anti")
    return pars, stage(new, "new", f"{work}/new")


def _write_segment(spark: SparkSession, rows: DataFrame, path: str, replaces: list[str]) -> bool:
    """Store ``k, run, batch_id`` as a segment with its Bloom bitmaps; false if there is nothing to store.

    ``_spec`` goes last, so a segment cut short by a failure is never read.
    """
    fs, jpath = _fs(spark, path)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spec"), False)
    rows = stage(rows.select("k", "run", "batch_id"), "segment")
    n = rows.count()
    if n == 0:
        return False
    spec = bloom_spec(n)
    hexed = rows.withColumn("key", F.lower(F.hex("k")))
    hexed.withColumn("part", _part(F.col("key"), spec)).select("k", "run", "batch_id", "part") \
        .write.mode("overwrite").partitionBy("part").parquet(f"{path}/keys")
    bloom = bloom_build(hexed, "key", n=n)
    bloom.withColumn("part", F.floor(F.col("bucket") / PART_BLOCKS).cast("int")) \
        .write.mode("overwrite").partitionBy("part").parquet(f"{path}/bloom")
    _write_small(spark, f"{path}/_replaces", "\n".join(replaces))
    _write_small(spark, f"{path}/_spec", " ".join(str(v) for v in spec))
    return True


def _read_keys(spark: SparkSession, segments: list[Segment]) -> DataFrame:
    tables = [spark.read.schema(f"{SEEN_SCHEMA}, part int").parquet(f"{s.path}/keys").select("k", "run", "batch_id") for s in segments]
    keys = tables[0]
    for more in tables[1:]:
        keys = keys.unionByName(more)
    return keys


def compact_levels(spark: SparkSession, seen: str, fanout: int = FANOUT) -> None:
    """Merge every ``fanout`` segments of one level into one of the next, as a log-structured tree.

    Each key is rewritten once a level, so ``log(n) / log(fanout)`` times in
    all, and at most ``fanout - 1`` segments of each level stay live.  Rows keep
    their run and batch, so replays still see only what came before them.
    Replaced segments are removed once the merged one is committed.
    """
    while True:
        live = live_segments(spark, seen)
        levels: dict[int, list[Segment]] = {}
        for seg in live:
            levels.setdefault(seg.level, []).append(seg)
        full = sorted(level for level, segs in levels.items() if len(segs) >= fanout)
        if not full:
            return
        level, segs = full[0], sorted(levels[full[0]], key=lambda s: s.name)
        merged = f"{seen}/L{level + 1}-{uuid.uuid4().hex}"
        _write_segment(spark, _read_keys(spark, segs).distinct(), merged, [s.name for s in segs])
        for seg in segs:
            fs, jpath = _fs(spark, seg.path)
            fs.delete(jpath, True)


def _store_seen(new: DataFrame, seen: str, run: str, batch_id: int) -> None:
    spark = new.sparkSession
    rows = new.select("k", F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id"))
    if _write_segment(spark, rows, f"{seen}/L0-{run}-{batch_id}", []):
        compact_levels(spark, seen)


def compact_seen(spark: SparkSession, seen: str, into: str) -> None:
    """Copy a seen table to a new path as one segment.

    Rows keep their run and batch, so the last batch of a run may still be
    replayed against the copy.  Run it between runs of the stream and start the
    next with the new path.
    """
    _open_seen(spark, into)
    live = live_segments(spark, seen)
    if live:
        _write_segment(spark, _read_keys(spark, live).distinct(), f"{into}/L{max(s.level for s in live) + 1}-{uuid.uuid4().hex}", [])


def dedup_batch(batch: DataFrame, run: str, batch_id: int, seen: str, out: str, id: str, text: str) -> None:
    """Verdicts of one micro-batch: output first, then the seen keys."""
    pars, new = _new_firsts(batch, run, batch_id, seen, id, text)
    marks = new.select(id, "par_pos", F.lit(True).alias("first"))
    verdicts = pars.join(marks, [id, "par_pos"], "left").select(
        id, "par_pos", "key", F.col("first").isNull().alias("dup")
    )
    verdicts.write.mode("overwrite").parquet(part(out, run, batch_id))
    _store_seen(new, seen, run, batch_id)


def documents_batch(batch: DataFrame, run: str, batch_id: int, seen: str, out: str, id: str, text: str) -> None:
    """Re-assembled documents of one micro-batch."""
    _, new = _new_firsts(batch, run, batch_id, seen, id, text)
    docs = keep_paragraphs(batch.select(id, text), new, id, text)
    docs.write.mode("overwrite").parquet(part(out, run, batch_id))
    _store_seen(new, seen, run, batch_id)


def _start(sdf: DataFrame, work, seen: str, out: str, checkpoint: str, id: str, text: str):
    _open_seen(sdf.sparkSession, seen)
    run = run_of(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        work(batch, run, batch_id, seen, out, id, text)

    return (
        sdf.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_dedup(
    sdf: DataFrame, seen: str, out: str, checkpoint: str, id: str = "doc_id", text: str = "text"
):
    """Start a query writing ``id, par_pos, key, dup`` to ``out``."""
    return _start(sdf, dedup_batch, seen, out, checkpoint, id, text)


def stream_documents(
    sdf: DataFrame, seen: str, out: str, checkpoint: str, id: str = "doc_id", text: str = "text"
):
    """Start a query writing ``id, text, n_par, n_dup`` to ``out``."""
    return _start(sdf, documents_batch, seen, out, checkpoint, id, text)
