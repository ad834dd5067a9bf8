"""Exact top-k search by inner product with a vector-approximation file.

Weber, Schek and Blott (VLDB 1998), on Spark:

1. Equal vectors become one row, with the ``k + 1`` least ids that have it: no
   result can need more of them.
2. Every vector is quantised: one byte per component names its cell, and cell
   borders come from a bounded sample (``SAMPLE`` vectors).  Every vector is
   indexed; the outermost cells reach to the true extremes.
3. Scan: blocks of queries meet blocks of approximations.  The cells bound each
   product from below and above; who cannot reach the kth lower bound is out.
4. Reading: exact vectors are joined to the best ``READ`` candidates of each
   query in the order of their upper bounds, then to those whose upper bound
   still reaches the kth exact score.  After that the result is certain.

Blocks have a bounded size, so a task holds a few megabytes; all rows that the
scan hands on are candidates, never all pairs.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.staging import stage

SAMPLE = 4096
CELLS = 64
QUERY_BLOCK, VECTOR_BLOCK = 1024, 4096
#: Blocks of approximations that one task scans with one running threshold.
GROUP = 64
LEAST_TASKS = 32
READ = 3


def _integers(batches, scale: float, width: int):
    """``floor(scale * x)`` of usable vectors as 64-bit numbers, padded with zeros to ``width``."""
    for batch in batches:
        ids, rows = [], []
        for i, values in zip(batch.column(0), batch.column(1), strict=True):
            if values.values is None or values.values.null_count or not i.is_valid:
                continue
            x = np.floor(scale * values.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                row = np.zeros(width, np.int64)
                row[:len(x)] = x
                ids.append(i)
                rows.append(row.tobytes())
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i in ids], batch.column(0).type), pa.array(rows, pa.binary())], ["vec_id", "v"])


def _matrix(values: list[bytes], kind=np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _extremes(batches):
    low = high = None
    for batch in batches:
        if batch.num_rows:
            m = _matrix(batch.column(0).to_pylist())
            low = m.min(0) if low is None else np.minimum(low, m.min(0))
            high = m.max(0) if high is None else np.maximum(high, m.max(0))
    if low is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([low.tolist()], pa.list_(pa.int64())), pa.array([high.tolist()], pa.list_(pa.int64()))], ["low", "high"])


def cell_borders(sample: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer of every cell, ``(dimensions, CELLS)`` each."""
    cuts = np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="inverted_cdf").T.astype(np.int64)
    cuts = np.clip(cuts, low[:, None], high[:, None])
    least = np.concatenate((low[:, None], cuts), axis=1)
    greatest = np.maximum(np.concatenate((cuts - 1, high[:, None]), axis=1), least)
    return least, greatest


def _cells(batches, least: np.ndarray):
    """The cell of every component: how many cuts it reaches."""
    for batch in batches:
        if batch.num_rows:
            m = _matrix(batch.column(1).to_pylist())
            cells = np.empty(m.shape, np.uint8)
            for d in range(m.shape[1]):
                cells[:, d] = np.searchsorted(least[d, 1:], m[:, d], "right")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in cells], pa.binary())], ["rep", "cells"])


def _slack(q: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """The most that a bound computed in floats can miss for each query; 0 where all sums are exact."""
    most = np.abs(q) @ np.maximum(np.abs(least), np.abs(greatest)).max(axis=1)
    return np.where(most < 2.0**52, 0, np.ceil((2 * q.shape[1] + 16) * 2.0**-52 * most))[:, None]


def _whole(bounds: np.ndarray) -> np.ndarray:
    """Whole floats as 64-bit numbers, those beyond as the outermost."""
    ends = np.iinfo(np.int64)
    inner = np.abs(bounds) < 2.0**63
    return np.where(inner, np.where(inner, bounds, 0).astype(np.int64), np.where(bounds > 0, ends.max, ends.min))


def _scan(key, queries: pa.Table, blocks: pa.Table, k: int, borders) -> pa.Table:
    """Candidates of a block of queries in a group of approximations, with their bounds."""
    least, greatest = (b.astype(np.float64) for b in borders)
    q = _matrix(queries.column("v").to_pylist()).astype(np.float64)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    slack = _slack(q, least, greatest)
    best = np.full((len(q), k), -np.inf)
    dims = np.arange(q.shape[1])
    found = []
    for start in range(0, blocks.num_rows, VECTOR_BLOCK):
        part = blocks.slice(start, VECTOR_BLOCK)
        cells = _matrix(part.column("cells").to_pylist(), np.uint8)
        low, high = least[dims, cells].T, greatest[dims, cells].T
        lower, upper = up @ low + down @ high - slack, up @ high + down @ low + slack
        best = -np.partition(-np.concatenate((best, lower), axis=1), k - 1, axis=1)[:, :k]
        i, j = np.nonzero(upper >= best.min(axis=1)[:, None])
        found.append((i, j + start, lower[i, j], upper[i, j]))
    i, j, lower, upper = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 4
    keep = upper >= best.min(axis=1)[i]
    return pa.table({
        "query": queries.column("query").take(pa.array(i[keep])), "rep": blocks.column("rep").take(pa.array(j[keep])),
        "lower": pa.array(_whole(lower[keep])), "upper": pa.array(_whole(upper[keep]))})


def _products(batches):
    for batch in batches:
        if batch.num_rows:
            scores = (_matrix(batch.column(2).to_pylist()) * _matrix(batch.column(3).to_pylist())).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["query", "rep", "score"])


def _first(rows: DataFrame, per: str, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group; tasks keep ``n`` a group before they shuffle."""
    number = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return rows.withColumn("_row", number).where(F.col("_row") <= n).drop("_row")


def top_k(vectors: DataFrame, asked, k: int = 20, scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row that meets ``asked``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``asked`` is a condition on
    ``vec_id``.  A vector's components become ``floor(scale * x)``; the score is
    the inner product of these numbers, ties go to the lesser ``vec_id``, and a
    row is no result of itself.  Fewer results than ``k`` come out when there
    are fewer rows.  Rows whose id or vector is null, or whose vector holds
    null, NaN or an infinity, take no part.  Shorter vectors are padded with
    zeros; rows that repeat an id and its vector count once.  Scores must fit
    64 bits.  Other columns are not read.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    vectors = vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, width)
    usable = vectors.mapInArrow(partial(_integers, scale=scale, width=width), f"vec_id {kind}, v binary").distinct()
    rows = stage(usable.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")}), "vectors")
    classes = stage(
        rows.groupBy("k1", "k2").agg(
            F.min("vec_id").alias("rep"), F.first("v").alias("v"), F.max(asked(F.col("vec_id"))).alias("asked")), "classes")
    totals = classes.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    if not totals.q:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    found = _classes_found(classes, totals.n, totals.q, k + 1, kind)

    # From classes to rows: the best k + 1 rows of each asked class, one list per class.
    keyed = rows.select("k1", "k2", "vec_id").join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("rep", "vec_id")
    members = _first(keyed, "rep", [F.col("vec_id")], k + 1)
    best = _first(found.join(members, "rep").select("query", "score", "vec_id"), "query",
                  [F.desc("score"), F.col("vec_id")], k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("id")))).alias("best"))
    queries = keyed.where(asked(F.col("vec_id"))).select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"))
    others = F.filter("best", lambda x: x["id"] != F.col("query_id"))
    ranked = queries.join(lists, "query").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "hit"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"),
                         (-F.col("hit.minus")).alias("score"))


def _classes_found(classes: DataFrame, n: int, n_queries: int, k: int, kind: str) -> DataFrame:
    """``query, rep, score``: at least the ``k`` best classes for each asked class."""
    edges = classes.select("v").mapInArrow(_extremes, "low array<long>, high array<long>")
    ends = edges.select(F.posexplode(F.arrays_zip("low", "high"))).groupBy("pos").agg(
        F.min("col.low").alias("low"), F.max("col.high").alias("high")).orderBy("pos").collect()  # one row a dimension
    sample = classes.orderBy(F.xxhash64(F.lit(2), "rep"), "rep").limit(SAMPLE).select("v").collect()
    borders = cell_borders(_matrix([bytes(r.v) for r in sample]), *(np.array([r[c] for r in ends]) for c in ("low", "high")))

    query_blocks, blocks = -(-n_queries // QUERY_BLOCK), -(-n // VECTOR_BLOCK)
    groups = min(blocks, max(-(-blocks // GROUP), -(-LEAST_TASKS // query_blocks)))
    cells = classes.select("rep", "v").mapInArrow(partial(_cells, least=borders[0]), f"rep {kind}, cells binary")
    grouped = cells.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(groups)))
    scanned = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = classes.where("asked").select(
        F.col("rep").alias("query"), "v", F.pmod(F.xxhash64(F.lit(3), "rep"), F.lit(query_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"))
    candidates = queries.groupBy("block", "part").cogroup(scanned.groupBy("block", "part")).applyInArrow(
        lambda key, a, b: _scan(key, a, b, k, borders), f"query {kind}, rep {kind}, lower long, upper long")
    candidates = stage(candidates, "candidates")

    numbered = candidates.withColumn("_row", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("lower"), "rep"))).where(F.col("_row") == k)
    certain = candidates.join(numbered.select("query", F.col("lower").alias("floor")), "query", "left").where(
        "floor is null or upper >= floor").select("query", "rep", "upper")
    ranked = stage(certain.withColumn("place", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("upper"), "rep"))), "reading-order")

    def exact(pairs: DataFrame) -> DataFrame:
        v = classes.select("rep", "v")
        both = pairs.join(v.toDF("query", "v_query"), "query").join(v, "rep")
        return both.select("query", "rep", "v_query", "v").mapInArrow(_products, f"query {kind}, rep {kind}, score long")

    first = stage(exact(ranked.where(F.col("place") <= READ * k)), "read-first")
    kth = first.withColumn("_row", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), "rep"))).where(F.col("_row") == k)
    rest = ranked.where(F.col("place") > READ * k).join(kth.select("query", "score"), "query", "left").where(
        "score is null or upper >= score")
    both = first.unionByName(stage(exact(rest.select("query", "rep")), "read-rest"))
    return _first(both, "query", [F.desc("score"), F.col("rep")], k)
