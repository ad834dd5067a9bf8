"""Near-duplicate documents: many universal hash minima, bands, verified links, components.

1. One pass over the texts gives each document the size of its shingle set, a
   128-bit key of the set and the minima of ``bands * rows`` universal hashes.
2. Documents with equal sets form a class; only one of each class goes on.
3. Bands of minima put classes into buckets.  In each bucket all members are
   compared with the member that shares most buckets with others: first by
   their signatures, then on full sets.  Components follow.
   Buckets with the same centre, as a large group of near copies has in every
   band, count as one.
4. What is left are pairs with one centre whose components differ.  They are all
   compared, but for those that counts rule out.  A shingle that no other
   contested document has is in no intersection.  Of the others, those inside
   and those outside the centre are counted apart, and the sum of the
   lesser counts bounds the intersection.  Documents with equal counts are one
   block, and only blocks whose bounds allow a link are opened into pairs.

A group of thousands of near copies thus costs one comparison per copy and
bucket, and copies far from all others cost nothing.  No link is given up for
the size of a bucket.  A link between two texts at the threshold itself is
missed with a probability below ``MISS``, a closer one less often.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrays import Texts, binaries, mix, slices
from corpusloom.llm.components import connected_components
from corpusloom.operators.lookup import fits_broadcast
from corpusloom.staging import stage

ROWS = 5
MISS = 1e-6
#: Standard deviations below the threshold at which a signature rules a pair out.
SLACK = 6
#: Ids are broadcast up to so many bytes, 40 to a row.
ID_BYTES, ID_ROW = 64 << 20, 40
SIZE_STEP = 1.03
#: Bytes of text hashed at once; workers that have run keep what they held.
HASH_BYTES = 1 << 18


def bands_for(percent: int, rows: int = ROWS) -> int:
    """Bands with which a pair at the threshold is missed with probability ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def _constants(n: int) -> np.ndarray:
    return np.random.default_rng(7919).integers(0, 2**63, n, dtype=np.uint64)


def shingle_sets(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of word shingles, sorted in each document, and their bounds.

    A document of fewer words has its whole sequence as its one shingle; one
    without words has none.
    """
    texts = texts.lowered()
    starts, ends = texts.words
    hashes = texts.hashes(starts, ends)
    bounds = np.concatenate(([0], np.cumsum(texts.counts(starts))))
    factors = _constants(words) | np.uint64(1)
    padded = np.concatenate((hashes, np.zeros(words, np.uint64)))
    rolled = np.zeros(len(hashes), np.uint64)
    for k, factor in enumerate(factors):
        rolled += padded[k:k + len(hashes)] * factor
    rolled = mix(rolled)
    found = []
    for i in range(len(texts)):
        low, high = bounds[i], bounds[i + 1]
        if high - low >= words:
            found.append(np.unique(rolled[low:high - words + 1]))
        elif high > low:
            found.append(mix((hashes[low:high] * factors[:high - low]).sum(keepdims=True)))
        else:
            found.append(hashes[:0])
    sizes = np.array([len(x) for x in found], np.int64)
    return (np.concatenate(found) if found else hashes[:0]), np.concatenate(([0], np.cumsum(sizes)))


def minima(sets: np.ndarray, bounds: np.ndarray, hashes: int) -> np.ndarray:
    """``hashes`` minima of each non-empty set, one row per set."""
    filled = bounds[:-1][np.diff(bounds) > 0]
    folded = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(filled), hashes), np.uint32)
    if len(filled):
        seeds = _constants(2 * hashes + 64)[64:].astype(np.uint32).reshape(2, hashes)
        for k in range(hashes):
            out[:, k] = np.minimum.reduceat(folded * (seeds[0, k] | np.uint32(1)) + seeds[1, k], filled)
    return out


def _signatures(batches, words: int, hashes: int):
    for batch, texts in slices(batches, size=HASH_BYTES):
        sets, bounds = shingle_sets(texts, words)
        sizes = np.diff(bounds)
        filled = sizes > 0
        total = [np.concatenate(([0], np.cumsum(mix(sets * np.uint64(odd)))))[bounds].astype(np.uint64)
                 for odd in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)]
        keys = [pa.array(np.diff(t).view(np.int64), mask=~filled) for t in total]
        ends = np.concatenate(([0], np.cumsum(filled * hashes)))
        signature = binaries(minima(sets, bounds, hashes), ends)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), *keys, signature], ["doc_id", "n_shingles", "f1", "f2", "sig"])


def _bands(batches, rows: int):
    for batch in batches:
        if batch.num_rows:
            sigs = _matrix(batch.column(2))
            n, bands = len(sigs), sigs.shape[1] // rows
            parts = sigs.reshape(n, bands, rows).astype(np.uint64)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
            for k in range(rows):
                key = mix(key * np.uint64(31) + parts[:, :, k] + np.uint64(1))
            lists = pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), key.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["rep", "n", "buckets"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of 32-bit numbers."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), -1)


def _sets(batches, words: int):
    for batch, texts in slices(batches, size=HASH_BYTES):
        sets, bounds = shingle_sets(texts, words)
        yield pa.RecordBatch.from_arrays([batch.column(0), binaries(sets, bounds)], ["doc_id", "set"])


def _alike(batches, least: int):
    for batch in batches:
        if batch.num_rows:
            same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(same))


def _compared(batches, percent: int):
    for batch in batches:
        both, linked = [], []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both.append(len(np.intersect1d(x, y, assume_unique=True)))
            linked.append(100 * both[-1] >= percent * (len(x) + len(y) - both[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(linked, pa.bool_())],
            ["a", "b", "both", "linked"])


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents whose id is (``left_semi``) or is not (``left_anti``) in ``ids``.

    The stored ids are broadcast when few.  Documents without an id are in none.
    """
    if fits_broadcast(ids, ID_ROW, ID_BYTES):
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", how)


class _Search:
    """One run of the operator: the texts, the classes and how links are confirmed."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent = docs.where("doc_id is not null"), words, percent
        self.bands = bands_for(percent)
        self.hashes = self.bands * ROWS
        kind = docs.schema["doc_id"].dataType.simpleString()
        self.kind = kind
        everything = docs.mapInArrow(
            partial(_signatures, words=words, hashes=self.hashes),
            f"doc_id {kind}, n_shingles long, f1 long, f2 long, sig binary")
        self.rows = stage(everything, "signatures")
        classes = self.rows.where("f1 is not null and doc_id is not null").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        self.classes = stage(classes, "classes")

    def members(self) -> DataFrame:
        """``bucket, rep, n`` for buckets of two classes or more."""
        lists = self.classes.select("rep", "n", "sig").mapInArrow(
            partial(_bands, rows=ROWS), f"rep {self.kind}, n long, buckets array<long>")
        rows = lists.select("rep", "n", F.explode("buckets").alias("bucket"))
        shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        return stage(rows.join(shared, "bucket"), "buckets")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """``a, b, both, linked`` of the pairs whose signatures are alike, from full sets."""
        t = self.percent / 100
        least = math.floor(self.hashes * t - SLACK * math.sqrt(self.hashes * t * (1 - t)))
        sig = self.classes.select("rep", "sig")
        both = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        pair = f"a {self.kind}, b {self.kind}"
        alike = stage(both.select("a", "b", "sig_a", "sig_b").mapInArrow(partial(_alike, least=least), pair), "alike")
        ids = stage(alike.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        sets = stage(self.sets_of(ids), "sets")
        full = alike.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        checked = full.select("a", "b", "set_a", "set_b").mapInArrow(
            partial(_compared, percent=self.percent), f"{pair}, both long, linked boolean")
        return stage(checked, "compared")

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """``doc_id, set`` of the documents in ``ids``."""
        return by_ids(self.docs.select("doc_id", "text"), ids, "left_semi").mapInArrow(
            partial(_sets, words=self.words), f"doc_id {self.kind}, set binary")

    def shingles_of(self, ids: DataFrame) -> DataFrame:
        """``doc_id, shingle`` of the documents in ``ids``, by one Python worker a task."""
        return by_ids(self.docs.select("doc_id", "text"), ids, "left_semi").mapInArrow(
            partial(_shingles, words=self.words), f"doc_id {self.kind}, shingle long")

    def stars(self, members: DataFrame) -> DataFrame:
        """``rep, n, c, nc``: members of buckets and the centres of these.

        A bucket's centre is the member that shares most buckets with others.
        Buckets with the same centre count as one from here on.
        """
        weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
        ranked = members.join(weight, "rep")
        centre = ranked.groupBy("bucket").agg(F.max(F.struct("weight", "rep", "n")).alias("c"))
        rows = members.join(centre, "bucket")
        return stage(rows.select("rep", "n", F.col("c.rep").alias("c"), F.col("c.n").alias("nc")).distinct(), "stars")

    def star_pairs(self, stars: DataFrame) -> DataFrame:
        """Each member with its centre."""
        fits = F.least("n", "nc") * 100 >= F.greatest("n", "nc") * self.percent
        return _pairs(stars.where((F.col("rep") != F.col("c")) & fits), "rep", "c")

    def contested(self, stars: DataFrame, compared: DataFrame, found: DataFrame) -> DataFrame:
        """Members of centres with several components, with the counts that bound intersections.

        ``shared``: shingles that another contested document has; ``inner`` and
        ``outer``: those inside and outside the centre, -1 where not known.
        """
        rows = stars.join(found.toDF("rep", "component"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))
        several = rows.groupBy("c").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        rows = stage(rows.join(several.where("low <> high").select("c"), "c"), "contested")
        ids = stage(rows.select(F.col("rep").alias("doc_id")).distinct(), "ids")
        shingles = self.shingles_of(ids)
        own = shingles.groupBy("shingle").agg(F.count("*").alias("k"), F.min("doc_id").alias("rep")).where("k = 1")
        own = own.groupBy("rep").agg(F.count("*").alias("own"))
        rows = rows.join(own, "rep", "left").withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
        rows = rows.where(f"100 * shared >= {self.percent} * n")
        known = compared.select("a", "b", "both")
        rows = rows.withColumns({"a": F.least("rep", "c"), "b": F.greatest("rep", "c")}).join(known, ["a", "b"], "left")
        inner = F.when(F.col("rep") == F.col("c"), F.col("n")).otherwise(F.coalesce("both", F.lit(-1)))
        rows = rows.select("c", "rep", "component", "n", "shared", inner.alias("inner"))
        outer = F.when(F.col("inner") < 0, -1).otherwise(F.greatest(F.lit(0), F.col("shared") - F.col("inner")))
        kind = F.expr(f"cast(floor(ln(n) / ln({SIZE_STEP})) as int)")
        cell = F.ceil(F.pow(F.lit(SIZE_STEP), F.col("kind")) / 100)
        rows = rows.withColumns({"outer": outer, "kind": kind})
        return stage(rows.withColumns({
            "cell_in": F.floor(F.col("inner") / cell), "cell_out": F.floor(F.col("outer") / cell),
            "cell": F.floor(F.col("shared") / cell)}), "contested")

    def rest_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs with one centre and different components that counts do not rule out."""
        p = self.percent
        place = ["c", "kind", "component", "cell", "cell_in", "cell_out"]
        blocks = rows.groupBy(*place).agg(
            F.min("n").alias("n_y"), F.max("shared").alias("shared_y"), F.max("inner").alias("inner_y"),
            F.max("outer").alias("outer_y")).withColumnRenamed("component", "component_y")
        kind = f"cast(floor(ln(%s) / ln({SIZE_STEP})) as int)"
        top = f"least(n, floor(({100 + p} * shared - {p} * n) / {p}))"
        left = rows.withColumn("top", F.expr(top)).where(f"100 * top >= {p} * n").select(
            "c", *(F.col(c).alias(f"{c}_x") for c in ("rep", "component", "n", "shared", "inner", "outer")),
            F.explode(F.expr(f"sequence({kind % f'greatest(1, n * {p} / 100)'}, {kind % 'top'})")).alias("kind"))
        bound = """if(inner_x < 0 or inner_y < 0, least(shared_x, shared_y), least(shared_x, shared_y,
                   least(inner_x, inner_y) + least(outer_x, outer_y)))"""
        fits = f"component_x <> component_y and {100 + p} * {bound} >= {p} * (n_x + n_y)"
        near = left.join(blocks, ["c", "kind"]).where(fits).drop("n_y", "shared_y", "inner_y", "outer_y")
        right = rows.select(*place, *(F.col(c).alias(f"{c}_y") for c in ("rep", "n", "shared", "inner", "outer")))
        right = right.withColumnRenamed("component", "component_y")
        keys = ["c", "kind", "component_y", "cell", "cell_in", "cell_out"]
        pairs = near.join(right, keys).where(f"n_y <= n_x and 100 * n_y >= {p} * n_x and {fits}")
        return _pairs(pairs, "rep_x", "rep_y")


def _pairs(rows: DataFrame, one: str, other: str) -> DataFrame:
    return rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _shingles(batches, words: int):
    for batch, texts in slices(batches, size=HASH_BYTES):
        sets, bounds = shingle_sets(texts, words)
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(texts)), np.diff(bounds))))
        yield pa.RecordBatch.from_arrays([ids, pa.array(sets.view(np.int64))], ["doc_id", "shingle"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Words are runs of anything but ASCII white space, A-Z in lower case.  Two
    documents are linked when the sets of their ``words``-word shingles have
    ``100 * intersection >= percent * union``.  ``component_id`` is the least
    ``doc_id`` that links reach, ``kept`` marks the document that has it.

    Null and empty texts have no shingles and are alone.  Rows that repeat a
    ``doc_id`` share its component.  Rows without a ``doc_id`` take the
    component of their class, if it has another row, else null, and are kept
    only then.  Other columns are not read.
    """
    search = _Search(docs.select("doc_id", "text"), words, percent)
    stars = search.stars(search.members())
    near = search.compared(search.star_pairs(stars))
    first = near.where("linked").select("a", "b")
    rows = search.contested(stars, near, stage(connected_components(first), "components"))
    rest = search.compared(search.rest_pairs(rows)).where("linked").select("a", "b")
    found = connected_components(first.unionByName(rest))
    table = search.classes.select("f1", "f2", "rep").join(found.toDF("rep", "component"), "rep", "left").select(
        "f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    rows = search.rows.select("doc_id", "n_shingles", "f1", "f2")
    joined = rows.where("f1 is not null").join(table, ["f1", "f2"], "left")
    alone = rows.where("f1 is null").withColumn("component_id", F.col("doc_id"))
    return joined.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
