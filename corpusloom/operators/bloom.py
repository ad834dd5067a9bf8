"""A Bloom filter as a table of bitmaps.

The filter is split into blocks of at most 32,768 bits, one row each, and all
bits of a key lie in one block (Putze, Sanders, Singler: Cache-, Hash- and
Space-Efficient Bloom Filters, 2007).  Building is one aggregation by block and
probing one equi-join on it, however large the filter is; a filter can be
stored, merged with a later one and probed by any job.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.dedup import dedup_first_seen
from corpusloom.operators.lookup import BROADCAST_BYTES, lookup
from corpusloom.staging import stage

# Bits per bitmap, and how much larger than the smallest filter one
# with fewer hash functions may be.
BLOCK_BITS = 32_768
ROW_BYTES = 32
LARGER = 1.2
MOST_HASHES = 32


class BloomSpec(NamedTuple):
    """Number of hash functions, bits and expected keys."""

    k: int
    m: int
    n: int

    @property
    def blocks(self) -> int:
        return -(-self.m // BLOCK_BITS)

    @property
    def width(self) -> int:
        """Bits used in each block."""
        return -(-self.m // self.blocks)


def bits_needed(k: int, n: int, p: float) -> float:
    """Bits with which ``k`` hash functions and ``n`` keys give the rate ``p``."""
    return -k * n / math.log1p(-(p ** (1 / k)))


def bloom_spec(n: int, p: float = 0.01, fast: bool = True) -> BloomSpec:
    """Size a filter for ``n`` keys at false-positive rate ``p``, whatever the size.

    With ``fast`` it has the fewest hash functions that need at most ``LARGER``
    times the bits of the smallest filter, else those of the smallest.
    """
    n = max(1, n)
    sizes = {k: bits_needed(k, n, p) for k in range(1, MOST_HASHES + 1)}
    least = min(sizes.values())
    k = min(k for k, m in sizes.items() if m <= least * (LARGER if fast else 1))
    return BloomSpec(k, max(1, int(sizes[k])), n)


def _digits(key: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(key, start, length), 16, 10).cast("long")


def _block(key: Column, spec: BloomSpec) -> Column:
    return F.pmod(_digits(key, 1, 15), F.lit(spec.blocks))


def _bit(key: Column, i: int, spec: BloomSpec) -> Column:
    """The ``i``-th bit of a key in its block, by double hashing."""
    first, step = _digits(key, 16, 8), _digits(key, 24, 8)
    return F.pmod(first + i * step, F.lit(spec.width))


def bloom_build(
    df: DataFrame,
    key: str = "key",
    p: float = 0.01,
    fast: bool = True,
    n: int | None = None,
) -> DataFrame:
    """``bucket, bitmap, k, m, n``: the filter of a key column.

    Keys are 32 hexadecimal digits.  Without ``n`` the distinct keys are
    counted first.  Blocks without a key have no row.
    """
    keys = df.select(F.col(key).alias("key")).distinct()
    if n is None:
        keys = stage(keys, "bloom-keys")
        n = keys.count()
    spec = bloom_spec(n, p, fast)
    bits = F.array(*[_bit(F.col("key"), i, spec) for i in range(spec.k)])
    # Keys are brought to their block before any bitmap is made: a task before
    # the exchange would hold a whole bitmap for the few keys of each block.
    placed = keys.select(_block(F.col("key"), spec).alias("bucket"), bits.alias("bits"))
    rows = placed.repartition("bucket").select("bucket", F.explode("bits").alias("bit"))
    built = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return built.select(
        "bucket", "bitmap",
        *[F.lit(value).cast("long").alias(name) for name, value in spec._asdict().items()],
    )


def spec_of(bloom: DataFrame) -> BloomSpec | None:
    """Parameters of a stored filter; ``None`` for an empty one."""
    rows = bloom.select("k", "m", "n").limit(1).collect()
    return BloomSpec(*rows[0]) if rows else None


def bloom_probe(
    df: DataFrame, bloom: DataFrame, key: str = "key", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``maybe_seen``: false means the key is surely not in the filter.

    ``bloom`` should be a stored table: its size decides how it is joined.
    """
    spec = spec_of(bloom)
    if spec is None:
        return df.withColumn("maybe_seen", F.lit(False))
    probes = df.withColumn("bucket", _block(F.col(key), spec))
    joined = lookup(probes, bloom.select("bucket", "bitmap"), ["bucket"], ROW_BYTES, limit)
    hit = F.col("bitmap").isNotNull()
    for i in range(spec.k):
        hit = hit & _bit_is_set(F.col("bitmap"), _bit(F.col(key), i, spec))
    return joined.withColumn("maybe_seen", F.coalesce(hit, F.lit(False))).select(
        *df.columns, "maybe_seen"
    )


def _bit_is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1


def bloom_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two filters of equal ``k`` and ``m``; ``n`` is estimated from its fill."""
    one, two = spec_of(a), spec_of(b)
    if one is None or two is None:
        return b if one is None else a
    if (one.k, one.m) != (two.k, two.m):
        raise ValueError("only filters of equal size and hash count can be merged")
    merged = a.select("bucket", "bitmap").unionByName(b.select("bucket", "bitmap"))
    merged = stage(merged.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")), "bloom-merged")
    filled = merged.agg(F.sum(F.bitmap_count("bitmap")).alias("bits_set"))
    n = filled.select(_keys_of_fill(F.col("bits_set"), F.lit(one.k), F.lit(one.m)).alias("n"))
    return merged.select(
        "bucket", "bitmap", F.lit(one.k).cast("long").alias("k"), F.lit(one.m).cast("long").alias("m"), n.scalar().alias("n"))


def _keys_of_fill(bits_set: Column, k: Column, m: Column) -> Column:
    """How many keys set so many bits; for a full filter as many as leave one bit clear."""
    clear = F.greatest(m - bits_set, F.lit(1)) / m
    return F.round(-m / k * F.ln(clear)).cast("long")


def bloom_stats(bloom: DataFrame) -> DataFrame:
    """``k, m, n, bits_set, n_est, fpp`` of a filter.

    ``n`` is what it was made for; ``n_est``, its number of keys, and ``fpp``,
    its false-positive rate, come from the bits that are set.
    """
    filled = bloom.groupBy("k", "m", "n").agg(F.sum(F.bitmap_count("bitmap")).alias("bits_set"))
    k, m, bits_set = F.col("k"), F.col("m"), F.col("bits_set")
    fpp = F.pow(F.least(bits_set / m, F.lit(1.0)), k)
    return filled.withColumns({"n_est": _keys_of_fill(bits_set, k, m), "fpp": F.round(fpp, 9)})


def dedup_bloom(
    pars: DataFrame, bloom: DataFrame, id: str = "doc_id", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``id, par_pos, key, dup``: against an earlier corpus and inside this one.

    A paragraph is a repeat when the filter of the earlier corpus reports it or
    when it is not the first copy here.  New text is lost with probability up
    to the filter's rate.
    """
    verdicts = stage(dedup_first_seen(pars, id), "verdicts")
    # Only first copies ask the filter: no key is asked for twice, so none is hot.
    firsts = bloom_probe(verdicts.where(~F.col("dup")), bloom, limit=limit)
    firsts = firsts.select(id, "par_pos", "key", F.col("maybe_seen").alias("dup"))
    return firsts.unionByName(verdicts.where("dup"))
