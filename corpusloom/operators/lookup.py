"""Joining a large table with a lookup table whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

BROADCAST_BYTES = 64 << 20
SALTS = 32


def fits_broadcast(table: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True when ``table`` takes at most ``limit`` bytes.

    A row counts ``row_bytes`` for its fixed part and the bytes of its strings
    and binaries.  Reads no further than the bound on rows.  Pass a stored
    table: its rows are read.
    """
    bound = max(1, limit // row_bytes)
    long = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema.fields
            if isinstance(f.dataType, (StringType, BinaryType))]
    total = sum(long, F.lit(0)).cast("long") + row_bytes
    sizes = table.select(total.alias("size")).limit(bound + 1).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    n, size = sizes.first()
    return n <= bound and (size or 0) <= limit


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    row_bytes: int,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left equi-join of ``facts`` with a stored lookup table.

    A small table is broadcast, so ``facts`` is not shuffled.  A larger one is
    joined on a salted key.
    """
    if fits_broadcast(table, row_bytes, limit):
        return facts.join(F.broadcast(table), on, "left")
    return salted_lookup(facts, table, on)


def salted_lookup(facts: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left equi-join that splits every key over ``SALTS`` tasks.

    The table is copied once per salt; a key that a third of all facts share
    is then the work of ``SALTS`` tasks, and run-time skew handling can still
    split each of those.
    """
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int")
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = table.withColumn("_salt", F.explode(salts))
    return facts.withColumn("_salt", salt).join(copies, [*on, "_salt"], "left").drop("_salt")
