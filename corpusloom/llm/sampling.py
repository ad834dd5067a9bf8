"""Bounded samples of a table, spread over it by a hash of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_STEPS = 1 << 30


def hashed_sample(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows, about as many when there are enough.

    Rows are taken by a hash of ``doc_id`` (of the text's length too, as ids may
    be missing), a little more than needed; the surplus is cut in the order of
    the hash.  So no task sends more than its share, and one that is repeated
    sends the same.
    """
    place = F.xxhash64("doc_id", *([F.length("text")] if "text" in rows.columns else []))
    total = rows.count()
    share = min(1.0, 1.2 * n / max(1, total) + 40 / max(1, total))
    chosen = rows.withColumn("_place", place).where(F.pmod("_place", F.lit(_STEPS)) < int(share * _STEPS))
    return chosen.orderBy("_place", "doc_id").limit(n).select(*columns)
