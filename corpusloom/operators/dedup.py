"""Exact first-seen deduplication of paragraphs and document re-assembly.

The surviving copy of a paragraph is the one with the lowest ``(id, par_pos)``,
so results do not depend on arrival order.  Only keys and positions are
shuffled to find it: the minimum is combined on the map side, so a line that
occurs in every document costs one row per task, and no group is ever
collected.  Joins back run on the evenly spread document key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from corpusloom.functions import text as tx

#: More than any paragraph position.
POSITIONS = 1 << 32


def first_copies(pars: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, par_pos, key`` of the first copy of every paragraph key.

    Keys are 32 hexadecimal digits, as :func:`paragraph_hash` makes them.
    """
    # Sixteen bytes travel instead of thirty-two digits.
    no_key = F.raise_error(F.lit("paragraph keys must be hexadecimal")).cast("binary")
    packed = F.coalesce(F.unhex("key"), no_key)
    kind = pars.schema[id].dataType
    key = F.lower(F.hex("k")).alias("key")
    if isinstance(kind, IntegralType):
        # A number as the place: its minimum is a hash aggregate, that of a struct sorts.
        at = F.col(id).cast("decimal(20,0)") * F.lit(POSITIONS).cast("decimal(10,0)") + F.col("par_pos")
        firsts = pars.select(packed.alias("k"), at.cast("decimal(38,0)").alias("at")).groupBy("k").agg(F.min("at").alias("at"))
        pos = F.pmod("at", F.lit(POSITIONS).cast("decimal(10,0)"))
        places = firsts.select("k", "at", pos.alias("pos"))
        return places.select(
            F.expr(f"(at - pos) div {POSITIONS}").cast(kind).alias(id), F.col("pos").cast("int").alias("par_pos"), key)
    keyed = pars.select(packed.alias("k"), F.struct(id, "par_pos").alias("at"))
    firsts = keyed.groupBy("k").agg(F.min("at").alias("at"))
    return firsts.select("at.*", key)


def dedup_first_seen(pars: DataFrame, id: str = "doc_id", seen: DataFrame | None = None) -> DataFrame:
    """``id, par_pos, key, dup``: a verdict for every copy.

    ``seen`` holds the keys of an earlier corpus in ``key``: every copy of one
    of them is a repeat.  Both sides of that join have one row per key.

    ``pars`` is exchanged once by position; that exchange feeds both the
    minimum and the join, so the tokenization behind it runs once.
    """
    spread = pars.select(id, "par_pos", "key").repartition(id, "par_pos")
    firsts = first_copies(spread, id)
    if seen is not None:
        firsts = firsts.join(seen.select(F.lower("key").alias("key")).distinct(), "key", "left_anti")
    firsts = firsts.select(id, "par_pos", F.lit(True).alias("first"))
    joined = spread.join(firsts, [id, "par_pos"], "left")
    return joined.select(id, "par_pos", "key", F.col("first").isNull().alias("dup"))


def dedup_keep_unique(pars: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, par_pos, par``: the first copies with their text.

    ``pars`` has ``id, par_pos, key, par``.  First positions are found from keys
    alone; the text then moves once, by position.
    """
    firsts = first_copies(pars, id).select(id, "par_pos")
    return pars.select(id, "par_pos", "par").join(firsts, [id, "par_pos"], "left_semi")


def dup_stats(verdicts: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, n_par, n_dup`` for every document with a paragraph."""
    return verdicts.groupBy(id).agg(
        F.count("*").alias("n_par"), F.count_if("dup").alias("n_dup")
    )


def doc_verdict_join(
    docs: DataFrame, verdicts: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, n_par, n_verdict, complete``: documents against their verdicts.

    A document without paragraphs is complete at once.
    """
    sizes = docs.select(id, F.size(tx.raw_paragraphs(F.col(text))).cast("long").alias("n_par"))
    counts = verdicts.groupBy(id).agg(F.count("*").alias("n_verdict"))
    joined = sizes.join(counts, id, "left").select(
        id, "n_par", F.coalesce("n_verdict", F.lit(0)).alias("n_verdict")
    )
    return joined.withColumn("complete", F.col("n_par") == F.col("n_verdict"))


def kept_positions(firsts: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, kept``: positions of first copies, per document."""
    return firsts.groupBy(id).agg(F.collect_list("par_pos").alias("kept"))


def keep_paragraphs(
    docs: DataFrame, firsts: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` cut to first copies, plus ``n_par`` and ``n_dup``.

    The text is shuffled once, by document.  Positions are intersected with a
    hash set, so the work is linear in the number of paragraphs.  Documents
    whose paragraphs are all repeats stay, with empty text.
    """
    joined = docs.join(kept_positions(firsts, id), id, "left")
    joined = joined.withColumn("_lines", tx.raw_paragraphs(F.col(text)))
    joined = joined.withColumn(
        "_at",
        F.when(F.col("kept").isNull() | (F.size("_lines") == 0), F.array().cast("array<int>"))
        .otherwise(F.array_intersect(F.sequence(F.lit(0), F.size("_lines") - 1), "kept")),
    )
    lines = F.transform("_at", lambda pos: F.get("_lines", pos))
    return joined.select(
        *[c for c in docs.columns if c != text],
        F.array_join(lines, "\n").alias(text),
        F.size("_lines").alias("n_par"),
        (F.size("_lines") - F.size("_at")).alias("n_dup"),
    )


def reassemble(
    docs: DataFrame, pars: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, text, n_par, n_dup``: documents without repeated paragraphs.

    ``pars`` is the key table of the whole corpus the verdicts come from.
    """
    return keep_paragraphs(docs.select(id, text), first_copies(pars, id), id, text)
