"""Language identification with character 3-grams.

Tasks count the grams of the texts of a batch with numpy; every gram of the
whole text counts.  Training is then one aggregation of distinct grams.  Scoring
joins the counts of each document with the profile and sums: grams never leave
their task when the profile is small enough to broadcast, because the sum per
document is combined before the only exchange.  Log-probabilities are kept in
millionths as whole numbers, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, salted_lookup
from corpusloom.staging import stage

# Fixed values.
NOT_LETTERS = r"[^\p{L}\p{M}]+"
# Overlapping windows by look-ahead: linear in the text, where taking
# substrings by position would be quadratic.
WINDOW = r"(?=([\p{L}\p{M} ]{3}))"
MICRO = 1_000_000
#: Characters counted at a time in a task.
PIECE = 2_000_000
#: Languages up to which a profile has one column for each.
WIDE_LANGUAGES = 64


def clean(text: Column) -> Column:
    """Lower-case letters, everything else one blank, a blank at both ends."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), NOT_LETTERS, " ")


def grams(text: Column) -> Column:
    """Array of all character 3-grams of the cleaned text."""
    return F.regexp_extract_all(clean(text), F.lit(WINDOW), F.lit(1))


def _windows(cleaned: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and 3-grams, as numbers, of cleaned texts set one after the other, piece by piece.

    A cleaned text begins and ends with a blank and holds no two blanks side by
    side, so a window with two belongs to two texts and is left out.
    """
    for start in range(0, len(cleaned) - 2, PIECE):
        points = np.frombuffer(cleaned[start:start + PIECE + 2].encode("utf-32-le"), "<u4").astype(np.int64)
        a, b, c = points[:-2], points[1:-1], points[2:]
        inside = (b != 32) | ((a != 32) & (c != 32))
        yield start + np.flatnonzero(inside), ((a << 42) | (b << 21) | c)[inside]


def _spelled(codes: np.ndarray) -> pa.Array:
    points = np.stack([codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF], 1)
    flat = points.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([flat[i:i + 3] for i in range(0, len(flat), 3)], pa.string())


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, gram, n`` of batches of ``lang, cleaned``; a gram may come again."""
    for batch in batches:
        for lang in pc.unique(batch["lang"]):
            of_lang = batch.filter(pc.equal(batch["lang"], lang))
            for _, codes in _windows("".join(of_lang["cleaned"].to_pylist())):
                found, times = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(found)), _spelled(found), pa.array(times, pa.int64())], ["lang", "gram", "n"])


def _count_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, gram and times of batches of id and cleaned text; a text without grams gives a null one."""
    for batch in batches:
        names, ids, texts = [batch.schema.names[0], "gram", "times"], batch[0], batch[1].to_pylist()
        sizes = np.array([len(text) for text in texts], np.int64)
        bare = np.flatnonzero(sizes < 3)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(bare)), pa.nulls(len(bare), pa.string()), pa.array(np.zeros(len(bare), np.int64))], names)
        ends = np.cumsum(sizes)
        for places, codes in _windows("".join(texts)):
            found, at = np.unique(codes, return_inverse=True)
            pairs, times = np.unique(np.searchsorted(ends, places, "right") * len(found) + at, return_counts=True)
            doc, gram = np.divmod(pairs, max(1, len(found)))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)), _spelled(found).take(pa.array(gram)), pa.array(times, pa.int64())], names)


def document_grams(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, gram, times``: the 3-grams of every document, counted where it lies.

    A gram of a very long document may come in several rows, to be summed; a
    text without letters has one row without a gram.
    """
    rows = df.select(F.col(id), clean(F.col(text)).alias("cleaned"))
    kind = StructType([rows.schema[id], StructField("gram", StringType()), StructField("times", LongType())])
    return rows.mapInArrow(_count_by_document, kind)


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n``: how often each language shows each 3-gram; rows without a language are ignored."""
    rows = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), clean(F.col(text)).alias("cleaned"))
    kind = StructType([rows.schema["lang"], StructField("gram", StringType()), StructField("n", LongType())])
    return rows.mapInArrow(_count_by_language, kind).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def langid_fit(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, logp``: add-one smoothed log-probabilities.

    A language's row with the empty gram holds the value of a gram it never
    showed.  Rows without a language are ignored.
    """
    # Read four times below, and no larger than the vocabulary: stored once.
    counts = stage(gram_counts(df, text, lang), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary = counts.select(F.count_distinct("gram").alias("v"))
    sizes = totals.withColumn("size", F.col("total") + vocabulary.scalar())
    unseen = sizes.select("lang", F.lit("").alias("gram"), F.lit(0).cast("long").alias("n"), "size")
    seen = counts.join(sizes, "lang").select("lang", "gram", "n", "size")
    logp = F.log((F.col("n") + 1) / F.col("size"))
    return seen.unionByName(unseen).select("lang", "gram", F.round(logp, 6).alias("logp"))


def _wide(profile: DataFrame) -> tuple[list[str], dict[str, int], DataFrame]:
    """Profile with one row per gram and one whole-number column per language."""
    micro = profile.select(
        "lang", "gram", F.round(F.col("logp") * MICRO).cast("long").alias("micro")
    )
    rows = micro.where(F.col("gram") == "").collect()  # one for each language
    unseen = {row["lang"]: row["micro"] for row in rows}
    langs = sorted(unseen)
    wide = micro.where(F.col("gram") != "").groupBy("gram").pivot("lang", langs).agg(F.min("micro"))
    names = [f"l{i}" for i in range(len(langs))]
    return langs, unseen, wide.toDF("gram", *names).na.fill(
        {name: unseen[lang] for name, lang in zip(names, langs)}
    )


def langid_predict(
    df: DataFrame,
    profile: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id, lang, score``: best language of every document.

    ``profile`` should be a stored table: it is read for its languages and its
    size.  Ties go to the first language code; a text without letters has none.
    """
    if profile.where(F.col("gram") == "").limit(WIDE_LANGUAGES + 1).count() > WIDE_LANGUAGES:
        return _predict_long(df, profile, id, text)
    langs, unseen, wide = _wide(profile)
    found = document_grams(df, id, text)
    unknown = [F.coalesce(f"l{i}", F.lit(unseen[lang])) for i, lang in enumerate(langs)]
    if fits_broadcast(wide, 64 + 8 * len(langs), limit):
        scored = found.join(F.broadcast(wide), "gram", "left")
        # A text without grams adds one unknown gram to other texts of its id.
        weight = F.greatest("times", F.lit(1))
    else:
        found = found.groupBy(id, "gram").agg(F.sum("times").alias("times"))
        scored = salted_lookup(found, wide, ["gram"])
        weight = F.col("times")
    values = [weight * value for value in unknown]
    sums = scored.groupBy(id).agg(F.sum("times").alias("n"), *[F.sum(v).alias(f"l{i}") for i, v in enumerate(values)])
    best = F.array_max(F.array(*[
        F.struct(F.col(f"l{i}").alias("micro"), F.lit(-i).alias("rank"), F.lit(lang).alias("lang"))
        for i, lang in enumerate(langs)
    ]))
    picked = sums.select(id, F.when(F.col("n") > 0, best).alias("best"))
    return picked.select(
        id, F.col("best.lang").alias("lang"), (F.col("best.micro") / MICRO).alias("score")
    )


def _predict_long(df: DataFrame, profile: DataFrame, id: str, text: str) -> DataFrame:
    """``langid_predict`` for any number of languages, which stay rows.

    Every gram takes the unseen value of a language; known ones add the
    difference to it, so only languages that know a gram of a document meet it.
    A language that knows none can only win with the best unseen value.
    """
    micro = profile.select("lang", "gram", F.round(F.col("logp") * MICRO).cast("long").alias("micro"))
    base = micro.where(F.col("gram") == "").select("lang", F.col("micro").alias("base"))
    gain = micro.where(F.col("gram") != "").join(base, "lang").select("gram", "lang", (F.col("micro") - F.col("base")).alias("gain"), "base")
    counts = document_grams(df, id, text).groupBy(id, "gram").agg(F.sum("times").alias("times"))
    sizes = counts.groupBy(id).agg(F.sum("times").alias("n"))
    per_gram = gain.groupBy("gram").agg(F.collect_list(F.struct("lang", "base", "gain")).alias("known"))
    joined = salted_lookup(counts.where("gram is not null"), per_gram, ["gram"])
    sums = joined.select(id, "times", F.inline("known")).groupBy(id, "lang", "base").agg(F.sum(F.col("times") * F.col("gain")).alias("gain"))
    scores = sums.join(sizes, id).select(id, "lang", (F.col("n") * F.col("base") + F.col("gain")).alias("micro"))
    best_base = base.agg(F.max(F.col("base")).alias("base"))
    first = base.join(best_base, "base").agg(F.min("lang").alias("lang"), F.first("base").alias("base"))
    plain = sizes.where("n > 0").select(id, first.select("lang").scalar().alias("lang"), (F.col("n") * first.select("base").scalar()).alias("micro"))
    ranked = scores.unionByName(plain).groupBy(id).agg(F.max("micro").alias("micro"))
    picked = scores.unionByName(plain).join(ranked, [id, "micro"]).groupBy(id).agg(F.min("lang").alias("lang"), F.first("micro").alias("micro"))
    return sizes.select(id).join(picked, id, "left").select(id, "lang", (F.col("micro") / MICRO).alias("score"))


def filter_lang(
    df: DataFrame, lang: str = "lang", allowed: tuple[str, ...] = ("en",)
) -> DataFrame:
    """Keep rows in one of the allowed languages; no language means dropped."""
    return df.where(F.col(lang).isin(*allowed))
