"""Paragraphs, sentences and tokens.  Every operator here is a narrow map.

The ``_outer`` forms of explode are used on purpose: for the plain ones the
optimizer infers ``size(array) > 0`` and pushes it below, which evaluates the
whole chain of regex passes a second time.  For the same reason empty rows are
filtered after the explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.plan import where_computed

UNKNOWN = "Unknown"
#: Number of the chunk in which a document lies, where documents were placed in chunks.
CHUNK = "_chunk"


def in_chunks(df: DataFrame, id: str = "doc_id") -> DataFrame:
    """Documents placed by id in as many chunks as there are shuffle partitions, numbered in ``_chunk``.

    What is cut from them keeps the column and lies with its document, so joins
    and groupings by ``_chunk`` and more do not shuffle it again.  Chunks are
    not merged at run time: all tables placed like this line up.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.pmod(F.xxhash64(id), F.lit(n)).cast("int")
    return to_chunks(df.withColumn(CHUNK, chunk), n)


def to_chunks(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows moved to the chunk that ``_chunk`` names."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionById(n, CHUNK)


def chunk_of(df: DataFrame) -> list[str]:
    """``["_chunk"]`` when ``df`` was placed in chunks, else nothing."""
    return [CHUNK] if CHUNK in df.columns else []


def paragraph_split(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, par_pos, par``: the text lines that hold a token, as written."""
    lines = df.select(id, tx.raw_paragraphs(F.col(text)).alias("pars"))
    rows = lines.select(id, F.posexplode_outer("pars").alias("par_pos", "par"))
    return rows.where(F.col("par").isNotNull())


def segment_paragraphs(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_par, par_pos, seg``: one row per paragraph in segmented form."""
    chunk = chunk_of(df)
    pars = df.select(*chunk, id, tx.paragraphs(tx.segmented(F.col(text))).alias("pars"))
    rows = pars.select(
        *chunk, id, F.size("pars").alias("n_par"), F.posexplode_outer("pars").alias("par_pos", "seg")
    )
    return rows.where(F.col("seg") != "")


def explode_tokens(pars: DataFrame, keep: list[str], seg: str = "seg") -> DataFrame:
    """One row per token of a paragraph table.

    Adds ``sent_pos, tok_pos, tok, glue`` and the counts ``n_sent`` (of the
    paragraph) and ``n_tok`` (of the sentence), which tell first from last
    without a window.
    """
    sents = pars.select(*keep, tx.sentences(F.col(seg)).alias("sents"))
    sents = sents.select(
        *keep, F.size("sents").alias("n_sent"), F.posexplode_outer("sents").alias("sent_pos", "sent")
    )
    toks = sents.select(*keep, "n_sent", "sent_pos", tx.tokens(F.col("sent")).alias("toks"))
    toks = toks.select(
        *keep, "n_sent", "sent_pos", F.size("toks").alias("n_tok"),
        F.posexplode_outer("toks").alias("tok_pos", "raw"),
    )
    return toks.select(
        *keep, "n_sent", "sent_pos", "n_tok", "tok_pos",
        F.translate("raw", tx.GLUE, "").alias("tok"),
        F.startswith(F.col("raw"), F.lit(tx.GLUE)).alias("glue"),
    )


def token_table(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, par_pos, sent_pos, tok_pos, tok, glue``: one row per token."""
    pars = segment_paragraphs(df, id, text)
    chunk = chunk_of(pars)
    return explode_tokens(pars, [*chunk, id, "par_pos"]).select(
        *chunk, id, "par_pos", "sent_pos", "tok_pos", "tok", "glue"
    )


def head_tokens(df: DataFrame, id: str = "doc_id", title: str = "title") -> DataFrame:
    """``id, tok_pos, tok, glue``: tokens of the title, none when it is unknown."""
    named = where_computed(df.select(id, title), "named", F.col(title), lambda t: t != UNKNOWN)
    seg = tx.segmented(F.translate("named", "\r\n", "  "), sentences=False)
    heads = named.select(id, seg.alias("seg"))
    toks = explode_tokens(heads, [id]).select(id, "tok_pos", "tok", "glue")
    return toks.where(F.col("tok") != "")


def vertical_paragraph(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, par_pos, vertical``: each paragraph as one token per line."""
    return segment_paragraphs(df, id, text).select(
        id, "par_pos", tx.vertical(F.col("seg")).alias("vertical")
    )


def paragraph_hash(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, par_pos, key``: the content key of each paragraph."""
    return segment_paragraphs(df, id, text).select(
        id, "par_pos", tx.paragraph_key(F.col("seg")).alias("key")
    )
