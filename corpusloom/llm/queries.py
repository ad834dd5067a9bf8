"""The operators of this package as queries over the supplied tables, whole and uncapped."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.code_compress import book_digest, compress, with_label_error
from corpusloom.llm.near_dup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.pieces import decode_pieces, encode_pieces
from corpusloom.llm.pii import BASE, pii_spans
from corpusloom.llm.prefix_trie import prefix_trie
from corpusloom.llm.quality_model import quality_posterior
from corpusloom.llm.quality_rules import quality_measures
from corpusloom.llm.secret_scan import BASE as SECRET_KINDS, secret_spans
from corpusloom.llm.token_counts import EDIT, apply_edits, build_trees
from corpusloom.llm.topk import top_k
from corpusloom.llm.toxicity import toxicity
from corpusloom.llm.url_filter import url_verdicts
from corpusloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> None:
    """Let Python workers find the package where this process found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def query(run: Query) -> Query:
    def start(spark: SparkSession, sf: str) -> DataFrame:
        reach(spark)
        return run(spark, sf)

    QUERIES[run.__name__] = start
    return start


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", list(columns or ("doc_id", "text")))


@query
def op1_near_duplicates(spark, sf):
    """Shingles of three words, linked from a similarity of 0.85."""
    return near_duplicates(documents(spark, sf), words=3, percent=85)


@query
def op2_top_k(spark, sf):
    """Ids divisible by 20 ask; all other rows are candidates."""
    vectors = read_table(spark, f"{sf}/embeddings.parquet", ["vec_id", "embedding"])
    return top_k(vectors, lambda vec_id: vec_id % 20 == 0)


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op7_url_verdicts(spark, sf):
    pages = read_table(spark, f"{sf}/pages.parquet", ["page_id", "url", "html"])
    return url_verdicts(pages, URL_RULES)


@query
def op6_packing(spark, sf):
    pieces = pack_documents(documents(spark, sf), tokenizer_file("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


@query
def op4_quality_rules(spark, sf):
    return quality_measures(documents(spark, sf))


@query
def op10_quality_model(spark, sf):
    """Sources are hosts, languages their paths."""
    labels = read_table(spark, f"{sf}/labels.parquet", ["doc_id", "quality"])
    return quality_posterior(documents(spark, sf, "doc_id", "text", "source", "lang"), labels)


@query
def op3_toxicity(spark, sf):
    return toxicity(documents(spark, sf), read_table(spark, f"{sf}/labels.parquet", ["doc_id", "toxic"]))


def _written(spans: str):
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op5_pii(spark, sf):
    """Counts and digest of the base spans, and all spans."""
    found = pii_spans(documents(spark, sf))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(kinds) - F.size(F.array_remove(kinds, kind)) for kind in BASE]
    counts = [n.cast("long").alias(f"n_{kind}") for n, kind in zip(counts, BASE, strict=True)]
    return found.select("doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


_LONG_NUMBER = re.compile(r"[0-9]{4,}")


def clean_up_edits(text: str) -> list[dict]:
    """Edits that delete repeated lines and write numbers of four digits or more as 0."""
    edits, seen, at = [], set(), 0
    for line in text.splitlines(keepends=True):
        if line.strip() and line in seen:
            edits.append({"start": at, "end": at + len(line), "new": ""})
        else:
            edits += [{"start": at + m.start(), "end": at + m.end(), "new": "0"} for m in _LONG_NUMBER.finditer(line)]
        seen.add(line)
        at += len(line)
    return edits


def _with_edits(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())]))
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        yield batch.append_column("edits", pa.array([clean_up_edits(t or "") for t in texts], kind))


@query
def op8_token_counts(spark, sf):
    """Counts before and after repeated lines and long numbers are edited away."""
    tokenizer = tokenizer_file("byte_bpe_50k.json")
    trees = build_trees(documents(spark, sf), tokenizer).drop("n_tokens")
    edits = trees.mapInArrow(_with_edits, f"doc_id bigint, text string, tree binary, edits array<{EDIT}>")
    return apply_edits(edits, tokenizer).select("doc_id", "n_edits", "n_before", F.col("n_tokens").alias("n_after"), "n_encoded")


@query
def op9_pieces(spark, sf):
    """All texts encoded, and decoded again."""
    model = tokenizer_file("piece_bpe_32k.model")
    rows = decode_pieces(encode_pieces(documents(spark, sf), model), model)
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query
def op11_secrets(spark, sf):
    """Counts and digest of the base spans of secrets, and all spans, of every text."""
    found = secret_spans(documents(spark, sf))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in SECRET_KINDS]
    return found.select("doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


@query
def op12_prefix_trie(spark, sf):
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(read_table(spark, f"{sf}/conversations.parquet", ["conv_id", "turn", "role", "text"]))


@query
def op13_codes(spark, sf):
    """Codes of 8 parts from codebooks of 16 entries after 6 rounds, for every usable vector."""
    codes, book = compress(read_table(spark, f"{sf}/embeddings.parquet", ["vec_id", "embedding", "label"]))
    return with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"))
