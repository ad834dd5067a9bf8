"""From documents to packed training windows.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns they are given.

1. ``quality``: documents whose posterior of being good is below one half go.
2. ``rules``: documents that a quality rule rejects go.
3. ``near_duplicates``: of documents with a similarity of 0.8 or more on shingles
   of five words, directly or through others, the one with the least id stays.
4. ``pii``: personal data and secrets become ``[kind]``; ``n_chars`` follows.
5. ``packing``: documents become pieces of windows of 256 to 2048 tokens.

Documents are known by ``doc_id``: rows that share one stay or go together in
stages 1 and 3; rows without one always pass these.  Null texts are rejected by
the rules.  An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.near_dup import by_ids, near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.pii import mask_pii
from corpusloom.llm.quality_model import quality_posterior
from corpusloom.llm.quality_rules import keep_passing
from corpusloom.llm.queries import reach, tokenizer_file
from corpusloom.staging import stage


def _without(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """``docs`` without those that ``judged`` does not keep."""
    gone = judged.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return by_ids(docs, stage(gone, "rejected"), "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return _without(docs, quality_posterior(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return keep_passing(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return _without(docs, near_duplicates(docs, words=5, percent=80))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    masked = mask_pii(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality", quality), ("rules", rules), ("near_duplicates", near_duplicate), ("pii", pii), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models and a tokenizer decide, which SQL cannot express.
ORACLE_SQL = None
