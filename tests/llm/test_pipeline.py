"""The pipeline, and every query of the package, against its twin or its schema."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from checks.compare import connect, normal
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import QUERIES
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert [name for name, _ in pipeline.STAGES] == ["quality", "rules", "near_duplicates", "pii", "packing"]


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    df = QUERIES[name](spark, SF)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(SF).execute(ORACLES[name])
    assert ours == normal([c[0] for c in cursor.description], cursor.fetchall())


COLUMNS = {
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op6_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
                   "offset bigint, tier int, step_group bigint",
    "op8_token_counts": "doc_id bigint, n_edits bigint, n_before bigint, n_after bigint, n_encoded bigint",
    "op9_pieces": "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean",
    "op10_quality_model": "doc_id bigint, evidence double, site double, score double, kept boolean",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_rows_and_schema(spark, name):
    df = QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert df.select("doc_id").distinct().count() == docs.count()


def test_stages_keep_columns_and_odd_rows(spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame(
        [(9001, good, "en", "s", 3, 1.0, True), (9002, good, "en", None, 3, None, None), (9003, None, None, "s", None, 2.0, False),
         (None, good + " mail a@b.cd", "en", "s", 1, 2.0, False), (9001, good, "en", "s", 3, 1.0, True),
         (9004, "", "en", "s", 0, 0.0, None)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean")
    for empty in (False, True):
        now = docs.where("false") if empty else docs
        for name, step in pipeline.STAGES:
            made = step(spark, now, SF)
            if name != "packing":
                assert made.schema.simpleString() == docs.schema.simpleString()
            now = pipeline.stage(made, name)
        assert now.where(F.col("length") <= 0).count() == 0
        assert empty == (now.count() == 0)
        kept = now.where("doc_id > 9000").select("doc_id").distinct()
        assert rows(kept) == ([] if empty else [(9001,)])


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert 0 < out.select("doc_id").distinct().count() < 200 and out.where("doc_tokens < 50").count() == 0
