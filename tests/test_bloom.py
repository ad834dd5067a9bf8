import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import bloom
from corpusloom.staging import stage
from tests.conftest import rows


@pytest.fixture(scope="module")
def keys(spark):
    def make(start, stop):
        return spark.range(start, stop).select(F.md5(F.col("id").cast("string")).alias("key"))

    return make


@pytest.fixture(scope="module")
def built(keys):
    return stage(bloom.bloom_build(keys(0, 20_000)), "bloom")


def test_sizes():
    assert bloom.bloom_spec(300_000_000, 0.01) == (4, 3_156_811_385, 300_000_000)
    assert bloom.bloom_spec(20_000, 0.01) == (4, 210_454, 20_000)
    assert bloom.bloom_spec(20_000, 0.01, fast=False).k == 7
    assert bloom.bloom_spec(0).m >= 1


@pytest.mark.parametrize("n", [10**6, 10**12, 10**15])
@pytest.mark.parametrize("p", [0.1, 0.01, 1e-6])
def test_rate_holds_at_any_size(n, p):
    k, m, kept = bloom.bloom_spec(n, p)
    assert kept == n and abs((1 - math.exp(-k * n / m)) ** k / p - 1) < 0.1


def test_no_false_negatives(keys, built):
    assert bloom.bloom_probe(keys(0, 20_000), built).where("not maybe_seen").count() == 0


def test_false_positive_rate(keys, built):
    wrong = bloom.bloom_probe(keys(20_000, 60_000), built).where("maybe_seen").count()
    assert 0 < wrong <= 0.02 * 40_000


def test_salted_probe_is_the_same(keys, built):
    one = bloom.bloom_probe(keys(19_000, 22_000), built)
    other = bloom.bloom_probe(keys(19_000, 22_000), built, limit=0)
    assert rows(one) == rows(other)


def test_single_key_and_repeats(keys):
    single = stage(bloom.bloom_build(keys(5, 6).union(keys(5, 6))), "bloom")
    assert single.first().n == 1
    assert rows(bloom.bloom_probe(keys(5, 6), single), "maybe_seen") == [(True,)]


def test_empty_filter(keys):
    empty = stage(bloom.bloom_build(keys(0, 0)), "bloom")
    assert bloom.bloom_probe(keys(0, 10), empty).where("maybe_seen").count() == 0


def test_merge_equals_common_build(keys):
    a = stage(bloom.bloom_build(keys(0, 3000), n=6000), "a")
    b = stage(bloom.bloom_build(keys(2000, 6000), n=6000), "b")
    both = bloom.bloom_build(keys(0, 6000), n=6000)
    assert rows(bloom.bloom_merge(a, b), "bucket", "bitmap") == rows(both, "bucket", "bitmap")


def _measured(keys, built):
    return bloom.bloom_probe(keys(10**6, 10**6 + 40_000), built).where("maybe_seen").count() / 40_000


def test_statistics_follow_the_fill(keys):
    """After a merge of halves, and when far more keys came than were declared."""
    halves = [stage(bloom.bloom_build(keys(a, a + 10_000), n=20_000), "half") for a in (0, 10_000)]
    merged = stage(bloom.bloom_merge(*halves), "merged")
    assert abs(merged.first().n - 20_000) < 400
    over = stage(bloom.bloom_build(keys(0, 30_000), n=10_000), "over")
    for one in (merged, over):
        rate, told = _measured(keys, one), bloom.bloom_stats(one).first()
        assert abs(told.fpp - rate) < 0.1 * rate + 0.001
    assert abs(bloom.bloom_stats(over).first().n_est - 30_000) < 1500


def test_merge_needs_equal_filters(keys, built):
    other = stage(bloom.bloom_build(keys(0, 10)), "other")
    with pytest.raises(ValueError):
        bloom.bloom_merge(built, other)


def test_stats(built):
    got = bloom.bloom_stats(built).first()
    assert abs(got.n_est - 20_000) < 400
    assert got.k == 4 and got.n == 20_000 and 0.3 < got.bits_set / got.m < 0.5 and 0.005 < got.fpp < 0.02


def test_dedup_against_earlier_corpus(spark, keys):
    earlier = stage(bloom.bloom_build(keys(0, 100)), "earlier")
    pars = keys(50, 300).withColumn("doc_id", F.monotonically_increasing_id()).withColumn("par_pos", F.lit(0))
    twice = pars.unionByName(pars.withColumn("doc_id", F.col("doc_id") + 10**12))
    got = bloom.dedup_bloom(twice, earlier).join(keys(0, 100).withColumn("old", F.lit(True)), "key", "left")
    assert got.where("old and not dup").count() == 0
    fresh = got.where("old is null and not dup")
    assert fresh.count() == fresh.select("key").distinct().count() >= 190
