import math
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import topk
from tests.conftest import rows


def brute(vectors, k):
    ints = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints[i] = [math.floor(64 * float(np.float32(x))) for x in v]
    out = []
    for q in ints:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(ints[q], w)), i) for i, w in ints.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, vectors, k):
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id bigint, embedding array<float>, rep string")
    return rows(topk.top_k(df, lambda i: i % 20 == 0, k))


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = random.Random(1)
    common = [rng.gauss(0, 0.2) for _ in range(8)]
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(500)]
    vectors += [(i, common) for i in range(500, 700)]
    vectors += [(700, None), (720, [None] + common[1:]), (721, [float("nan")] + common[1:]), (740, [float("inf")] * 8),
                (760, [0.0] * 8), (780, [50.0] * 8), (None, common)]
    assert found(spark, vectors, 20) == brute(vectors, 20)


def test_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP", 3)
    rng = random.Random(3)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(300)]
    assert found(spark, vectors, 5) == brute(vectors, 5)


@pytest.mark.parametrize("vectors", [[], [(1, [0.5])], [(0, [0.5])], [(0, [0.5]), (3, [0.25]), (3, [0.25])], [(20, [])]])
def test_few_rows(spark, vectors):
    assert found(spark, vectors, 20) == brute(dict(vectors).items(), 20)


def test_bounds_hold_beyond_the_exact_floats():
    """Sums near 2**60: the small parts of the true best round away one by one."""
    q = np.array([[2**30] + [1] * 7], np.int64)
    v = np.array([[2**30] + [100] * 7, [2**30, 600] + [0] * 6, [0] * 8], np.int64)
    values = np.sort(v.T, axis=1)
    cells = np.array([[np.searchsorted(values[d], x) for d, x in enumerate(row)] for row in v], np.uint8)
    scores = (v * q).sum(axis=1)
    out = topk._scan(None, pa.table({"query": [0], "v": [q[0].tobytes()]}), pa.table(
        {"rep": [0, 1, 2], "cells": [c.tobytes() for c in cells]}), 1, (values, values)).to_pydict()
    assert set(out["rep"]) == {0, 1} and scores.argmax() == 0
    assert all(a <= scores[r] <= b for r, a, b in zip(out["rep"], out["lower"], out["upper"], strict=True))
    assert topk._whole(np.array([2.0**63, -(2.0**64), 5.0])).tolist() == [2**63 - 1, -(2**63), 5]
    assert (topk._slack(np.ones((1, 8)), values[:, :1] * 0.0, values[:, :1] * 0.0 + 9) == 0).all()
