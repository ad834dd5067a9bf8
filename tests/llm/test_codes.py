import hashlib
import math
import random

import numpy as np

from corpusloom.llm import code_compress as cc


def brute(rows, parts=8, k=16, rounds=6):
    """Plain k-means per part, straight from the contract, with every distance evaluated."""
    kept = [(i, l, v) for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, l, [math.floor(4096 * float(x)) for x in v]) for i, l, v in kept]
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))[:k]
    w = len(first[0][2]) // parts
    book = [[list(r[2][p * w:(p + 1) * w]) for r in first] for p in range(parts)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e)) for e in book[p]]
        j = min(range(len(d)), key=lambda j: (d[j], j))
        return j, d[j]

    for _ in range(rounds):
        new = [[list(e) for e in es] for es in book]
        for p in range(parts):
            groups = {}
            for _, _, v in ints:
                groups.setdefault(assign(v, p)[0], []).append(v[p * w:(p + 1) * w])
            for j, g in groups.items():
                new[p][j] = [sum(c) // len(g) for c in zip(*g)]
        book = new
    out = {}
    for i, l, v in ints:
        found = [assign(v, p) for p in range(parts)]
        out.setdefault(i, []).append((l, "".join(f"{j:02x}" for j, _ in found), sum(d for _, d in found)))
    digest = hashlib.sha256(",".join(str(x) for es in book for e in es for x in e).encode()).hexdigest()
    return out, digest


def test_nearest_with_pivots_equals_full_search():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x = rng.integers(-50, 50, (300, 8))
        e = rng.integers(-50, 50, (16, 8))
        e[3] = e[7]  # ties go to the lower index
        piv = cc.pivots_of(e[None])[0]
        dist = lambda a: np.sqrt(((a[:, None, :] - piv[None]) ** 2).sum(2))
        idx, best, evaluated = cc.nearest(x, e, dist(x), dist(e))
        full = ((x[:, None, :] - e[None]) ** 2).sum(2)
        assert (best == full.min(1)).all() and (idx == full.argmin(1)).all()
        assert evaluated <= 300 * 16


def test_codes_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        v = [rng.choice([0.01, -0.02, 0.3]) + rng.random() * 0.01 for _ in range(16)]
        rows.append((i // 2 if i % 7 else None, rng.choice([1, 2, None]), v))
    rows += [(100, 1, None), (101, 2, [1.0] * 15 + [float("nan")]), (102, 1, [None] * 16), rows[5], (103, 3, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    codes, book = cc.compress(df)
    got = cc.with_label_error(codes).collect()
    want, digest = brute([(i, l, None if v is None else [float(np.float32(x)) if x is not None else None for x in v]) for i, l, v in rows])
    assert cc.book_digest(book) == digest
    assert sorted((r.vec_id is None, r.vec_id or 0, r.label or 0, r.code, r.error) for r in got) == sorted(
        (i is None, i or 0, l or 0, c, e) for i, xs in want.items() for l, c, e in xs)
    by_label = {}
    for r in got:
        by_label[r.label] = by_label.get(r.label, 0) + r.error
    assert all(r.label_error == by_label[r.label] for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    codes, book = cc.compress(df)
    assert codes.count() == 0 and book.size == 0
