"""Product codes of vectors: per-part codebooks trained in rounds, assignments pruned by LAESA pivots.

Each vector becomes integers (``floor(scale * x)``) cut into ``parts`` equal
consecutive parts.  Every part position has a codebook of ``entries`` entries,
started from that part of the vectors with the smallest ids.  A round assigns
every part to its nearest entry and moves each entry to the floored mean of its
parts; the code of a vector is its entries' indexes after the last round.

Nearest entries are found with LAESA (Micó, Oncina and Vidal, 1994): for each
part position a few fixed pivots are chosen once (far apart, from the first
codebook), and every part's Euclidean distances to them are computed once and
stored beside it.  In a round only the entries' distances to the pivots are
new; ``|d(x, p) - d(e, p)|`` bounds ``d(x, e)`` from below, entries are visited
in the order of that bound, and exact integer distances are evaluated only
while the bound does not exceed the best distance found, so the result is the
exact nearest entry (ties to the lower index).

On Spark every round is one pass over the stored parts: tasks assign their rows
and emit one partial sum per part position and entry, which Spark adds up by a
grouping; the driver receives the new codebook only (``parts * entries`` rows).
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from corpusloom.staging import stage

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 8, 16, 6, 4096, 4


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds only finite, non-null components."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col(column).isNotNull() & finite)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten()
    return np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.int64).reshape(-1, width)


def pivots_of(book: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` entries of each part's codebook chosen far apart (greedy farthest first from entry 0)."""
    out = []
    for entries in book:
        chosen = [0]
        far = ((entries - entries[0]) ** 2).sum(1)
        while len(chosen) < min(n, len(entries)):
            nxt = int(np.argmax(far))
            chosen.append(nxt)
            far = np.minimum(far, ((entries - entries[nxt]) ** 2).sum(1))
        out.append(entries[chosen])
    return np.stack(out)


def nearest(x: np.ndarray, entries: np.ndarray, x_piv: np.ndarray, e_piv: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, and the number of exact evaluations.

    ``x_piv`` and ``e_piv`` are Euclidean distances of rows and entries to the
    pivots.  Bounds are shrunk by a margin of rounding, so pruning never drops
    the true nearest entry.
    """
    n, k = len(x), len(entries)
    lower = np.abs(x_piv[:, None, :] - e_piv[None, :, :]).max(2) if x_piv.shape[1] else np.zeros((n, k))
    lower = np.maximum(lower - 1e-7 * (1 + lower), 0.0) ** 2
    order = np.argsort(lower, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max, np.int64)
    index = np.full(n, k, np.int64)
    rows, evaluated = np.arange(n), 0
    for step in range(k):
        cand = order[:, step]
        open_ = lower[rows, cand] <= best
        if not open_.any():
            break
        r, c = rows[open_], cand[open_]
        d = ((x[r] - entries[c]) ** 2).sum(1)
        evaluated += len(r)
        better = (d < best[r]) | ((d == best[r]) & (c < index[r]))
        best[r[better]], index[r[better]] = d[better], c[better]
    return index, best, evaluated


def _split(batch: pa.RecordBatch, width: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    ints = _matrix(batch.column(batch.schema.get_field_index("ints")), width).reshape(-1, parts, width // parts)
    piv = batch.column(batch.schema.get_field_index("piv"))
    piv = np.asarray(piv.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ints), parts, -1)
    return ints, piv


def _with_pivot_distances(batches, pivots: np.ndarray, width: int, parts: int):
    for batch in batches:
        ints = _matrix(batch.column(batch.schema.get_field_index("ints")), width).reshape(-1, parts, width // parts)
        d = np.sqrt(((ints[:, :, None, :] - pivots[None, :, :, :]) ** 2).sum(3, dtype=np.float64))
        yield batch.append_column("piv", pa.array(list(d.reshape(len(ints), -1)), pa.list_(pa.float64())))


def _assign(ints, piv, book, book_piv):
    parts = book.shape[0]
    idx = np.empty(ints.shape[:2], np.int64)
    err = np.empty(ints.shape[:2], np.int64)
    for p in range(parts):
        idx[:, p], err[:, p], _ = nearest(ints[:, p], book[p], piv[:, p], book_piv[p])
    return idx, err


def _partial_sums(batches, book, book_piv, width):
    parts, k, _ = book.shape
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ints, piv = _split(batch, width, parts)
        idx, _ = _assign(ints, piv, book, book_piv)
        part, entry, count, sums = [], [], [], []
        for p in range(parts):
            n = np.bincount(idx[:, p], minlength=k)
            s = np.zeros((k, width // parts), np.int64)
            np.add.at(s, idx[:, p], ints[:, p])
            used = np.nonzero(n)[0]
            part += [p] * len(used)
            entry += used.tolist()
            count += n[used].tolist()
            sums += list(s[used])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()),
             pa.array([list(x) for x in sums], pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])


def _codes(batches, book, book_piv, width):
    parts = book.shape[0]
    for batch in batches:
        ints, piv = _split(batch, width, parts)
        idx, err = _assign(ints, piv, book, book_piv)
        codes = ["".join(f"{i:02x}" for i in row) for row in idx]
        keep = [i for i, name in enumerate(batch.schema.names) if name not in ("ints", "piv")]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(codes, pa.string()), pa.array(err.sum(1), pa.int64())],
                                         [*(batch.schema.names[i] for i in keep), "code", "error"])


def _distances_to(book: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((book[:, :, None, :] - pivots[:, None, :, :]) ** 2).sum(3, dtype=np.float64))


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for v in book.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", label: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(codes, codebook)``: per kept row ``id, label, code, error``, and the final codebook.

    Rows whose vector is null or holds a null or non-finite component are left
    out, as are rows whose vector differs in length from the first entry's or
    whose length is not a multiple of ``parts``.  The codebook starts from the
    kept rows of the ``entries`` smallest ids (ties by the vector; rows without an
    id come last); with fewer rows it has fewer entries.  Repeated rows count
    each.  An empty input gives an empty result and an empty codebook.
    ``label`` may be ``None``; other columns are not read.
    """
    spark = vectors.sparkSession
    cols = [F.col(id_col).alias("vec_id")] + ([F.col(label).alias("label")] if label else [F.lit(None).cast("int").alias("label")])
    kept = usable(vectors, column).select(*cols, F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("ints"))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    if not first:
        empty = spark.createDataFrame([], "vec_id bigint, label int, code string, error bigint")
        return empty, np.zeros((parts, 0, 0), np.int64)
    width = len(first[0]["ints"])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("ints") == width)
    book = np.array([r["ints"] for r in first if len(r["ints"]) == width], np.int64).reshape(-1, parts, width // parts).transpose(1, 0, 2).copy()
    pivots = pivots_of(book)
    schema = T.StructType([*kept.schema.fields, T.StructField("piv", T.ArrayType(T.DoubleType()))])
    stored = stage(kept.mapInArrow(partial(_with_pivot_distances, pivots=pivots, width=width, parts=parts), schema), "codes-parts")
    for _ in range(rounds):
        book_piv = _distances_to(book, pivots)
        sums = stored.mapInArrow(partial(_partial_sums, book=book, book_piv=book_piv, width=width),
                                 "part int, entry int, n bigint, sums array<bigint>")
        total = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.col("sums")[j]) for j in range(width // parts)]).alias("sums")).collect()
        for r in total:
            book[r["part"], r["entry"]] = np.floor_divide(np.array(r["sums"], np.int64), r["n"])
    book_piv = _distances_to(book, pivots)
    schema = kept.schema["vec_id"], kept.schema["label"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", code string, error bigint"
    return stored.mapInArrow(partial(_codes, book=book, book_piv=book_piv, width=width), schema), book


def with_label_error(codes: DataFrame, small: int = 1 << 20) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over rows of the same label (nulls together).

    Sums are taken by a grouping with map-side combining, so a label that holds
    most rows costs one partial sum per task.  They come back by a broadcast
    when there are at most ``small`` labels (counted first), else by a join.
    """
    key = F.coalesce(F.col("label").cast("string"), F.lit("\u0000null"))
    sums = codes.groupBy(key.alias("_label")).agg(F.sum("error").cast("long").alias("label_error"))
    sums = stage(sums, "codes-labels")
    side = F.broadcast(sums) if sums.count() <= small else sums
    return codes.withColumn("_label", key).join(side, "_label").drop("_label")
