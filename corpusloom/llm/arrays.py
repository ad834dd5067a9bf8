"""Texts of an Arrow batch as numpy arrays of bytes, words and hashes.

Whole texts are handled; a batch is only cut between documents, into slices of
about ``SLICE_BYTES`` of text, so the arrays of one step stay small whatever
the size of the Arrow batch.  A single longer text is a slice of its own.

Hashes are polynomials modulo 2**64 over random values of the bytes, mixed
once more.  Equal strings always have equal hashes; different strings share one
with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> list[np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to ``n``.

    Those of one slice are kept for the life of the worker; a longer text gets
    its own, given back with it, so a worker holds no more than a slice needs.
    """
    if n > SLICE_BYTES + 1:
        table = _power_table(n)
        return table[0], table[1]
    if len(_POWERS[0]) < SLICE_BYTES + 1:
        _POWERS[:] = _power_table(SLICE_BYTES + 1)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass
class Texts:
    """``data``: all bytes; ``bounds``: where each document begins, with the end."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Texts:
        """A-Z in lower case."""
        return Texts(_LOWER[self.data], self.bounds)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every run of bytes that are not ASCII white space."""
        solid = ~_SPACE[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = self.bounds[:-1][np.diff(self.bounds) > 0]
        first[inner] = solid[inner]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        last[self.bounds[1:][np.diff(self.bounds) > 0] - 1] = solid[self.bounds[1:][np.diff(self.bounds) > 0] - 1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def counts(self, starts: np.ndarray) -> np.ndarray:
        """How many of the sorted ``starts`` lie in each document."""
        return np.diff(np.searchsorted(starts, self.bounds))

    @cached_property
    def _prefix(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * _powers(len(self.data) + 1)[0][:-1], out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each piece ``data[start:end]``."""
        inverse = _powers(len(self.data) + 1)[1]
        lengths = (ends - starts).astype(np.uint64)
        return mix((self._prefix[ends] - self._prefix[starts]) * inverse[starts] + lengths)

    def subset(self, docs: np.ndarray) -> Texts:
        """The documents with these numbers, in their order."""
        parts = [self.data[self.bounds[i]:self.bounds[i + 1]] for i in docs]
        return Texts(np.concatenate(parts) if parts else self.data[:0], np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))))

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """The document of each of the sorted ``starts``."""
        return np.repeat(np.arange(len(self)), self.counts(starts))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum over each document of one number per byte."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES,
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Each batch in slices of about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        all_texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        begin = 0
        while begin < batch.num_rows:
            limit = all_texts.bounds[begin] + size
            end = max(begin + 1, int(np.searchsorted(all_texts.bounds, limit, "right")) - 1)
            low, high = all_texts.bounds[begin], all_texts.bounds[end]
            yield batch.slice(begin, end - begin), Texts(all_texts.data[low:high], all_texts.bounds[begin:end + 1] - low)
            begin = end


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of slices of one array; ``bounds`` count its elements."""
    raw = np.ascontiguousarray(data)
    offsets = (np.asarray(bounds, np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
