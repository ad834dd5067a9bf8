"""Packing token sequences hierarchically into windows of several lengths.

Every document is cut into full windows of the longest tier; what is left goes
to the shortest tier that holds it.  Longest first, such a rest opens a window
of its tier, and the gap is filled with the longest rests that fit, which
belong to shorter tiers.  Only when none fits is a rest cut, and then at the
gap, so every window is full.  What remains at the end of a task is cut at
powers of two, so it is not padded either.  Windows of one tier are counted off
into step groups of equally many tokens.

All work is local to the tasks that read the documents: nothing is shuffled,
and a task holds about ``POOL`` tokens.  Pass a stored table, whose partitions
do not change; a repeated task then packs the same documents in the same way.
"""

from __future__ import annotations

from array import array
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from corpusloom.llm.arrays import Texts, slices
from corpusloom.llm.units import UnitIds

TIERS = (256, 512, 1024, 2048)
#: Tokens of rests among which fits are sought; below ``RESERVE`` a task reads on.
POOL, RESERVE = 1 << 20, 1 << 17
#: Tokens in a full step group.
STEP_TOKENS = 64 * 2048
CACHE_UNITS, ROW_UNITS = 1_000_000, 2048
OUT_BYTES = 8 << 20
_BYTES = np.arange(256)
_LETTER = (_BYTES >= 97) & (_BYTES <= 122)
_PUNCTUATION = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~((_BYTES >= 48) & (_BYTES <= 57)) & ~((_BYTES >= 65) & (_BYTES <= 90))


class WordEncoder:
    """Ids of a tokenizer that drops white space, remembered unit by unit.

    The tokenizer must lower-case, never join text across white space, and end
    a pre-token between an ASCII letter and ASCII punctuation.  The ids of a
    text are then those of its units in a row: words, cut behind a letter that
    punctuation follows.  Texts with marks of special tokens are encoded whole.
    Units are told apart by their 64-bit hash.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a pre-token
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = UnitIds(CACHE_UNITS)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, keys: np.ndarray, units: list[str]) -> None:
        """Encode new units; those of letters alone in rows, as each is one pre-token."""
        alone = np.array([u.isalpha() and (u.isascii() or u.lower().isalpha()) for u in units], bool)
        parts: list[np.ndarray] = []
        order, sizes = [], []
        single = np.flatnonzero(alone).tolist()
        rest = np.flatnonzero(~alone).tolist()
        for k in range(0, len(single), ROW_UNITS):
            row = single[k:k + ROW_UNITS]
            ids = self.whole([" ".join([units[i] for i in row])])[0]
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(row):
                parts.append(ids)
                order.extend(row)
                sizes.append(np.diff(ends, prepend=0))
            else:
                rest.extend(row)
        parts.extend(self.whole([units[i] for i in rest]))
        sizes.append(np.array([len(x) for x in parts[len(parts) - len(rest):]] if rest else [], np.int64))
        sizes, ids = np.concatenate(sizes), np.concatenate(parts)
        self.known.add(keys, np.array(order + rest), sizes, ids)

    def encode(self, texts: Texts) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        texts = texts.lowered()
        data = texts.data
        starts, ends = texts.words
        if not len(starts):
            return [b""] * len(texts)
        cut = np.concatenate(([False], _LETTER[data[:-1]] & _PUNCTUATION[data[1:]], [False]))
        cut[texts.bounds] = False
        cuts = np.flatnonzero(cut)
        starts, ends = np.sort(np.concatenate((starts, cuts))), np.sort(np.concatenate((ends, cuts)))
        keys, first, which = np.unique(texts.hashes(starts, ends), return_index=True, return_inverse=True)
        new = self.known.missing(keys)
        if new.any():
            raw, at = data.tobytes(), first[new]
            self._remember(keys[new], [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        ids, total = self.known.gather(keys, which)
        bounds = total[np.searchsorted(starts, texts.bounds)]
        out = [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        if len(np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))):
            for i in range(len(texts)):
                raw = data[texts.bounds[i]:texts.bounds[i + 1]].tobytes()
                if b"<|" in raw:
                    out[i] = None
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class Packer:
    """Packs the documents of one task; pieces are ``(doc, start, ids, doc_tokens)``."""

    def __init__(self, tiers=TIERS, first: int = 0, step_tokens: int = STEP_TOKENS):
        self.tiers, self.next, self.step_tokens = sorted(tiers), first, step_tokens
        self.first, self.groups, self.next_group = first, {}, first
        top = self.tiers[-1]
        self.pool: list[list[tuple]] = [[] for _ in range(top + 1)]
        self.filled, self.tokens = 0, 0  # which lengths the pool has, as bits; its tokens
        self.out: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        total, top = len(ids) // 4, self.tiers[-1]
        start = 0
        while total - start >= top:
            self._emit(top, [(doc, start, ids[4 * start:4 * (start + top)], total)])
            start += top
        if start < total:
            self._put((doc, start, ids[4 * start:], total))
        if self.tokens >= POOL:
            self.pack(RESERVE)

    def _put(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        self.pool[size].append(piece)
        self.filled |= 1 << size
        self.tokens += size

    def _take(self, size: int) -> tuple:
        piece = self.pool[size].pop()
        if not self.pool[size]:
            self.filled ^= 1 << size
        self.tokens -= size
        return piece

    def _emit(self, tier: int, pieces: list[tuple]) -> None:
        group, used = self.groups.get(tier, (None, self.step_tokens))
        if used + tier > self.step_tokens:
            group, used = self.next_group, 0
            self.next_group += 1
        self.groups[tier] = (group, used + tier)
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, ids, total, self.next, offset, tier, group))
            offset += len(ids) // 4
        self.next += 1

    def pack(self, reserve: int = 0) -> None:
        """Fill windows until at most ``reserve`` tokens, or nothing, is left."""
        while self.tokens > reserve:
            longest = self.filled.bit_length() - 1
            tier = next(t for t in self.tiers if t >= longest)
            pieces, gap = [self._take(longest)], tier - longest
            while gap and self.filled:
                fits = (self.filled & ((2 << gap) - 1)).bit_length() - 1
                if fits > 0:
                    pieces.append(self._take(fits))
                    gap -= fits
                else:
                    above = self.filled >> (gap + 1)
                    size = gap + 1 + ((above & -above).bit_length() - 1)
                    doc, start, ids, total = self._take(size)
                    pieces.append((doc, start, ids[:4 * gap], total))
                    self._put((doc, start + gap, ids[4 * gap:], total))
                    gap = 0
            if gap:
                self._close(pieces, tier - gap)
            else:
                self._emit(tier, pieces)

    def _close(self, pieces: list[tuple], tokens: int) -> None:
        """Cut the last pieces of a task at powers of two."""
        while tokens:
            size = 1 << (tokens.bit_length() - 1)
            tokens, room, now = tokens - size, size, []
            while room:
                doc, start, ids, total = pieces.pop(0)
                have = min(room, len(ids) // 4)
                now.append((doc, start, ids[:4 * have], total))
                if 4 * have < len(ids):
                    pieces.insert(0, (doc, start + have, ids[4 * have:], total))
                room -= have
            self._emit(size, now)


def _pack(batches, path: str, end_id: int, tiers, id_type):
    end = array("I", [end_id]).tobytes()
    packer = Packer(tiers, TaskContext.get().partitionId() << 33)

    def flush():
        doc, start, ids, total, seq, offset, tier, group = zip(*packer.out, strict=True)
        length = np.fromiter(map(len, ids), np.int64) // 4
        packer.out = []
        longs = [pa.array(x, pa.int64()) for x in (start, length)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, id_type), *longs, pa.array(ids, pa.binary()), *(pa.array(x, pa.int64()) for x in (total, seq, offset)),
             pa.array(tier, pa.int32()), pa.array(group, pa.int64())],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"])

    waiting = 0
    for batch, texts in slices(batches):
        docs, column = batch.column(0).to_pylist(), batch.column(1)
        for i, ids in enumerate(encoder(path).encode(texts)):
            if ids is None:  # marks of special tokens
                ids = encoder(path).whole([column[i].as_py()])[0].tobytes()
            packer.add(docs[i], ids + end)
            waiting += len(ids)
            if waiting > OUT_BYTES and packer.out:
                yield flush()
                waiting = 0
    packer.pack()
    if packer.out:
        yield flush()


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """The pieces of all documents (``doc_id, text``) in their windows, one row per piece.

    ``doc_id, start, length``: the piece is ``length`` ids of the document from
    ``start``; ``ids``: these as little-endian unsigned 32-bit numbers;
    ``doc_tokens``: all ids of the document, the last being ``end_id``;
    ``sequence_id, offset``: the window and the place in it, without gaps;
    ``tier``: the window's length; ``step_group``: windows of one tier that
    together have ``STEP_TOKENS`` tokens, but for the last of a task.

    Null and empty texts are documents of the end id alone.  Rows that repeat
    an id, or have none, are documents of their own.  An empty table gives no
    rows.  Other columns are not read.  ``tokenizer`` is the path of a file for
    the ``tokenizers`` library whose ids do not cross white space; every
    executor must reach it.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    kind = docs.schema["doc_id"].dataType
    names = {"start": LongType(), "length": LongType(), "ids": BinaryType(), "doc_tokens": LongType(),
             "sequence_id": LongType(), "offset": LongType(), "tier": IntegerType(), "step_group": LongType()}
    schema = StructType([StructField("doc_id", kind), *(StructField(k, v) for k, v in names.items())])
    work = partial(_pack, path=tokenizer, end_id=end_id, tiers=tiers, id_type=to_arrow_type(kind))
    return docs.select("doc_id", "text").mapInArrow(work, schema)
