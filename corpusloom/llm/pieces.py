"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Different words are encoded once; words of equal length advance together, one
character at a time.  For every end, the hashes of the substrings that end there
probe the sorted hashes of the pieces; the score of the best way to each piece is
the score of its beginning plus its own, and the maximum over all pieces with its
backpointer is stored, for all words at once.

For a unigram model this is the model's own segmentation.  The public model here
is a BPE model, whose segmentation does not maximise a sum of scores.  Its pieces
are found by the same search under one more condition: a piece may follow
another only if BPE would leave the two side by side.  A segmentation all of
whose neighbours meet the condition is the BPE segmentation, and it is unique;
so the search returns exactly what merging would, byte fallback included.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.arrays import Texts, binaries, mix, slices
from corpusloom.llm.units import UnitIds

SPACE = "▁"
CACHE_UNITS = 600_000
#: Characters that one step of the search holds at most.
BATCH_CHARS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.int64(1) << 40
#: Bytes of text encoded at a time: the more, the more words advance together.
SLICE_BYTES = 2 << 20
DECODE_ROWS = 512
#: Bits of a hash that tell at once that no piece has it.
_SIEVE_BITS = np.uint64(20)
#: Score of a character without a piece, below every piece's.
UNKNOWN = 10.0


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class PieceTable:
    """Pieces with their sorted hashes; for BPE also ranks and how each piece is merged.

    ``pieces``: ``(text, score, id)`` of the ordinary pieces.  ``bytes_at`` has
    the ids of the 256 byte pieces, or is None; ``unknown`` is the id for
    characters without a piece where there are none.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], bpe: bool, bytes_at: np.ndarray | None, unknown: int = 0):
        self.bpe, self.bytes_at, self.unknown = bpe, bytes_at, unknown
        held = {p for p, _, _ in pieces}
        # Characters that only occur inside pieces can be merged too, but are written as bytes.
        loose = sorted({c for p in held for c in p} - held)
        rows = [*pieces, *((c, -np.inf, -1) for c in loose)]
        texts = [r[0] for r in rows]
        self.longest = max(map(len, texts), default=1)
        self.power = _powers(self.longest + 1)
        self.length = np.array([len(p) for p in texts], np.int64)
        self.raw = np.array([self._hash(p) for p in texts], np.uint64)
        keys = self._key(self.raw, self.length)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.sieve = np.zeros(1 << int(_SIEVE_BITS), bool)
        self.sieve[keys >> (np.uint64(64) - _SIEVE_BITS)] = True
        self.at = order  # place of a piece by its place among the sorted keys
        self.ids = np.array([r[2] for r in rows], np.int64)
        self.score = np.array([r[1] for r in rows])
        self.least = min((s for _, s, _ in pieces), default=0.0) - UNKNOWN
        self.across = any(SPACE in p.lstrip(SPACE) for p in held)
        if bpe:
            self._merges(texts)

    def _hash(self, text: str) -> int:
        value = 0
        for c in text:
            value = (value * int(_BASE) + ord(c) + 1) & (2**64 - 1)
        return value

    @staticmethod
    def _key(raw: np.ndarray, length) -> np.ndarray:
        return mix(raw + np.asarray(length, np.uint64) * np.uint64(0xD1342543DE82EF95))

    def find(self, raw: np.ndarray, length) -> np.ndarray:
        """Places of the pieces with these hashes and lengths, -1 where there is none."""
        keys = self._key(raw, length)
        out = np.full(len(keys), -1)
        likely = np.flatnonzero(self.sieve[keys >> (np.uint64(64) - _SIEVE_BITS)])
        if len(likely):
            keys = keys[likely]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out[likely] = np.where(self.keys[at] == keys, self.at[at], -1)
        return out

    def _merges(self, texts: list[str]) -> None:
        """Ranks, and the two parts from which BPE makes each piece last."""
        place = {t: i for i, t in enumerate(texts)}
        order = sorted((i for i in range(len(texts)) if self.length[i] > 1), key=lambda i: (-self.score[i], self.ids[i]))
        self.rank = np.full(len(texts) + 1, -1, np.int64)  # single characters are there from the start
        self.rank[order] = np.arange(len(order))
        self.left, self.right = np.full(len(texts), -1), np.full(len(texts), -1)
        self.made = self.length == 1
        rank = self.rank.tolist()
        for i in order:
            parts = list(texts[i])
            while len(parts) > 2:
                best = min((rank[place[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in place) \
                    if any(a + b in place for a, b in zip(parts, parts[1:])) else None
                if best is None:
                    break
                k = best[1]
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 2 and parts[0] in place and parts[1] in place:
                self.left[i], self.right[i], self.made[i] = place[parts[0]], place[parts[1]], True

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves piece ``b`` beside piece ``a``; -1 stands for a character without a piece.

        Goes back in time: the edges of both pieces are taken apart in the reverse
        order of their merges, and at no time may a merge across them come first.
        """
        ok = np.ones(len(a), bool)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        x, y = a[todo], b[todo]
        limit = np.full(len(todo), _FAR)
        while len(todo):
            size = self.length[x] + self.length[y]
            both = np.full(len(todo), -1)
            short = size <= self.longest
            both[short] = self.find(self.raw[x[short]] * self.power[self.length[y[short]]] + self.raw[y[short]], size[short])
            crossed = (both >= 0) & (self.rank[both] < limit)
            ok[todo[crossed]] = False
            go = ~crossed & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            todo, x, y = todo[go], x[go], y[go]
            first = self.rank[x] > self.rank[y]
            limit = np.where(first, self.rank[x], self.rank[y] + 1)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return ok

    def segment(self, codes: np.ndarray) -> np.ndarray:
        """Viterbi over words of one length, given as rows of code points.

        Returns for every end the length of the piece chosen there where the
        best way passes, 0 elsewhere.
        """
        n, size = codes.shape
        prefix = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            prefix[j + 1] = prefix[j] * _BASE + codes[:, j] + np.uint64(1)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        last = np.full((size + 1, n), -2)  # the piece that ends here; -1 without a piece, -2 at the start
        taken = np.zeros((size + 1, n), np.int64)
        rows = np.arange(n)
        for j in range(1, size + 1):
            open_ = rows
            # The longest first: BPE leaves one way to each end, so words that have it are done.
            for k in range(min(self.longest, j), 0, -1):
                piece = self.find(prefix[j, open_] - prefix[j - k, open_] * self.power[k], k)
                use = np.flatnonzero(piece >= 0) if k > 1 else np.arange(len(open_))
                if self.bpe and k > 1 and len(use):
                    use = use[self.made[piece[use]]]
                    use = use[self.beside(last[j - k, open_[use]], piece[use])]
                if not len(use):
                    continue
                at, piece = open_[use], piece[use]
                value = best[j - k, at] + np.where(piece >= 0, np.maximum(self.score[piece], 2 * self.least), self.least)
                better = value > best[j, at]
                chosen = at[better]
                best[j, chosen], last[j, chosen], taken[j, chosen] = value[better], piece[better], k
                if self.bpe:
                    open_ = np.delete(open_, use)
                    if not len(open_):
                        break
        out = np.zeros((n, size), np.int64)
        end = np.full(n, size)
        while (going := np.flatnonzero(end > 0)).size:
            k = taken[end[going], going]
            out[going, end[going] - 1] = k
            end[going] -= k
        self._last = last
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the words, number of ids of each, and all ids in that order."""
        lengths = np.array([len(w) for w in words])
        order, sizes, ids = [], [], []
        by_length = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[by_length])) + 1
        for group in np.split(by_length, cuts):
            size = int(lengths[group[0]])
            step = max(1, BATCH_CHARS // max(1, size))
            for k in range(0, len(group), step):
                part = group[k:k + step]
                codes = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le"), np.uint32).reshape(len(part), size).astype(np.uint64)
                n, flat = self._ids(codes, self.segment(codes))
                order.append(part)
                sizes.append(n)
                ids.append(flat)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (order, sizes, ids))

    def _ids(self, codes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, end = np.nonzero(chosen)
        piece = self._last[end + 1, row]
        ids = np.where(piece >= 0, self.ids[piece], -1)
        lost = np.flatnonzero(ids < 0)
        if not len(lost):
            return np.bincount(row, minlength=len(codes)), ids
        # Characters without a piece become their UTF-8 bytes, or the unknown id.
        spelled = [chr(int(codes[row[i], end[i]])).encode("utf-8", "replace") for i in lost]
        if self.bytes_at is None:
            ids[lost] = self.unknown
            return np.bincount(row, minlength=len(codes)), ids
        times = np.ones(len(ids), np.int64)
        times[lost] = [len(s) for s in spelled]
        out = np.repeat(ids, times)
        out[out < 0] = self.bytes_at[np.frombuffer(b"".join(spelled), np.uint8)]
        return np.bincount(row, weights=times, minlength=len(codes)).astype(np.int64), out


class PieceCodec:
    """Encodes and decodes with the pieces of a model file of the sentencepiece library.

    The model must leave text as it is but for a space before it.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        pieces = [(model.id_to_piece(i), model.get_score(i), i) for i in range(n) if i not in special]
        at = [i for i in range(n) if model.is_byte(i)]
        spelled = {int(model.id_to_piece(i)[3:5], 16): i for i in at}
        bytes_at = np.array([spelled[b] for b in range(256)]) if len(spelled) == 256 else None
        # Only BPE numbers its scores; a unigram model has logarithms.
        bpe = all(float(s).is_integer() for _, s, _ in pieces)
        self.table = PieceTable(pieces, bpe, bytes_at, model.unk_id())
        self.known = UnitIds(CACHE_UNITS)
        written = [b""] * n
        for text, _, i in pieces:
            written[i] = text.replace(SPACE, " ").encode()
        for b, i in spelled.items():
            written[i] = bytes([b])
        written[model.unk_id()] = " ⁇ ".encode()
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(w) for w in written])))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit numbers, and where each document's begin."""
        texts = _with_spaces(texts)
        size = np.diff(texts.bounds)
        filled = np.flatnonzero(size > 0)
        bounds = np.concatenate(([0], np.cumsum(size + (size > 0))))
        data = np.full(bounds[-1], 32, np.uint8)  # a space before every text
        inside = np.ones(bounds[-1], bool)
        inside[bounds[:-1][filled]] = False
        data[inside] = texts.data
        spaced = Texts(data, bounds)
        space = data == 32
        first = space.copy()
        if self.table.across:
            first[:] = False
        first[1:] &= ~space[:-1]
        first[bounds[:-1][filled]] = True
        starts = np.flatnonzero(first)
        ends = np.concatenate((starts[1:], [len(data)]))[:len(starts)]
        if not len(starts):
            return np.zeros(0, np.uint32), bounds
        keys, at, which = np.unique(spaced.hashes(starts, ends), return_index=True, return_inverse=True)
        new = self.known.missing(keys)
        if new.any():
            raw = data.tobytes()
            words = [raw[a:b].decode().replace(" ", SPACE) for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
            self.known.add(keys[new], *self.table.encode(words))
        ids, total = self.known.gather(keys, which)
        return ids, total[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space before it; broken UTF-8 becomes U+FFFD."""
        size = self.starts[ids + 1] - self.starts[ids]
        total = np.cumsum(size)
        if not len(ids) or not total[-1]:
            return ""
        spelled = self.written[np.repeat(self.starts[ids] - total + size, size) + np.arange(total[-1])].tobytes()
        return spelled[spelled[:1] == b" ":].decode("utf-8", "replace")


def _with_spaces(texts: Texts) -> Texts:
    """The mark that stands for a space, where a text has it itself, as a space."""
    mark = SPACE.encode()
    d = texts.data
    if len(d) < 3 or not ((d[:-2] == mark[0]) & (d[1:-1] == mark[1]) & (d[2:] == mark[2])).any():
        return texts
    parts = [d[a:b].tobytes().replace(mark, b" ") for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)]
    return Texts(np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))))


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _encoded(batches, path: str):
    for batch, texts in slices(batches, size=SLICE_BYTES):
        ids, bounds = codec(path).encode(texts)
        yield pa.RecordBatch.from_arrays([*batch.columns, binaries(ids, bounds)], [*batch.schema.names, "ids"])


def _decoded(batches, path: str):
    for whole in batches:
        at = whole.schema.get_field_index("ids")
        for begin in range(0, whole.num_rows, DECODE_ROWS):
            batch = whole.slice(begin, DECODE_ROWS)
            texts = [None if not v.is_valid else codec(path).decode(np.frombuffer(v.as_buffer(), np.uint32).astype(np.int64))
                     for v in batch.column(at)]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, text, ids`` of every row; ``ids`` are little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids.  Repeated rows and rows without an id are
    encoded each.  Other columns are not read.  ``model`` is the path of a model
    file, which every executor must reach.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_encoded, path=model), f"doc_id {kind}, text string, ids binary")


def decode_pieces(rows: DataFrame, model: str) -> DataFrame:
    """All columns of ``rows`` and ``decoded``, the text of the column ``ids``; null where that is null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(partial(_decoded, path=model), f"{schema}, decoded string")
