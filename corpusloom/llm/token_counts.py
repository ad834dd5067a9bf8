"""Token counts that follow edits: a segment tree of pre-tokens per document.

Byte-level BPE never merges across pre-tokens, so a document's count is the sum
over its pre-tokens.  ``build_trees`` cuts every text into leaves of ``LEAF``
pre-tokens and keeps, per document, a complete binary tree with the characters
and tokens below every node.  ``apply_edits`` walks down the tree to the leaves
an edit touches, re-encodes from there, with ``CONTEXT`` characters of boundary
context, until a new pre-token boundary meets an old leaf boundary, and updates
the sums on the paths to the root.  Untouched leaves are never encoded again.

A pre-token depends on at most two characters behind its end (a run of white
space gives its last character to a following word), hence the context.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAF = 32
CONTEXT = 4
CACHE_WORDS = 600_000
SLICE_ROWS = 256
EDIT = "struct<start:bigint,end:bigint,new:string>"
#: Fixed value: the public pre-token pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    """Tokens of pre-tokens, remembered; ``encoded`` counts the characters looked at."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.pattern = regex.compile(PATTERN)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known.clear()
                new = set(words)
            new = list(new)
            found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, (len(e.ids) for e in found), strict=True))
        return list(map(self.known.__getitem__, words))

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of each leaf."""
        words = self.pattern.findall(text)
        sizes, counts = list(map(len, words)), self.counts(words)
        cuts = range(0, len(words), LEAF)
        return [sum(sizes[k:k + LEAF]) for k in cuts], [sum(counts[k:k + LEAF]) for k in cuts]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


class Tree:
    """Sums in heap order: node ``i`` has the children ``2i`` and ``2i + 1``, leaves come last."""

    def __init__(self, sums: np.ndarray):
        self.sums = sums  # (2 * width, 2): characters and tokens
        self.width = len(sums) // 2

    @classmethod
    def of(cls, chars, tokens) -> Tree:
        width = 1 << max(0, len(chars) - 1).bit_length()
        sums = np.zeros((2 * width, 2), np.int64)
        sums[width:width + len(chars)] = np.stack((chars, tokens), axis=1) if len(chars) else 0
        level = width
        while level > 1:
            half = level // 2
            sums[half:level] = sums[level:2 * level:2] + sums[level + 1:2 * level:2]
            level = half
        return cls(sums)

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character ``at``, and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at - begin >= self.sums[node, 0] and self.sums[node + 1, 0]:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.width, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        change = np.array((chars, tokens)) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def leaf_chars(self) -> np.ndarray:
        return self.sums[self.width:, 0]


def edit(text: str, tree: Tree, edits: list[tuple[int, int, str]], count: Counter) -> tuple[str, Tree, int, int]:
    """The edited text, its tree, the characters encoded for it, the edits made.

    ``edits`` are ``(start, end, new)`` in code points of ``text``.  They are
    taken in the order of their starts; one that overlaps an earlier is left
    out, ends beyond the text are cut to it.
    """
    chosen, done = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
        start, end = max(0, min(start, len(text))), max(0, min(end, len(text)))
        if start >= done and end >= start:
            chosen.append((start, end, new))
            done = end
    if not chosen:
        return text, tree, 0, 0
    parts, at = [], 0
    for start, end, new in chosen:
        parts += [text[at:start], new]
        at = end
    after = "".join([*parts, text[at:]])
    chars = tree.leaf_chars()
    used = int(np.count_nonzero(chars))
    begins = [0, *np.cumsum(chars[:used]).tolist()]  # leaf boundaries of the old text
    regions, shift, encoded, k = [], 0, 0, 0
    while k < len(chosen):
        start, end, new = chosen[k]
        first, begin = tree.find(max(0, start - CONTEXT)) if used else (0, 0)
        at, words, sizes = begin + shift, [], 0
        shift += len(new) - (end - start)
        k += 1
        last = used
        for m in count.pattern.finditer(after, at):
            # Edits that begin before this word's lookahead ends belong to the same region.
            while k < len(chosen) and chosen[k][0] + shift <= m.end() + CONTEXT:
                shift += len(chosen[k][2]) - (chosen[k][1] - chosen[k][0])
                end = chosen[k][1]
                k += 1
            old = m.start() - shift
            if old >= end and words or old > end:
                i = bisect_left(begins, old)
                if i < len(begins) and begins[i] == old and i > first and i < used:
                    last = i
                    break
            words.append(m.group())
            sizes += len(words[-1])
        regions.append((first, last, words))
        encoded += sizes
    return after, _rebuilt(tree, used, regions, count), encoded, len(chosen)


def _rebuilt(tree: Tree, used: int, regions: list, count: Counter) -> Tree:
    """New leaves for the regions; in place when their number stays."""
    fresh = []
    for first, last, words in regions:
        counts, sizes = count.counts(words), list(map(len, words))
        n = max(1, last - first)
        # As many leaves as before while they stay below twice their size.
        step = max(1, -(-len(words) // n)) if len(words) <= 2 * LEAF * n else LEAF
        cuts = range(0, len(words), step)
        fresh.append(([sum(sizes[c:c + step]) for c in cuts], [sum(counts[c:c + step]) for c in cuts]))
    same = all(len(f[0]) == last - first for f, (first, last, _) in zip(fresh, regions, strict=True))
    if same:
        out = Tree(tree.sums.copy())
        for (chars, tokens), (first, _, _) in zip(fresh, regions, strict=True):
            for i, (c, t) in enumerate(zip(chars, tokens, strict=True)):
                out.set(first + i, c, t)
        return out
    chars, tokens, at = [], [], 0
    old = tree.sums[tree.width:]
    for (c, t), (first, last, _) in zip(fresh, regions, strict=True):
        chars += [*old[at:first, 0].tolist(), *c]
        tokens += [*old[at:first, 1].tolist(), *t]
        at = last
    return Tree.of(chars + old[at:used, 0].tolist(), tokens + old[at:used, 1].tolist())


def _parts(batches):
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(begin, SLICE_ROWS)


def _bytes(tree: Tree) -> bytes:
    return tree.sums.astype(np.int32).tobytes()


def _built(batches, path: str):
    count = counter(path)
    for part in _parts(batches):
        trees = [Tree.of(*count.leaves(t or "")) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array([_bytes(t) for t in trees], pa.binary()), pa.array([t.tokens for t in trees], pa.int64())],
            [*part.schema.names, "tree", "n_tokens"])


def build_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` with ``tree`` (sums as 32-bit numbers in heap order) and ``n_tokens``.

    Null texts have an empty tree and no tokens.  Repeated rows and rows
    without an id have trees of their own.  Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_built, path=tokenizer), f"doc_id {kind}, text string, tree binary, n_tokens long")


def _edited(batches, path: str):
    count = counter(path)
    for part in _parts(batches):
        out = []
        for text, raw, edits in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            tree = Tree(np.frombuffer(raw, np.int32).astype(np.int64).reshape(-1, 2))
            usable = [(e["start"], e["end"], e["new"] or "") for e in edits or [] if e and e["start"] is not None and e["end"] is not None]
            after, new, encoded, made = edit(text or "", tree, usable, count)
            out.append((after if text is not None or usable else None, _bytes(new), new.tokens, tree.tokens, made, encoded))
        texts, trees, *numbers = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(texts, pa.string()), pa.array(trees, pa.binary()),
             *(pa.array(x, pa.int64()) for x in numbers)],
            ["doc_id", "text", "tree", "n_tokens", "n_before", "n_edits", "n_encoded"])


def apply_edits(trees: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """The rows of ``build_trees`` after the edits in the column ``edits``.

    The column holds an array of ``start, end, new``: code points ``start`` to
    ``end`` of the text become ``new``.  Edits with a null border are left out,
    a null ``new`` deletes, a null array changes nothing; overlapping edits
    after the first are left out.  ``n_before`` is the count before, ``n_edits``
    the number of edits made, ``n_encoded`` the characters encoded again.
    """
    kind = trees.schema["doc_id"].dataType.simpleString()
    return trees.select("doc_id", "text", "tree", F.col(edits)).mapInArrow(
        partial(_edited, path=tokenizer),
        f"doc_id {kind}, text string, tree binary, n_tokens long, "
        "n_before long, n_edits long, n_encoded long")
