"""Quality rules as a short-circuit cascade.

Each rule rejects documents from their whole text.  On a bounded sample
(``SAMPLE`` documents) every rule is timed and its rejections are counted; the
cascade then asks the rules in the order of rejections per second, and each
rule reads only the documents that all rules before it have let pass.  The
order changes the time, never the verdict: a document is kept when no rule
rejects it.

Rules compare whole numbers, so their results do not depend on rounding.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.arrays import Texts, mix, slices, texts_of
from corpusloom.llm.sampling import hashed_sample

SAMPLE = 2000
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_NEWLINE = 10


# ---------------------------------------------------------------- measures, one number per document

def n_words(texts: Texts) -> np.ndarray:
    return texts.counts(texts.words[0])


def word_chars(texts: Texts) -> np.ndarray:
    """Code points in words."""
    starts, ends = texts.words
    total = np.concatenate(([0], np.cumsum(_CODE_POINT[texts.data], dtype=np.int64)))
    each = np.concatenate(([0], np.cumsum(total[ends] - total[starts])))
    return np.diff(each[np.searchsorted(starts, texts.bounds)])


def n_symbols(texts: Texts) -> np.ndarray:
    return texts.sums(SYMBOLS[texts.data])


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the lines that hold a word."""
    breaks = np.flatnonzero(texts.data == _NEWLINE)
    starts = np.unique(np.concatenate((texts.bounds[:-1], breaks + 1)))
    starts = starts[starts < len(texts.data)]
    ends = np.concatenate((starts[1:], [len(texts.data)]))[:len(starts)]
    ends = ends - (texts.data[ends - 1] == _NEWLINE)
    words = texts.words[0]
    full = np.searchsorted(words, starts) < np.searchsorted(words, ends)
    return starts[full], ends[full]


def n_lines(texts: Texts) -> np.ndarray:
    """Lines that hold a word."""
    return texts.counts(_lines(texts)[0])


def n_dup_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of the document."""
    starts, ends = _lines(texts)
    owner = texts.owners(starts)
    keys = texts.hashes(starts, ends) ^ mix(owner.astype(np.uint64) + np.uint64(1))
    repeated = np.ones(len(keys), bool)
    repeated[np.unique(keys, return_index=True)[1]] = False
    return np.bincount(owner[repeated], minlength=len(texts))


def n_repeat_words(texts: Texts, window: int = 3) -> np.ndarray:
    """Words in windows of three that the document has twice or more, the first included."""
    starts, ends = texts.words
    owner, hashes = texts.owners(starts), texts.hashes(starts, ends)
    last = len(hashes) - window + 1
    if last <= 0:
        return np.zeros(len(texts), np.int64)
    keys = mix(owner[:last].astype(np.uint64) + np.uint64(1))
    for k in range(window):
        keys = mix(keys + hashes[k:k + last] * np.uint64(2 * k + 3))
    inside = np.flatnonzero(owner[:last] == owner[window - 1:])
    _, which, often = np.unique(keys[inside], return_inverse=True, return_counts=True)
    twice = inside[often[which] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    return np.bincount(owner[np.cumsum(cover)[:-1] > 0], minlength=len(texts))


# ---------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """``rejects`` gives one truth value per document."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def few_words(texts: Texts) -> np.ndarray:
    return n_words(texts) < 50


def repeated_words(texts: Texts) -> np.ndarray:
    return 100 * n_repeat_words(texts) > 50 * n_words(texts)


def many_symbols(texts: Texts) -> np.ndarray:
    """More than one symbol of ``#*$%&|<>`` in five words."""
    return 5 * n_symbols(texts) > n_words(texts)


def odd_words(texts: Texts) -> np.ndarray:
    """Mean word length below 2 or above 20."""
    chars, words = word_chars(texts), n_words(texts)
    return (chars < 2 * words) | (chars > 20 * words)


def repeated_lines(texts: Texts) -> np.ndarray:
    """More than half of the lines repeat an earlier one."""
    return 2 * n_dup_lines(texts) > n_lines(texts)


def capitals(texts: Texts) -> np.ndarray:
    """More than half of the ASCII letters are capitals."""
    return 2 * texts.sums(_UPPER[texts.data]) > texts.sums(_LETTER[texts.data])


BASE = (Rule("few_words", few_words), Rule("repeated_words", repeated_words))
EXTRA = (Rule("many_symbols", many_symbols), Rule("odd_words", odd_words),
         Rule("repeated_lines", repeated_lines), Rule("capitals", capitals))


def ordered(rules: tuple[Rule, ...], sample: Texts) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample, measured one by one on fresh texts."""
    gain = {}
    for rule in rules:
        fresh = Texts(sample.data, sample.bounds)
        start = time.perf_counter()
        rejected = int(rule.rejects(fresh).sum())
        gain[rule.name] = rejected / (time.perf_counter() - start)
    return tuple(sorted(rules, key=lambda r: -gain[r.name]))


def passes(texts: Texts, rules: tuple[Rule, ...], alive: np.ndarray) -> np.ndarray:
    """Which of the documents ``alive`` no rule rejects; rules see survivors only."""
    alive = alive.copy()
    left, rest = np.flatnonzero(alive), texts
    if len(left) < len(alive):
        rest = texts.subset(left)
    for rule in rules:
        if not len(left):
            break
        rejected = rule.rejects(rest)
        if rejected.any():
            alive[left[rejected]] = False
            rest, left = rest.subset(np.flatnonzero(~rejected)), left[~rejected]
    return alive


def _sample(docs: DataFrame) -> Texts:
    """At most ``SAMPLE`` whole texts, spread over the table by a hash; collected to time the rules."""
    rows = hashed_sample(docs.select("doc_id", "text").where("text is not null"), SAMPLE, "text").toArrow()
    return texts_of(rows.column("text"))


def _measured(batches, rules):
    for batch, texts in slices(batches):
        words, repeats = n_words(texts), n_repeat_words(texts)
        failed = (words < 50) | (100 * repeats > 50 * words)
        kept = passes(texts, rules, ~failed)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (
                words, word_chars(texts), n_symbols(texts), n_dup_lines(texts), repeats)), pa.array(failed), pa.array(kept)],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])


def _judged(batches, rules):
    for batch, texts in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(passes(texts, rules, np.ones(len(texts), bool)))], ["doc_id", "kept"])


def quality_measures(docs: DataFrame) -> DataFrame:
    """All measures and the verdict of every row of ``docs`` (``doc_id, text``).

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` are counted
    for every document; ``base_failed`` when it has fewer than 50 words or more
    than half of them in repeated windows; ``kept`` when the base and the
    cascade of the further rules let it pass.  Null texts count as empty and
    fail.  Repeated rows are judged each, rows without an id too.  Other
    columns are not read.
    """
    rules = ordered(EXTRA, _sample(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_measured, rules=rules),
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean")


def quality_cascade(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``doc_id, kept`` of every row: all rules in one cascade, no measure more than it needs."""
    rules = ordered(rules, _sample(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_judged, rules=rules), f"doc_id {kind}, kept boolean")


def _passing(batches, rules):
    for batch, texts in slices(batches):
        yield batch.filter(pa.array(passes(texts, rules, np.ones(len(texts), bool))))


def keep_passing(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns; nothing is shuffled."""
    return docs.mapInArrow(partial(_passing, rules=ordered(rules, _sample(docs))), docs.schema)
