"""Personal data: patterns, and a semi-Markov conditional random field for what they miss.

Patterns find the base spans of four kinds.  Around every trigger (a digit, ``@``
or ``=``) a region of tokens is then segmented by a semi-Markov field (Sarawagi and
Cohen, NIPS 2004): every candidate segment is scored as a whole, for each kind,
by its digits, letters, length, check sums, neighbours and cue words, and dynamic
programming over segments of at most ``MAX_TOKENS`` tokens chooses boundaries
and kinds together.  Base spans always stay; the field adds spans that overlap
none of them.

The field is trained by penalised maximum likelihood on regions of at most
``FIT_DOCS`` documents.  Its labels are the base spans and, as a fifth kind, the
secrets whose written form is beyond doubt (``SECRETS``); it carries over to
other forms through its features.  All texts are searched whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.sampling import hashed_sample

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
FIT_DOCS, FIT_REGIONS, EPOCHS = 1500, 250, 60
MAX_TOKENS, MARGIN, REGION_TOKENS = 12, 3, 400

# Each pattern is linear in the text: a match can only begin where a run begins.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Secrets beyond doubt, used as labels only; the last group is the span.
SECRETS = (re.compile(r"\b(AKIA[0-9A-Z]{16})\b"),
           re.compile(r"\b(?:password|passwd|token|secret|api_?key)\s?[=:]\s?\"?([0-9A-Za-z]{16,64})\b"))
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Matches of ``local@domain``, from the signs of ``@`` on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start; ends are exclusive, in code points."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not any(c in text for c in "0123456789"):
        return found
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _DIGITS.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group()) if len(m.group()) >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                  if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return found


# ---------------------------------------------------------------- regions, segments, features

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_TRIGGER = re.compile(r"[0-9@=]")
_CUES = {w: i + 1 for i, w in enumerate(
    "password passwd pwd token secret key apikey bearer tel phone call mail email card visa ip addr".split())}
_SLOTS = (8, 13, 8, 4, 3, 3, 3, 6, len(_CUES) + 1, 7, 7, 6, 48, 2)
_OFFSETS = np.cumsum((0, *_SLOTS[:-1]))
N_FEATURES = sum(_SLOTS)
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_STEPS = (1, 3, 6, 8, 12, 16, 20)


def _side(c: str) -> int:
    if not c:
        return 0
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in "\"'" else 5 if c == "=" else 6


def _charset(s: str) -> int:
    digits, letters = any("0" <= c <= "9" for c in s), any(c.isalpha() for c in s)
    if not s.isalnum():
        return 5
    if not letters:
        return 0
    if not digits:
        return 4
    return 1 if all(c in "0123456789abcdef" for c in s) else 2 if s.isupper() else 3


def segment_features(text: str, start: int, end: int, tokens: int, cue: int) -> list[int]:
    """One value for each slot of a whole segment."""
    s = text[start:end]
    digits = _NOT_DIGIT.sub("", s)
    n, size = len(digits), min(7, max(0, len(s).bit_length() - 1))
    at = s.count("@")
    charset = _charset(s)
    plus = s[0] == "+"
    ends = 3 * (s[-1].isalnum()) + (0 if s[0].isalnum() else 1 if plus else 2)
    slots = (
        bisect_left(_STEPS, n + 1), min(tokens, 12), size, 0 if not at else 3 if at > 1 else 2 if "." in s.partition("@")[2] else 1,
        0 if s.count(".") != 3 or not _QUAD.fullmatch(s) else 2 if all(int(p) < 256 for p in s.split(".")) else 1,
        0 if not 16 <= n <= 19 or s.strip("0123456789 -") else 2 if luhn(digits) else 1,
        0 if not plus else 2 if 8 <= n <= 15 else 1, charset, cue, _side(text[start - 1:start]), _side(text[end:end + 1]),
        ends, 8 * charset + size, int(any(c.isspace() for c in s)))
    return slots


class Region:
    """Tokens near triggers, their candidate segments and the features of these."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]):
        self.tokens = tokens
        cues = []
        for k, (a, b) in enumerate(tokens):
            near = [_CUES.get(text[x:y].lower(), 0) for x, y in tokens[max(0, k - 4):k]]
            cues.append(next((c for c in reversed(near) if c), 0))
        seen = [bool(_TRIGGER.search(text, a, b)) and text[a] != "=" for a, b in tokens]
        pairs, rows = [], []
        for i, (a, _) in enumerate(tokens):
            first = text[a]
            whole = first.isalnum() or first in "+("
            trigger = False
            for j in range(i, min(i + MAX_TOKENS, len(tokens))):
                b = tokens[j][1]
                trigger |= seen[j]
                if j == i or (whole and trigger and text[b - 1].isalnum()):
                    pairs.append((i, j + 1))
                    rows.append(segment_features(text, a, b, j + 1 - i, cues[i]))
                if "\n" in text[b:tokens[j + 1][0] if j + 1 < len(tokens) else b]:
                    break
        self.pairs = pairs
        self.x = np.array(rows, np.int64).reshape(len(rows), len(_SLOTS)) + _OFFSETS
        # A single token may be outside or, with a trigger, an entity; longer segments are entities.
        self.single = np.array([j - i == 1 for i, j in pairs])
        self.entity = np.array([text[tokens[i][0]].isalnum() and any(seen[i:j]) or j - i > 1 for i, j in pairs])


def regions(text: str) -> list[Region]:
    """The parts of a text in which a span can lie; each has a bounded number of tokens."""
    if not _TRIGGER.search(text):
        return []
    out = []
    marks = [m.start() for m in _TRIGGER.finditer(text)]
    low = 0
    while low < len(marks):
        high = low
        while high + 1 < len(marks) and marks[high + 1] - marks[high] <= 40 and marks[high + 1] - marks[low] < 4 * REGION_TOKENS:
            high += 1
        a, b = max(0, marks[low] - 48), min(len(text), marks[high] + 64)
        tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
        begin = next(k for k, t in enumerate(tokens) if t[1] > marks[low])
        end = next((k for k, t in enumerate(tokens) if t[0] > marks[high]), len(tokens))
        tokens = tokens[max(0, begin - MAX_TOKENS):min(len(tokens), end + MARGIN)]
        out.append(Region(text, tokens))
        low = high + 1
    return out


# ---------------------------------------------------------------- the field

_TYPES = len(KINDS) + 1  # the last is outside
_OUT = len(KINDS)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


class Field:
    """Weights for (kind, feature) and (kind, next kind)."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((_TYPES, N_FEATURES)) if weights is None else weights
        self.moves = np.zeros((_TYPES, _TYPES)) if moves is None else moves

    def scores(self, region: Region) -> np.ndarray:
        s = self.weights[:, region.x].sum(axis=2).T
        s[~region.entity, :_OUT] = -np.inf
        s[~region.single, _OUT] = -np.inf
        return s

    def best(self, region: Region) -> list[tuple[int, int, int]]:
        """The most probable segmentation: ``(kind, first token, end token)`` of the entities."""
        n, s = len(region.tokens), self.scores(region)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j) in enumerate(region.pairs):
            ending[j].append(k)
        top = np.full((n + 1, _TYPES), -np.inf)
        top[0, _OUT] = 0
        entry, from_kind = np.full((n + 1, _TYPES), -np.inf), np.zeros((n + 1, _TYPES), int)
        back = np.zeros((n + 1, _TYPES), int)
        for j in range(n + 1):
            if j:
                found = np.stack([entry[region.pairs[k][0]] + s[k] for k in ending[j]])
                which = found.argmax(axis=0)
                top[j] = found[which, np.arange(_TYPES)]
                back[j] = np.array(ending[j])[which]
            steps = top[j][:, None] + self.moves
            from_kind[j] = steps.argmax(axis=0)
            entry[j] = steps.max(axis=0)
        out, j, kind = [], n, int(top[n].argmax())
        while j:
            i = region.pairs[back[j, kind]][0]
            if kind != _OUT:
                out.append((kind, i, j))
            j, kind = i, int(from_kind[i, kind])
        return out[::-1]

    def gradient(self, region: Region, gold: dict[tuple[int, int], int], weights: np.ndarray, moves: np.ndarray) -> float:
        """Adds observed minus expected counts; returns the log-likelihood."""
        n, s = len(region.tokens), self.scores(region)
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j) in enumerate(region.pairs):
            starting[i].append(k)
            ending[j].append(k)
        alpha = np.full((n + 1, _TYPES), -np.inf)
        alpha[0, _OUT] = 0
        entry = np.empty((n + 1, _TYPES))
        for j in range(n + 1):
            if j:
                alpha[j] = _log_sum(np.stack([entry[region.pairs[k][0]] + s[k] for k in ending[j]]), 0)
            entry[j] = _log_sum(alpha[j][:, None] + self.moves, 0)
        total = _log_sum(alpha[n], 0)
        beta = np.zeros((n + 1, _TYPES))
        chosen = np.zeros(s.shape)
        likely = 0.0
        for i in range(n - 1, -1, -1):
            onward = np.stack([s[k] + beta[region.pairs[k][1]] for k in starting[i]])
            ahead = _log_sum(onward, 0)
            chosen[starting[i]] = np.exp(entry[i] + onward - total)
            moves -= np.exp(alpha[i][:, None] + self.moves + ahead - total)
            beta[i] = _log_sum(self.moves + ahead, 1)
        at, before = 0, _OUT
        while at < n:
            k = next((k for k in starting[at] if region.pairs[k] in gold), None)
            k, kind = (k, gold[region.pairs[k]]) if k is not None else (next(k for k in starting[at] if region.single[k]), _OUT)
            chosen[k, kind] -= 1
            moves[before, kind] += 1
            likely += s[k, kind] + self.moves[before, kind]
            at, before = region.pairs[k][1], kind
        for slot in range(region.x.shape[1]):
            np.subtract.at(weights.T, region.x[:, slot], chosen)
        return float(likely - total)

    @classmethod
    def fit(cls, cases: list[tuple[Region, dict]], epochs: int = EPOCHS, rate: float = 0.3, penalty: float = 0.02) -> Field:
        """Gradient ascent on the penalised likelihood with a step size per weight (Adagrad)."""
        field = cls()
        seen_w, seen_m = np.full(field.weights.shape, 1e-6), np.full(field.moves.shape, 1e-6)
        field.weights[_OUT] = 0.01
        batches = [cases[k::8] for k in range(8)] if len(cases) >= 8 else [cases]
        for step in range(epochs if cases else 0):
            part = batches[step % len(batches)]
            if not part:
                continue
            w, m = -penalty * field.weights, -penalty * field.moves
            for region, gold in part:
                field.gradient(region, gold, w, m)
            seen_w += w * w
            seen_m += m * m
            field.weights += rate * w / np.sqrt(seen_w)
            field.moves += rate * m / np.sqrt(seen_m)
        return field


def _gold(text: str, region: Region) -> dict[tuple[int, int], int] | None:
    """Labelled segments of a region; None if one does not fit its tokens."""
    starts = {a: i for i, (a, _) in enumerate(region.tokens)}
    ends = {b: j + 1 for j, (_, b) in enumerate(region.tokens)}
    spans = [(KINDS.index(k), a, b) for k, a, b in base_spans(text)]
    taken = [(a, b) for _, a, b in spans]
    for pattern in SECRETS:
        spans += [(4, *m.span(1)) for m in pattern.finditer(text) if not any(a < m.end(1) and m.start(1) < b for a, b in taken)]
    gold, used = {}, set()
    low, high = region.tokens[0][0], region.tokens[-1][1]
    for kind, a, b in spans:
        if b <= low or a >= high:
            continue
        pair = (starts.get(a), ends.get(b))
        if pair not in region.index or used & set(range(*pair)):
            return None
        used |= set(range(*pair))
        gold[pair] = kind
    return gold


def train(texts: list[str]) -> Field:
    """A field from the regions of these texts, those with spans first, as many without."""
    found, clear = [], []
    for text in texts:
        for region in regions(text):
            region.index = set(region.pairs)
            gold = _gold(text, region)
            if gold is not None and len(region.tokens) <= 80:
                (found if gold else clear).append((region, gold))
        if len(found) >= FIT_REGIONS and len(clear) >= FIT_REGIONS:
            break
    return Field.fit(found[:FIT_REGIONS] + clear[:FIT_REGIONS])


def find_spans(text: str, field: Field) -> tuple[list, list]:
    """The base spans, and all spans with those the field adds, both by kind and start."""
    base = base_spans(text)
    added = []
    if _TRIGGER.search(text):
        taken = sorted((a, b) for _, a, b in base)
        starts = [a for a, _ in taken]
        longest = max((b - a for a, b in taken), default=0)
        for region in regions(text):
            for kind, i, j in field.best(region):
                a, b = region.tokens[i][0], region.tokens[j - 1][1]
                k = bisect_left(starts, a - longest)
                clash = False
                while k < len(taken) and taken[k][0] < b:
                    clash |= taken[k][1] > a
                    k += 1
                if not clash:
                    added.append((KINDS[kind], a, b))
    added = _without_overlap(added)
    return base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1]))


def _without_overlap(spans: list) -> list:
    out, end = [], -1
    for span in sorted(set(spans), key=lambda x: (x[1], -x[2])):
        if span[1] >= end:
            out.append(span)
            end = span[2]
    return out


def _found(batches, field: Field):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            base, every = zip(*(find_spans(t or "", field) for t in part.column(1).to_pylist()), strict=True)
            columns = [pa.array([[dict(kind=k, start=a, end=b) for k, a, b in x] for x in spans], span) for spans in (base, every)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "base", "spans"])


def _masked(batches, field: Field):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            texts = [t if t is None else mask(t, find_spans(t, field)[1]) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))


def mask(text: str, spans: list) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def fit_field(docs: DataFrame, n: int = FIT_DOCS) -> Field:
    """Trained on ``n`` texts with triggers at most, spread by a hash of the id."""
    rows = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@=]"))
    sample = hashed_sample(rows, n, "text").toArrow()
    return train(sample.column("text").to_pylist())


def pii_spans(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, base, spans`` of every row: arrays of ``kind, start, end`` in code points.

    ``base`` has the spans of the patterns, ``spans`` also those the field adds.
    Null texts count as empty and have none.  Repeated rows and rows without an
    id are searched each.  Other columns are not read.
    """
    field = field or fit_field(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(partial(_found, field=field), f"doc_id {kind}, base {span}, spans {span}")


def mask_pii(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the spans in ``text`` replaced by ``[kind]``; null stays null."""
    return docs.mapInArrow(partial(_masked, field=field or fit_field(docs)), docs.schema)
