"""Secrets in text: a keyword automaton first, anchored patterns only at its hits, then checksums.

One Aho-Corasick automaton (``pyahocorasick``) over the text, with A-Z lower-cased
in place so that offsets stay, finds every place where a secret can begin.  Only
there is an anchored pattern tried (``re.match`` at the hit), so a text without
keywords costs one pass of the automaton.  Runs of lower-case hex digits have no
keyword; they are found by one linear scan for runs of 24 or more.

Base kinds (leftmost non-overlapping matches per kind; a match that fails its
length test is dropped and its characters are not searched again):

* ``assign``: a keyword (``password``, ``passwd``, ``secret``, ``token``,
  ``api_key`` or ``apikey``, letters in either case), an optional quote, ``:``
  or ``=`` between spaces, an optional quote and a value of 6 or more of
  ``A-Za-z0-9+/_.=-``; the span is the whole match.
* ``access``: ``AKIA`` and upper-case letters or digits, 20 or more in all.
* ``hex``: runs of ``0-9a-f``, 24 or more.

The method adds kinds that carry a check of their own:

* ``token``: ``ghp_``, ``gho_``, ``ghu_``, ``ghs_``, ``ghr_`` or ``npm_`` and a run of
  ``0-9A-Za-z``; valid if the run has 36 characters whose last 6 equal the CRC-32
  of the first 30, written in base 62 (digits, upper, lower case) with leading
  ``0``.  Tokens of this format embed their checksum, so typos and random strings fail.
* ``private_key``: ``-----BEGIN <label>PRIVATE KEY-----``, a body of base-64
  characters and white space, ``-----END <label>PRIVATE KEY-----`` (labels of
  ``A-Z`` and spaces); valid if both labels are equal and the body without white
  space is well-formed base 64 of at least 64 bytes.

Spans are ``(kind, start, end)`` in code points, end exclusive.  Null texts count
as empty and have none; so have empty texts.  Texts of any length are searched
whole; the cost is linear in the text plus the hits.
"""

from __future__ import annotations

import re
import zlib
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "token", "private_key")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

# The keywords of the ``assign`` kind and the prefixes of checksummed tokens.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
TOKEN_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _either_case(word: str) -> str:
    """A pattern for ``word`` whose ASCII letters match in either case, and nothing else."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else re.escape(c) for c in word)


#: The keyword part as written in the contract: (password|passwd|secret|token|api_?key).
KEYWORD = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + \
    _either_case("api") + "_?" + _either_case("key") + ")"
ASSIGN = re.compile(KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]+)")
PEM = re.compile(r"-----BEGIN ([A-Z\x20]*)PRIVATE KEY-----([A-Za-z0-9+/=\x20\x09-\x0D]+)-----END ([A-Z\x20]*)PRIVATE KEY-----")
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?")
_WHITE = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        machine.add_word(word, ("assign", len(word)))
    machine.add_word("akia", ("access", 4))
    for prefix in TOKEN_PREFIXES:
        machine.add_word(prefix, ("token", len(prefix)))
    machine.add_word("-----begin", ("private_key", 10))
    machine.make_automaton()
    return machine


_MACHINE = _automaton()


def base62_crc(part: str) -> str:
    """CRC-32 of ``part`` in base 62, six characters."""
    n, out = zlib.crc32(part.encode()), []
    for _ in range(6):
        n, r = divmod(n, 62)
        out.append(BASE62[r])
    return "".join(reversed(out))


def _hits(text: str) -> dict[str, list[int]]:
    """Sorted start offsets of the keywords of each kind."""
    found: dict[str, list[int]] = {kind: [] for kind in ("assign", "access", "token", "private_key")}
    for end, (kind, size) in _MACHINE.iter(text.translate(_LOWER)):
        found[kind].append(end - size + 1)
    for starts in found.values():
        starts.sort()
    return found


def _anchored(text: str, starts: list[int], pattern: re.Pattern, keep) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches that begin at one of ``starts``, those that ``keep`` passes."""
    out, done = [], 0
    for at in starts:
        if at < done:
            continue
        m = pattern.match(text, at)
        if m:
            done = m.end()
            if keep(m):
                out.append(m.span())
    return out


def _token_ok(m: re.Match) -> bool:
    run = m.group(1)
    return len(run) == 36 and base62_crc(run[:30]) == run[30:]


def _pem_ok(m: re.Match) -> bool:
    body = _WHITE.sub("", m.group(2))
    return m.group(1) == m.group(3) and _BASE64.fullmatch(body) is not None and 3 * len(body) // 4 - body.count("=") >= 64


def scan(text: str | None) -> tuple[list, list]:
    """``(base, spans)``: the base spans, and all spans; each sorted by start, then kind as listed."""
    text = text or ""
    hits = _hits(text)
    base = [("assign", a, b) for a, b in _anchored(text, hits["assign"], ASSIGN, lambda m: len(m.group(2)) >= 6)]
    base += [("access", a, b) for a, b in _anchored(text, hits["access"], ACCESS, lambda m: m.end() - m.start() >= 20)]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    added = [("token", a, b) for a, b in _anchored(text, hits["token"], TOKEN, _token_ok)]
    added += [("private_key", a, b) for a, b in _anchored(text, hits["private_key"], PEM, _pem_ok)]
    order = lambda s: (s[1], _ORDER[s[0]])
    return sorted(base, key=order), sorted(base + added, key=order)


def _found(batches, text: str):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for begin in range(0, batch.num_rows, 256):
            part = texts.slice(begin, 256).to_pylist()
            base, every = zip(*(scan(t) for t in part), strict=True) if part else ((), ())
            columns = [pa.array([[dict(kind=k, start=a, end=b) for k, a, b in x] for x in spans], span) for spans in (base, every)]
            yield pa.RecordBatch.from_arrays([ids.slice(begin, 256), *columns], ["doc_id", "base", "spans"])


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, base, spans`` of every row of ``docs``, spans as ``array<struct<kind, start, end>>``.

    Only ``doc_id`` and ``text`` are read, so other columns cannot clash.  Every
    row gives one row: repeated rows and rows without an id each; null texts
    give empty arrays.  An empty table gives an empty result.  The scan runs
    in the tasks that read the rows; nothing is shuffled.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    rows = docs.select("doc_id", docs[text].alias("text"))
    return rows.mapInArrow(partial(_found, text="text"), f"doc_id {kind}, base {spans}, spans {spans}")
