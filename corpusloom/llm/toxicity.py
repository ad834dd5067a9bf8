"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

A lexicon of terms and stems is held in a trie.  The automaton that accepts all
words within the allowed distance of a term runs over the trie; its states are
sets of (trie node, edits) and are made when first met, so a word costs one
dictionary step per letter.  Longer terms allow more edits; a stem accepts
whatever follows it.  Words are runs of letters, and also what white space
separates, without outer punctuation: an inner digit or symbol costs an edit.

Each hit is looked at in its context window: inside quotation marks, or near a
word of reporting, it counts as quoted, else as abuse.  Counts of both kinds,
for exact and for misspelled hits, go into a logistic model.

The lexicon is a list of common insults and what a bounded sample of at most
``FIT_ROWS`` labelled documents adds: words and stems whose neighbours differ from
use to use (so copies of one document count once) and that are hardly ever
found in documents without the label.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.arrays import Texts, mix, slices
from corpusloom.llm.logit import fit
from corpusloom.llm.sampling import hashed_sample

FIT_ROWS = 20_000
#: Uses with different neighbours that a learned term needs, and their least share in toxic documents.
MIN_USES, MIN_SHARE = 5, 0.9
STEMS = range(4, 8)
THRESHOLD = 0.3
CACHE_WORDS = 300_000
WINDOW = 8

#: Common English insults.
INSULTS = ("bastard", "clown", "disgusting", "dumb", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid",
           "trash", "vermin", "worthless")
#: Words that report what others say.
REPORTING = ("called", "calls", "quote", "quoted", "quotes", "said", "says", "slur", "term", "word", "wrote", "writes")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_WORDLIKE = _LETTER.copy()
_WORDLIKE[[*range(48, 58)]] = True
_QUOTE = ord('"')
#: Prior weights: constant, abuse, quoted, misspelled abuse, misspelled quoted, share of hits.
PRIOR = np.array([-4.0, 4.0, 0.3, 1.0, 0.0, 1.0])
PRECISION = np.array([0.1, 0.3, 3.0, 0.3, 3.0, 0.3])


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """The product of the lexicon trie and the Levenshtein automaton, made as it is used.

    ``match(word)`` gives -1 for no hit, else the least number of edits to a
    term (0 for a stem).  A stem ends with ``*``.
    """

    DEAD, ANY = 0, 1

    def __init__(self, terms):
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]  # edits allowed for the term that ends here
        self.stem: list[bool] = [False]
        for term in sorted(terms):
            node = 0
            for letter in term.rstrip("*"):
                node = self.child[node].setdefault(letter, len(self.child))
                if node == len(self.child):
                    self.child.append({})
                    self.ends.append(-1)
                    self.stem.append(False)
            if term.endswith("*"):
                self.stem[node] = True
            else:
                self.ends[node] = edits_allowed(term)
        self.reach = [0] * len(self.child)  # most edits any term below allows
        for node in range(len(self.child) - 1, -1, -1):
            self.reach[node] = max([max(0, self.ends[node]), *(self.reach[c] for c in self.child[node].values())])
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {frozenset(): self.DEAD, frozenset({-1}): self.ANY}
        self.sets: list[frozenset] = [frozenset(), frozenset({-1})]
        self.moves: list[dict[str, int]] = [{}, {}]
        self.score: list[int] = [-1, 0]
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, pairs: set) -> frozenset:
        """With letters of terms that the word leaves out."""
        todo, seen = list(pairs), dict()
        while todo:
            node, edits = todo.pop()
            if edits > self.reach[node] or seen.get(node, 9) <= edits:
                continue
            seen[node] = edits
            todo.extend((c, edits + 1) for c in self.child[node].values())
        return frozenset(seen.items())

    def _state(self, found: frozenset) -> int:
        if any(edits == 0 and self.stem[node] for node, edits in found):
            return self.ANY
        if found not in self.states:
            self.states[found] = len(self.sets)
            self.sets.append(found)
            self.moves.append({})
            hits = [edits for node, edits in found if edits <= self.ends[node]]
            self.score.append(min(hits, default=-1))
        return self.states[found]

    def _move(self, state: int, letter: str) -> int:
        to = set()
        for node, edits in self.sets[state]:
            for c, child in self.child[node].items():
                to.add((child, edits if c == letter else edits + 1))
            to.add((node, edits + 1))
        return self._state(self._closed(to))

    def match(self, word: str) -> int:
        if len(self.sets) > CACHE_WORDS:
            self._reset()
        state, moves = self.start, self.moves
        for letter in word:
            known = moves[state]
            if letter not in known:
                known[letter] = self._move(state, letter)
            state = known[letter]
            if state <= self.ANY:
                break
        return self.score[state]


def letter_runs(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of letters; ``texts`` are in lower case."""
    solid = np.concatenate(([False], _LETTER[texts.data], [False]))
    edge = solid[1:] != solid[:-1]
    cut = texts.bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(texts.data))]
    inner = np.unique(cut[solid[cut] & solid[cut + 1]])
    starts = np.sort(np.concatenate((np.flatnonzero(edge & solid[1:]), inner)))
    ends = np.sort(np.concatenate((np.flatnonzero(edge & solid[:-1]), inner)))
    return starts, ends


def mixed_words(texts: Texts, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of white-space words with letters and 1 to ``most`` other bytes within, outer punctuation left out."""
    starts, ends = texts.words
    solid = np.concatenate(([0], np.cumsum(_WORDLIKE[texts.data])))
    at = np.flatnonzero(_WORDLIKE[texts.data])
    held = solid[ends] > solid[starts]
    first, last = solid[starts[held]], solid[ends[held]] - 1
    starts, ends = at[first], at[last] + 1
    letters = np.concatenate(([0], np.cumsum(_LETTER[texts.data])))
    n = letters[ends] - letters[starts]
    other = ends - starts - n
    fit_ = (n > 0) & (other > 0) & (other <= most)
    return starts[fit_], ends[fit_]


class Scanner:
    """Counts of hits in texts, with the words met before remembered by their hash."""

    def __init__(self, terms):
        self.automaton = LexiconAutomaton(terms)
        #: Most bytes other than letters that a word within the allowed edits of a term can hold.
        self.most_other = max((edits_allowed(t) + int((~_LETTER[list(t.encode())]).sum()) for t in terms if not t.endswith("*")), default=0)
        self.reporting = {w.encode() for w in REPORTING}
        self.known: dict[int, int] = {}

    def _kinds(self, texts: Texts, starts, ends, hashes) -> np.ndarray:
        """-1: nothing, 0: exact hit, 1: misspelled hit, 2: word of reporting."""
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, data = self.known, texts.data.tobytes()
        out = np.empty(len(keys), np.int8)
        for i, (key, at) in enumerate(zip(keys.tolist(), first.tolist(), strict=True)):
            kind = known.get(key)
            if kind is None:
                raw = data[starts[at]:ends[at]]
                kind = 2 if raw in self.reporting else min(1, self.automaton.match(raw.decode("utf-8", "replace")))
                known[key] = kind
            out[i] = kind
        return out[which]

    def features(self, texts: Texts) -> np.ndarray:
        texts = texts.lowered()
        starts, ends = letter_runs(texts)
        owner = texts.owners(starts)
        kinds = self._kinds(texts, starts, ends, texts.hashes(starts, ends))
        self._add_mixed(texts, starts, kinds)
        hits = np.flatnonzero((kinds == 0) | (kinds == 1))
        quoted = self._quoted(texts, starts, kinds, owner, hits)
        count = [np.bincount(owner[hits[(kinds[hits] == kind) & (quoted == q)]], minlength=len(texts))
                 for kind in (0, 1) for q in (False, True)]
        words = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        share = 10 * (count[0] + count[2]) / words
        return np.stack([np.ones(len(texts)), *(np.log1p(c) for c in count), np.minimum(share, 3)], axis=1)

    def _add_mixed(self, texts: Texts, starts, kinds) -> None:
        """Counts a hit of a whole word at its first run of letters, unless one of its runs is a hit."""
        begins, ends = mixed_words(texts, self.most_other)
        first, after = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
        hit = np.concatenate(([0], np.cumsum((kinds == 0) | (kinds == 1))))
        free = hit[after] == hit[first]
        begins, ends, first = begins[free], ends[free], first[free]
        found = self._kinds(texts, begins, ends, texts.hashes(begins, ends))
        met = (found == 0) | (found == 1)
        kinds[first[met]] = found[met]

    @staticmethod
    def _quoted(texts: Texts, starts, kinds, owner, hits) -> np.ndarray:
        """Hits within quotation marks of their line, or close to a word of reporting."""
        marks = np.concatenate(([0], np.cumsum(texts.data == _QUOTE)))
        breaks = np.concatenate((texts.bounds[:-1], np.flatnonzero(texts.data == 10)))
        breaks.sort()
        line = np.searchsorted(breaks, starts[hits], "right")
        begin = breaks[line - 1]
        end = np.concatenate((breaks, [len(texts.data)]))[line]
        inside = ((marks[starts[hits]] - marks[begin]) % 2 == 1) & (marks[end] > marks[starts[hits]])
        told = np.flatnonzero(kinds == 2)
        before = np.searchsorted(told, hits)
        near = np.zeros(len(hits), bool)
        if len(told):
            for at in (np.maximum(before - 1, 0), np.minimum(before, len(told) - 1)):
                near |= (np.abs(told[at] - hits) <= WINDOW) & (owner[told[at]] == owner[hits])
        return inside | near


def _uses(batches):
    """Words of labelled texts with a hash of their neighbours, once per document."""
    for batch, texts in slices(batches):
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        texts = texts.lowered()
        starts, ends = letter_runs(texts)
        if not len(starts):
            continue
        owner, hashes = texts.owners(starts), texts.hashes(starts, ends)
        padded = np.concatenate(([0], hashes, [0])).astype(np.uint64)
        around = mix(padded[:-2] * np.uint64(3) + padded[2:] * np.uint64(5))
        data = texts.data.tobytes()
        words = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()), pa.array(around.view(np.int64)), pa.array(toxic[owner])],
            ["word", "around", "toxic"])


def learn_terms(sample: DataFrame) -> list[str]:
    """Terms and stems that a labelled sample (``text, toxic``) adds to the lexicon.

    Words stay beside the stems that cover them: stems allow no edit.
    """
    uses = sample.select("text", "toxic").mapInArrow(_uses, "word string, around long, toxic boolean").distinct()
    stems = F.transform(F.sequence(F.lit(STEMS[0]), F.lit(STEMS[-1])),
                        lambda n: F.when(F.length("word") > n, F.concat(F.substring("word", F.lit(1), n), F.lit("*"))))
    terms = uses.select(F.explode(F.concat(F.array("word"), stems)).alias("term"), "toxic").where("length(term) > 3")
    counted = terms.groupBy("term").agg(F.count("*").alias("n"), F.count_if("toxic").alias("k"))
    found = {r.term for r in counted.where((F.col("k") >= MIN_USES) & (F.col("k") >= MIN_SHARE * F.col("n"))).collect()}
    short = {t for t in found if t.endswith("*") and not any(t[:n] + "*" in found for n in STEMS if n < len(t) - 1)}
    return sorted(short | {t for t in found if not t.endswith("*")})


def _hit_features(batches, terms):
    scanner = Scanner(terms)
    for batch, texts in slices(batches):
        f = scanner.features(texts)
        lists = pa.ListArray.from_arrays(np.arange(0, f.size + 1, f.shape[1], dtype=np.int32), f.ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["toxic", "x"])


def _scores(batches, terms, weights):
    scanner = Scanner(terms)
    for batch, texts in slices(batches):
        z = np.clip(scanner.features(texts) @ weights, -30, 30)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(1 / (1 + np.exp(-z)), 9))], ["doc_id", "score"])


class ToxicityModel:
    """A lexicon and weights; ``score`` works on any ``doc_id, text``."""

    def __init__(self, terms, weights: np.ndarray):
        self.terms, self.weights = tuple(terms), weights

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
        """Learns from ``labels`` (``doc_id, toxic``) whose documents are in ``docs``.

        At most ``fit_rows`` labelled rows are used, spread by a hash of the id.
        Rows with a null id or label are not.  Without rows the common insults
        and the prior weights stand.
        """
        rows = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        chosen = hashed_sample(rows, fit_rows, "doc_id", "toxic")
        sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))
        terms = sorted({*INSULTS, *learn_terms(sample)})
        seen = sample.select("toxic", "text").mapInArrow(partial(_hit_features, terms=terms), "toxic boolean, x array<double>").toPandas()
        x = np.array(seen["x"].tolist(), float).reshape(len(seen), len(PRIOR))
        order = np.lexsort((*x.T, seen["toxic"].to_numpy(bool)))
        return cls(terms, np.round(fit(x[order], seen["toxic"].to_numpy(float)[order], PRIOR, PRECISION), 9))

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score`` of every row; the score is from 0 to 1.

        Null and empty texts have no hits and get the lowest score.  Repeated
        rows and rows without an id are scored each.
        """
        kind = docs.schema["doc_id"].dataType.simpleString()
        work = partial(_scores, terms=self.terms, weights=self.weights)
        return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, learned without the held-out rows."""
    model = ToxicityModel.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return model.score(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
