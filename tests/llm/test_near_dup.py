import random
import re

import pytest

from corpusloom.llm import near_dup
from corpusloom.llm.components import connected_components
from tests.conftest import rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORDS.findall(lower)
    return {" ".join(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute(texts, n, percent):
    """``doc_id: (size, component)`` by comparing all pairs."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Groups of near copies with few and many edits, chains, exact copies, odd texts."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(500)}" for _ in range(150)]
    texts = [edited(rng, base, rng.randrange(0, 12)) for _ in range(120)]
    for _ in range(15):
        own = [f"u{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 40, 300]))]
        texts += [edited(rng, own, rng.randrange(0, 3)) for _ in range(3)] + [" ".join(own), " ".join(own)]
    chain = [f"c{i}" for i in range(100)]
    for step in range(6):
        chain = chain[:20 * step % 100] + [f"x{step}"] + chain[20 * step % 100 + 1:]
        texts.append(" ".join(chain))
    texts += ["", " \t\n", "one", "One", "one two", "TWO one", "\x85 one", "é É", "a " * 30_000, "a " * 20_000 + "b"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_equals_all_pairs(spark, corpus, n, percent):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus.items()], "doc_id bigint, text string, rep int, component_id string")
    got = near_dup.near_duplicates(df, n, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(corpus, n, percent)
    assert rows(got) == sorted(((i, s, c, i == c) for i, (s, c) in want.items()), key=repr)


def test_nulls_repeats_and_text_ids(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame(
        [("b", text), ("b", text), ("a", text), (None, text), ("z", None), (None, None), ("y", "")], "doc_id string, text string")
    got = rows(near_dup.near_duplicates(df))
    assert got == sorted([("b", 3, "a", False)] * 2 + [("a", 3, "a", True), (None, 3, "a", False), ("z", 0, "z", True),
                                                       (None, 0, None, True), ("y", 0, "y", True)], key=repr)


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_bands_keep_links_at_the_threshold():
    for percent in (50, 80, 85, 95):
        assert (1 - (percent / 100) ** near_dup.ROWS) ** near_dup.bands_for(percent) <= near_dup.MISS


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(5, 5), (None, 3), (250, 101)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert rows(got) == sorted(((i, root(i)) for i in parent), key=repr)


def test_contested_shingles_take_one_python_worker(spark):
    """Two Python maps in one task would hold two workers for each core."""
    texts = {1: "a b c d e f g", 2: "a b c d e f h", 3: "x", 4: None, 5: "a b c d e a b c d e"}
    search = near_dup._Search(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), 5, 80)
    got = search.shingles_of(spark.createDataFrame([(i,) for i in texts], "doc_id bigint"))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(i for i, _ in rows(got)) == sorted(i for i, t in texts.items() for _ in shingles(t, 5))
    assert len({s for _, s in rows(got)}) == len(set().union(*(shingles(t, 5) for t in texts.values())))
