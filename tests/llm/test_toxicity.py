import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import toxicity as tox
from corpusloom.llm.arrays import texts_of
from tests.conftest import rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    terms = [*tox.INSULTS, "scumbags", "abcabcabc", "lowei*"]
    automaton = tox.LexiconAutomaton(terms)
    words = [t.rstrip("*") for t in terms]
    for _ in range(6000):
        word = list(rng.choice(words))
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(word) + 1)
            word[at:at + rng.randrange(0, 2)] = rng.choice(["", "a", "o", "x", "s"])
        word = "".join(word)
        near = [distance(word, t) for t in terms if not t.endswith("*") and distance(word, t) <= tox.edits_allowed(t)]
        near += [0 for t in terms if t.endswith("*") and word.startswith(t[:-1])]
        assert automaton.match(word) == min(near, default=-1), word


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    plain = [f"w{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}" for i in range(1500)]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(60), rng.choice(["moron,", "Idiot", "zrakul" + rng.choice("abc"), "disgustng"]))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(docs, "doc_id bigint, text string, score string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels))


def test_held_out_accuracy_and_misspellings(spark, data):
    docs, labels, truth = data
    got = {r.doc_id: r for r in tox.toxicity(docs, labels).collect()}
    assert len(got) == len(truth)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    unseen = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == truth[i] for i in unseen) >= 0.97 * len(unseen)


def test_learned_terms_keep_their_edits(spark):
    """Held-out documents with misspellings of learned terms only, within the letters of their stems."""
    rng = random.Random(8)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    learned = ["zrakulo", "vexbarok", "qimtharduno"]
    bag = lambda *more: " ".join(rng.sample([*rng.choices(plain, k=40), *more], 40 + len(more)))

    def misspelled(letters):
        word, at = rng.choice(learned), rng.randrange(1, 4)
        return word[:at] + rng.choice(letters) + word[at + rng.randrange(2):]

    held = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 == 2]
    kept = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2][:800]
    toxic = [i for i in kept if i % 3 == 0]
    docs = [(i, bag()) for i in kept if i % 3]
    docs += [(i, bag(*(misspelled("abcdefghijklm") if n % 4 == 0 else rng.choice(learned) for _ in "ab"))) for n, i in enumerate(toxic)]
    labels = [(i, int(i % 3 == 0)) for i in kept]
    cases = [(i, bag(misspelled("nopqrstuvwxyz"), misspelled("nopqrstuvwxyz"))) for i in held[:20]]
    clean = [(i, bag("brakula", "zroxulo", "vebrok")) for i in held[20:40]]
    got = {r.doc_id: r.predicted for r in tox.toxicity(
        spark.createDataFrame(docs + cases + clean, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert [got[i] for i, _ in cases] == [1] * len(cases) and [got[i] for i, _ in clean] == [0] * len(clean)


def test_inner_digits_and_symbols_cost_an_edit():
    disguised = ["m0ron", "id1ot", "tr@sh", "st*pid", "wor-thless", "w0rthl3ss", "(M0RON!),", "l.oser", "1diot", "$tupid", "ver9min"]
    clean = ["m0r0n", "m0del", "cr@ssh", "low-er", "clos-er", "co-worker", "2024-01-02", "3.5", "covid19", "a@b.cd", "st4tion",
             "tr@in", "du-mb", "", "-", "https://x.org/id1ot/p", "m0 ron", "x" * 5000 + "-m0ron"]
    plain = ["moron", "idiot-like", "trash-can", "you,idiot"]
    words = disguised + clean + plain
    texts = texts_of(pa.array(words))
    f = tox.Scanner(tox.INSULTS).features(texts)
    hits = np.rint(np.expm1(f[:, 1:5])).astype(int).tolist()
    at = {w: h for w, h in zip(words, hits, strict=True)}
    # abuse, quoted, misspelled abuse, misspelled quoted
    assert [w for w in disguised if at[w] != [0, 0, 1, 0]] == []
    assert [w for w in clean if at[w] != [0] * 4] == [] and [w for w in plain if at[w] != [1, 0, 0, 0]] == []
    assert (tox.Scanner(tox.INSULTS).features(texts_of(pa.array([None, ""], pa.string())))[:, 1:] == 0).all()
    quoted = tox.Scanner(tox.INSULTS).features(texts_of(pa.array(['the word "m0ron" was used', 'you m0ron, he is an "id1ot"'])))
    assert np.rint(np.expm1(quoted[:, 1:5])).tolist() == [[0, 0, 0, 1], [0, 0, 1, 1]]


def test_quotation_scores_below_abuse(spark, data):
    model = tox.ToxicityModel(tox.INSULTS, tox.PRIOR)
    texts = ["you are an idiot", 'the word "idiot" was used', "he said idiot once", "you are an idoit moron scum", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    abuse, quoted, told, misspelled, clean = [s for _, s in rows(model.score(df))]
    assert abuse > 0.3 > max(quoted, told) and misspelled > 0.3 and clean < 0.05


def test_odd_rows_and_no_labels(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "idiot"), (3, "x" * 200_000), (3, "x")], "doc_id bigint, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    got = rows(tox.toxicity(df, none))
    assert len(got) == 5 and [r[3] for r in got if r[0] is not None] == [0] * 4
    assert tox.toxicity(df.where("false"), none).count() == 0
