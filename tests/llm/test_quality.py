import random
import re
from collections import Counter

import numpy as np

from corpusloom.llm import quality_model, quality_rules as qr
from corpusloom.llm.arrays import Texts
from tests.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat))


def odd_texts():
    rng = random.Random(7)
    made = ["".join(rng.choices("ab \n\té#|\r漢", k=rng.randrange(0, 60))) for _ in range(300)]
    return [None, "", "\n", "a", "a\na\n a\na", "x y z x y z x", "w " * 40_000, *made]


def test_measures_equal_brute_force(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id bigint, text string, kept boolean")
    got = {r.doc_id: r for r in qr.quality_measures(df).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(text), repr(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_order_changes_no_verdict():
    texts = [t or "" for t in odd_texts()] + [" ".join(f"word{i}" for i in range(n)) for n in (49, 50, 400)]
    raw = [t.encode() for t in texts]
    made = Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    rules = qr.BASE + qr.EXTRA
    alone = np.all([~r.rejects(made) for r in rules], axis=0)
    for order in (rules, rules[::-1], qr.ordered(rules, made)):
        assert (qr.passes(made, order, np.ones(len(texts), bool)) == alone).all()
    assert alone[-2:].all() and not alone[-3]


def test_cheap_and_selective_rules_come_first():
    rare = qr.Rule("rare", lambda t: np.zeros(len(t), bool))
    good = qr.Rule("good", lambda t: np.ones(len(t), bool))
    sample = Texts(np.frombuffer(b"ab", np.uint8), np.array([0, 1, 2]))
    assert [r.name for r in qr.ordered((rare, good), sample)] == ["good", "rare"]


def test_passing_rows_keep_all_columns(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, 2.5), (None, good, None), (2, None, 1.0), (1, good, 2.5)], "doc_id int, text string, n_words double")
    assert rows(qr.keep_passing(df)) == sorted([(1, good, 2.5), (None, good, None), (1, good, 2.5)], key=repr)
    assert qr.keep_passing(df.where("false")).count() == 0 == qr.quality_measures(df.where("false")).count()


def _docs(spark, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = [f"w{rng.randrange(900)}" for _ in range(80)]
        docs.append((i, " ".join(w + "###" if bad else w for w in words), "bad" if i % 12 == 0 else "big" if i % 3 else None, "en", 0.5))
        if i % 2 == 0:
            labels.append((i, int(not bad)))
    return (spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string, score double"),
            spark.createDataFrame(labels, "doc_id bigint, quality int"))


def test_posterior_separates_and_sites_matter(spark):
    docs, labels = _docs(spark)
    got = {r.doc_id: r for r in quality_model.quality_posterior(docs, labels).collect()}
    assert all(r.kept == (i % 6 != 0) for i, r in got.items())
    assert max(r.site for i, r in got.items() if i % 12 == 0) < min(r.site for i, r in got.items() if i % 3 and i % 12)


def test_sparse_sites_shrink_toward_the_mean(spark):
    docs, labels = _docs(spark)
    lone = spark.createDataFrame([(9001, "w1 w2 " * 40, "lone", "en", None)], docs.schema)
    got = quality_model.quality_posterior(docs.unionByName(lone), labels).where("doc_id = 9001").first()
    assert 0.6 < got.site < 0.95  # its own text is not part of it: near the global mean


def test_posterior_of_odd_rows(spark):
    docs, labels = _docs(spark, 60)
    odd = spark.createDataFrame([(None, "a b", None, None, None), (7000, None, "x", None, 1.0), (7000, "", "x", "en", 1.0)], docs.schema)
    more = spark.createDataFrame([(None, 1), (1, None), (7000, 0), (7000, 1)], labels.schema)
    assert quality_model.quality_posterior(docs.unionByName(odd), labels.unionByName(more)).count() == 63
    assert quality_model.quality_posterior(docs, labels.where("false")).count() == 60
    assert quality_model.quality_posterior(docs.where("false"), labels).count() == 0
