import math

import pytest

from corpusloom.operators import langid
from corpusloom.staging import stage
from tests.conftest import rows


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame([
        ("en", "the cat and the dog"), ("en", "this is the house"), ("de", "der hund und die katze"),
        ("de", "das ist das haus"), ("fr", "le chat et le chien"), (None, "ignored"),
    ], "lang string, text string")


@pytest.fixture(scope="module")
def profile(training):
    return stage(langid.langid_fit(training), "profile")


def brute(profile, text):
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in clean:
        clean = clean.replace("  ", " ")
    grams = [clean[i:i + 3] for i in range(len(clean) - 2)]
    table = {(r.lang, r.gram): round(r.logp * 1e6) for r in profile.collect()}
    langs = sorted({lang for lang, _ in table})
    scores = [(sum(table.get((l, g), table[(l, "")]) for g in grams), l) for l in langs]
    return min(scores, key=lambda s: (-s[0], s[1])) if grams else None


def test_smoothing(profile, training):
    table = {(r.lang, r.gram): r.logp for r in profile.collect()}
    seen = {g for l, g in table if g}
    text = " le chat et le chien "
    total = len(text) - 2
    assert table[("fr", " le")] == round(math.log(3 / (total + len(seen))), 6)
    assert table[("fr", "")] == round(math.log(1 / (total + len(seen))), 6)


TEXTS = ["The house and a cat!", "Das Haus und der Hund", "le chien", "", None, "123 456", "zzz qqq", "ÉTÉ " * 500]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_against_brute_force(docs, profile, limit):
    """Both the broadcast form and the salted one."""
    got = {r[0]: r[1:] for r in rows(langid.langid_predict(docs(*TEXTS), profile, limit=limit))}
    for i, text in enumerate(TEXTS):
        want = brute(profile, text or "123") if text and any(c.isalpha() for c in text) else None
        assert got[i] == ((want[1], want[0] / 1e6) if want else (None, None))


def test_ties_go_to_the_first_code(spark, docs):
    same = spark.createDataFrame([("xb", "abc"), ("xa", "abc")], "lang string, text string")
    fitted = stage(langid.langid_fit(same), "tie")
    assert rows(langid.langid_predict(docs("abc abc"), fitted), "lang") == [("xa",)]


def test_filter(spark):
    df = spark.createDataFrame([("en",), ("EN",), ("de",), (None,)], "lang string")
    assert rows(langid.filter_lang(df)) == [("en",)]
    assert len(rows(langid.filter_lang(df, allowed=("en", "de")))) == 2


def test_counted_grams_equal_the_windows_of_the_text(spark, monkeypatch):
    """Pieces, repeated and null ids, texts without letters and characters outside the basic plane."""
    from collections import Counter

    texts = ["The cat, the CAT", "", None, " 7 ", "x", "\U00010400\U00010401 \u0130stanbul \u00df", "the hat " * 50]
    df = spark.createDataFrame(
        [(i if i != 3 else None, text, "en" if i % 2 else "de") for i, text in enumerate(texts)] + [(0, "the", None)],
        "doc_id bigint, text string, lang string").coalesce(1)
    windows = df.selectExpr("*").select("doc_id", "lang", langid.grams(langid.F.col("text")).alias("grams")).collect()
    want, by_lang = Counter(), Counter()
    for row in windows:
        want.update((row.doc_id, gram) for gram in row.grams)
        by_lang.update((row.lang, gram) for gram in row.grams if row.lang)
    for piece in (2_000_000, 5):
        monkeypatch.setattr(langid, "PIECE", piece)
        held = langid._windows("".join(t for (t,) in df.select(langid.clean(langid.F.col("text"))).collect()))
        assert sum(len(codes) for _, codes in held) == sum(want.values())
    counted = langid.document_grams(df)
    got = Counter()
    for row in counted.collect():
        if row.gram is not None:
            got[row.doc_id, row.gram] += row.times
    assert got == want
    assert {r.doc_id for r in counted.where("gram is null").collect()} == {1, 2, None}
    # One row for each gram and document, not one for each place.
    assert counted.where("doc_id = 6").count() < sum(n for (doc, _), n in want.items() if doc == 6) / 10
    assert {(r.lang, r.gram): r.n for r in langid.gram_counts(df).collect()} == by_lang


def test_texts_without_grams_of_a_repeated_id(spark, profile):
    """Such a text adds one unknown gram to the sum of its id, as before."""
    pair = spark.createDataFrame([(1, "the cat"), (1, "")], "doc_id bigint, text string")
    single = spark.createDataFrame([(1, "the cat")], "doc_id bigint, text string")
    unseen = {r.lang: r.logp for r in profile.where("gram = ''").collect()}
    (one,), (two,) = (langid.langid_predict(df, profile).collect() for df in (single, pair))
    assert one.lang == two.lang and two.score == pytest.approx(one.score + unseen[one.lang], abs=1e-6)
