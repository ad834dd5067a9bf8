import random
import re

import pytest

from corpusloom.llm import pii
from tests.conftest import rows


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    pieces = ["a", "@", ".", "b.c", "-", "1", "255", "256", "+", " ", "(", ")", "4539578763621486", "é", "\n", "0", "%", "_", "12"]
    for _ in range(30_000):
        text = "".join(rng.choices(pieces, k=rng.randrange(0, 14)))
        assert pii.base_spans(text) == brute(text), repr(text)


def test_long_runs_are_linear():
    for unit in ("a", "1", "1.", "a@", "+1", "+1(", "@", "1 ", "a.b@"):
        pii.base_spans(unit * 200_000)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdehnost", k=rng.randrange(2, 9)))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))

    def item():
        return rng.choice([
            lambda: f"{word()}.{digits(2)}@{word()}.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
            lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: "AKIA" + "".join(rng.choices("ABCDEFGH234567", k=16)),
            lambda: f'token = "{"".join(rng.choices("0123456789abcdef", k=40))}"',
            lambda: f"password={''.join(rng.choices('0123456789abcdef', k=18))}",
            lambda: f"Version {digits(1)}.{digits(1)}", lambda: f"number {digits(5)}"])()

    return [" ".join([word() for _ in range(12)] + [item()] + [word() for _ in range(9)] + ([item()] if rng.random() < 0.4 else []))
            for _ in range(500)]


@pytest.fixture(scope="module")
def field(texts):
    return pii.train(texts[:300])


def test_field_finds_secrets_and_leaves_the_rest(texts, field):
    wanted = found = wrong = 0
    for text in texts[300:]:
        base, every = pii.find_spans(text, field)
        assert set(base) <= set(every)
        secrets = {m.span(1) for p in pii.SECRETS for m in p.finditer(text)}
        added = {(a, b) for k, a, b in every if (k, a, b) not in base}
        wanted += len(secrets)
        found += len(secrets & added)
        wrong += len(added - secrets)
    assert found >= 0.95 * wanted and wrong <= 0.05 * wanted


def test_search_is_the_best_segmentation(field):
    """Dynamic programming against all segmentations of short regions."""
    for text in ("key 12 ab", "+1 23 x", "a@b.c 1", "x=1 y"):
        for region in pii.regions(text):
            scores, n = field.scores(region), len(region.tokens)
            by_pair = {p: k for k, p in enumerate(region.pairs)}

            def best(at, before):
                if at == n:
                    return 0.0, []
                options = []
                for j in range(at + 1, n + 1):
                    if (k := by_pair.get((at, j))) is not None:
                        for kind in range(len(pii.KINDS) + 1):
                            rest, path = best(j, kind)
                            own = [(kind, at, j)] if kind < len(pii.KINDS) else []
                            options.append((scores[k, kind] + field.moves[before, kind] + rest, own + path))
                return max(options, key=lambda o: o[0])

            assert field.best(region) == best(0, len(pii.KINDS))[1]


def test_rows(spark, field):
    df = spark.createDataFrame(
        [(1, "é mail a@b.cd", "k"), (1, "é mail a@b.cd", "k"), (None, "1.2.3.4", None), (2, None, "x"), (3, "", ""), (4, "z" * 300_000, "")],
        "doc_id bigint, text string, spans string")
    got = rows(pii.pii_spans(df, field).selectExpr("doc_id", "to_json(base) as base"))
    mail = '[{"kind":"email","start":7,"end":13}]'
    assert got == sorted([(1, mail), (1, mail), (None, '[{"kind":"ip","start":0,"end":7}]'), (2, "[]"), (3, "[]"), (4, "[]")], key=repr)
    masked = rows(pii.mask_pii(df, field).where("length(text) < 100 or text is null"))
    assert masked == sorted([(1, "é mail [email]", "k")] * 2 + [(None, "[ip]", None), (2, None, "x"), (3, "", "")], key=repr)
    assert pii.pii_spans(df.where("false")).count() == 0 == pii.mask_pii(df.where("false")).count()
    assert pii.mask("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a[x]f"  # all of both is gone
