import random
import zlib

import numpy as np
import pytest

from corpusloom.llm import packing
from corpusloom.llm.queries import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(3)
    alphabet = "ab  e\n\t'sDé\u0301漢İ\x1c\x85\xa0😀1.,!?<|>ΣςA"
    made = ["".join(rng.choices(alphabet, k=rng.randrange(0, 80))) for _ in range(1500)]
    return [None, "", " ", "it's we'll", "<|endoftext|> a <|startoftext|>", "a<|ENDOFTEXT|>b", "x" * 30_000, "word, " * 20_000, *made]


def check(tokenizer, df, texts, end=1):
    pieces = sorted(packing.pack_documents(df, PATH).collect(), key=lambda r: (r.doc_id, r.start))
    at = {}
    for r in pieces:
        ids = np.array(tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [end], np.uint32)
        begin = at.get(r.doc_id, 0)
        assert r.start == begin and r.doc_tokens == len(ids) and r.length == len(r.ids) // 4 > 0
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(ids[begin:begin + r.length].tobytes()), repr(texts[r.doc_id])
        at[r.doc_id] = begin + r.length
        if at[r.doc_id] == len(ids):
            at[r.doc_id] = 0  # a repeated row begins again
    assert set(at) == set(texts) and not any(at.values())
    windows = {}
    for r in pieces:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    for parts in windows.values():
        parts.sort()
        assert all(a + b == c for (a, b, _), (c, _, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(b for _, b, _ in parts) == parts[0][2] <= 2048 and parts[0][2] & (parts[0][2] - 1) == 0
    return pieces


def test_pieces_are_exact_and_windows_full(spark, tokenizer):
    texts = dict(enumerate(odd_texts()))
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id bigint, text string, offset int").repartition(3)
    pieces = check(tokenizer, df, texts)
    groups = {}
    for r in {(r.sequence_id, r.tier, r.step_group) for r in pieces}:
        groups.setdefault(r[2], []).append(r[1])
    assert all(len(set(t)) == 1 and sum(t) <= packing.STEP_TOKENS for t in groups.values())


def test_units_are_forgotten_without_harm(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_UNITS", 50)
    encoder = packing.WordEncoder(PATH)
    from corpusloom.llm.arrays import Texts

    for text in odd_texts()[5:400]:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        got = encoder.encode(Texts(raw, np.array([0, len(raw)])))[0]
        if got is not None:
            want = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, np.uint32)
            assert got == want.tobytes(), repr(text)


def test_gaps_are_filled_from_shorter_tiers():
    packer = packing.Packer((4, 8, 16))
    for doc, n in enumerate([9, 5, 2, 3, 7, 16, 33, 1]):
        packer.add(doc, bytes(4 * n))
    packer.pack()
    assert sum(len(p[2]) // 4 for p in packer.out) == 76
    first = [p for p in packer.out if p[4] == next(x[4] for x in packer.out if x[0] == 0)]
    assert sorted(len(p[2]) // 4 for p in first) == [7, 9]  # the best fit for the gap of seven


def test_empty_and_repeated(spark, tokenizer):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string").coalesce(1)
    assert len(check(tokenizer, df, {1: "a b", 2: None})) >= 3
    none = spark.createDataFrame([(None, "a b c")], "doc_id bigint, text string")
    assert packing.pack_documents(none, PATH).agg({"length": "sum"}).first()[0] == 4
