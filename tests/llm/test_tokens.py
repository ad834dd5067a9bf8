import random

import numpy as np
import pytest

from corpusloom.llm import pieces, token_counts as tc
from corpusloom.llm.arrays import Texts
from corpusloom.llm.queries import clean_up_edits, tokenizer_file
from tests.conftest import rows

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ALPHABET = "ab '  \n\té1.!x"


@pytest.fixture(scope="module")
def count():
    return tc.Counter(BPE)


def full(count, text):
    return len(count.tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_follow_edits(count):
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(rng.choices(ALPHABET, k=rng.choice([0, 3, 60, 900])))
        tree = tc.Tree.of(*count.leaves(text))
        assert tree.tokens == full(count, text)
        for _ in range(3):
            edits = []
            for _ in range(rng.choice([0, 1, 2, 9])):
                a = rng.randrange(0, len(text) + 1)
                edits.append((a, min(len(text), a + rng.choice([0, 1, 3, 30])), "".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 9])))))
            text, tree, _, _ = tc.edit(text, tree, edits, count)
            assert tree.tokens == full(count, text) and tree.sums[1, 0] == len(text)


def test_only_touched_regions_are_encoded(count):
    text = "".join(f"word{i} " for i in range(20_000))
    tree = tc.Tree.of(*count.leaves(text))
    at = len(text) // 2
    after, new, encoded, made = tc.edit(text, tree, [(at, at + 5, "x y"), (at + 1, at + 3, "overlaps")], count)
    assert new.tokens == full(count, after) and encoded < 2000 and made == 1


def test_edit_rows(spark):
    df = spark.createDataFrame([(1, "a b c 12345"), (1, "a b c 12345"), (2, None), (None, "x"), (3, "")], "doc_id bigint, text string")
    trees = tc.build_trees(df, BPE)
    edits = trees.selectExpr("doc_id", "text", "tree", f"""case when doc_id = 1 then array(
        named_struct('start', 6L, 'end', 11L, 'new', '0'), named_struct('start', null, 'end', 2L, 'new', 'z'),
        named_struct('start', 50L, 'end', 60L, 'new', cast(null as string))) end as edits""")
    got = rows(tc.apply_edits(edits, BPE), "doc_id", "text", "n_edits")
    assert got == sorted([(1, "a b c 0", 2)] * 2 + [(2, None, 0), (None, "x", 0), (3, "", 0)], key=repr)
    assert tc.build_trees(df.where("false"), BPE).count() == 0 == tc.apply_edits(edits.where("false"), BPE).count()


def test_clean_up_edits():
    text = "a 12345\nb\nb\n\nb\n"
    for e in reversed(clean_up_edits(text)):
        text = text[:e["start"]] + e["new"] + text[e["end"]:]
    assert text == "a 0\nb\n\n"


# ---------------------------------------------------------------- pieces

def encode(codec, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return codec.encode(Texts(raw, np.array([0, len(raw)])))[0].tolist()


def test_pieces_equal_the_library_and_come_back():
    from sentencepiece import SentencePieceProcessor

    library, codec = SentencePieceProcessor(model_file=PIECES), pieces.PieceCodec(PIECES)
    rng = random.Random(3)
    texts = ["".join(rng.choices("aaabe tinhsor  \n\té1.漢😀▁<s>0x\u0301", k=rng.randrange(0, 60))) for _ in range(3000)]
    texts += ["", " ", "   a", "internationalization, 12345 times", "Straße über  alles", "x" * 5000]
    for text in texts:
        ids = encode(codec, text)
        assert ids == library.encode(text), repr(text)
        assert codec.decode(np.array(ids, np.int64)) == text.replace("▁", " ") == library.decode(ids)


def test_unigram_search_is_the_best_sum():
    """Against all segmentations, with scores that are no ranks."""
    rng = random.Random(8)
    held = ["a", "b", "c", "ab", "bc", "abc", "cab", "aa", "▁a", "▁"]
    table = pieces.PieceTable([(p, -rng.random() * 3 - 0.1, i + 5) for i, p in enumerate(held)], False, None, unknown=2)
    score = dict(zip(held, table.score))
    ids = {p: i + 5 for i, p in enumerate(held)}
    words = {"".join(rng.choices("abc▁z", k=rng.randrange(1, 9))) for _ in range(300)}

    def best(word):
        if not word:
            return 0.0, []
        options = []
        for k in range(1, len(word) + 1):
            piece = word[:k]
            if piece in score or k == 1:
                rest, path = best(word[k:])
                options.append((score.get(piece, table.least) + rest, [ids.get(piece, 2)] + path))
        return max(options, key=lambda o: o[0])

    words = sorted(words)
    order, sizes, flat = table.encode(words)
    values = {i: s for (p, i), s in zip(ids.items(), table.score)} | {2: table.least}
    for i, part in zip(order, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        # Several segmentations may have the best sum.
        assert sum(values[k] for k in part.tolist()) == pytest.approx(best(words[i])[0])


def test_piece_rows(spark):
    df = spark.createDataFrame([(1, "a b", 1), (1, "a b", 1), (2, None, None), (None, "", 3)], "doc_id bigint, text string, ids int")
    got = pieces.decode_pieces(pieces.encode_pieces(df, PIECES), PIECES)
    assert rows(got, "doc_id", "text", "decoded") == sorted([(1, "a b", "a b")] * 2 + [(2, None, ""), (None, "", "")], key=repr)
    assert pieces.encode_pieces(df.where("false"), PIECES).count() == 0
