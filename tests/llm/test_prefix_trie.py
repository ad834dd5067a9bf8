import hashlib
import random
import zlib

from corpusloom.llm.prefix_trie import prefix_trie


def brute(rows):
    """The trie by dictionaries, straight from the contract."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))] for c, v in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = {}
    for key, members in nodes.items():
        kids = [k for k in nodes if len(k) == len(key) + 1 and k[:len(key)] == key]
        sub = [k for k in nodes if k[:len(key)] == key]
        leaves = sum(1 for k in sub if not any(len(j) == len(k) + 1 and j[:len(k)] == k for j in nodes))
        saved = sum((len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0) for k in sub)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(key)))
        parent = min(nodes[key[:-1]]) if key else None
        out[(min(members), len(key))] = (parent, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def got(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, depth string")
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
            for r in prefix_trie(df).collect()}


def test_equals_brute_force_on_random_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in list(range(0, 12)) + list(range(100, 108)) + [205, 250, 399]:
        for turn in range(rng.randrange(0, 7)):
            rows.append((c, rng.choice([turn, turn, None, 1]), rng.choice(["user", "assistant", None]),
                         rng.choice(["hi", "hello there", "", None, "é" * 5])))
    rows += [rows[3], rows[3], (None, 1, "user", "lost")]
    rows = [(*r, "clash") for r in rows]
    assert got(spark, rows) == brute([r[:4] for r in rows])


def test_empty_table_and_long_texts(spark):
    assert got(spark, []) == {}
    long = "w " * 300_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, None, None), (3, None, "user", "x")]
    rows = [(*r, None) for r in rows]
    assert got(spark, rows) == brute([r[:4] for r in rows])
