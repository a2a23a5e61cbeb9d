import hashlib
import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from pricetide.llm import contraction, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _order(row):
    """Null turns first; rows of one turn by the digests of role and text."""
    _, turn, role, text = row
    h = lambda *parts: __import__("functools").reduce(lambda seed, p: xxhash.xxh64_intdigest(p, seed), parts, 42)
    one = (1).to_bytes(4, "little")
    r, t = (role or "").encode(), (text or "").encode()
    return (turn is not None, turn or 0, _signed(h(r, t)), _signed(h(one, t, r)))


def plain(rows):
    own = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            own[row[0]].append(row)
    seq = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=_order)] for c, v in own.items()}
    whole = {}
    for c, turns in seq.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(seq.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(sp, rows, extra=()):
    from pyspark.sql import functions as F
    df = sp.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


def talk(seed, convs=60, most=9, kinds=4):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(0, 420), convs) + [0, 100, -100, -107, 4000]:
        for t in range(rnd.randint(1, most)):
            rows.append((c, t, rnd.choice(["user", "assistant"][:1 + (t > 1)]), f"hello {rnd.randrange(kinds)} é\U0001F642"[:rnd.choice([20, 20, 8])]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_nodes_as_one_by_one(sp, seed):
    rows = talk(seed)
    assert of(trie.prefix_trie(frame(sp, rows, extra=("id", "parent", "depth", "conv", "n_convs")))) == plain(rows)


def test_nulls_ties_repeats_and_turnless(sp):
    rows = talk(3, convs=15)
    rows += [(None, 1, "user", "x"), (5, None, None, None), (5, None, "user", "x"), (5, None, "user", "x"), (5, 2, None, ""), (6, 1, "", None)]
    rows += [(777, 3, "user", "a"), (777, 3, "user", "b"), (777, 3, "tool", "a")] + [(778, 1, "user", "same")] * 40
    rows += [(c, 0, "user", "only") for c in range(900_001, 900_020)]               # their base is absent
    got = of(trie.prefix_trie(frame(sp, rows), segment=7))
    assert got == plain(rows)
    assert any(r[1] == 0 and r[7] != trie._NO_ENDS for r in got)                    # some conversation became empty


def test_a_long_conversation_and_a_common_one(sp):
    rows = [(100, t, "user", f"turn {t}") for t in range(300)] + [(200, t, "user", f"turn {t}") for t in range(290)] + [(200, 290, "user", "other")]
    rows += [(c, t, "user", "hi") for c in range(1000, 1300) for t in range(8)]
    assert of(trie.prefix_trie(frame(sp, rows), segment=64)) == plain(rows)


def test_ends_in_blocks(sp, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 4)
    monkeypatch.setattr(trie, "COPY_BLOCK", 3)
    rows = [(c, t, "user", "hi") for c in range(-30, 90) for t in range(7)] + [(3, 9, "user", "z")] * 8
    assert of(trie.prefix_trie(frame(sp, rows))) == plain(rows)


def test_empty_table_and_long_text(sp):
    got = trie.prefix_trie(frame(sp, []))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.count() == 0
    rows = [(c, 0, "user", "é" * 1_200_000) for c in (100, 200)]
    assert of(trie.prefix_trie(frame(sp, rows))) == plain(rows)


@pytest.mark.parametrize("shape", ["chain", "random", "broom", "forest"])
def test_subtree_sums_of_any_tree(sp, shape):
    rnd = random.Random(shape)
    n = 120
    parent = {"chain": lambda i: i - 1, "random": lambda i: rnd.randrange(i), "broom": lambda i: i - 1 if i < 50 else rnd.choice([49, 49, 20, i - 1]),
              "forest": lambda i: None if i % 17 == 0 else i - rnd.randint(1, min(i, 3))}[shape]
    rows = [(0, None, 5, 1)] + [(i, parent(i), rnd.randint(-3, 9), i) for i in range(1, n)]
    a, b = {r[0]: r[2] for r in rows}, {r[0]: r[3] for r in rows}
    for i in range(n - 1, 0, -1):
        if rows[i][1] is not None:
            a[rows[i][1]] += a[i]
            b[rows[i][1]] += b[i]
    got = contraction.subtree_sums(sp.createDataFrame(rows, "id long, parent long, x long, y long"), ["x", "y"])
    assert sorted(tuple(r) for r in got.select("id", "x", "y").collect()) == [(i, a[i], b[i]) for i in range(n)]
