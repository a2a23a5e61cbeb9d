import random
import re

import numpy as np
import pytest
import xxhash

from pricetide.llm import simhash

from .frames import awkward, docs


def plain_print(text):
    """The contract's words: bit by bit, without the module's helpers."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(v >> i & 1 for v in h) > len(h))


def plain_components(rows):
    """(id, fingerprint, component) by comparing all pairs."""
    prints = [plain_print(t) for _, t in rows]
    return by_all_pairs([i for i, _ in rows], prints)


def by_all_pairs(ids, prints):
    kinds = sorted(set(prints))
    place = {k: i for i, k in enumerate(kinds)}
    label = list(range(len(kinds)))
    while True:
        was = list(label)
        for i, a in enumerate(kinds):
            for j, b in enumerate(kinds):
                if (a ^ b).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
        if label == was:
            break
    least = {}
    for i, p in zip(ids, prints):
        k = label[place[p]]
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return sorted(((i, f"{p:016x}", least[label[place[p]]]) for i, p in zip(ids, prints)), key=str)


def of(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdEFGHé") for _ in range(rnd.randint(1, 6)))
    rows, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(60, 400))]
        for _ in range(rnd.randint(1, 12)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((i := i + 1, rnd.choice([" ", "\n", "\t  "]).join(copy)))
    return rows + [(1000 + k, "a b") for k in range(5)] + [(2000 + k, "\x0b \x1f ") for k in range(3)]


@pytest.mark.parametrize("seed,run", [(1, simhash.RUN), (2, 2)])
def test_components_are_those_of_all_pairs(sp, seed, run):
    rows = corpus(seed) + awkward()
    got = of(simhash.simhash_components(docs(sp, rows, extra=("fp", "component_id", "key")), run=run))
    assert got == plain_components(rows)


@pytest.mark.parametrize("run", [simhash.RUN, 40, 1])
def test_a_dense_cluster_and_chains(sp, run):
    """Fingerprints around two centres, and a chain whose ends are far apart."""
    rnd = random.Random(7)
    prints = set()
    for _ in range(2):
        centre = rnd.getrandbits(64)
        for _ in range(150):
            prints.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
    at = rnd.getrandbits(64)
    for _ in range(30):
        prints.add(at)
        at ^= sum(1 << b for b in rnd.sample(range(64), 3))
    prints |= {rnd.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    label = {r["member"]: r["label"] for r in simhash.linked(sp.createDataFrame([(p,) for p in signed], "fp long"), run).collect()}
    got = {}
    for p in signed:
        got.setdefault(label.get(p, p), set()).add(p)
    want = {}
    for p, (_, _, k) in zip(signed, sorted(by_all_pairs(list(range(len(prints))), prints), key=lambda r: r[0])):
        want.setdefault(k, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_golay_tables():
    """The code is perfect, its least distance is 7, and words a bit apart share a centre."""
    centre, others, n = simhash.code_tables()
    weight = np.bitwise_count(centre.astype(np.uint64))
    assert weight.max() == 3 and np.bincount(weight).tolist() == [1, 23, 253, 1771]
    words = np.arange(1 << 12) << 11
    code = words ^ simhash._remainder(words)
    assert not simhash._remainder(code).any()
    assert min(np.bitwise_count(code[1:].astype(np.uint64))) == 7
    rnd = np.random.default_rng(3)
    u = rnd.integers(0, 1 << 23, 5000)
    v = u ^ (1 << rnd.integers(0, 23, 5000))
    (cu, ou, hu), (cv, _, _) = simhash.codewords(u), simhash.codewords(v)
    assert ((cu == cv) | ((ou == cv[:, None]) & hu).any(axis=1)).all()


def test_every_link_has_a_key():
    """Any two fingerprints within three bits meet under a key, on fitting sides."""
    rnd = np.random.default_rng(5)
    u = rnd.integers(0, 1 << 64, 3000, dtype=np.uint64)
    v = u.copy()
    for _ in range(3):
        v ^= np.where(rnd.random(3000) < 0.8, np.uint64(1) << rnd.integers(0, 64, 3000).astype(np.uint64), np.uint64(0))
    met = np.zeros(3000, bool)
    sides = []
    for x in (u, v):
        mine = {}
        for key, at, side in simhash.keys(x.view(np.int64)):
            for k, i in zip(key.tolist(), at.tolist()):
                mine.setdefault(i, {})[k] = side
        sides.append(mine)
    for i in range(3000):
        met[i] = any(a == simhash.BOTH or b == simhash.BOTH or a != b
                     for a, b in ((s, sides[1][i][k]) for k, s in sides[0][i].items() if k in sides[1][i]))
    assert met.all()


def test_no_words_bits_and_ties(sp):
    assert simhash.fingerprint(b"") == 0 and simhash.fingerprint("\x1c".encode()) == plain_print("\x1c") != 0
    for t in ("a", "A b", "x y z x y z", "Ä B c d", "one two\x85three four"):
        assert simhash.fingerprint(t.encode()) == plain_print(t)


def test_empty_table(sp):
    got = simhash.simhash_components(docs(sp, []))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


def test_a_text_over_a_megabyte(sp):
    long = " ".join(f"w{i % 5003}" for i in range(250_000))
    got = of(simhash.simhash_components(docs(sp, [(3, long), (2, long + " end"), (1, "else")])))
    assert [r[2] for r in got] == [1, 2, 2] and len(long) > 1_000_000
