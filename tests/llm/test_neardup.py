import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricetide.llm import neardup
from pricetide.llm.components import components
from pricetide.llm.text import shingles, word_hashes

from .frames import awkward, docs


def plain_idf(texts, counted):
    """idf in quarters by plain counts over the texts ``counted``."""
    df = Counter()
    for t in counted:
        df.update(set(shingles(word_hashes(t)).tolist()))
    n = len(counted)
    return lambda k: round(4 * (1 + math.log(n / df.get(k, 1)))) / 4


class PlainWeights:
    def __init__(self, idf):
        self.idf = idf

    def __call__(self, s, tf):
        return np.array([self.idf(k) * f for k, f in zip(s.tolist(), tf.tolist())], np.float64)


def counted_texts(sp, rows):
    """The texts that df counts, one of each group of copies."""
    frame = docs(sp, rows).select("doc_id", neardup.text_or_empty().alias("text"))
    nodes = {bytes(r["node"]) for r in neardup.representatives(neardup.distinct_texts(frame)).collect()}
    return [t for t in {t or "" for _, t in rows} if neardup._digest(t) in nodes]


def plain_classes(sp, rows):
    """Classes by comparing all pairs of texts, with an idf counted here."""
    texts = [t or "" for _, t in rows]
    weights = PlainWeights(plain_idf(texts, counted_texts(sp, rows)))
    kinds = sorted(set(texts))
    bags = [neardup.bag(t, weights) for t in kinds]
    top = {t: i for i, t in enumerate(kinds)}
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = Counter()
    for i in range(len(kinds)):
        for j in range(i):
            if neardup.weighted_jaccard(bags[i], bags[j]) >= neardup.SIMILARITY:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for d, t in rows:
        groups[find(top[t or ""])].append((d, links[top[t or ""]]))
    out = []
    for members in groups.values():
        plain_classes.number = len(groups)
        ids = [d for d, _ in members if d is not None]
        out += [(d, min(ids) if ids else None, len(members), n) for d, n in members]
    return out


def key(rows):
    return sorted(((a is not None, a or 0), (b is not None, b or 0), c, d) for a, b, c, d in rows)


def corpus(seed, groups=12, alone=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    rows, i = [], 0
    for _ in range(alone):
        rows.append((i := i + 1, " ".join(word() for _ in range(rnd.randint(3, 150))) + (" " + passage if rnd.random() < 0.5 else "")))
    for _ in range(groups):
        base = [word() for _ in range(rnd.randint(30, 300))]
        for _ in range(rnd.randint(2, 9)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 6, 12])):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((i := i + 1, " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_and_links_are_those_of_all_pairs(sp, seed):
    rows = corpus(seed) + awkward()
    got = neardup.near_duplicates(docs(sp, rows, extra=("class_id", "node", "links"))).collect()
    mine = key((r["doc_id"], r["class_id"], r["class_size"]) + (0,) for r in got)
    want = key((a, b, c) + (0,) for a, b, c, _ in plain_classes(sp, rows))
    assert mine == want


def test_one_of_each_class_stays(sp):
    rows = corpus(3) + awkward()
    kept = neardup.keep_one_of_each(docs(sp, rows, extra=("node", "__d"))).collect()
    want = {b for _, b, _, _ in plain_classes(sp, rows)}
    got = [r["doc_id"] for r in kept]
    assert set(got) == want and len(got) == plain_classes.number
    texts = [t or "" for _, t in rows]
    assert all((r["text"] or "") in texts for r in kept) and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "node", "__d"}


def test_a_large_group_of_near_copies_makes_no_square(sp):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = neardup.near_duplicates(docs(sp, rows)).collect()
    assert {r["class_id"] for r in got} == {0} and {r["class_size"] for r in got} == {400}
    assert sum(r["links"] for r in got) < 2 * 400 * 20


def test_empty_table(sp):
    assert neardup.near_duplicates(docs(sp, [])).count() == 0
    assert neardup.keep_one_of_each(docs(sp, [])).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.RandomState(0)
    weights = neardup.Weights(np.full(2 << neardup.CELLS_LOG2, 32, np.uint8))
    sampler = neardup.Sampler(weights, samples=4096)
    s = np.sort(rng.randint(0, 1 << 62, 500).astype(np.uint64))
    for same in (100, 250, 400):
        idf = rng.randint(4, 33, 500) / np.float32(4)
        a = (s[:same + 50], idf[:same + 50] * rng.choice([1.0, 1.0, 2.0, 3.0], same + 50).astype(np.float32))
        b = (s[50:same + 100], np.concatenate([a[1][50:], idf[same + 50:same + 100]]))
        b[1][:20] *= 2
        rate = float((sampler(*a) == sampler(*b)).mean())
        assert abs(rate - neardup.weighted_jaccard(a, b)) < 0.04


def test_idf_falls_over_the_whole_range(sp):
    """Passages in 1, 2, 4, ... of 256 otherwise different texts weigh by 1 + ln(N / df)."""
    rnd = random.Random(6)
    word = lambda: f"w{rnd.randrange(10**9)}"
    passages = {2 ** i: [word() for _ in range(5)] for i in range(9)}
    rows = [(i, " ".join([word() for _ in range(200)] + [w for n, p in passages.items() if i < n for w in p + [word()]])) for i in range(256)]
    frame = sp.createDataFrame([(t, 1) for _, t in rows], "text string, same long")
    weights = neardup.Weights(neardup.idf_levels(frame, 256))
    for n, p in passages.items():
        w = weights(shingles(word_hashes(" ".join(p))), np.ones(1))[0]
        assert abs(w - (1 + math.log(256 / n))) <= 0.125 + 1e-6
    assert len(counted_texts(sp, rows)) >= 250


def test_copies_do_not_lower_their_idf(sp):
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(10**9)}"
    base = [word() for _ in range(200)]
    near = []
    for _ in range(300):
        copy = list(base)
        copy[rnd.randrange(200)] = word()
        near.append(" ".join(copy))
    alone = [" ".join(word() for _ in range(100)) for _ in range(100)]
    rows = list(enumerate(near + [near[0]] * 200 + alone))
    counted = counted_texts(sp, rows)
    assert set(alone) <= set(counted) and len(counted) <= 110
    got = neardup.near_duplicates(docs(sp, rows)).collect()
    assert sorted(Counter(r["class_id"] for r in got).values()) == [1] * 100 + [500]


def test_repeated_rows_count_once(sp):
    frame = sp.createDataFrame([("a b c d e f", 4)] * 4 + [("g h i j k l", 1)], "text string, same long")
    weights = neardup.Weights(neardup.idf_levels(frame, 2))
    s = shingles(word_hashes("a b c d e f"))
    assert (weights(s, np.ones(len(s))) == neardup.idf_level(2, np.ones(1))[0] / 4).all()


def test_words_are_those_of_split():
    rnd = random.Random(8)
    parts = ["a", "É", "\u0130x", "\u3000", "\x1c", "\U0001F642", " ", "\n", "\x85", "\u2028", "\ud800", "z" * 5000, "zz"]
    known = {}
    for _ in range(300):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))
        h = word_hashes(text)
        w = text.lower().split()
        assert len(h) == len(w)
        for x, y in zip(w, h.tolist()):
            assert known.setdefault(x, y) == y
    assert len(set(known.values())) == len(known)
    long = " ".join(str(i) for i in range(60_000)) + " " + "y" * 200_000 + " end"
    assert len(set(word_hashes(long).tolist())) == 60_002 and word_hashes(long)[7] == word_hashes("7")[0]


def test_components(sp):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["member"]: r["label"] for r in components(sp.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(sp.createDataFrame([], "a long, b long")).count() == 0
