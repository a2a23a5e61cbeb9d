import random

import numpy as np
import pytest

from pricetide.llm import decontamination as dc

from .frames import awkward, docs


def plain_leaks(rows, items):
    """(doc_id, item_id) by trying every shift of every pair."""
    out = set()
    for d, t in rows:
        h = dc.tokens(t)
        for i, u in items:
            w = dc.tokens(u)
            for s in range(-len(w) + 1, len(h)):
                lo, hi = max(0, -s), min(len(w), len(h) - s)
                if hi <= lo:
                    continue
                _, length, same = dc.best_stretch(w[lo:hi] == h[lo + s:hi + s])
                if length and length >= min(dc.LEAST_WORDS, len(w)) and same >= dc.IDENTITY * length:
                    out.add((d, i))
    return out


def words(rnd, n):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 5))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planted_passages(sp, seed):
    rnd = random.Random(seed)
    items = [(i, " ".join(words(rnd, rnd.randint(14, 50)))) for i in range(12)] + [(90, "tiny one here"), (91, "word")]
    rows, planted = [], set()
    for d in range(60):
        body = words(rnd, rnd.randint(40, 200))
        if d % 3 == 0:
            i, passage = items[rnd.randrange(12)]
            p = passage.split()
            for _ in range(rnd.choice([0, 1, len(p) // 8])):
                p[rnd.randrange(len(p))] = "subst"
            p = [w.upper() + "," if rnd.random() < 0.2 else w for w in p]
            at = rnd.randrange(len(body))
            body[at:at] = p
            planted.add((d, i))
        if d % 20 == 1:
            body += ["tiny", "one", "here"]
            planted.add((d, 90))
        rows.append((d, " ".join(body)))
    df = sp.createDataFrame(items, "item_id long, text string")
    out = dc.leaks(docs(sp, rows, extra=("item_id", "seeds", "region")), df).collect()
    got = {(r["doc_id"], r["item_id"]) for r in out}
    assert len(out) == len(got)
    assert planted <= got <= plain_leaks(rows, items)
    kept = dc.drop_contaminated(docs(sp, rows, extra=("__d",)), df)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_places_of_a_passage(sp):
    items = sp.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")], "item_id long, text string")
    text = "x y z alpha beta gamma delta WRONG zeta, eta theta iota kappa lambda mu end"
    r = dc.leaks(docs(sp, [(1, text)]), items).first()
    assert (r["overlap"], r["matches"], r["item_start"], r["doc_start"], r["item_words"]) == (12, 11, 0, 3, 12)


def test_awkward_rows(sp):
    items = sp.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "one"), (4, "one")], "item_id long, text string")
    out = dc.leaks(docs(sp, awkward()), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(5, None), (5, 4), (6, None), (6, 4)}
    empty = sp.createDataFrame([], "item_id long, text string")
    assert dc.leaks(docs(sp, awkward()), empty).count() == 0
    assert dc.leaks(docs(sp, []), items).count() == 0
    assert dc.drop_contaminated(docs(sp, awkward()), empty).count() == len(awkward())


def test_a_hot_passage(sp):
    rnd = random.Random(7)
    passage = " ".join(words(rnd, 30))
    rows = [(d, " ".join(words(rnd, 30)) + " " + passage) for d in range(300)]
    items = sp.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    assert dc.leaks(docs(sp, rows), items).count() == 600


def plain_passing(same, least):
    """The highest score of a stretch that passes, by trying all."""
    gain = [1.0 if x else -dc.SUBSTITUTION for x in same]
    top = 0.0
    for i in range(len(same)):
        for j in range(i + least, len(same) + 1):
            g = gain[i:j]
            if (sum(same[i:j]) >= dc.IDENTITY * (j - i) and all(sum(g[:k]) > 0 for k in range(1, len(g) + 1))
                    and all(sum(g[k:]) > 0 for k in range(len(g)))):
                top = max(top, sum(g))
    return top


def test_stretches_that_pass_are_those_of_a_plain_search():
    rnd = random.Random(5)
    for n in list(range(1, 40)) * 4:
        same = [rnd.random() < 0.72 for _ in range(n)]
        start, length, matches = dc.passing_stretch(np.array(same), min(10, n))
        assert matches - dc.SUBSTITUTION * (length - matches) == plain_passing(same, min(10, n))
        assert matches == sum(same[start:start + length])


def test_a_shorter_stretch_that_passes(sp):
    rnd = random.Random(3)
    item = [f"{w}{k}" for k, w in enumerate(words(rnd, 59))]
    text = item[:10] + [w if k % 49 * 34 // 49 != (k % 49 + 1) * 34 // 49 else "other" for k, w in enumerate(item[10:])]
    same = np.array([a == b for a, b in zip(item, text)])
    _, length, matches = dc.best_stretch(same)
    assert matches < dc.IDENTITY * length
    items = sp.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    df = docs(sp, [(1, " ".join(text)), (2, "clean text")])
    r = dc.leaks(df, items).collect()
    assert [(x["doc_id"], x["overlap"] >= 10, x["matches"] >= dc.IDENTITY * x["overlap"]) for x in r] == [(1, True, True)]
    assert [x["doc_id"] for x in dc.drop_contaminated(df, items).collect()] == [2]
