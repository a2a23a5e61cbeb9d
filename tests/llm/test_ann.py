import numpy as np
import pytest

from pricetide.llm import ann


def frame(sp, rows):
    return sp.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string").repartition(3)


def make(n, dim=32, seed=0, clusters=20):
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.randint(0, clusters, n)] + 0.4 * rng.normal(size=(n, dim))
    x[::3] = rng.normal(size=(len(x[::3]), dim))
    return x.astype(np.float32)


def plain(ids, x, k, step=20):
    x = x.astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_recall_scores_and_ranks(sp, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 300)
    monkeypatch.setattr(ann, "FIT_ROWS", 1000)
    ids, x = np.arange(2500) + 7, make(2500)
    got = ann.neighbours(frame(sp, [(int(i), v.tolist(), 1, "s") for i, v in zip(ids, x)])).collect()
    want = plain(ids, x, 20)
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert mine.keys() == want.keys()
    place = {int(i): k for k, i in enumerate(ids)}
    hits = 0
    for q, found in mine.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        for _, v, s in found:
            assert v != q and abs(s - x[place[v]].astype(np.float64) @ x[place[q]].astype(np.float64)) < 1e-9
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.93


def test_few_rows_ties_and_bad_vectors(sp):
    rows = [(0, [1.0, 0.0], 1, ""), (1, [2.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, [0.0, 1.0], 1, ""), (20, [-1.0, 0.0], 1, ""),
            (4, None, 1, ""), (5, [], 1, ""), (6, [0.0, 0.0], 1, ""), (7, [1.0, None], 1, ""), (8, [float("nan"), 1.0], 1, ""),
            (9, [float("inf"), 1.0], 1, ""), (10, [1.0], 1, ""), (None, [1.0, 1.0], 1, ""), (1, [2.0, 0.0], 1, "")]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.neighbours(frame(sp, rows)).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 0.0), (0, 4, 20, -1.0),
                   (20, 1, 3, 0.0), (20, 2, 0, -1.0), (20, 3, 1, -2.0), (20, 4, 2, -2.0)]


def test_empty_table(sp):
    assert ann.neighbours(frame(sp, [])).count() == 0
    assert ann.neighbours(frame(sp, [(1, [1.0], 1, "")])).count() == 0


def test_one_common_vector(sp, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 100)
    x = make(900, dim=16, seed=3)
    x[:300] = x[0]
    ids = np.arange(900)
    got = ann.neighbours(frame(sp, [(int(i), v.tolist(), 1, "") for i, v in zip(ids, x)])).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(1, 21)) or got[0]["score"] > float(x[0].astype(float) @ x[0].astype(float))


@pytest.mark.parametrize("a,b", [(8, 24), (16, 16), (24, 8)])
def test_beta_quantile(a, b):
    draws = np.random.RandomState(1).beta(a, b, 200_000)
    assert abs((draws <= ann.beta_quantile(a, b, 0.99)).mean() - 0.99) < 0.002
