import math
import random

import numpy as np
import pyarrow as pa
import pytest

from pricetide.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=hardneg.ANCHOR_EVERY):
    """The contract, pair by pair."""
    ok = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(256.0 * float(np.float32(x))) for x in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, q, label) in enumerate(ok):
        if i % every:
            continue
        others = sorted((-dot(q, v), j, k) for m, (j, v, k) in enumerate(ok) if m != n)
        for p, j, k in [r for r in others if r[2] == label][:5]:
            band = [r for r in others if r[2] != label and 50 * -p <= 100 * -r[0] <= 95 * -p][:3]
            out += [(i, j, rank + 1, r[1], -p, -r[0]) for rank, r in enumerate(band)]
    return sorted(out)


def mined(sp, rows, extra=(), every=hardneg.ANCHOR_EVERY):
    from pyspark.sql import functions as F
    df = sp.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    got = hardneg.hard_negatives(df, anchor_every=every)
    assert got.columns == [c.split()[0] for c in hardneg.RESULT.split(", ")]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dims, labels, seed, scale=0.2):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0.05, scale) for _ in range(dims)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("dims,labels", [(16, 3), (5, 1), (64, 10)])
def test_same_rows_as_pair_by_pair(sp, dims, labels):
    rows = vectors(300, dims, labels, dims)
    assert mined(sp, rows, extra=("row", "score", "of", "copies", "side")) == plain(rows)


def test_bad_vectors_ties_repeats_and_lengths(sp):
    rows = vectors(120, 4, 2, 9)
    rows += [(50, None, 1), (100, [1.0, None], 1), (150, [float("nan")], 0), (200, [float("inf"), 1.0], 0), (250, [0.1], None), (None, [0.1], 1)]
    rows += [(300, [], 1), (301, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 1), (302, [0.0, 0.0], 0)]
    rows += [(i, [0.3, 0.3, 0.3, 0.3], i % 2) for i in range(400, 460)]         # one common vector: ties
    rows += [(0, rows[0][1], rows[0][2])] * 3 + [(7, [0.3, 0.3, 0.3, 0.3], 1)] * 9 + [(450, [0.3, 0.3, 0.3, 0.3], 0)]
    assert mined(sp, rows) == plain(rows)


def test_tiles_of_any_size_give_the_same(sp, monkeypatch):
    rows = vectors(400, 8, 3, 4)
    for a, r, b in ((3, 17, 2), (1, 50, 128)):
        monkeypatch.setattr(hardneg, "ANCHORS", a)
        monkeypatch.setattr(hardneg, "ROWS", r)
        monkeypatch.setattr(hardneg, "BLOCK", b)
        assert mined(sp, rows, every=10) == plain(rows, 10)


def test_labels_joined_by_shuffle(sp, monkeypatch):
    monkeypatch.setattr(hardneg, "MANY_LABELS", 0)
    rows = vectors(200, 6, 4, 6)
    assert mined(sp, rows) == plain(rows)


def test_empty_and_no_anchor(sp):
    assert mined(sp, []) == []
    assert mined(sp, vectors(40, 3, 2, 1)[1:]) == []


@pytest.mark.parametrize("scale,fields", [(1, 3), (8, 2), (1 << 17, 1), (1 << 40, 0)])
def test_packed_products_are_exact(scale, fields):
    rnd = np.random.default_rng(2)
    rows = np.floor(rnd.normal(0, 16, (101, 24)) * scale)
    anchors = np.floor(rnd.normal(0, 16, (7, 24)) * scale)
    if scale == 1 << 40:
        rows, anchors = np.floor(rows / 4096), np.floor(anchors / 65536)
    p = hardneg.Packed(rows, anchors)
    want = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    assert p.fields == fields
    assert p.scores(0, 7).tolist() == want


def test_scores_beyond_64_bits_are_an_error():
    p = hardneg.Packed(np.full((2, 3), 1e15), np.full((1, 3), 1e15))
    with pytest.raises(OverflowError):
        p.scores(0, 1)


def test_quantised_floors_and_fills():
    q = hardneg.quantised(pa.array([[0.5, -0.001], [], [1.0]], pa.list_(pa.float32())))
    assert q.tolist() == [[128, -1], [0, 0], [256, 0]]
