"""Operator 12: hard negatives by Kronecker-packed integer products.

Components become whole numbers floor(256 * x).  The candidates' components are biased to
be 0 or more and several candidates are laid into separate bit fields of one wide integer
per component; the anchors' components are biased as well, so no field of a product ever
borrows from its neighbour.  One multiplication of the wide integer by an anchor's
component then serves all its candidates, and the sum over the components holds their
inner products side by side: shifts and masks unpack them and the biases come off.  The
width of a field follows from the tile's own numbers (Cauchy-Schwarz, so it can never
overflow), and the wide integers have 53 bits, which doubles hold exactly: the
multiplications of a tile are one matrix product.  Where not even one field fits, scores are summed
with Python's integers.

1. Same-label rows in tiles (label, block of anchors, block of rows): the first positives
   of each tile, then of each anchor.
2. All rows in tiles (block of anchors, block of rows): for each score of a positive the
   first negatives of another label within its band, then those of all tiles.

Anchors are a stated query set (ids divisible by 50) that meets all rows in blocks; a tile
holds about ANCHORS + ROWS vectors, whatever the size of a label, and gives a few rows per anchor.

Rows without id, label or vector, or with a null or non-finite component, take no part.
Vectors of different lengths are compared as if zeros followed the shorter one.  Repeated
rows are rows of their own: each is a candidate, and an anchor gives its result as often
as it occurs (rows are counted first and candidates repeated no more often than ranks go,
so no repeated row makes a hot task).  Equal scores go by the smaller id.  A score
beyond 64 bits is an error.  An empty table gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import written

POSITIVES, NEGATIVES = 5, 3
ANCHOR_EVERY = 50
LOW, HIGH = 50, 95               # band of a negative's score in percent of the positive's
ANCHORS, ROWS = 2048, 8192       # sides of a tile
BLOCK = 128                      # anchors whose scores are held at once
MANY_LABELS = 100_000            # label sizes are broadcast up to so many, else joined by shuffle
WIDE_BITS = 53
_NONE = np.iinfo(np.int64).min

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# ---------------------------------------------------------------- packed products

def quantised(vectors: pa.Array) -> np.ndarray:
    """floor(256 * x) of each vector as doubles that hold whole numbers, zeros after short ones."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    ends = np.asarray(vectors.value_lengths(), np.int64)
    flat = np.floor(256.0 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(ends.max(initial=0))
    if len(ends) * width == len(flat):
        return flat.reshape(len(ends), width)
    out = np.zeros((len(ends), width))
    out[np.arange(width)[None, :] < ends[:, None]] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (a, b))


class Packed:
    """Candidates (rows of whole numbers) packed for exact inner products with ``anchors``."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        anchors, rows = _same_width(anchors, rows)
        self.n, self.dims = rows.shape
        self.anchors, self.rows, self.fields = anchors, rows, 0
        if not self.n or not len(anchors) or not self.dims:
            return
        self.bias_a, self.bias_b = -min(anchors.min(), 0.0), -min(rows.min(), 0.0)
        a, b = anchors + self.bias_a, rows + self.bias_b
        if self.dims * int(a.max()) * int(b.max()) < 1 << WIDE_BITS:
            most = math.isqrt(int((a * a).sum(axis=1).max()) * int((b * b).sum(axis=1).max())) + 1
            self.width = max(most.bit_length(), 1)
            self.fields = WIDE_BITS // self.width
        if self.fields:
            wide = np.zeros((-(-self.n // self.fields) * self.fields, self.dims))
            wide[:self.n] = b
            wide = wide.reshape(-1, self.fields, self.dims)
            self.packed = sum(wide[:, j] * float(1 << (j * self.width)) for j in range(self.fields)).T.copy()
            self.a, self.sum_b = a, rows.sum(axis=1).astype(np.int64)

    def scores(self, lo: int, hi: int) -> np.ndarray:
        """Inner products of anchors ``lo`` to ``hi`` with all candidates."""
        if not self.n or not self.dims:
            return np.zeros((hi - lo, self.n), np.int64)
        if not self.fields:
            whole = lambda x: np.array([[int(v) for v in row] for row in x], object)
            plain = whole(self.anchors[lo:hi]) @ whole(self.rows).T
            if any(abs(v) >= 1 << 63 for v in plain.flat):
                raise OverflowError("an inner product does not fit into 64 bits")
            return plain.astype(np.int64)
        product = (self.a[lo:hi] @ self.packed).astype(np.int64)
        mask = (1 << self.width) - 1
        out = np.empty((hi - lo, product.shape[1], self.fields), np.int64)
        for j in range(self.fields):
            out[:, :, j] = (product >> (j * self.width)) & mask
        out = out.reshape(hi - lo, -1)[:, :self.n]
        bias_a, bias_b = int(self.bias_a), int(self.bias_b)
        sum_a = self.anchors[lo:hi].sum(axis=1).astype(np.int64)
        out -= bias_a * self.sum_b[None, :]
        return out - (bias_b * sum_a + self.dims * bias_a * bias_b)[:, None]


def _first(scores: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(anchors, columns) of the highest, second highest, ... score; the first column among
    equal ones.  ``scores`` is used up."""
    at, out = np.arange(len(scores)), []
    for _ in range(min(k, scores.shape[1])):
        top = scores.argmax(axis=1)
        some = np.flatnonzero(scores[at, top] != _NONE)
        if not len(some):
            break
        out.append((some, top[some]))
        scores[some, top[some]] = _NONE
    return out


class _Tile:
    """Anchors and rows of a tile, the rows in the order of their ids."""

    def __init__(self, tile: pa.Table):
        side = tile.column("side").to_numpy()
        part = {s: tile.filter(pa.array(side == s)) for s in (0, 1)}
        self.anchors = part[0]
        self.rows = part[1].take(pa.array(np.argsort(part[1].column("vec_id").to_numpy(), kind="stable")))
        self.packed = Packed(quantised(self.rows.column("vec")), quantised(self.anchors.column("vec")))
        self.id, self.row, self.copies, self.label = (self.rows.column(c).to_numpy() for c in ("vec_id", "row", "copies", "label"))
        self.anchor = self.anchors.column("row").to_numpy()

    def blocks(self):
        for lo in range(0, len(self.anchor), BLOCK):
            hi = min(lo + BLOCK, len(self.anchor))
            yield lo, hi, self.packed.scores(lo, hi)


def _positives(tile: pa.Table) -> pa.Table:
    t = _Tile(tile)
    out = {"anchor": [], "positive_id": [], "score": [], "copies": []}
    place = {r: i for i, r in enumerate(t.row.tolist())}
    for lo, hi, scores in t.blocks():
        own = [(i, place[r]) for i, r in enumerate(t.anchor[lo:hi].tolist()) if r in place]
        for i, j in own:                                       # the anchor is no row of its own
            if t.copies[j] == 1:
                scores[i, j] = _NONE
        own = set(own)
        kept = scores.copy()
        for some, top in _first(scores, POSITIVES):
            out["anchor"].append(t.anchor[lo:hi][some])
            out["positive_id"].append(t.id[top])
            out["score"].append(kept[some, top])
            out["copies"].append(t.copies[top] - np.array([(i, j) in own for i, j in zip(some.tolist(), top.tolist())], np.int64))
    return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})


def _negatives(tile: pa.Table) -> pa.Table:
    t = _Tile(tile)
    out = {"anchor": [], "positive_score": [], "negative_id": [], "score": [], "copies": []}
    labels, wanted = t.anchors.column("label").to_numpy(), t.anchors.column("scores").to_pylist()
    for lo, hi, scores in t.blocks():
        scores[labels[lo:hi, None] == t.label[None, :]] = _NONE
        for k in range(max((len(w) for w in wanted[lo:hi]), default=0)):
            who = np.array([i for i, w in enumerate(wanted[lo:hi]) if len(w) > k and w[k] >= 0], np.int64)
            if not len(who):                                    # 50 p <= 95 p needs p >= 0
                continue
            goal = [wanted[lo + i][k] for i in who.tolist()]
            least = np.array([-(-LOW * p // 100) for p in goal], np.int64)
            most = np.array([HIGH * p // 100 for p in goal], np.int64)
            mine = scores[who]
            mine[(mine < least[:, None]) | (mine > most[:, None])] = _NONE
            kept = mine.copy()
            for some, top in _first(mine, NEGATIVES):
                out["anchor"].append(t.anchor[lo:hi][who[some]])
                out["positive_score"].append(np.array(goal, np.int64)[some])
                out["negative_id"].append(t.id[top])
                out["score"].append(kept[some, top])
                out["copies"].append(t.copies[top])
    return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})


# ---------------------------------------------------------------- tiles

def _tiled(rows: DataFrame, anchors: DataFrame, by: str) -> DataFrame:
    """Both sides, each repeated for the blocks of the other; row_blocks and anchor_blocks
    are the numbers of blocks."""
    cols = ["row", "vec_id", "label", "vec", "copies", "scores"]
    block = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    right = rows.withColumn("scores", F.lit(None).cast("array<long>")).select(
        by, F.lit(1).alias("side"), *cols, each("anchor_blocks").alias("i"), block("row_blocks").alias("j"))
    left = anchors.select(by, F.lit(0).alias("side"), *cols, block("anchor_blocks").alias("i"), each("row_blocks").alias("j"))
    return left.unionByName(right)


def _blocks(n: str, size: int):
    return F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("int")


def _first_of_all(found: DataFrame, by: list[str], name: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group, rows that stand for several counted as such."""
    order = [F.desc("score"), F.col(name)]
    some = Window.partitionBy(*by).orderBy(*order)
    few = found.withColumn("__r", F.row_number().over(some)).where(F.col("__r") <= most).drop("__r")
    every = few.withColumn("__c", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(most)).cast("int"))))
    return every.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= most).drop("__c", "copies")


def hard_negatives(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
                   anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """Columns of RESULT: up to NEGATIVES rows for each anchor and positive."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"), F.col(label).cast("long").alias("label"))
    base = base.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    base = (base.groupBy("vec_id", "label", "vec").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("row", F.monotonically_increasing_id()))
    base = written(base, "vectors")                              # fixes the row numbers
    anchors = base.where(F.col("vec_id") % anchor_every == 0)
    sizes = (base.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % anchor_every == 0).alias("n_anchors"))
             .select(F.col("label").alias("of"), _blocks("n", ROWS).alias("row_blocks"), _blocks("n_anchors", ANCHORS).alias("anchor_blocks"), "n_anchors")
             .where("n_anchors > 0").drop("n_anchors"))
    sizes = written(sizes, "labels")
    if sizes.count() <= MANY_LABELS:
        sizes = F.broadcast(sizes)

    sized = lambda df: df.join(sizes, F.col("label") == F.col("of"))
    no_scores = F.lit(None).cast("array<long>").alias("scores")
    same = _tiled(sized(base), sized(anchors).select("*", no_scores), "of")
    found = same.groupBy("of", "i", "j").applyInArrow(_positives, "anchor long, positive_id long, score long, copies long")
    found = found.where("copies > 0")
    positives = written(_first_of_all(found, ["anchor"], "positive_id", POSITIVES), "positives")

    goals = positives.groupBy("anchor").agg(F.collect_set("score").alias("scores"))      # POSITIVES at most
    totals = base.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % anchor_every == 0).alias("n_anchors")).first()
    blocks = [F.lit(max(1, -(-totals["n"] // ROWS))).alias("row_blocks"), F.lit(max(1, -(-totals["n_anchors"] // ANCHORS))).alias("anchor_blocks")]
    asks = anchors.join(goals, F.col("row") == F.col("anchor")).select("row", "vec_id", "label", "vec", "copies", "scores", F.lit(0).alias("all"), *blocks)
    every = base.select("*", F.lit(0).alias("all"), *blocks)
    found = _tiled(every, asks, "all").groupBy("i", "j").applyInArrow(
        _negatives, "anchor long, positive_score long, negative_id long, score long, copies long")
    negatives = _first_of_all(found, ["anchor", "positive_score"], "negative_id", NEGATIVES)

    pairs = positives.select("anchor", "positive_id", F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "copies")
    return (negatives.join(pairs, ["anchor", "positive_score"]).join(named, "anchor")
            .withColumn("__c", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")))


def shifted_labels(embeddings: DataFrame) -> DataFrame:
    """The labels of the query: every seventh id belongs to the next of ten labels."""
    other = F.col("vec_id") % 7 == 0
    return embeddings.withColumn("label", F.when(other, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def oracle() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, b.r AS br, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
p AS (
  SELECT ar, br, anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other, br) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.other, s.br) AS rank
  FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
