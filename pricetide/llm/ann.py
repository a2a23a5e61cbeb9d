"""Operator 7: nearest neighbours by inner product with adaptive dimension scans.

Vectors are dealt to lists (nearest centre); centres, the number of lists that a query
probes and a first threshold for every query come from a bounded sample (FIT_ROWS rows
of the lowest hash of their id); every row is indexed.  PROBES are chosen so that the
sample's own neighbours are found with a recall of TARGET.

In a probed list, vectors turned by a random rotation are read in blocks of BLOCK
columns.  The squared distance so far, as a share of the whole, follows a Beta(d/2,
(D-d)/2) distribution; a candidate whose partial distance is above the (1 - MISS)
quantile of what a neighbour could have is abandoned (ADSampling, Gao and Long 2023, with
the exact quantile in place of its bound).  Those left get their exact inner product of
the original vectors in double precision.

A unit of work is a tile of at most about ROWS rows of a list and QUERIES queries, so a
list of any size is spread over tasks.  Each tile keeps a query's best K, and a window
with a limit joins the tiles.

Vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without an id or of another dimension than most; rows that repeat an id count
once (smallest vector).  An empty table gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import written

FIT_ROWS, FIT_QUERIES = 20_000, 512
ROWS_PER_LIST, MOST_LISTS = 64, 4096
TARGET = 0.97
MISS = 0.001
SPARE = 4
BLOCK = 16
ROWS, QUERIES = 4096, 1024


def clean_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = (table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(~bad).where(F.exists("v", lambda x: x != 0)).groupBy("vec_id").agg(F.min("v").alias("v")))
    rows = written(rows, "vectors")
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size["d"] if size else 0))


def _matrix(col: pa.Array) -> np.ndarray:
    """A list column without nulls, of one dimension, as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def beta_quantile(a: float, b: float, p: float, steps: int = 20_000) -> float:
    """The p-quantile of Beta(a, b), by summing its density."""
    x = (np.arange(steps) + 0.5) / steps
    log = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    cum = np.cumsum(np.exp(log - log.max()))
    return float((np.searchsorted(cum, p * cum[-1]) + 1) / steps)


@dataclass
class Index:
    """What a bounded sample tells: centres, probes, rotation, test bounds."""
    centres: np.ndarray
    probes: int
    sample: np.ndarray
    sample_ids: np.ndarray
    sample_lists: np.ndarray
    rotation: np.ndarray
    bounds: list[tuple[int, float]]        # (columns read, largest share of a squared distance)

    def lists(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.centres)

    def probed(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(q @ self.centres.T), axis=1, kind="stable")[:, :self.probes]

    def floor(self, ids: np.ndarray, q: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """A score that about SPARE more than ``k`` rows of the probed lists reach: those of the sample."""
        s = q @ self.sample.T
        s[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        asked = np.zeros((len(q), len(self.centres)), bool)
        np.put_along_axis(asked, probed, True, axis=1)
        s[~asked[:, self.sample_lists]] = -np.inf
        if s.shape[1] < k + SPARE:
            return np.full(len(q), -np.inf)
        return np.partition(s, s.shape[1] - k - SPARE, axis=1)[:, s.shape[1] - k - SPARE] - 1e-9


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([(x[i:i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def fit(ids: np.ndarray, sample: np.ndarray, k: int, seed: int = 5, rounds: int = 12) -> Index:
    rng = np.random.RandomState(seed)
    n, dim = sample.shape
    n_lists = max(1, min(MOST_LISTS, n // ROWS_PER_LIST))
    centres = sample[rng.permutation(n)[:n_lists]].copy()
    for _ in range(rounds):
        at = _nearest(sample, centres)
        total = np.zeros_like(centres)
        np.add.at(total, at, sample)
        size = np.bincount(at, minlength=n_lists)
        centres[size > 0] = total[size > 0] / size[size > 0][:, None]
    at = _nearest(sample, centres)
    tried = rng.permutation(n)[:FIT_QUERIES]
    s = sample[tried] @ sample.T
    s[np.arange(len(tried)), tried] = -np.inf
    near = np.argsort(-s, axis=1)[:, :min(k, n - 1)]
    place = np.argsort(np.argsort(-(sample[tried] @ centres.T), axis=1, kind="stable"), axis=1)      # of each list for each query
    need = np.sort(np.take_along_axis(place, at[near], axis=1).ravel())
    probes = int(need[min(len(need) - 1, int(np.ceil(TARGET * len(need))))]) + 1 if len(need) else n_lists
    rotation, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    bounds = [(d, beta_quantile(d / 2, (dim - d) / 2, 1 - MISS)) for d in range(BLOCK, dim, BLOCK)]
    return Index(centres, probes, sample, ids, at, rotation, bounds)


def scan(index: Index, k: int, ids: np.ndarray, rows: np.ndarray, q_ids: np.ndarray, queries: np.ndarray,
         floor: np.ndarray, exact: bool = False, step: int = 512) -> list[tuple[int, int, float]]:
    """(query, row, score): the best ``k`` rows of a tile for each query that reach its floor;
    ``exact`` abandons no candidate."""
    x, q = rows @ index.rotation, queries @ index.rotation
    xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
    best: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    floor = floor.copy()
    for lo in range(0, len(x), step):
        hi = min(lo + step, len(x))
        a, b = np.meshgrid(np.arange(len(q)), np.arange(lo, hi), indexing="ij")
        a, b = a.ravel(), b.ravel()
        keep = q_ids[a] != ids[b]
        a, b = a[keep], b[keep]
        partial, done = np.zeros(len(a)), 0
        for d, share in () if exact else index.bounds:
            diff = q[a, done:d] - x[b, done:d]
            partial += np.einsum("ij,ij->i", diff, diff)
            done = d
            # a neighbour's squared distance is at most |q|^2 + |x|^2 - 2 * floor
            alive = partial <= share * (qq[a] + xx[b] - 2 * floor[a]) + 1e-9
            a, b, partial = a[alive], b[alive], partial[alive]
        score = np.einsum("ij,ij->i", queries[a], rows[b])
        ok = score >= floor[a]
        a, b, score = a[ok], b[ok], score[ok]
        order = np.argsort(a, kind="stable")
        cut = np.searchsorted(a[order], np.arange(len(q) + 1))
        for i in np.unique(a).tolist():
            at = order[cut[i]:cut[i + 1]]
            best[i] = sorted(best[i] + [(-s, r) for s, r in zip(score[at].tolist(), ids[b[at]].tolist())])[:k]
            if len(best[i]) == k:
                floor[i] = max(floor[i], -best[i][-1][0])
    return [(int(q_ids[i]), r, -s) for i, found in enumerate(best) for s, r in found]


def neighbours(table: DataFrame, k: int = 20, query_step: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of every row whose id is
    divisible by ``query_step``."""
    spark = table.sparkSession
    rows = clean_vectors(table, vec_id, vector)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toArrow().combine_chunks()
    if not sample.num_rows:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    index = fit(sample["vec_id"].to_numpy(), _matrix(sample["v"].combine_chunks()), k)
    shared = spark.sparkContext.broadcast(index)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(shared.value.lists(x), pa.int32()),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "list", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                q, ids = _matrix(part.column("v")), part.column("vec_id").to_numpy()
                probed = shared.value.probed(q)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(probed.tolist(), pa.list_(pa.int32())), pa.array([r.tobytes() for r in q], pa.binary()),
                                                  pa.array(shared.value.floor(ids, q, probed, k))], names=["id", "lists", "v", "floor"])

    dealt = written(rows.mapInArrow(deal, "id long, list int, v binary"), "lists")
    asked = written(rows.where(F.pmod("vec_id", F.lit(query_step)) == 0).mapInArrow(ask, "id long, lists array<int>, v binary, floor double"), "queries")
    found = written(_search(dealt, asked, shared, k, False), "found")
    # a query of which fewer than k rows were found goes over all lists without a test
    want = min(k, rows.count() - 1)
    full = found.groupBy("query_id").count().where(F.col("count") >= want)
    few = asked.join(full, asked["id"] == full["query_id"], "left_anti")
    few = written(few.withColumn("lists", F.sequence(F.lit(0), F.lit(len(index.centres) - 1))).withColumn("floor", F.lit(float("-inf"))), "few")
    found = found.join(few.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(_search(dealt, few, shared, k, True))
    return found.select("query_id", "rank", "vec_id", "score")


def _search(dealt: DataFrame, asked: DataFrame, shared, k: int, exact: bool) -> DataFrame:
    """The best ``k`` rows of each query in the lists that it probes."""
    asked = asked.select("id", F.explode("lists").alias("list"), "v", "floor")
    tiles = (lambda c, most: F.greatest(F.lit(1), F.ceil(F.col(c) / most)).cast("int"))
    size = (dealt.groupBy("list").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy("list").agg(F.count(F.lit(1)).alias("m")), "list")
            .select("list", tiles("n", ROWS).alias("n_tiles"), tiles("m", QUERIES).alias("m_tiles")))
    size = F.broadcast(size)                      # at most MOST_LISTS rows
    left = dealt.join(size, "list").select("list", F.pmod(F.xxhash64("id"), F.col("n_tiles")).cast("int").alias("i"),
                                           F.explode(F.sequence(F.lit(0), F.col("m_tiles") - 1)).alias("j"), "id", "v", F.lit(None).cast("double").alias("floor"))
    right = asked.join(size, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("i"),
                                            F.pmod(F.xxhash64("id"), F.col("m_tiles")).cast("int").alias("j"), "id", "v", "floor")

    def tile(key, part: pd.DataFrame) -> pd.DataFrame:
        is_row = part["floor"].isna()
        r, q = part[is_row], part[~is_row]
        unpack = lambda p: np.frombuffer(b"".join(p["v"])).reshape(len(p), -1)
        best = scan(shared.value, k, r["id"].to_numpy(), unpack(r), q["id"].to_numpy(), unpack(q), q["floor"].to_numpy(), exact) if len(r) and len(q) else []
        return pd.DataFrame(best, columns=["query_id", "vec_id", "score"])

    best = left.unionByName(right).groupBy("list", "i", "j").applyInPandas(tile, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
