"""Operator 1: near-duplicates by improved consistent weighted sampling.

Each text is a bag of five-word shingles with TF-IDF weights tf * idf, where
idf = 1 + ln(N / df), in steps of a quarter, over the whole range of df.  N and df count one
document of each group of copies, near ones included: otherwise a group's own shingles
would weigh little just because the group is large, and the few words that tell its
members apart would weigh much.  Such a group is told by four keys of two min-hashes each;
a text counts if no text of a smaller digest shares one of its keys (copies at 0.9 share
one with 0.999, texts that have a third in common with 0.4).  df is counted in a count-min
sketch of fixed size over all these texts, so it is never too small, and too large by what
else falls into both of a shingle's cells: about one document in 3,000 at any input size,
below which the idf is flat.  Shingles of none of these texts weigh as those of one.

1. Texts get SAMPLES consistent weighted samples.  Bands of ROWS samples each are keys.
2. Equal texts are one node.  In every bucket of a band the node with the most company
   in all its buckets is the hub, and every other node is paired with it: rows grow with
   the nodes, not with the square of a bucket.
3. Pairs whose samples agree often enough are measured exactly on their whole texts; a
   weighted Jaccard similarity of at least 0.8 is a link.
4. Links give components.  Only buckets that still hold several components are looked at
   again: their nodes outside the largest component (a stated query set) are compared
   with all nodes of the bucket, in tiles of bounded size, each pair in the first band
   that it shares.  1 - similarity is a metric, so two nodes whose distances to the hub
   differ by more than 0.2 are no pair; the others must agree in their samples and then
   in their shingles, and what is left is verified too.  So no pair that shares a band is
   left out for not being the hub's.

The class of a document is the smallest id of its component.

Nulls and texts without words take no part in links and are classes of their own (all
rows with an equal text, the empty one too, are copies and share a class).  Null ids
come after all others as class ids.  Repeated rows are copies.  An empty table gives no
rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.bitmaps import BITMAP_LOG2, bitmap, in_bitmap
from pricetide.llm.common import text_or_empty, written
from pricetide.llm.components import components
from pricetide.llm.text import mix, shingles, word_hashes

SIMILARITY = 0.8
SAMPLES, ROWS = 64, 4            # 16 bands: a pair at 0.8 misses all of them with 0.0002
AGREE = 38                       # of 64 samples; a pair at 0.8 has fewer with 0.00003
STEPS = 4                        # steps of the idf per unit
KEYS, PER_KEY = 4, 2             # keys of min-hashes that tell groups of copies
CELLS_LOG2 = 20                  # cells of each of the two rows of the sketch
SLICE = 1 << 15                  # cells that travel together
TILE = 512                       # nodes on either side of a tile of step 4

_ROW2 = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- document frequencies

def _cells(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each shingle in the two rows of the sketch."""
    down = np.uint64(64 - CELLS_LOG2)
    return (s >> down).astype(np.int64), ((s * _ROW2) >> down).astype(np.int64)


_KEY_ODD = mix(np.arange(1, KEYS * PER_KEY + 1, dtype=np.uint64) * _ROW2) | np.uint64(1)


def _digest(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def copy_keys(s: np.ndarray) -> np.ndarray:
    """KEYS keys of the shingles ``s`` of a text, each of PER_KEY min-hashes."""
    low = np.array([(s * odd).min() for odd in _KEY_ODD]).reshape(KEYS, PER_KEY)
    keys = np.arange(KEYS, dtype=np.uint64)
    for i in range(PER_KEY):
        keys = mix(keys * _ROW2 + low[:, i])
    return keys


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, keys = [], []
        for text in batch.column("text").to_pylist():
            node.append(_digest(text))
            s = shingles(word_hashes(text))
            keys.append(copy_keys(s).astype(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                                         names=["doc_id", "node", "keys"])


def distinct_texts(rows: DataFrame) -> DataFrame:
    """node, doc_id (the smallest), same (rows that have this id and text), copies, keys."""
    pairs = (rows.mapInArrow(_keyed, "doc_id long, node binary, keys array<long>")
             .groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("same"), F.first("keys").alias("keys")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")).alias("m")
    return pairs.groupBy("node").agg(first, F.sum("same").alias("copies"), F.first("keys").alias("keys")).select(
        "node", "m.doc_id", "m.same", "copies", "keys")


def representatives(nodes: DataFrame) -> DataFrame:
    """The nodes that have the smallest digest under every one of their keys."""
    firsts = (nodes.select("node", F.posexplode("keys").alias("at", "key"))
              .groupBy("at", "key").agg(F.min("node").alias("node")))
    every = firsts.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == KEYS)
    return nodes.join(every.select("node"), "node", "left_semi").select("node", "doc_id", "same")


def idf_level(n: int, df: np.ndarray) -> np.ndarray:
    """Steps of idf = 1 + ln(n / df)."""
    n = max(n, 1)
    return np.rint(STEPS * (1 + np.log(n / np.clip(df, 1, n)))).astype(np.uint8)


def idf_levels(texts: DataFrame, n: int) -> np.ndarray:
    """The idf of each cell, in steps, from the columns text and same (as often as a row
    repeats, by so much less does it count); cells of the second row come after the first's."""
    n_cells, most = 1 << CELLS_LOG2, 1 << 20

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * n_cells)
        held: list[np.ndarray] = []
        share: list[float] = []

        def add_up() -> None:
            if held:
                a, b = _cells(np.concatenate(held))
                w = None if min(share) == 1 else np.repeat(share, [len(s) for s in held])
                total[:n_cells] += np.bincount(a, w, n_cells)
                total[n_cells:] += np.bincount(b, w, n_cells)
                held.clear()
                share.clear()
        size = 0
        for batch in batches:
            for text, same in zip(batch.column("text"), batch.column("same").to_pylist()):
                s = np.unique(shingles(word_hashes(text.as_py())))               # once a document
                held.append(s)
                share.append(1 / same)
                size += len(s)
                if size >= most:
                    add_up()
                    size = 0
        add_up()
        for i in range(0, 2 * n_cells, SLICE):
            part = total[i:i + SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i // SLICE], pa.int32()), "counts": [part.astype(np.float32).tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}             # at most all cells, 16 MB
        for batch in batches:
            for i, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                sums.setdefault(i, np.zeros(SLICE))
                sums[i] += np.frombuffer(raw, np.float32)
        for i, total in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "levels": [idf_level(n, np.rint(total)).tobytes()]})

    levels = np.full(2 * n_cells, idf_level(n, np.ones(1))[0], np.uint8)
    found = texts.mapInArrow(count, "slice int, counts binary").repartition("slice").mapInArrow(add, "slice int, levels binary")
    for row in found.toLocalIterator():              # 2 MB in all
        levels[row["slice"] * SLICE:(row["slice"] + 1) * SLICE] = np.frombuffer(row["levels"], np.uint8)
    return levels


class Weights:
    """TF-IDF weights of shingles, multiples of a step, from the idf of the sketch's cells."""

    def __init__(self, levels: np.ndarray):
        n_cells = 1 << CELLS_LOG2
        self.first, self.second = levels[:n_cells], levels[n_cells:]
        self.top = int(levels.max())

    def __call__(self, s: np.ndarray, tf: np.ndarray) -> np.ndarray:
        a, b = _cells(s)
        return np.maximum(self.first[a], self.second[b]) * tf.astype(np.float32) / np.float32(STEPS)


def bag(text: str | None, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles of a text and their weights."""
    s, tf = np.unique(shingles(word_hashes(text)), return_counts=True)
    return s, weights(s, tf)


def weighted_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger; 0 for two empty bags."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(x[1][i], y[1][j]).sum(dtype=np.float64))
    all_ = float(x[1].sum(dtype=np.float64) + y[1].sum(dtype=np.float64)) - both
    return both / all_ if all_ > 0 else 0.0


# ---------------------------------------------------------------- consistent weighted samples

class Sampler:
    """Improved consistent weighted sampling (Ioffe 2010).  For a shingle k of weight S and
    a sample j: r, c ~ Gamma(2, 1), b ~ U(0, 1), t = floor(ln S / r + b) and
    ln a = ln c - r (t - b + 1); the sample is (k, t) of the smallest ln a.  The random
    numbers of (k, j) come from tables of 2^16 draws, picked by bits of k times an odd
    number of j; weights up to the highest idf have r (t - b + 1) tabled for all draws."""

    def __init__(self, weights: Weights, samples: int = SAMPLES, seed: int = 20):
        rng = np.random.RandomState(seed)
        n = 1 << 16
        self.r = -np.log(rng.random_sample(n) * rng.random_sample(n)).astype(np.float32) + np.float32(1e-6)
        self.b = rng.random_sample(n).astype(np.float32)
        self.ln_c = np.log(-np.log((1 - rng.random_sample(n)) * (1 - rng.random_sample(n)) * (1 - 1e-12))).astype(np.float32)
        self.odd = (rng.randint(0, 1 << 62, samples, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.top = weights.top
        self.tabled = np.zeros((self.top + 1, n), np.float32)
        for level in range(STEPS, self.top + 1):
            self.tabled[level] = self._steps(np.log(np.float32(level / STEPS)), np.arange(n))[1]
        self.tabled = self.tabled.ravel()

    def _steps(self, ln_s, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """t and r (t - b + 1) for draws ``i``."""
        t = np.floor(ln_s / self.r[i] + self.b[i])
        return t, self.r[i] * (t - self.b[i] + np.float32(1))

    def __call__(self, s: np.ndarray, w: np.ndarray, block: int = 1024) -> np.ndarray:
        """One 64-bit fingerprint of (k, t) for each sample, the same for equal (k, t)."""
        n = len(self.odd)
        rows, odd = np.arange(n), self.odd[:, None]
        best, key, weight = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64), np.ones(n, np.float32)
        low_weight = w <= self.top / STEPS
        for tabled in (True, False):
            part = np.flatnonzero(low_weight == tabled)
            for lo in range(0, len(part), block):
                k, wk = s[part[lo:lo + block]], w[part[lo:lo + block]]
                u = np.multiply(k[None, :], odd)
                i = u >> np.uint64(48)
                u >>= np.uint64(32)
                u &= np.uint64(0xFFFF)
                a = self.ln_c.take(u.view(np.int64), mode="clip")
                if tabled:
                    i += ((wk * STEPS).astype(np.uint64) << np.uint64(16))[None, :]
                    a -= self.tabled.take(i.view(np.int64), mode="clip")
                else:
                    a -= self._steps(np.log(wk)[None, :], i.view(np.int64))[1]
                at = a.argmin(axis=1)
                low = a[rows, at]
                won = (low < best) | ((low == best) & (k[at] < key))
                best[won], key[won], weight[won] = low[won], k[at][won], wk[at][won]
        t = self._steps(np.log(weight), ((key * self.odd) >> np.uint64(48)).view(np.int64))[0]
        return mix(key + t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _band_keys(f: np.ndarray) -> np.ndarray:
    keys = np.zeros(len(f) // ROWS, np.uint64)
    for i in range(ROWS):
        keys = mix(keys + f[i::ROWS][:len(keys)] + np.uint64(i + 1))
    return keys


def signatures(docs: DataFrame, shared) -> DataFrame:
    """doc_id, node (the text's digest), bands and samples (both null without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value)
        sampler = Sampler(weights)
        for batch in batches:
            node, bands, samples = [], [], []
            for text in batch.column("text").to_pylist():
                node.append(_digest(text))
                x = bag(text, weights)
                if len(x[0]):
                    f = sampler(*x)
                    bands.append(_band_keys(f).astype(np.int64))
                    samples.append((f >> np.uint64(32)).astype(np.uint32).tobytes())
                else:
                    bands.append(None)
                    samples.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(node, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(samples, pa.binary())],
                names=["doc_id", "node", "bands", "samples"])

    return docs.mapInArrow(sign, "doc_id long, node binary, bands array<long>, samples binary")


# ---------------------------------------------------------------- pairs

def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose samples agree in at least AGREE places."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SAMPLES) for c in ("sa", "sb"))
        ok = pa.array(_agree(x, y) >= AGREE)
        yield batch.select(["a", "b"]).filter(ok)


def _verify(pairs: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """a, b and the similarity of their whole texts."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value)
        last, last_bag = None, None                 # rows come sorted by b from the join
        for batch in batches:
            sim = []
            for b, tb, ta in zip(batch.column("b").to_pylist(), batch.column("tb").to_pylist(), batch.column("ta").to_pylist()):
                if b != last:
                    last, last_bag = b, bag(tb, weights)
                sim.append(weighted_jaccard(bag(ta, weights), last_bag))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim, pa.float64())], names=["a", "b", "similarity"])

    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a binary, b binary, similarity double")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of the nodes ``wanted`` (node, doc_id of its first row).  A bitmap of
    bounded size drops most other texts before the join."""
    spark = docs.sparkSession
    n = wanted.count()
    log2 = min(BITMAP_LOG2, max(16, int(16 * max(n, 1)).bit_length()))
    number = F.conv(F.hex(F.substring("node", 1, 7)), 16, 10).cast("long")       # 56 bits of the digest
    bits = spark.sparkContext.broadcast(bitmap(wanted.select(number.alias("seed")), log2))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = [_digest(t) for t in batch.column("text").to_pylist()]
            number = np.array([int.from_bytes(d[:7], "big") for d in node], np.uint64)
            at = pa.array(in_bitmap(bits.value, log2, number))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text").take(at), pa.array(node, pa.binary()).take(at)],
                                             names=["doc_id", "text", "node"])

    rows = docs.mapInArrow(some, "doc_id long, text string, node binary")
    need = wanted.select(F.col("doc_id").alias("__d"), F.col("node").alias("__n"))
    found = rows.join(need, (rows["node"] == need["__n"]) & rows["doc_id"].eqNullSafe(need["__d"]), "left_semi")
    return found.groupBy("node").agg(F.first("text").alias("text"))      # rows may repeat


def _short_bags(texts: DataFrame, shared) -> DataFrame:
    """node, shingles (32 bits of each, sorted) and weights, for tiles."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value)
        for batch in batches:
            bags = [bag(t, weights) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([(s >> np.uint64(32)).astype(np.uint32).tobytes() for s, _ in bags], pa.binary()),
                 pa.array([w.tobytes() for _, w in bags], pa.binary())], names=["node", "shingles", "weights"])
    return texts.mapInArrow(make, "node binary, shingles binary, weights binary")


class _Rows:
    """Rows of tiles as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        self.place = np.column_stack([get(c).astype(np.int64) for c in ("band", "key", "i", "j")])
        self.side, self.far = get("side"), get("far")                       # far is NaN where not known
        self.node, self.label = batch.column("node").to_pylist(), np.array(batch.column("label").to_pylist(), object)
        self.bands = batch.column("bands").flatten().to_numpy().reshape(batch.num_rows, -1)
        self.samples = np.frombuffer(b"".join(batch.column("samples").to_pylist()), np.uint32).reshape(-1, SAMPLES)
        self.shingles = [np.frombuffer(x, np.uint32) for x in batch.column("shingles").to_pylist()]
        self.weights = [np.frombuffer(x, np.float32) for x in batch.column("weights").to_pylist()]
        self.total = np.array([w.sum() for w in self.weights])

    def starts(self) -> np.ndarray:
        """Where each tile begins."""
        return np.concatenate([[0], np.flatnonzero((self.place[1:] != self.place[:-1]).any(axis=1)) + 1])


def _near(rows: _Rows, i: int, which: np.ndarray) -> np.ndarray:
    """Those of ``which`` whose short bags are about as similar to that of ``i`` as a link needs."""
    own, w = rows.shingles[i], rows.weights[i]
    theirs = np.concatenate([rows.shingles[j] for j in which])
    at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    both = np.where(own[at] == theirs, np.minimum(w[at], np.concatenate([rows.weights[j] for j in which])), 0)
    starts = np.cumsum([0] + [len(rows.shingles[j]) for j in which[:-1]])
    common = np.add.reduceat(both, starts)
    return which[common >= (SIMILARITY - 0.01) * (rows.total[i] + rows.total[which] - common)]


def _pairs_within(rows: _Rows, lo: int, hi: int) -> list[tuple[bytes, bytes]]:
    """Pairs of a tile (rows ``lo`` to ``hi``) that lie in different components and may be
    similar, in the first band that they share."""
    side = rows.side[lo:hi]
    x, y = lo + np.flatnonzero(side == 0), lo + np.flatnonzero(side == 1)
    out = []
    for i in x.tolist():
        may = y[(rows.label[y] != rows.label[i]) & ~(np.abs(rows.far[y] - rows.far[i]) > 1 - SIMILARITY + 1e-9)]
        may = may[(rows.bands[may] == rows.bands[i]).argmax(axis=1) == rows.place[lo, 0]]
        may = may[_agree(rows.samples[may], rows.samples[i]) >= AGREE]
        if len(may):
            a = rows.node[i]
            out += [(a, b) if a < b else (b, a) for b in (rows.node[j] for j in _near(rows, i, may))]
    return out


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; the last tile of a batch waits for the next batch."""
    def pairs(rows: _Rows, cuts: list[int]) -> pa.RecordBatch:
        found = [p for lo, hi in zip(cuts, cuts[1:]) for p in _pairs_within(rows, lo, hi)]
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        rows = _Rows(batch)
        cuts = rows.starts().tolist()
        yield pairs(rows, cuts)
        rest = batch.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield pairs(_Rows(rest), [0, rest.num_rows])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, links, node (digest of the text), class_key (smallest
    digest of the class): one row per document.  ``links`` counts the verified links of the
    document's text to other texts."""
    from pyspark.sql import SparkSession
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    one = written(distinct_texts(rows), "nodes")          # one row per node: that of its smallest id
    counted = written(representatives(one), "representatives")
    n = counted.count()
    first = counted.select(F.col("doc_id").alias("__d"), F.col("node").alias("__n"), "same")
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    once = (rows.withColumn("node", digest).join(first, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("node") == F.col("__n")))
            .select("text", "same"))
    shared = spark.sparkContext.broadcast(idf_levels(once, n))
    signed = written(signatures(rows, shared), "signatures")
    sig = (signed.join(one.select("node", F.col("doc_id").alias("__d")), "node")
           .where(F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("bands").isNotNull()).drop("__d", "doc_id")
           .groupBy("node").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples")))
    sig = written(sig, "samples")
    band = sig.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = band.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    member = written(band.join(sizes, ["band", "key"]), "buckets")
    company = member.groupBy("node").agg(F.sum("size").alias("company"))
    hubs = (member.join(company, "node").groupBy("band", "key")
            .agg(F.max(F.struct("company", "node"))["node"].alias("hub")))
    wanted = one.select("doc_id", "node").join(member.select("node").distinct(), "node", "left_semi")
    texts = written(_texts(rows, written(wanted, "wanted")), "texts")
    spokes = (member.join(hubs, ["band", "key"]).where("node <> hub")
              .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    sa = sig.select(F.col("node").alias("a"), F.col("samples").alias("sa"))
    sb = sig.select(F.col("node").alias("b"), F.col("samples").alias("sb"))
    likely = spokes.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(_likely, "a binary, b binary")
    star = written(_verify(likely, texts, shared), "star")
    links = star.where(F.col("similarity") >= SIMILARITY).select("a", "b")
    label = components(links)

    # buckets that still hold several components: what is outside the largest meets all of it
    placed = member.join(hubs, ["band", "key"]).join(label, F.col("node") == F.col("member"), "left").select(
        "band", "key", "node", "hub", F.coalesce("label", "node").alias("label"))
    shares = placed.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (shares.groupBy("band", "key").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("size"))
             .select("band", "key", F.col("m.label").alias("main"), "size", (F.col("size") - F.col("m.n")).alias("n_out")).where("n_out > 0"))
    inside = written(placed.join(mixed, ["band", "key"]).withColumn("out", F.col("label") != F.col("main")).drop("main"), "mixed")
    short = _short_bags(texts.join(inside.select("node").distinct(), "node", "left_semi"), shared)
    far = star.select(F.col("a").alias("node"), F.col("b").alias("hub"), (1 - F.col("similarity")).alias("far"))
    both = inside.join(far, ["node", "hub"], "left").join(sig.select("node", "bands", "samples").join(short, "node"), "node")
    both = both.withColumn("far", F.when(F.col("node") == F.col("hub"), 0.0).otherwise(F.col("far")))
    tiles_of = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / TILE)).cast("int")
    spread = lambda c, salt: F.pmod(F.xxhash64("node", F.lit(salt)), tiles_of(c)).cast("int")
    cols = ["band", "key", "node", "label", "far", "bands", "samples", "shingles", "weights"]
    asks = both.where("out").select(*cols, F.lit(0).alias("side"), spread("n_out", 1).alias("i"),
                                    F.explode(F.sequence(F.lit(0), tiles_of("size") - 1)).alias("j"))
    rest = both.select(*cols, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), tiles_of("n_out") - 1)).alias("i"),
                       spread("size", 2).alias("j"))
    tile = ["band", "key", "i", "j"]
    crossed = written(asks.unionByName(rest).repartition(*tile).sortWithinPartitions(*tile)
                      .mapInArrow(_tile_pairs, "a binary, b binary").distinct(), "crossed")
    known = star.select("a", "b").unionByName(star.select(F.col("a").alias("b"), F.col("b").alias("a")))
    more = written(_verify(crossed.join(known, ["a", "b"], "left_anti"), texts, shared), "more_links")
    links = links.unionByName(more.where(F.col("similarity") >= SIMILARITY).select("a", "b"))
    label = components(links)

    degree = (links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("links")))
    nodes = (one.join(label, F.col("node") == F.col("member"), "left").join(degree, "node", "left")
             .select("node", "doc_id", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links")))
    classes = nodes.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = nodes.join(classes, "label").select("node", "class_id", "class_size", "links", "label")
    return (signed.select("doc_id", "node").join(named, "node")
            .select("doc_id", "class_id", "class_size", "links", F.hex("node").alias("node"), F.hex("label").alias("class_key")))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns: that of the smallest id (null last),
    of the smallest text digest among equal ids, and one row only where rows repeat."""
    classes = written(near_duplicates(docs, doc_id, text), "classes")
    first = (classes.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("m"))
             .select(F.col("m.doc_id").alias("__d"), F.col("m.node").alias("__n")))
    same = classes.groupBy(F.col("doc_id").alias("__e"), F.col("node").alias("__o")).agg(F.count(F.lit(1)).alias("__same"))
    keep = written(first.join(same, F.col("__d").eqNullSafe(F.col("__e")) & (F.col("__n") == F.col("__o"))).select("__d", "__n", "__same"), "kept")
    digest = F.upper(F.md5(F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")))

    def rows_of(some: DataFrame, how: str) -> DataFrame:
        return docs.join(some, docs[doc_id].cast("long").eqNullSafe(some["__d"]) & (digest == some["__n"]), how)
    out = rows_of(keep.where(F.col("__same") == 1), "left_semi")
    repeated = keep.where(F.col("__same") > 1)
    if repeated.isEmpty():
        return out
    one = Window.partitionBy(repeated["__d"], repeated["__n"]).orderBy(F.lit(1))
    rank = f"rank_{uuid.uuid4().hex}"                             # no column of the documents has this name
    return out.unionByName(rows_of(repeated, "inner").select(*[docs[c] for c in docs.columns], F.row_number().over(one).alias(rank))
                           .where(F.col(rank) == 1).drop(rank))
