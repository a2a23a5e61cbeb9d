"""Operator 8: benchmark decontamination by spaced-seed hashing.

Words are compared in lower case without the marks around them.  A mask picks WEIGHT
positions of a run of words and ignores the others, so that a passage with substituted
words still agrees with its source under some mask at some place.  The hashes of all
places of the test items and of the documents are joined; around each hit the passage is
laid on the item without gaps.  Stretches all of whose beginnings and ends have a positive
score (a match counts 1, a substitution -SUBSTITUTION) are tested one by one: at least
LEAST_WORDS words (or the whole item, if shorter), of which a share of IDENTITY agree; the
best one that passes is reported.

A bitmap of the items' hashes, of a size bounded by BITMAP_LOG2, lets tasks drop nearly
all places of clean text before the join; the join itself is exact.  Documents that have
hits are kept as regions (the words around the hits), so texts are not shuffled.

Items with fewer words than the shortest mask are sought as a whole.  Items and texts
without words give nothing; null texts count as empty; null ids are ids like others.
Repeated items are items of their own, repeated documents give one row per item.  Empty
tables give no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.bitmaps import BITMAP_LOG2, bitmap, in_bitmap
from pricetide.llm.common import text_or_empty, written
from pricetide.llm.text import mix

# fixed masks: 1 marks a position that counts
MASKS = ("11011101", "111001011", "1101100011", "101011010001")
LEAST_WORDS = 10
IDENTITY = 0.75
SUBSTITUTION = 2.0
BROADCAST_SEEDS = 200_000        # items' seeds up to this number are broadcast (5 MB), more are shuffled

_MARKS = string.punctuation + "“”‘’«»„…–—¿¡"
_ODD = (np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _Cores(dict):
    """Hashes of words without the marks around them, 0 for marks alone; emptied when full."""

    MOST = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        core = word.strip(_MARKS)
        h = self[word] = (xxhash.xxh64_intdigest(core.encode("utf-8", "surrogatepass")) | 1) if core else 0
        return h


_cores = _Cores()


def tokens(text: str | None) -> np.ndarray:
    w = (text or "").lower().split()
    h = np.fromiter(map(_cores.__getitem__, w), np.uint64, len(w))
    return h[h != 0]


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash under ``mask`` of every place where it fits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.full(n, len(mask), np.uint64)
    for k, p in enumerate(i for i, c in enumerate(mask) if c == "1"):
        s += h[p:p + n] * _ODD[k % 32]
        s = (s ^ (s >> np.uint64(29))) * _ODD[(k + 7) % 32] if k % 8 == 7 else s
    return mix(s + np.uint64((int(mask, 2) * int(_ODD[31])) % (1 << 64)))


def masks_for(n_words: int) -> tuple[str, ...]:
    """The masks that fit an item; one of all its words if none does."""
    fit = tuple(m for m in MASKS if len(m) <= n_words)
    return fit or (("1" * n_words,) if n_words else ())


def item_seeds(items: DataFrame) -> DataFrame:
    """item (a number of its own), item_id, words, seeds and their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, d, t in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text"))):
                h = tokens(t)
                found = [(s, np.arange(len(s))) for s in (seeds(h, m) for m in masks_for(len(h)))]
                if found:
                    out.append((i, d, h.view(np.int64), np.concatenate([s for s, _ in found]).view(np.int64), np.concatenate([p for _, p in found]), len(h)))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64())),
                 pa.array(cols[3], pa.list_(pa.int64())), pa.array([p.astype(np.int32) for p in cols[4]], pa.list_(pa.int32())), pa.array(cols[5], pa.int32())],
                names=["item", "item_id", "words", "seeds", "places", "n_words"])

    return items.mapInArrow(run, "item long, item_id long, words array<long>, seeds array<long>, places array<int>, n_words int")


def _regions(h: np.ndarray, at: np.ndarray, reach: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, hits) of stretches of words that hold hits no further than ``reach`` apart."""
    cut = np.flatnonzero(np.diff(at) > 2 * reach) + 1
    for lo, hi in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])):
        yield max(0, int(at[lo]) - reach), min(len(h), int(at[hi - 1]) + reach), np.arange(lo, hi)


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """(start, length, matches) of the stretch of the highest score."""
    gain = np.where(same, 1.0, -SUBSTITUTION)
    upto = np.concatenate([[0.0], np.cumsum(gain)])
    low = np.minimum.accumulate(upto)
    end = int((upto - low).argmax())
    start = int(np.flatnonzero(upto[:end + 1] == low[end])[-1]) if end else 0
    return start, end - start, int(same[start:end].sum())


def passing_stretch(same: np.ndarray, least: int) -> tuple[int, int, int]:
    """(start, length, matches) of the stretch of the highest score among those of at least
    ``least`` words and a share of IDENTITY, all of whose beginnings and ends score above 0;
    length 0 if there is none."""
    start, length, matches = best_stretch(same)
    if length >= least and matches >= IDENTITY * length:
        return start, length, matches
    found, top = (0, 0, 0), 0.0
    upto = np.concatenate([[0], np.cumsum(same)])
    if upto[-1] < IDENTITY * least:
        return found
    # the best stretch from or to the middle of a run of matches is shorter than that of the whole run
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    score = upto * (1.0 + SUBSTITUTION) - np.arange(len(upto)) * SUBSTITUTION
    for r, i in enumerate(first):
        under = np.flatnonzero(score[first[r + 1:]] <= score[i])
        ends = last[r:r + 1 + under[0]] if len(under) else last[r:]
        up = score[ends]
        higher = up > np.concatenate([[-np.inf], np.maximum.accumulate(up)[:-1]])
        n, same_n = ends - i, upto[ends] - upto[i]
        ok = np.flatnonzero(higher & (n >= least) & (same_n >= IDENTITY * n))
        if len(ok) and up[ok[-1]] - score[i] > top:
            top, found = up[ok[-1]] - score[i], (int(i), int(n[ok[-1]]), int(same_n[ok[-1]]))
    return found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        cols = [batch.column(c).to_pylist() for c in ("doc_id", "text_key", "start", "item", "item_id", "n_words", "shifts")]
        words, items = batch.column("region"), batch.column("words")
        for k, (doc, key, start, item, item_id, n, shifts) in enumerate(zip(*cols)):
            d, w = words[k].values.to_numpy(zero_copy_only=False), items[k].values.to_numpy(zero_copy_only=False)
            best, least = (0, 0, 0, 0), max(1, min(LEAST_WORDS, n))
            for s in shifts:                       # word j of the item lies on word j + s of the region
                lo, hi = max(0, -s), min(len(w), len(d) - s)
                at, length, matches = passing_stretch(w[lo:hi] == d[lo + s:hi + s], least)
                best = max(best, (matches, length, -(lo + at), start + lo + at + s))
            matches, length, item_at, doc_at = best
            if length:
                rows.append((doc, key, item, item_id, n, length, matches, -item_at, doc_at))
        got = list(zip(*rows)) if rows else [()] * 9
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, types)], names=_FOUND_NAMES)


_FOUND_NAMES = ["doc_id", "text_key", "item", "item_id", "item_words", "overlap", "matches", "item_start", "doc_start"]
_FOUND = "doc_id long, text_key binary, item long, item_id long, item_words int, overlap int, matches int, item_start int, doc_start long"


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that it holds a passage of: doc_id, text_key (the
    text's digest), item_id, item_words, overlap (words of the passage), matches,
    item_start and doc_start (places of the passage, in words)."""
    spark = docs.sparkSession
    known = written(item_seeds(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("long").alias("item_id"),
                                            text_or_empty(item_text).alias("text"))), "items")
    seed = known.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        F.col("s.seeds").alias("seed"), "item", F.col("s.places").alias("place"))
    facts = known.agg(F.coalesce(F.sum(F.size("seeds")), F.lit(0)).alias("n"), F.coalesce(F.max("n_words"), F.lit(0)).alias("reach")).first()
    n_seeds, reach = facts["n"], facts["reach"]
    short = [r["n_words"] for r in known.select("n_words").where(F.col("n_words") < min(map(len, MASKS))).distinct().collect()]   # fewer than 8
    masks = MASKS + tuple("1" * n for n in sorted(short))
    log2 = min(BITMAP_LOG2, max(20, int(256 * max(n_seeds, 1)).bit_length()))
    shared = spark.sparkContext.broadcast(bitmap(seed, log2))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, number = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                h = tokens(t)
                hits = [(s[k], k) for s in (seeds(h, m) for m in masks) for k in [in_bitmap(bits, log2, s)] if len(k)]
                if not hits:
                    continue
                s, at = np.concatenate([x for x, _ in hits]), np.concatenate([k for _, k in hits])
                order = np.argsort(at, kind="stable")
                s, at = s[order].view(np.int64), at[order]
                key = hashlib.md5(t.encode("utf-8", "surrogatepass")).digest()
                for lo, hi, part in _regions(h, at, reach + 16):
                    rows.append((number, d, key, lo, h[lo:hi].view(np.int64), s[part], (at[part] - lo).astype(np.int32)))
                    number += 1
            got = list(zip(*rows)) if rows else [()] * 7
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, types)],
                                             names=["number", "doc_id", "text_key", "start", "region", "seeds", "places"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    found = written(rows.mapInArrow(scan, "number long, doc_id long, text_key binary, start long, region array<long>, seeds array<long>, places array<int>"), "regions")
    hit = found.select("number", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "number", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    small = F.broadcast if n_seeds <= BROADCAST_SEEDS else (lambda df: df)
    shift = (hit.join(small(seed), "seed").select("number", "item", (F.col("at") - F.col("place")).alias("shift"))
             .groupBy("number", "item").agg(F.collect_set("shift").alias("shifts")))
    pairs = (shift.join(found.select("number", "doc_id", "text_key", "start", "region"), "number")
             .join(known.select("item", "item_id", "words", "n_words"), "item"))
    best = pairs.mapInArrow(_verify, _FOUND)
    rest = ["item_id", "item_words", "overlap", "matches", "item_start", "doc_start"]
    order = F.struct("matches", "overlap", (-F.col("doc_start")).alias("early"), *rest[:1], *rest[1:2], "item_start", "doc_start")
    return (best.groupBy("doc_id", "text_key", "item").agg(F.max(order).alias("b"))
            .select("doc_id", "text_key", *[F.col(f"b.{c}").alias(c) for c in rest]))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a passage of an item, with all their columns."""
    # written first, so that its size is known when the join is planned
    out = written(leaks(docs, items, doc_id, text).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")).distinct(), "leaks")
    key = F.unhex(F.md5(F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")))
    return docs.join(out, docs[doc_id].cast("long").eqNullSafe(out["__d"]) & (key == out["__k"]), "left_anti")
