"""Operator 11: near-duplicates by SimHash and Golay-code fuzzy hashing.

A text's fingerprint has bit i where over half of its shingles' hashes have it (three
words in lower-case letters A-Z, repeats included, XXH64 with seed 42).  Fingerprints that
differ in at most 3 of 64 bits are linked; a document's component_id is the smallest id
that links reach.

The fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a word of 23
bits.  The binary Golay code [23, 12, 7] is perfect: every word lies within 3 bits of one
codeword, its centre.  A word has one or six codewords within 4 bits, and two words
that differ in one bit always have the centre of one among those of the other.  Three
errors over three segments (pigeonhole) leave two cases:

* no segment has more than one error: key = three codewords, the first segment's centre and
  all codewords near the other two on one side, and the other way round on the other;
* one segment has two or more: of the other two, one has no error and one has one at
  most: key = the segment without errors as it is and a codeword of the other, the
  centre on one side and all near codewords on the other (6 ordered pairs of segments).

Keys select 33 to 36 bits, so unrelated fingerprints hardly ever meet.  Equal fingerprints
are one row from the start.  Rows are dealt by key and sorted; runs of equal keys are
compared (each pair by its whole fingerprint) and a run gives the edges of a spanning
forest of its links, never all pairs.  A run of more than RUN rows is not held: its rows are
written, and settled exactly in another way:

* two fingerprints within 2 bits share a neighbour (or one is the other's), so each gives
  its 65 fingerprints within one bit as keys; all that meet there are linked, in a star;
* what is left are links of 3 bits between components.  A run of one component needs
  nothing more; else the rows outside its largest component (a stated query set) are
  compared with all rows of the run, in tiles of bounded size, which give pairs of
  components.

Nulls and texts without words have fingerprint zero, and are linked like any other.
Repeated rows are documents of their own.  Null ids get a component_id as well, but are
none (a component without any id has a null one).  An empty table gives no rows.  Extra
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import written
from pricetide.llm.components import components

WORDS, SEED, DISTANCE = 3, 42, 3
SEGMENTS = ((0, 22), (22, 21), (43, 21))         # lowest bit and bits of each segment
RUN = 512                                        # rows of a key that are compared at once
TILE = 2048                                      # rows on either side of a tile of a longer run
PAIRS = 1 << 21                                  # pairs held at once
BOTH, STORED, ASKS = 0, 1, 2                     # a row's side: pairs are BOTH with any, STORED with ASKS


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes) -> int:
    """The 64 bits of a text as an unsigned number."""
    words = text.lower().split()                 # bytes: A-Z only, white space is 09-0D and 20
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - WORDS + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter([hashed(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 4096):                 # whole texts, in blocks of bounded size
        bits = np.unpackbits(h[lo:lo + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    plain = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), plain.alias("text")).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- Golay code

# Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the code.
GENERATOR = 0b101011100011


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial: the syndrome."""
    out = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        out ^= np.where((out >> bit) & 1, GENERATOR << (bit - 11), 0)
    return out


@lru_cache(maxsize=1)
def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the 2048 syndromes: the error of at most 3 bits, the up to 5 errors of 4
    bits, and how many errors of at most 4 bits there are (1 or 6)."""
    one = np.int64(1) << np.arange(23, dtype=np.int64)
    centre, others, n = np.full(2048, -1, np.int64), np.zeros((2048, 5), np.int64), np.zeros(2048, np.int64)
    errors = np.zeros(1, np.int64)
    for weight in range(5):
        syndrome = _remainder(errors)
        if weight < 4:
            centre[syndrome] = errors
            n[syndrome] = 1
        else:
            # words with an error of weight 3 as centre have 5 more codewords at 4 bits
            order = np.argsort(syndrome, kind="stable")
            kinds, start, count = np.unique(syndrome[order], return_index=True, return_counts=True)
            for j in range(5):
                some = count > j
                others[kinds[some], j] = errors[order][start[some] + j]
            n[kinds] += count
        more = (errors[:, None] | one[None, :])[(errors[:, None] & one[None, :]) == 0]
        errors = np.unique(more)
    return centre, others, n


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index (12 bits) of the centre of each word, of its up to five further codewords
    within 4 bits, and a mask of those that there are."""
    centre, others, n = code_tables()
    s = _remainder(words)
    return (words ^ centre[s]) >> 11, (words[:, None] ^ others[s]) >> 11, np.arange(5)[None, :] < (n[s] - 1)[:, None]


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [((u >> np.uint64(lo)) & np.uint64((1 << bits) - 1)).astype(np.int64) for lo, bits in SEGMENTS]


def keys(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(key, place in ``fp``, side) of all keys of all fingerprints."""
    seg = _segments(fp)
    near = [codewords(s) for s in seg]
    everyone = np.arange(len(fp))
    family = 0
    for x in range(3):                                    # segment x without errors, a codeword of y
        for y in range(3):
            if x == y:
                continue
            family += 1
            head = (np.int64(family) << 60) | (seg[x] << 12)
            centre, others, there = near[y]
            yield head | centre, everyone, BOTH
            at, j = np.nonzero(there)
            yield head[at] | others[at, j], at, ASKS
    (a, more_a, has_a), (b, more_b, has_b), (c, more_c, has_c) = near
    yield (a << 24) | (b << 12) | c, everyone, BOTH
    at, j = np.nonzero(has_a)
    yield (more_a[at, j] << 24) | (b[at] << 12) | c[at], at, STORED
    at, j = np.nonzero(has_b)
    yield (a[at] << 24) | (more_b[at, j] << 12) | c[at], at, ASKS
    at, j = np.nonzero(has_c)
    yield (a[at] << 24) | (b[at] << 12) | more_c[at, j], at, ASKS
    at, j, k = np.nonzero(has_b[:, :, None] & has_c[:, None, :])
    yield (a[at] << 24) | (more_b[at, j] << 12) | more_c[at, k], at, ASKS


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for key, at, side in keys(fp):
            yield pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "side": pa.array(np.full(len(key), side, np.int8)),
                                              "fp": pa.array(fp[at], pa.int64())})


# ---------------------------------------------------------------- runs of equal keys

def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place of each place's component under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, was, label)                  # the former smallest follows its members
        label = label[label]
        if (label == was).all():
            break
    return label


def _run_links(side: np.ndarray, fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, smallest place of its component) within runs, for all that are linked."""
    a_all, b_all = [], []
    cut = np.searchsorted(np.cumsum(sizes * sizes), np.arange(PAIRS, int((sizes * sizes).sum()) + PAIRS, PAIRS), side="left") + 1
    for lo, hi in zip([0, *cut.tolist()], cut.tolist()):
        s, n = starts[lo:hi], sizes[lo:hi]
        if not len(s):
            continue
        # each row of a run with all later rows of it
        first = np.repeat(s, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        after = np.repeat(s + n, n) - first - 1
        a = np.repeat(first, after)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
        sa, sb = side[a], side[b]
        ok = (sa == BOTH) | (sb == BOTH) | (sa != sb)
        a, b = a[ok], b[ok]
        ok = _differ(fp[a], fp[b]) <= DISTANCE
        a_all.append(a[ok])
        b_all.append(b[ok])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_all, b_all))
    label = _forest(len(fp), a, b)
    at = np.flatnonzero(label != np.arange(len(fp)))
    return at, label[at]


def _compare(run: int):
    """Rows come sorted by key.  Gives links (key null: a and b) and the rows of runs longer
    than ``run`` (key, fingerprint in a)."""

    def batch_of(key, a, b) -> pa.RecordBatch:
        n = len(a)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([none if key is None else pa.array(key), pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64())],
                                          names=["key", "a", "b"])

    def settle(key, side, fp) -> Iterator[pa.RecordBatch]:
        """Whole runs."""
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1]) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(key)))
        for i in np.flatnonzero(sizes > run).tolist():
            at = slice(starts[i], starts[i] + sizes[i])
            yield batch_of(key[at], fp[at], None)
        some = (sizes > 1) & (sizes <= run)
        at, root = _run_links(side, fp, starts[some], sizes[some])
        if len(at):
            yield batch_of(None, fp[at], fp[root])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None                                # rows of the last key so far, at most ``run``
        long_key = None                            # a key known to have more
        for batch in batches:
            key, side, fp = (batch.column(c).to_numpy() for c in ("key", "side", "fp"))
            if rest is not None:
                key, side, fp = (np.concatenate(p) for p in zip(rest, (key, side, fp)))
            if not len(key):
                continue
            if long_key is not None:
                same = int(np.searchsorted(key, long_key, side="right"))
                if same:
                    yield batch_of(key[:same], fp[:same], None)
                key, side, fp = key[same:], side[same:], fp[same:]
                rest = None
                if not len(key):
                    continue
                long_key = None
            last = int(np.searchsorted(key, key[-1], side="left"))
            yield from settle(key[:last], side[:last], fp[:last])
            rest = (key[last:], side[last:], fp[last:])
            if len(rest[0]) > run:
                yield batch_of(rest[0], rest[2], None)
                long_key, rest = int(rest[0][0]), None
        if rest is not None and len(rest[0]):
            yield from settle(*rest)

    return go


# ---------------------------------------------------------------- runs too long to hold

def _crossed(tile: pa.Table) -> pa.Table:
    """Pairs of components that some pair of the tile's rows links."""
    side, fp, label = (tile.column(c).to_numpy() for c in ("side", "fp", "label"))
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    found = set()
    for i in x.tolist():
        at = y[(_differ(fp[y], fp[i]) <= DISTANCE) & (label[y] != label[i])]
        found.update((int(label[i]), v) for v in np.unique(label[at]).tolist())
    a, b = zip(*sorted(found)) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _long_runs(long: DataFrame, links: DataFrame) -> DataFrame:
    """Links (a, b) that join the rows of long runs (key, fp), given all links of short ones."""
    rows = long.select("fp").distinct()
    bits = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
    ball = F.array(*[F.col("fp").bitwiseXOR(F.lit(b).cast("long")) for b in bits.tolist()])
    met = rows.select("fp", F.explode(ball).alias("at"))
    hub = met.groupBy("at").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = written(met.join(hub, "at").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct(), "near_links")
    links = links.unionByName(near)
    label = components(links)
    placed = long.join(label, long["fp"] == label["member"], "left").select("key", "fp", F.coalesce("label", "fp").alias("label"))
    placed = written(placed.distinct(), "long_runs")
    shares = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (shares.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("size"))
             .select("key", F.col("m.label").alias("main"), "size", (F.col("size") - F.col("m.n")).alias("n_out")).where("n_out > 0"))
    inside = placed.join(mixed, "key")
    tiles = lambda n: F.ceil(F.col(n) / TILE).cast("int")
    part = lambda n, salt: F.pmod(F.xxhash64("fp", F.lit(salt)), tiles(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), tiles(n) - 1))
    asks = inside.where("label <> main").select("key", F.lit(0).alias("side"), "fp", "label", part("n_out", 1).alias("i"), each("size").alias("j"))
    every = inside.select("key", F.lit(1).alias("side"), "fp", "label", each("n_out").alias("i"), part("size", 2).alias("j"))
    crossed = asks.unionByName(every).groupBy("key", "i", "j").applyInArrow(_crossed, "a long, b long")
    return links.unionByName(written(crossed.distinct(), "crossed_links"))


# ---------------------------------------------------------------- documents

def linked(prints: DataFrame, run: int = RUN) -> DataFrame:
    """member and label of all fingerprints (column fp, distinct) that have a link."""
    rows = (prints.select("fp").mapInArrow(_keyed, "key long, side byte, fp long")
            .repartition("key").sortWithinPartitions("key"))
    found = written(rows.mapInArrow(_compare(run), "key long, a long, b long"), "fingerprint_links")
    links = written(found.where("key IS NULL").select("a", "b").distinct(), "links")
    long = found.where("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    if not long.isEmpty():
        links = _long_runs(long, links)
    return components(links)


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document."""
    signed = written(fingerprints(docs, doc_id, text), "fingerprints")
    prints = written(signed.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "prints")
    label = linked(prints, run)
    named = prints.join(label, F.col("fp") == F.col("member"), "left").select("fp", "doc_id", F.coalesce("label", "fp").alias("label"))
    named = written(named, "labelled")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_print = named.join(least, "label").select(F.col("fp").alias("of"), "component_id")
    return (signed.join(by_print, F.col("fp") == F.col("of"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
