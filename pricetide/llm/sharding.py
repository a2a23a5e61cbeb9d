"""Operator 3: reproducible shuffle and sharding by a Feistel permutation (native).

Rows get global numbers 0 .. N-1: the rank of the row's bucket (a hash of all its keys)
plus its rank within the bucket.  A generalised Feistel network over Z_a x Z_b, with
a = ceil(sqrt N) and b = ceil(N / a), permutes 0 .. a*b-1, and cycle walking (apply it
again while the result is N or more) makes that a permutation of 0 .. N-1.  At most
a*b - N < a numbers lie outside, so a walk ends after at most that many steps and the
walks of all rows together take fewer than N.  Shard = p mod shards, slot = p div shards:
row counts differ by one at most, slots have no gaps, and both follow from the row
number alone.

Only Spark expressions run here.  Rows that agree in all keys are interchangeable: they
are counted before the shuffle and numbered as a block, so no repeated row makes a hot
task.  Nulls: a null text has size 1 and the crc32 of the empty text; null ids hash like
any other value.  An empty table gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import text_or_empty

BUCKETS = 4096
ROUNDS = 6
BLOCK = 1 << 16


def row_numbers(rows: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``keys`` and ``row_no``, the global number of each row (0 .. N-1)."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: the window runs over at most ``buckets`` rows, as does the broadcast
    base = (rows.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
            .select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")))
    within = Window.partitionBy("__bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    distinct = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    placed = (distinct.withColumn("__bucket", bucket)
              .withColumn("__in", F.coalesce(F.sum("__n").over(within), F.lit(0)))
              .join(F.broadcast(base), "__bucket"))
    blocks = placed.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / BLOCK))))
    last = F.least(F.col("__n"), (F.col("__block") + 1) * BLOCK) - 1
    return (blocks.withColumn("__k", F.explode(F.sequence(F.col("__block") * BLOCK, last)))
            .select(*keys, (F.col("__base") + F.col("__in") + F.col("__k")).alias("row_no")))


def _div(x: Column, k: int) -> Column:
    """x div k in whole numbers, also beyond 2^53."""
    return F.call_function("div", x, F.lit(k).cast("long"))


def feistel(x: Column, a: int, b: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the network: a permutation of 0 .. a*b-1.  The halves are x div b
    (below a) and x mod b; odd rounds change one by a hash of the other, even rounds
    the other way round."""
    right = F.pmod(x, F.lit(b))
    left = _div(x, b)
    for k in range(rounds):
        key = F.lit(seed * 1000 + k).cast("long")
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(key, right), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(key, left), F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def permuted(x: Column, n: int, seed: int) -> Column:
    """The place of row number ``x`` in a shuffle of 0 .. n-1."""
    a = max(1, math.isqrt(n - 1) + 1)
    b = -(-n // a)
    n_col, outside = F.lit(n).cast("long"), a * b - n
    p = feistel(x, a, b, seed)
    if not outside:
        return p
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(outside)), p,
                       lambda acc, _: F.when(acc < n_col, acc).otherwise(feistel(acc, a, b, seed)))
    return F.when(p < n_col, p).otherwise(walk)


def shard_rows(rows: DataFrame, keys: list[str], shards: int, seed: int = 17) -> DataFrame:
    """``keys``, row_no, shard and slot of each row."""
    n = rows.count()
    if n == 0:
        return rows.select(*keys, F.lit(0).cast("long").alias("row_no"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    place = row_numbers(rows, keys).withColumn("__p", permuted(F.col("row_no"), n, seed))
    return place.select(*keys, "row_no", F.pmod("__p", F.lit(shards)).cast("int").alias("shard"),
                        _div(F.col("__p"), shards).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 17, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_no: one row per document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
                       F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"))
    return (shard_rows(rows, ["doc_id", "size", "text_crc32"], shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "row_no"))
