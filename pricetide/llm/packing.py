"""Operator 10: best-fit packing by the sum-of-squares rule.

Documents become BPE ids with an end id; only those longer than a sequence are cut,
into full pieces, the first of which may be shorter.  Full pieces are sequences of
their own.  The other pieces are dealt by a hash of a stored row number into groups
of bounded size; within a group they come longest first, and each is put where the
sum of N(g)^2 over all residual gaps g becomes smallest, N(g) being the number of
open sequences with gap g.  What each group leaves half empty is dealt again: the
sequences filled below ``reopen`` are opened, and their pieces packed in one more
round over (far fewer) groups, until one group is left or nothing more is saved.

Nulls: a null text counts as empty, a null id stays null.  Empty texts give one piece
with the end id only.  Rows that repeat are pieces of their own.  An empty table gives
no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import text_or_empty, written
from pricetide.llm.tokens import (END_ID, encode_texts, ids_crc32, text_slices, tokenizer_path)

CAPACITY = 2048
GROUP_PIECES = 16384           # pieces that are packed by one call
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with ``n`` ids."""
    head = n % capacity if n > capacity else n
    spans = [(0, head)] if head else []
    return spans + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document."""
    path = tokenizer or tokenizer_path()

    def cut(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, off = encode_texts(part.column("text"), path, end_id)
                rows = [(d, k, s, n, ids_crc32(ids[o + s:o + s + n]))
                        for d, o, e in zip(part.column("doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist())
                        for k, (s, n) in enumerate(cut_points(e - o, capacity))]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(cut, PIECES)

SEQ_BITS = 15                    # of a sequence's number within its group: a group has no more pieces
MOST_TASKS = 100_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, taken in the given order.

    Putting a piece of length s into a sequence with gap g changes the sum by
    2 * (N(g - s) - N(g)) + 2; with the gap filled (g = s) by 1 - 2 * N(g), with a new
    sequence by 2 * N(capacity - s) + 1.  The smallest change wins, the smaller gap on
    ties."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        gaps = np.arange(s, capacity)
        change = 2 * (count[:capacity - s] - count[s:capacity]) + 2
        if len(change):
            change[0] -= 1                                     # N(0) is not counted
            change[count[s:capacity] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            fresh = 1 + (2 * count[capacity - s] if s < capacity else 0)
            if change[best] <= fresh and change[best] < np.iinfo(np.int64).max:
                g = int(gaps[best])
                b = open_at[g].pop()
                count[g] -= 1
                seq[i], offset[i] = b, capacity - g
                if g > s:
                    open_at[g - s].append(b)
                    count[g - s] += 1
                continue
        seq[i], offset[i] = made, 0
        if s < capacity:
            open_at[capacity - s].append(made)
            count[capacity - s] += 1
        made += 1
    return seq, offset


def _pack_group(capacity: int):
    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        seq, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        fill = np.bincount(seq, rows["length"].to_numpy())
        return rows.assign(grp=key[0], seq=seq, offset=offset, fill=fill[seq].astype(np.int64))
    return pack


def _packed(rows: DataFrame, n_groups: int, capacity: int, level: int) -> DataFrame:
    schema = "uid long, length long, grp long, seq long, offset long, fill long"
    dealt = rows.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(n_groups)).alias("grp"))
    # a stated number of partitions: groups are few bytes and would else be put into one task
    return (dealt.repartition(min(n_groups, MOST_TASKS), "grp").groupBy("grp").applyInPandas(_pack_group(capacity), schema))


def pack(items: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         reopen: float = 0.995) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces (column ``length`` of 1 to
    ``capacity``); the table is written to the shared folder first."""
    if not 0 < group_pieces <= 1 << SEQ_BITS:
        raise ValueError(f"group_pieces must be from 1 to {1 << SEQ_BITS}")
    base = written(items.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    todo = base.where(F.col("length") < capacity).select(F.col("__uid").alias("uid"), "length")
    done: list[DataFrame] = []
    n, level = todo.count(), 0
    while n:
        groups = -(-n // group_pieces)
        level += 1                                              # each round deals the pieces in another way
        out = written(_packed(todo, groups, capacity, level), "packed")
        keep = out if groups == 1 else out.where(F.col("fill") >= F.lit(int(reopen * capacity)))
        done.append(keep.withColumn("level", F.lit(level)))
        if groups == 1:
            break
        todo = out.where(F.col("fill") < F.lit(int(reopen * capacity))).select("uid", "length")
        left = todo.count()
        if left > 0.9 * n:                                      # hardly anything fills up: what is open stays
            done[-1] = out.withColumn("level", F.lit(level))
            break
        n = left
    full = base.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("__uid") * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    if not done:
        return full.drop("__uid")
    places = done[0]
    for d in done[1:]:
        places = places.unionByName(d)
    places = places.select(F.col("uid").alias("__uid"), "offset", (
        ((F.col("level") * F.lit(1 << 40) + F.col("grp")) * F.lit(1 << SEQ_BITS) + F.col("seq")) * 2).alias("sequence_id"))
    return full.unionByName(base.where(F.col("length") < capacity).join(places, "__uid")).drop("__uid")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    out = pack(pieces(docs, doc_id, text, capacity, tokenizer, end_id), capacity, group_pieces)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
