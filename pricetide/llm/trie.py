"""Operator 13: the trie of conversation prefixes, with subtree totals by tree contraction.

1. Turns become fixed-size rows (two 64-bit digests of role and text, code points) before
   any shuffle.  Repeated rows are counted.  A range partitioning by (conversation, turn)
   and running counts per partition number the turns, so a conversation of any length is
   spread over tasks.
2. Every conversation c takes the first h = crc32(c) % 6 turns of conversation c - c % 100
   (at most five rows of it) and goes on with its own turns after its first h.
3. The path of a prefix is the exclusive-or of two 64-bit hashes of (depth, turn) over its
   turns: running sums by segments of SEGMENT turns, so again no conversation is one task.
   Equal (depth, path) is one node; 128 bits tell different prefixes apart.
4. Nodes are joined to their parents; sums over subtrees come from ``contraction``.
5. The ids of the conversations that end at a node are put together in blocks of ID_BLOCK
   ids, in parallel; SHA-256 then reads the blocks of a node one after the other (it can't
   be computed otherwise) and holds none of them.

Order of turns: by turn, null first; rows of one turn by the digests of role and text.  Rows
without conv_id belong to no conversation and take no part.  Null roles and texts count as empty.
A conversation may become empty: it is a member of the root.  An empty table gives no rows.
Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import crc32_mod, text_or_empty, written
from pricetide.llm.contraction import subtree_sums

MOST_SHARED, CENTURY = 6, 100        # h is below MOST_SHARED
SEGMENT = 1024
ID_BLOCK = 1024
COPY_BLOCK = 1 << 16
NODE = ["depth", "path1", "path2"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos from 1, e1, e2, n_chars) and conversations (conv, n_turns)."""
    said, who = text_or_empty(text), text_or_empty(role)
    rows = (conversations.where(F.col(conv_id).isNotNull())
            .select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                    F.xxhash64(who, said).alias("e1"), F.xxhash64(F.lit(1), said, who).alias("e2"), F.length(said).cast("long").alias("n_chars"))
            .groupBy("conv", "turn", "e1", "e2", "n_chars").agg(F.count(F.lit(1)).alias("copies")))
    order = [F.asc_nulls_first("turn"), F.asc("e1"), F.asc("e2")]
    placed = written(rows.repartitionByRange(F.asc("conv"), *order).withColumn("part", F.spark_partition_id()), "turns")
    sizes = placed.groupBy("conv", "part").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = (placed.withColumn("upto", F.sum("copies").over(upto)).join(starts, ["conv", "part"])
             .withColumn("first", F.col("before") + F.col("upto") - F.col("copies")))
    blocks = first.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPY_BLOCK))))
    last = F.least(F.col("copies"), (F.col("block") + 1) * COPY_BLOCK)
    pos = F.explode(F.sequence(F.col("block") * COPY_BLOCK + 1, last))
    turns = blocks.select("conv", "first", "e1", "e2", "n_chars", pos.alias("k")).select(
        "conv", (F.col("first") + F.col("k")).alias("pos"), "e1", "e2", "n_chars")
    return turns, sizes.groupBy("conv").agg(F.sum("n").alias("n_turns"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, depth, length of the whole, e1, e2, n_chars) and conversations
    (conv, h, base, shared, length)."""
    base = F.col("conv") - F.col("conv") % CENTURY
    named = convs.select("conv", "n_turns", crc32_mod("conv", MOST_SHARED).alias("h"), base.alias("base"))
    bases = convs.where(F.col("conv") % CENTURY == 0).select(F.col("conv").alias("base"), F.col("n_turns").alias("n_base"))
    shared = F.least(F.col("h").cast("long"), F.coalesce("n_base", F.lit(0)))
    convs = named.join(bases, "base", "left").select("conv", "h", "base", shared.alias("shared"), "n_turns")
    convs = written(convs.select("conv", "h", "base", "shared", (F.col("shared") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    own = (turns.join(convs, "conv").where("pos > h")
           .select("conv", (F.col("shared") + F.col("pos") - F.col("h")).alias("depth"), "length", "e1", "e2", "n_chars"))
    heads = turns.where((F.col("conv") % CENTURY == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv", "base")
    taken = convs.where("shared > 0").join(heads, "base").where("pos <= shared").select("conv", F.col("pos").alias("depth"), "length", "e1", "e2", "n_chars")
    return own.unionByName(taken), convs


def paths(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``rows`` with path1, path2 (of the prefix up to the row) and up1, up2 (without the row)."""
    g = {"1": F.xxhash64("depth", "e1", "e2"), "2": F.xxhash64(F.lit(2), "depth", "e2", "e1")}
    rows = rows.select("conv", "depth", "length", "n_chars", *[c.alias(f"g{i}") for i, c in g.items()], F.floor((F.col("depth") - 1) / segment).alias("seg"))
    upto = Window.partitionBy("conv", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy("conv", "seg").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    before = whole.select("conv", "seg", *[F.coalesce(F.bit_xor(f"s{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in g]).where("seg > 0")
    run = rows.select("*", *[F.bit_xor(f"g{i}").over(upto).alias(f"r{i}") for i in g])
    path = lambda i: F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0)))
    return run.join(before, ["conv", "seg"], "left").select(
        "conv", "depth", "length", "n_chars", *[path(i).alias(f"path{i}") for i in g], *[path(i).bitwiseXOR(F.col(f"g{i}")).alias(f"up{i}") for i in g])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come sorted by node and block."""
    last, state = None, None

    def row(node, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"depth": pa.array([node[0]], pa.int64()), "path1": pa.array([node[1]], pa.int64()),
                                           "path2": pa.array([node[2]], pa.int64()), "ends_sha256": pa.array([state.hexdigest()])})
    for batch in batches:
        done = {c: [] for c in (*NODE, "ends_sha256")}
        for *node, piece in zip(*[batch.column(c).to_pylist() for c in (*NODE, "piece")]):
            if node != last:
                if last is not None:
                    for c, v in zip(done, (*last, state.hexdigest())):
                        done[c].append(v)
                last, state = node, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "ends_sha256" else pa.int64()) for c, v in done.items()})
    if last is not None:
        yield row(last, state)


def ends(ended: DataFrame) -> DataFrame:
    """NODE and ends_sha256 of the nodes at which conversations (conv, NODE) end."""
    block = F.floor(F.col("conv") / ID_BLOCK)
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))     # ID_BLOCK ids at most
    pieces = ended.groupBy(*NODE, block.alias("block")).agg(F.array_join(ids, ",").alias("piece"))
    schema = "depth long, path1 long, path2 long, ends_sha256 string"
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "block").mapInArrow(_digests, schema)


def _zero() -> Column:
    return F.lit(0).cast("long")


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns, convs = numbered_turns(conversations)
    turns = written(turns, "numbered")
    rows, convs = rebuilt(turns, convs)
    prefixes = written(paths(rows, segment), "prefixes")
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
            .select(*[_zero().alias(c) for c in (*NODE, "up1", "up2", "n_chars")], "n_convs", "conv_id"))
    nodes = (prefixes.groupBy(*NODE).agg(F.max("up1").alias("up1"), F.max("up2").alias("up2"), F.max("n_chars").alias("n_chars"),
                                         F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"))
             .unionByName(root).withColumn("id", F.monotonically_increasing_id()))
    nodes = written(nodes, "nodes")                                       # fixes the ids
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("path1").alias("up1"), F.col("path2").alias("up2"),
                         F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tree = written(nodes.join(above, ["depth", "up1", "up2"], "left"), "tree")
    children = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = written(tree.join(children, F.col("id") == F.col("of"), "left").drop("of", "up1", "up2")
                   .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")
    sums = subtree_sums(tree.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                    ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    at_end = prefixes.where("depth = length").select("conv", *NODE).unionByName(
        convs.where("length = 0").select("conv", *[_zero().alias(c) for c in NODE]))
    return (tree.join(sums, "id").join(ends(at_end), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")))


def oracle() -> str:
    """DuckDB: crc32 bit by bit over the decimal id, prefixes as lists.  parent_conv_id is a
    DOUBLE here, as pandas makes one of Spark's nullable long when results are compared."""
    return """
WITH turns AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce("text", '')} AS e,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (
  SELECT conv_id, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1])) AS s
  FROM (SELECT DISTINCT conv_id FROM turns)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(s, lambda v: CAST(v AS BIGINT))),
             lambda crc, v: CASE WHEN v >= 0 THEN xor(crc, v) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295) % 6 AS h
  FROM steps),
rows AS (
  SELECT c.conv_id, t.e, t.pos AS o, 0 AS part FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.e, t.pos, 1 FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
whole AS (
  SELECT c.conv_id, coalesce(list(r.e ORDER BY r.part, r.o) FILTER (r.o IS NOT NULL), []) AS seq
  FROM convs c LEFT JOIN rows r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, d, seq[1:d] AS p, len(seq) = d AS ends FROM whole, unnest(generate_series(0, len(seq))) AS g(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(p[d].text) END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d),
kids AS (
  SELECT a.p, a.d, count(b.d) AS n_children FROM nodes a LEFT JOIN nodes b ON b.d = a.d + 1 AND b.p[1:a.d] = a.p GROUP BY a.p, a.d)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, CAST(any_value(up.conv_id) AS DOUBLE) AS parent_conv_id, any_value(n.n_convs) AS n_convs,
       any_value(k.n_children) AS n_children, CAST(count(*) FILTER (bk.n_children = 0) AS BIGINT) AS n_leaves,
       CAST(sum(b.saved) AS BIGINT) AS saved_tokens, any_value(n.ends_sha256) AS ends_sha256
FROM nodes n JOIN kids k ON k.p = n.p AND k.d = n.d
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
JOIN nodes b ON b.d >= n.d AND b.p[1:n.d] = n.p
JOIN kids bk ON bk.p = b.p AND bk.d = b.d
GROUP BY n.p, n.d, n.conv_id
"""
