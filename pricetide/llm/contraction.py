"""Subtree sums of a forest by parallel tree contraction, in DataFrame joins.

A phase first compresses, then rakes:

* compress: a node with one child is unary.  Pointer jumping doubles the way of every unary
  node down its chain, and adds up what lies on the way, until it stands at the chain's
  bottom (a leaf or a branching node); rounds grow with the logarithm of the longest chain.
  All unary nodes are contracted into the edge above the bottom.
* rake: every leaf is taken off and its sum added to its parent's.

After a compression each inner node has two children or more, so a phase takes off half of
the nodes at least, whatever the depth: phases grow with the logarithm of the nodes.  Then
the phases are undone backwards: a raked node knows its sum already, a contracted one adds
what lay on its way to the sum of its chain's bottom.  Every step is written to the shared
folder, which cuts the lineage; only emptiness tests go to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import written


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and, under their names, the sums of ``values`` (long) over the subtree of each
    node of ``nodes`` (id, parent: null for a root; values)."""
    edge = {v: f"edge_{v}" for v in values}            # what contracted nodes hand to the parent
    live = nodes.select("id", "parent", *values, *[F.lit(0).cast("long").alias(e) for e in edge.values()])
    raked, jumped = [], []
    while True:
        kids = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
            F.count(F.lit(1)).alias("kids"), F.min("id").alias("only"))
        state = written(live.join(kids, F.col("id") == F.col("of"), "left")
                        .select(*live.columns, F.coalesce("kids", F.lit(0)).alias("kids"), "only"), "tree_state")
        jump = _jumps(state, values, edge)
        jumped.append(jump)
        rest = state.where("kids <> 1")
        if jump is not None:
            heads = (state.where("kids = 1").join(jump.select("id", F.col("to").alias("bottom"), *[F.col(v).alias(f"way_{v}") for v in values]), "id")
                     .join(state.where("kids = 1").select(F.col("only").alias("id")), "id", "left_anti")
                     .select("bottom", F.col("parent").alias("above"), *[(F.col(f"way_{v}") + F.col(e)).alias(f"way_{v}") for v, e in edge.items()]))
            lifted = F.col("bottom").isNotNull()
            rest = rest.join(heads, F.col("id") == F.col("bottom"), "left").select(
                "id", F.when(lifted, F.col("above")).otherwise(F.col("parent")).alias("parent"), *values,
                *[F.when(lifted, F.col(f"way_{v}")).otherwise(F.col(e)).alias(e) for v, e in edge.items()], "kids")
            rest = written(rest, "tree_compressed")
        leaves = rest.where("kids = 0")
        raked.append(leaves.select("id", *values))
        given = (leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of"))
                 .agg(*[F.sum(F.col(v) + F.col(e)).alias(f"given_{v}") for v, e in edge.items()]))
        live = rest.where("kids > 0").join(given, F.col("id") == F.col("of"), "left").select(
            "id", "parent", *[(F.col(v) + F.coalesce(f"given_{v}", F.lit(0))).alias(v) for v in values], *edge.values())
        live = written(live, "tree_raked")
        if live.isEmpty():
            break
    known: list[DataFrame] = []
    for leaves, jump in zip(reversed(raked), reversed(jumped)):
        known.append(leaves)
        if jump is not None:
            sums = reduce(DataFrame.unionByName, known).select(F.col("id").alias("bottom"), *[F.col(v).alias(f"sum_{v}") for v in values])
            known.append(written(jump.join(sums, F.col("to") == F.col("bottom"))
                                 .select("id", *[(F.col(v) + F.col(f"sum_{v}")).alias(v) for v in values]), "tree_expanded"))
    return reduce(DataFrame.unionByName, known)


def _jumps(state: DataFrame, values: list[str], edge: dict[str, str]) -> DataFrame | None:
    """id, to (the chain's bottom) and the sums on the way there, for all unary nodes."""
    child = state.select(F.col("id").alias("to"), (F.col("kids") == 1).alias("on"), *[F.col(e).alias(f"below_{v}") for v, e in edge.items()])
    way = (state.where("kids = 1").select("id", F.col("only").alias("to"), *values).join(child, "to")
           .select("id", "to", "on", *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values]))
    way = written(way, "tree_ways")
    if way.isEmpty():
        return None
    there, going = [way.where("NOT on")], way.where("on")
    while not going.isEmpty():
        all_ = reduce(DataFrame.unionByName, [*there, going])
        next_ = all_.select(F.col("id").alias("to"), F.col("to").alias("further"), F.col("on").alias("still"), *[F.col(v).alias(f"more_{v}") for v in values])
        step = written(going.join(next_, "to").select("id", F.col("further").alias("to"), F.col("still").alias("on"),
                                                      *[(F.col(v) + F.col(f"more_{v}")).alias(v) for v in values]), "tree_ways")
        there.append(step.where("NOT on"))
        going = step.where("on")
    return reduce(DataFrame.unionByName, there).drop("on")
