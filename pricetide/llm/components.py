"""Connected components of a table of links, by DataFrame joins.

Every node points at the smallest node it knows of; a round takes the smallest pointer
among the neighbours and then follows pointers once (pointer jumping), so the rounds
grow with the logarithm of the longest path.  Each round is written to the shared
folder, which cuts the lineage; only a count goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """member, label (the smallest member of its component) for all nodes of ``links`` (a, b)."""
    both = written(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                   .unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).where("u <> v").distinct(), "arcs")
    label = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).select(F.col("u").alias("member"), "label"), "labels")
    while True:
        near = (both.join(label, both["v"] == label["member"]).groupBy("u").agg(F.min("label").alias("near")))
        lower = label.join(near, label["member"] == near["u"]).select("member", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        # the component's smallest node may know of a smaller one by now
        point = label.select(F.col("member").alias("to"), F.col("label").alias("further"))
        step = written(lower.join(point, "to").select("member", F.least("to", "further").alias("label"), "was"), "labels")
        if step.where("label <> was").isEmpty():
            return step.select("member", "label")
        label = step.select("member", "label")
