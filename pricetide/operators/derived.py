"""Derived metrics computed on top of the analytic questions.

These are the numbers a report page derives from a question's result
(roll-ups, shares, gaps, trimmed distributions, box statistics, facets, cards,
formatting).  Every one is a DataFrame transformation: no driver loop, no
collect.  Windows without a partition only run over already-aggregated rows
(one row per store / category / weekday / histogram bin).

Exact percentiles are found by counting: equal values are counted first, the distinct values
are dealt to slices whose bounds come from a sample of them, the slices' counts locate each
rank, and only the slices that hold one are ordered.  No task holds all values of a group,
however they are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions import round2
from pricetide.session import checkpoint_dir, written


def _all() -> Window:
    """The whole (already aggregated, small) result as one window."""
    return Window.partitionBy()


def ranged(counted: DataFrame, keys: list[str], slices: int | None = None) -> DataFrame:
    """``counted`` (keys, v) in slices of about equal size, numbered in the order of (keys, v) in
    the column part.  Spark takes the slices' bounds from a sample of the rows, so they
    follow the data: an outlier moves no bound.  Written, as the numbers must not change."""
    by = counted.repartitionByRange(slices, *keys, "v") if slices else counted.repartitionByRange(*keys, "v")
    return written(by.withColumn("part", F.spark_partition_id()), "slices")


def percentiles(values: DataFrame, col: str, ps: list[float], groups: list[str] | None = None,
                slices: int | None = None) -> DataFrame:
    """``groups`` and ``q``, the exact percentiles ``ps`` of ``col`` (linear between the two
    ranks around a position, NULLs left out); one row per group, or one without groups.
    ``slices`` (default: the session's shuffle partitions) bounds a task's share of the
    distinct values to about twice 1 / slices."""
    keys = groups or ["__all"]
    base = values if groups else values.withColumn("__all", F.lit(0))
    counted = base.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = ranged(counted, keys, slices)
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "part").agg(F.sum("n").alias("m"))             # a row per slice (and group)
    sizes = sizes.select(*keys, "part", "m", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"), F.sum("m").over(Window.partitionBy(*keys)).alias("total"))
    ranks = (sizes.select("*", F.posexplode(F.array(*[F.lit(float(p)) * (F.col("total") - 1) for p in ps])).alias("i", "at"))
             .select(*keys, "part", "m", "before", "i", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")))
    wanted = ranks.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("m"))).drop("m")
    inner = placed.join(wanted.select(*keys, "part", "before").distinct(), [*keys, "part"])
    within = Window.partitionBy(*keys, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("first", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))).drop("before")
    hit = (wanted.drop("before").join(inner, [*keys, "part"])
           .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    at = F.first("at")
    one = F.when(F.floor(at) == F.ceil(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)
    q = hit.groupBy(*keys, "i").agg(one.alias("value"))
    out = q.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda s: s["value"]).alias("q"))   # a few per group
    return out if groups else out.drop("__all")


def held(changes: DataFrame) -> DataFrame:
    """The percent changes alone, written to the shared folder: read several times below."""
    checkpoint_dir(changes.sparkSession)
    return changes.select("price_change_pct").checkpoint()


def discount_rollup(top: DataFrame) -> DataFrame:
    """Largest and mean discount percent, total discount amount."""
    return top.agg(round2(F.max("discount_pct")).alias("max_discount_pct"),
                   round2(F.avg("discount_pct")).alias("mean_discount_pct"),
                   round2(F.sum("discount_amount")).alias("total_discount_amount"))


def market_share(ranking: DataFrame) -> DataFrame:
    """Share of products per store (percent of all ranked products)."""
    return ranking.select("store_name", "product_count",
                          round2(F.col("product_count") / F.sum("product_count").over(_all()) * F.lit(100.0))
                          .alias("share_pct"))


def coverage_kpis(ranking: DataFrame) -> DataFrame:
    """D3: total products, store count, mean of the store averages, store
    with most products (ties: better rank)."""
    return ranking.agg(F.sum("product_count").alias("total_products"),
                       F.count(F.lit(1)).alias("total_stores"),
                       round2(F.avg("avg_price")).alias("mean_store_avg_price"),
                       F.max_by("store_name", F.struct(F.col("product_count"), -F.col("rank"))).alias("top_store"),
                       F.max("product_count").alias("top_store_products"))


def price_gap(ranking: DataFrame) -> DataFrame:
    """Cheapest vs dearest store by average latest price, the gap and the
    gap as percent of the dearest (cheapest = lowest average)."""
    g = ranking.agg(F.min_by("store_name", F.struct("avg_price", "store_name")).alias("cheapest_store"),
                    F.min("avg_price").alias("cheapest_avg_price"),
                    F.max_by("store_name", F.struct("avg_price", F.col("store_name"))).alias("dearest_store"),
                    F.max("avg_price").alias("dearest_avg_price"))
    gap = F.col("dearest_avg_price") - F.col("cheapest_avg_price")
    return g.select("*", round2(gap).alias("price_gap"),
                    round2(gap / F.nullif(F.col("dearest_avg_price"), F.lit(0.0)) * F.lit(100.0)).alias("gap_pct"))


def cheapest_store_per_category(comparison: DataFrame) -> DataFrame:
    """Per category the store with the lowest average price."""
    best = F.min_by(F.struct("store_name", "avg_price", "product_count"), F.struct("avg_price", "store_name"))
    return comparison.groupBy("category_name").agg(best.alias("b")).select("category_name", "b.*")


def series_stats(series: DataFrame) -> DataFrame:
    """Min, max, range and mean of a price series."""
    return series.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"),
                      round2(F.max("price") - F.min("price")).alias("price_range"),
                      round2(F.avg("price")).alias("mean_price"))


def trimmed_changes(changes: DataFrame, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Percent changes between the ``lo`` and ``hi`` percentiles
    (inclusive), split into decreases (< 0) and increases (>= 0)."""
    q = percentiles(changes, "price_change_pct", [lo, hi]).scalar()   # scalar sub-query
    return (changes
            .filter((F.col("price_change_pct") >= q[0]) & (F.col("price_change_pct") <= q[1]))
            .select("price_change_pct",
                    F.when(F.col("price_change_pct") < 0, "decrease").otherwise("increase").alias("direction")))


def histogram(values: DataFrame, col: str, n_bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max (the max falls in the last bin)."""
    mm = values.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    lo, hi = mm.getField("lo"), mm.getField("hi")
    w = (hi - lo) / F.lit(float(n_bins))
    b = F.least(F.floor((F.col(col) - lo) / F.nullif(w, F.lit(0.0))), F.lit(n_bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    return (values.withColumn("bin", b)
            .groupBy("bin").agg(F.count(F.lit(1)).alias("count"),
                                F.min(col).alias("min_value"), F.max(col).alias("max_value")))


def change_summary(changes: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Mean and median percent change (all rows) and the share of
    trimmed decreases among all changes."""
    median = percentiles(changes, "price_change_pct", [0.5]).scalar()
    a = changes.agg(round2(F.avg("price_change_pct")).alias("mean_pct"), F.count(F.lit(1)).alias("n_changes"))
    a = a.select("mean_pct", round2(median[0]).alias("median_pct"), "n_changes")
    t = trimmed.select(F.count_if(F.col("direction") == "decrease")).scalar()
    return a.withColumn("n_decreases", t).withColumn(
        "decrease_share_pct", round2(F.col("n_decreases") / F.nullif(F.col("n_changes"), F.lit(0)) * F.lit(100.0)))


def box_stats(prices: DataFrame, group: str = "category_name") -> DataFrame:
    """Quartiles, mean and standard deviation per group, ordered by median."""
    g = prices.groupBy(group).agg(round2(F.avg("price")).alias("mean_price"),
                                  round2(F.stddev_samp("price")).alias("stddev_price"),
                                  F.count(F.lit(1)).alias("n"))
    g = g.join(percentiles(prices, "price", [0.25, 0.5, 0.75], [group]), group)
    return (g.select(group, round2(F.col("q")[0]).alias("q1"), round2(F.col("q")[1]).alias("median"),
                     round2(F.col("q")[2]).alias("q3"), "mean_price", "stddev_price", "n")
             .orderBy("median", group))


def facets(products: DataFrame) -> DataFrame:
    """Sorted distinct categories, brands (non-empty) and stores, one row each."""
    cats = products.select(F.lit("category").alias("facet"), F.col("category_name").alias("value"))
    brands = products.filter(F.col("brand").isNotNull() & (F.col("brand") != "")) \
                     .select(F.lit("brand").alias("facet"), F.col("brand").alias("value"))
    stores = products.select(F.lit("store").alias("facet"), F.col("store_name").alias("value"))
    return cats.unionByName(brands).unionByName(stores).distinct().orderBy("facet", "value")


def price_bounds(prices: DataFrame, categories: DataFrame, default_lo: float = 0.0,
                 default_hi: float = 50000.0) -> DataFrame:
    """Min and max price per category; categories without prices get
    the default bounds."""
    b = prices.groupBy("category_name").agg(F.min("price").alias("mn"), F.max("price").alias("mx"))
    return (categories.select(F.col("name").alias("category_name")).join(b, "category_name", "left")
            .select("category_name", F.coalesce("mn", F.lit(default_lo)).alias("min_price"),
                    F.coalesce("mx", F.lit(default_hi)).alias("max_price")))


def lowest_price_by_name(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Per product name the lowest latest price over stores, attached to
    every product of that name (left join: products without a price keep NULL)."""
    best = prices.groupBy("product_name").agg(F.min("price").alias("current_price"))
    return products.join(best, "product_name", "left")


def faceted_filter(rows: DataFrame, brand: str | None = None, store: str | None = None,
                   price_min: float | None = None, price_max: float | None = None) -> DataFrame:
    """Optional brand / store equality and inclusive price range (rows
    without a price fall out once a range is given)."""
    out = rows
    if brand is not None:
        out = out.filter(F.col("brand") == brand)
    if store is not None:
        out = out.filter(F.col("store_name") == store)
    if price_min is not None or price_max is not None:
        lo = float("-inf") if price_min is None else float(price_min)
        hi = float("inf") if price_max is None else float(price_max)
        out = out.filter(F.col("current_price").between(lo, hi))
    return out


def category_header(summary: DataFrame, named_products: DataFrame) -> DataFrame:
    """Category KPIs: products, number of stores, mean, range, mean change."""
    stores = named_products.groupBy("category_name").agg(F.countDistinct("store_id").alias("store_count"))
    return summary.join(stores, "category_name", "left").select(
        "category_name", "product_count", "store_count", "avg_price", "min_price", "max_price", "avg_discount_pct")


def product_cards(history: DataFrame) -> DataFrame:
    """Per product: last price, min, max, last percent change."""
    last = F.max_by(F.struct("price", "price_change_pct"), F.struct("scraped_at", "id"))
    return (history.groupBy("product_id")
            .agg(last.alias("l"), F.min("price").alias("min_price"), F.max("price").alias("max_price"))
            .select("product_id", F.col("l.price").alias("current_price"), "min_price", "max_price",
                    F.col("l.price_change_pct").alias("last_change_pct")))


def recent_rows(history: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest rows of every product (top-n per key; plans as a
    WindowGroupLimit that trims each partition before the shuffle)."""
    w = Window.partitionBy("product_id").orderBy(F.col("scraped_at").desc(), F.col("id").desc())
    return history.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def weekday_saving(best_time: DataFrame) -> DataFrame:
    """(worst - best) / worst * 100 with worst = highest average day."""
    g = best_time.agg(F.max_by("day_of_week", F.struct(F.col("avg_price"), -F.col("day_number"))).alias("worst_day"),
                      F.max("avg_price").alias("worst_avg"),
                      F.min_by("day_of_week", F.struct("avg_price", "day_number")).alias("best_day"),
                      F.min("avg_price").alias("best_avg"))
    return g.withColumn("saving_pct", F.when(F.col("worst_avg") > 0, round2(
        (F.col("worst_avg") - F.col("best_avg")) / F.col("worst_avg") * F.lit(100.0))).otherwise(F.lit(0.0)))


def money(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def signed_pct(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%+.2f%%", c))


def short_name(c: Column, n: int = 40) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def yes_no(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("N/A")).when(c, F.lit("yes")).otherwise(F.lit("no"))


def format_report(rows: DataFrame) -> DataFrame:
    """Display strings: money, signed percent, dd/MM/yyyy, cut names."""
    return rows.select(short_name(F.col("product_name")).alias("product"), F.col("store_name"),
                       money(F.col("current_price")).alias("price"),
                       signed_pct(-F.col("discount_pct")).alias("change"),
                       F.date_format("scraped_at", "dd/MM/yyyy").alias("date"))


def with_ordinal(rows: DataFrame, order: list[Column], name: str = "n") -> DataFrame:
    """1..n ordinal over an already aggregated (small) result."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)))
