"""The analytic questions over the price-history star schema.

Every function takes a :class:`~pricetide.sources.adapters.Star` and returns a
lazy DataFrame.  ``as_of`` is the newest observation (a scalar sub-query), so a
look-back of ``days`` means ``scraped_at >= as_of - days``.

Plan shape: the "latest row per product" is read from the stored star, bucketed by
product (else it is a row number with a group limit, which trims every map task to one row
per product); stores and categories are joined as their measured size suggests, and
products (which grow with the data) are joined on product id with the strategy
AQE picks from measured sizes.  Top-n questions end in ``orderBy().limit()``
which plans as a distributed TakeOrderedAndProject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import iso_weekday, round2, round4, weekday_name
from pricetide.sources.adapters import Star, newest_per_group

# ----------------------------------------------------------------------------
# shared building blocks
# ----------------------------------------------------------------------------


def latest_prices(star: Star, days: int | None = None) -> DataFrame:
    """Latest observation per product (optionally among the last ``days``).  Where the star
    keeps it, it is read, not found anew: the newest row of all is the newest of a
    look-back, or the product has no row in it."""
    if star.latest is not None:
        return star.latest if days is None else star.latest.filter(F.col("scraped_at") >= star.since(days))
    ph = star.price_history if days is None else star.recent(days)
    return newest_per_group(ph, ["product_id"], ["scraped_at", "id"])


def _dims(star: Star):
    # the planner broadcasts them by their measured size: categories may grow with the data
    stores = star.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"))
    cats = star.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return stores, cats


def named_products(star: Star, category_id: int | None = None) -> DataFrame:
    """products with store and category names: product_id, product_name, brand,
    category_id, category_name, store_id, store_name."""
    stores, cats = _dims(star)
    p = star.products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                             "brand", "category_id", "store_id")
    if category_id is not None:
        p = p.filter(F.col("category_id") == F.lit(int(category_id)))
    return p.join(stores, "store_id").join(cats, "category_id")


def stddev(c: Column, kind: str = "samp") -> Column:
    """Sample (default) or population standard deviation."""
    return F.stddev_pop(c) if kind == "pop" else F.stddev_samp(c)


# ----------------------------------------------------------------------------
# A1 .. A15
# ----------------------------------------------------------------------------


def kpi_summary(star: Star) -> DataFrame:
    """A1: one row of headline numbers.  Price statistics cover all history
    rows; discount / increase counts look at each product's latest row.

    One aggregate over the history and one over the latest rows."""
    return headline(star, star.price_history.agg(
        F.count(F.lit(1)).alias("n"), F.min("price").alias("low"),
        F.max("price").alias("high"), F.max("scraped_at").alias("newest"), F.avg("price").alias("mean")))


def headline(star: Star, facts: DataFrame) -> DataFrame:
    """A1's row from the one-row ``facts`` of the history: total (sum of prices) or mean, n, low, high, newest."""
    mean = F.col("mean") if "mean" in facts.columns else F.col("total") / F.nullif(F.col("n"), F.lit(0))
    now = latest_prices(star).select(F.struct(F.count_if(F.col("price_change") < 0).alias("down"), F.count_if(F.col("price_change") > 0).alias("up"))).scalar()
    count = F.count(F.lit(1))
    zero = lambda c: F.coalesce(round2(c), F.lit(0.0))
    # dimension counts are scalar sub-queries attached to the one-row aggregate
    return facts.select(
        star.products.select(count).scalar().alias("total_products"),
        star.stores.select(count).scalar().alias("total_stores"),
        star.categories.select(count).scalar().alias("total_categories"),
        zero(mean).alias("avg_price_mxn"), zero(F.col("low")).alias("min_price_mxn"), zero(F.col("high")).alias("max_price_mxn"),
        now.getField("down").alias("products_with_discount"), now.getField("up").alias("products_price_up"),
        F.col("newest").alias("last_update"), F.coalesce("n", F.lit(0)).cast("bigint").alias("total_price_records"))


def resolve_product(star: Star, product_id: int | None = None, product_name: str | None = None) -> Column:
    """Product id wins; otherwise the lowest id whose name contains the text
    (case-insensitive).  Returned as a scalar sub-query."""
    if product_id is not None:
        return F.lit(int(product_id)).cast("bigint")
    if product_name is None:
        return F.lit(None).cast("bigint")
    pat = f"%{product_name}%"
    return star.products.filter(F.col("name").ilike(pat)).select(F.min("id")).scalar()


def price_evolution(star: Star, product_id: int | None = None, product_name: str | None = None,
                    days: int = K.DEFAULT_DAYS) -> DataFrame:
    """A2: one product's observations in the look-back, oldest first."""
    pid = resolve_product(star, product_id, product_name)
    np_ = named_products(star)
    ph = star.recent(days).filter(F.col("product_id") == pid)
    return (ph.join(np_, "product_id")
              .orderBy("scraped_at")
              .select(F.to_date("scraped_at").alias("date"), "price", "price_change", "price_change_pct",
                      "availability", "product_name", "store_name"))


def store_ranking(star: Star, category_id: int | None = None) -> DataFrame:
    """A3: stores ranked by the average latest price of their products (1 = cheapest)."""
    lp = latest_prices(star).select("product_id", "price")
    g = (lp.join(named_products(star, category_id), "product_id")
           .groupBy("store_name")
           .agg(F.avg("price").alias("raw_avg"), F.min("price").alias("mn"), F.max("price").alias("mx"),
                F.count("product_id").alias("product_count")))
    # the ranking window runs over the aggregated rows (one per store)
    w = Window.orderBy(F.col("raw_avg").asc_nulls_last(), F.col("store_name"))
    return (g.select("store_name", round2(F.col("raw_avg")).alias("avg_price"), round2(F.col("mn")).alias("min_price"),
                     round2(F.col("mx")).alias("max_price"), "product_count",
                     F.row_number().over(w).alias("rank"))
              .orderBy("rank"))


def category_volatility(star: Star, days: int = K.DEFAULT_DAYS, kind: str = "samp") -> DataFrame:
    """A4: standard deviation and mean of percent changes per category."""
    ph = star.recent(days).filter(F.col("price_change_pct").isNotNull())
    g = (ph.join(named_products(star), "product_id")
           .groupBy("category_name")
           .agg(stddev(F.col("price_change_pct"), kind).alias("sd"),
                F.avg("price_change_pct").alias("avg_pct"),
                F.count("id").alias("price_records"),
                F.countDistinct("product_id").alias("products_count")))
    return (g.orderBy(F.col("sd").desc_nulls_last(), "category_name")
             .select("category_name", round2(F.col("sd")).alias("volatility"),
                     round2(F.col("avg_pct")).alias("avg_change_pct"), "price_records", "products_count"))


def top_discounts(star: Star, n: int = 10, days: int = K.DEFAULT_DAYS, category_id: int | None = None) -> DataFrame:
    """A5: products whose latest row (inside the look-back) is a price drop,
    biggest drop first."""
    lp = latest_prices(star, days).filter(F.col("price_change_pct") < 0)
    j = lp.join(named_products(star, category_id), "product_id")
    return (j.orderBy(F.col("price_change_pct").asc(), F.col("product_id").asc())
             .limit(int(n))
             .select("product_name", "store_name", "category_name",
                     round2(F.col("price")).alias("current_price"),
                     round2(F.col("price") - F.col("price_change")).alias("previous_price"),
                     round2(F.abs(F.col("price_change"))).alias("discount_amount"),
                     round2(F.abs(F.col("price_change_pct"))).alias("discount_pct"),
                     "scraped_at"))


def best_time_to_buy(star: Star, category_id: int | None = None, days: int = K.WEEKDAY_DAYS) -> DataFrame:
    """Price statistics per ISO weekday; ``is_best`` marks the first day
    (lowest number) with the lowest rounded average."""
    ph = star.recent(days)
    p = star.products.select(F.col("id").alias("product_id"), "category_id")
    if category_id is not None:
        p = p.filter(F.col("category_id") == F.lit(int(category_id)))
    g = (ph.join(p, "product_id")
           .groupBy(iso_weekday(F.col("scraped_at")).alias("day_number"))
           .agg(round2(F.avg("price")).alias("avg_price"), round2(F.min("price")).alias("min_price"),
                round2(F.max("price")).alias("max_price"), F.count("id").alias("price_records")))
    # at most 7 rows: a global window is fine here
    best = F.min_by(F.col("day_number"), F.struct(F.col("avg_price"), F.col("day_number"))).over(Window.partitionBy())
    return (g.select(weekday_name(F.col("day_number")).alias("day_of_week"), "day_number", "avg_price",
                     "min_price", "max_price", "price_records",
                     (F.col("day_number") == best).alias("is_best"))
             .orderBy("day_number"))


def price_comparison(star: Star, product_name: str) -> DataFrame:
    """Latest price of every product whose name matches, with the gap to
    the cheapest one (ties: all cheapest rows are flagged)."""
    p = star.products.filter(F.col("name").ilike(f"%{product_name}%")) \
        .select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "store_id")
    stores = star.stores.select(F.col("id").alias("store_id"), F.col("name").alias("sname"))
    rows = (p.join(latest_prices(star), "product_id")
              .join(stores, "store_id", "left")
              .select(F.coalesce(F.col("sname"), F.lit("Unknown")).alias("store_name"), "product_name",
                      round2(F.col("price")).alias("current_price"), "availability",
                      F.col("scraped_at").alias("last_updated"), "product_id"))
    cheapest = rows.select(F.min("current_price")).scalar()   # scalar sub-query
    return (rows.withColumn("cheapest", cheapest)
                .orderBy("current_price", "product_id")
                .select("store_name", "product_name", "current_price", "availability", "last_updated",
                        round2(F.col("current_price") - F.col("cheapest")).alias("price_diff_vs_cheapest"),
                        (F.col("current_price") == F.col("cheapest")).alias("is_cheapest")))


def category_summary(star: Star) -> DataFrame:
    """Latest prices per category: count, mean, min, max, mean percent change."""
    g = (latest_prices(star).join(named_products(star), "product_id")
           .groupBy("category_name")
           .agg(F.count("product_id").alias("product_count"), round2(F.avg("price")).alias("avg_price"),
                round2(F.min("price")).alias("min_price"), round2(F.max("price")).alias("max_price"),
                round2(F.avg("price_change_pct")).alias("avg_discount_pct")))
    return g.orderBy("category_name")


def price_changes(star: Star, days: int = K.DEFAULT_DAYS, category_id: int | None = None) -> DataFrame:
    """Every percent change in the look-back with names, newest first."""
    ph = star.recent(days).filter(F.col("price_change_pct").isNotNull())
    return (ph.join(named_products(star, category_id), "product_id")
              .orderBy(F.col("scraped_at").desc(), F.col("id").desc())
              .select("product_name", "store_name", "category_name", "price_change_pct", "price", "scraped_at"))


def products_list(star: Star, category_id: int | None = None) -> DataFrame:
    """A10: products with category and store names."""
    return (named_products(star, category_id)
            .orderBy("category_name", "product_name", "product_id")
            .select(F.col("product_id").alias("id"), F.col("product_name").alias("name"), "brand",
                    "category_id", "category_name", "store_id", "store_name"))


def category_price_stats(star: Star, days: int = K.DEFAULT_DAYS) -> DataFrame:
    """Latest price in the look-back of every product, by category."""
    return (latest_prices(star, days).join(named_products(star), "product_id")
            .orderBy("category_name", "price", "product_id")
            .select("category_name", "product_name", "store_name", "price"))


def store_category_comparison(star: Star) -> DataFrame:
    """Mean latest price and product count per category x store."""
    return (latest_prices(star).join(named_products(star), "product_id")
            .groupBy("category_name", "store_name")
            .agg(round2(F.avg("price")).alias("avg_price"), F.count("product_id").alias("product_count"))
            .orderBy("category_name", "store_name"))


def store_detailed_stats(star: Star) -> DataFrame:
    """Per store: latest-price statistics, products, categories, last update."""
    g = (latest_prices(star).join(named_products(star), "product_id")
           .groupBy("store_name")
           .agg(F.avg("price").alias("raw_avg"), F.min("price").alias("mn"), F.max("price").alias("mx"),
                F.count("product_id").alias("product_count"),
                F.countDistinct("category_id").alias("category_count"),
                F.max("scraped_at").alias("last_update")))
    return (g.orderBy(F.col("raw_avg").asc_nulls_last(), "store_name")
             .select("store_name", round2(F.col("raw_avg")).alias("avg_price"), round2(F.col("mn")).alias("min_price"),
                     round2(F.col("mx")).alias("max_price"), "product_count", "category_count", "last_update"))


def most_volatile_products(star: Star, category_id: int, top_n: int = 5, days: int = K.DEFAULT_DAYS,
                           kind: str = "samp") -> DataFrame:
    """The ``top_n`` products of a category with the largest standard
    deviation of percent change in the look-back; current price is the latest
    price over all history."""
    ph = star.recent(days).filter(F.col("price_change_pct").isNotNull())
    np_ = named_products(star, category_id)
    g = (ph.join(np_, "product_id")
           .groupBy("product_id", "product_name", "store_name")
           .agg(stddev(F.col("price_change_pct"), kind).alias("sd"), F.avg("price_change_pct").alias("avg_pct"),
                F.count("id").alias("price_records")))
    cur = latest_prices(star).select("product_id", F.col("price").alias("current_price"))
    return (g.join(cur, "product_id")
             .orderBy(F.col("sd").desc_nulls_last(), F.col("product_id"))
             .limit(int(top_n))
             .select("product_id", "product_name", "store_name", round4(F.col("sd")).alias("volatility"),
                     round2(F.col("avg_pct")).alias("avg_change_pct"), "price_records",
                     round2(F.col("current_price")).alias("current_price")))


def product_detail(star: Star, product_id: int, days: int = K.DEFAULT_DAYS) -> DataFrame:
    """One product's history in the look-back, oldest first."""
    ph = star.recent(days).filter(F.col("product_id") == F.lit(int(product_id)))
    return (ph.orderBy("scraped_at")
              .select(F.col("scraped_at").alias("date"), round2(F.col("price")).alias("price"), "availability",
                      "price_change", "price_change_pct"))


def weekday_numbers(star: Star) -> DataFrame:
    """ISO weekday of every observation (Monday = 1 .. Sunday = 7), counted."""
    return (star.price_history.groupBy(iso_weekday(F.col("scraped_at")).alias("day_number"))
            .agg(F.count(F.lit(1)).alias("price_records"))
            .select("day_number", weekday_name(F.col("day_number")).alias("day_of_week"), "price_records"))
