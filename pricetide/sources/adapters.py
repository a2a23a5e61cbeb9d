"""Adapters from the driver's tables to the price-history star schema.

The star schema (stores, categories, products, price_history) is what every
analytic question reads.  Two deterministic mappings are provided:

* ``events_star`` (E): product = (user_id, event_type); category = event type;
  store = user_id % 3 + 1; price = value; scraped_at = ts.
* ``retail_star`` (R): store = region of the supplier; product = (part, region);
  category = p_type; brand = p_brand; price = extendedprice / quantity;
  scraped_at = l_shipdate.

Both keep one observation per product per UTC day (the latest one of the
day) and compute the change against the previous kept observation, which is
what the daily idempotent load produces.

Scale notes: the day-dedup of a lazy star is a row number with a group limit (every
map task keeps one row per product and day before the shuffle, so a product holding a
third of the rows sends a handful).  The change column is a ``lag`` window partitioned by
product over the *deduplicated* rows, at most one row per product per day, so
a window partition never exceeds the number of days in the history.  Stored stars do both
behind one shuffle by product (``daily_rows``) and take the group limit for products of
very many rows only: it sorts every map task's rows, which few products need.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import price_change, price_change_pct, round2
from pricetide.sources.tables import read_table

# FIXED VALUES: adapter E maps event types to category ids in this order.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


ROW_GROUP = 20_000               # rows of a row group of the stored history: a product's rows are few
SLOTS, HEAVY = 1 << 16, 1_000_000  # products are counted by a hash; in slots of more rows than HEAVY days are thinned first


@dataclass
class Observations:
    """What a history is made from: ``rows`` (product_id, price, scraped_at, payload), the
    columns ``order`` that rank a product's rows, and ``shape``, which makes history rows of
    kept rows with their change columns."""

    rows: DataFrame
    order: list[str]
    shape: Callable[[DataFrame, list[str]], DataFrame]

    def history(self) -> DataFrame:
        return self.shape(with_daily_changes(self.rows, self.order), [])


@dataclass
class Star:
    """Lazy DataFrames of the star schema plus the reference clock ``as_of``."""

    stores: DataFrame
    categories: DataFrame
    products: DataFrame
    price_history: DataFrame
    monthly: DataFrame | None = None  # the stored history with its partition column ``month``
    latest: DataFrame | None = None  # the newest row of each product, where it is stored
    clock: DataFrame | None = None   # raw observation times (scraped_at) the history is built from
    source: Observations | None = None

    @property
    def as_of(self) -> Column:
        """Newest observation time as a scalar sub-query (never the wall clock).

        The daily de-duplication keeps the newest row of every day, so the
        newest raw observation is also the newest history row: reading it from
        ``clock`` scans one column instead of rebuilding the history."""
        src = self.clock if self.clock is not None else self.price_history
        return src.select(F.max("scraped_at")).scalar()

    def since(self, days: int) -> Column:
        return self.as_of - F.make_interval(days=F.lit(int(days)))

    def recent(self, days: int) -> DataFrame:
        """The history of the last ``days``.  The stored history is partitioned by month
        (column ``month``), so that the look-back reaches the scan."""
        start, ph = self.since(days), self.price_history
        if self.monthly is not None:
            ph = self.monthly.filter(F.col("month") >= _month(start)).drop("month")
        return ph.filter(F.col("scraped_at") >= start)

    def register(self, prefix: str) -> None:
        for name in ("stores", "categories", "products", "price_history"):
            getattr(self, name).createOrReplaceTempView(prefix + name)


def _month(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed and sorted by a column: joins and
    groupings on it need no shuffle of this side."""
    import uuid

    from pricetide.session import bucket_count, scratch_path
    spark = df.sparkSession
    table = f"pricetide_{name}_{uuid.uuid4().hex}"
    n = bucket_count(spark)
    (df.repartition(n, by).write.bucketBy(n, by).sortBy(by)
     .option("path", scratch_path(spark, table)).saveAsTable(table))
    return spark.table(table)


def _stored(spark: SparkSession, star: Star) -> Star:
    """The star as questions read it, written once to the shared folder: the history, change
    columns and all, by month; the products and their newest rows, bucketed by product.

    Within a month rows are sorted by product, with a bloom filter on it, so that the
    look-up of one product reads the row groups that may hold it and no others.  The
    clock is the stored history's newest time."""
    import uuid

    from pricetide.session import scratch_path, written
    path = scratch_path(spark, f"history-{uuid.uuid4().hex}")
    # few columns are shuffled and sorted; the others are made of them behind it
    rows = daily_rows(star.source.rows, star.source.order).withColumn("month", _month(F.col("scraped_at")))
    rows = rows.hint("rebalance", F.col("month")).sortWithinPartitions("month", "product_id", "scraped_at")
    rows = star.source.shape(_changes(rows.withColumn("obs_date", F.to_date("scraped_at")), F.col("previous")), ["newest", "month"])
    (rows.write.option("parquet.bloom.filter.enabled#product_id", "true").option("parquet.bloom.filter.expected.ndv#product_id", ROW_GROUP)
         .option("parquet.block.row.count.limit", ROW_GROUP).partitionBy("month").parquet(path))
    back = spark.read.schema(rows.schema).parquet(path)
    newest, back = back.where("newest").drop("newest", "month"), back.drop("newest")
    history, latest = back.drop("month"), bucketed(newest, "latest", "product_id")
    # small tables of known size: the planner broadcasts them while they are small
    return Star(written(star.stores, "stores"), written(star.categories, "categories"), bucketed(star.products, "products", "id"), history, back, latest)


def stores_dim(spark: SparkSession) -> DataFrame:
    """The three stores: a fixed 3-row dimension (``load.fill_defaults`` gives created_at, V7)."""
    return spark.createDataFrame([(int(i), n, c, None) for i, n, c, *_ in K.STORES],
                                 "id bigint, name string, country string, created_at timestamp_ntz")


def categories_dim(spark: SparkSession) -> DataFrame:
    """Fixed product categories with their inclusive valid price range."""
    return spark.createDataFrame([(int(i), n, lo, hi) for i, n, lo, hi in K.CATEGORIES],
                                 "id bigint, name string, min_price double, max_price double")


def newest_per_group(df: DataFrame, keys: list, order_cols: list[str]) -> DataFrame:
    """The newest row per group (``order_cols`` descending, unique per group).

    ``row_number() = 1`` plans as a WindowGroupLimit: every map task keeps only
    its newest row per group *before* the shuffle, so a group holding a third
    of all rows sends a handful of rows, not a third of the data."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def with_daily_changes(obs: DataFrame, order_cols: list[str]) -> DataFrame:
    """Keep the latest observation per (product_id, UTC day) and attach the
    change against the previous kept day.

    ``obs`` has product_id, price, scraped_at plus payload columns; ``order_cols``
    break ties inside a day (newest wins)."""
    day = newest_per_group(obs.withColumn("obs_date", F.to_date("scraped_at")), ["product_id", "obs_date"],
                           order_cols)
    w = Window.partitionBy("product_id").orderBy("scraped_at")
    return _changes(day, F.lag("price").over(w))


def _changes(day: DataFrame, previous: Column) -> DataFrame:
    return (day.withColumn("price_change", price_change(F.col("price"), previous))
               .withColumn("price_change_pct", price_change_pct(F.col("price"), previous)))


def daily_rows(obs: DataFrame, order_cols: list[str], heavy: int = HEAVY) -> DataFrame:
    """The rows that ``with_daily_changes`` keeps, with ``previous`` (the price of the kept day
    before) and ``newest`` (the product's last row), behind one shuffle by product.

    Rows are counted by a hash of the product first (no row is shuffled for it).  Products
    that share a slot of more than ``heavy`` rows are thinned to one row per day by a group
    limit, map-side, so that no window partition holds more than that or a row per day."""
    slot = F.pmod(F.hash("product_id"), F.lit(SLOTS))
    counted = obs.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    over = [r["slot"] for r in counted.where(F.col("n") > int(heavy)).collect()]      # SLOTS numbers at most
    day = F.to_date("scraped_at")
    if over:
        thinned = newest_per_group(obs.where(slot.isin(over)).withColumn("__day", day), ["product_id", "__day"], order_cols)
        obs = obs.where(~slot.isin(over)).unionByName(thinned.drop("__day"))
    w = Window.partitionBy("product_id").orderBy(*order_cols)
    rows = obs.withColumn("newest", F.lead(F.lit(1)).over(w).isNull()).withColumn("__next", F.lead(day).over(w))
    kept = rows.where(F.col("newest") | ~day.eqNullSafe(F.col("__next"))).drop("__next")
    return kept.withColumn("previous", F.lag("price").over(w))


def _event_type_no(c: Column) -> Column:
    m = F.create_map(*[x for i, t in enumerate(EVENT_TYPES, 1) for x in (F.lit(t), F.lit(i))])
    return F.coalesce(F.element_at(m, c), F.lit(0)).cast("bigint")


def event_observations(events: DataFrame) -> DataFrame:
    """Events as product observations: event_id, ts, user_id, event_type, value,
    category_id, product_id, name, store_id."""
    cat = _event_type_no(F.col("event_type"))
    return events.select("event_id", "ts", "user_id", "event_type", "value", cat.alias("category_id"),
                         (F.col("user_id") * 10 + cat).alias("product_id"),
                         F.concat(F.col("event_type"), F.lit(" #"), F.col("user_id").cast("string")).alias("name"),
                         (F.col("user_id") % 3 + 1).alias("store_id"))


def last_day_cut(events: DataFrame) -> Column:
    """The UTC day of the newest event (scalar sub-query): the 'incoming' batch
    of the split-in-two load scenarios."""
    return events.select(F.to_date(F.max("ts"))).scalar()


_STARS: dict = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build):
    """What is stored once per session and folder: the stars' history, and the state that the
    load starts from.  Files that arrive later are not in it (``forget`` has it built anew)."""
    key = (kind, id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _STARS:
        _STARS[key] = build()
    return _STARS[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Drops what is kept for a folder, its file listings too: the next question stores the
    stars anew from the files that are there then."""
    from pricetide.sources import tables
    app = (id(spark), spark.sparkContext.applicationId)
    for key in [k for k in _STARS if k[1:] == (*app, sf_dir)]:
        del _STARS[key]
    for key in [k for k in tables._SCANS if k[:2] == app and k[2].startswith(sf_dir)]:
        del tables._SCANS[key]


def events_star(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> Star:
    """Star schema of adapter E; ``events`` overrides the table (e.g. a time slice)."""
    if events is None:
        return _memo("e", spark, sf_dir, lambda: _stored(spark, _events_star(spark, sf_dir, read_table(spark, sf_dir, "events"))))
    return _events_star(spark, sf_dir, events)


def _events_star(spark: SparkSession, sf_dir: str, src: DataFrame) -> Star:
    ev = event_observations(src)

    categories = spark.createDataFrame([(i, t) for i, t in enumerate(EVENT_TYPES, 1)],
                                       "id bigint, name string")
    products = (ev.groupBy("product_id", "user_id", "event_type", "category_id")
                  .agg(F.min("ts").alias("created_at"))
                  .select(F.col("product_id").alias("id"),
                          F.concat(F.col("event_type"), F.lit(" #"), F.col("user_id").cast("string")).alias("name"),
                          F.concat(F.lit("brand "), (F.col("user_id") % 4).cast("string")).alias("brand"),
                          F.concat(F.lit("/item/"), F.col("product_id").cast("string")).alias("url"),
                          F.concat(F.lit("EV-"), F.col("product_id").cast("string")).alias("sku"),
                          "category_id",
                          (F.col("user_id") % 3 + 1).alias("store_id"),
                          "created_at"))
    obs = ev.select("product_id", F.col("event_id").alias("id"), F.col("value").alias("price"),
                    (F.col("event_type") != "error").alias("availability"),
                    F.col("ts").alias("scraped_at"))

    def shape(rows: DataFrame, more: list[str]) -> DataFrame:
        return rows.select("id", "product_id", "price", F.lit(K.BASE_CURRENCY).alias("currency"), "availability", "price_change",
                           "price_change_pct", "scraped_at", "obs_date", *more)
    source = Observations(obs, ["scraped_at", "id"], shape)
    return Star(stores_dim(spark), categories, products, source.history(), clock=obs.select("scraped_at"), source=source)


def retail_star(spark: SparkSession, sf_dir: str) -> Star:
    return _memo("r", spark, sf_dir, lambda: _stored(spark, _retail_star(spark, sf_dir)))


def _retail_star(spark: SparkSession, sf_dir: str) -> Star:
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")

    # lineitem joins supplier first: the planner can only broadcast a side it
    # estimates small (supplier, never the fact table); at scale supplier grows
    # and AQE picks the strategy from measured sizes.  nation (25 rows) and
    # region (5 rows) are fixed-size by the TPC-H spec: broadcasting them is bounded.
    obs_full = (li.join(supplier, li.l_suppkey == supplier.s_suppkey)
                  .join(F.broadcast(nation), F.col("s_nationkey") == nation.n_nationkey)
                  .withColumn("store_id", F.col("n_regionkey").cast("bigint"))
                  .withColumn("product_id", F.col("l_partkey") * 10 + F.col("store_id")))

    stores = region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"),
                           F.col("r_name").alias("country"))
    categories = (part.select(F.col("p_type").alias("name")).distinct()
                      .select((F.row_number().over(Window.orderBy("name"))).cast("bigint").alias("id"), "name"))
    pairs = obs_full.groupBy("product_id", "l_partkey", "store_id").agg(F.min("l_shipdate").alias("created_at"))
    products = (pairs.join(part, pairs.l_partkey == part.p_partkey)
                     .join(categories.withColumnRenamed("id", "category_id").withColumnRenamed("name", "p_type"),
                           "p_type")
                     .select(F.col("product_id").alias("id"),
                             F.concat_ws(" ", F.col("p_name"), F.concat(F.lit("#"), F.col("p_partkey").cast("string"))).alias("name"),
                             F.col("p_brand").alias("brand"),
                             F.concat(F.lit("/item/"), F.col("product_id").cast("string")).alias("url"),
                             F.concat(F.lit("R-"), F.col("product_id").cast("string")).alias("sku"),
                             "category_id", "store_id", "created_at"))
    obs = obs_full.select(
        "product_id", "l_orderkey", "l_linenumber",
        F.col("l_shipdate").alias("scraped_at"),
        round2(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("price"))

    def shape(rows: DataFrame, more: list[str]) -> DataFrame:
        # one row per product and day is left, so the two make the history's key
        day = F.datediff("obs_date", F.lit("1970-01-01").cast("date"))
        return rows.select((F.col("product_id") * 100_000 + day).alias("id"), "product_id", "price", F.lit(K.BASE_CURRENCY).alias("currency"),
                           F.lit(True).alias("availability"), "price_change", "price_change_pct", "scraped_at", "obs_date", *more)
    source = Observations(obs, ["scraped_at", "l_orderkey", "l_linenumber"], shape)
    return Star(stores, categories, products, source.history(), clock=obs.select("scraped_at"), source=source)


ADAPTERS = {"e": events_star, "r": retail_star}


@dataclass
class Batch:
    """A stored state and an incoming, already-cleaned batch (one row per
    (name, store_id)), for the load scenarios."""

    stored: Star
    incoming: DataFrame
    run_time: Column


def split_incoming(ev: DataFrame, cut: Column) -> DataFrame:
    """The incoming observations of the split scenarios: those from the cut on, and for
    some users the day before (rows that are stored already: no-ops); some users' products
    come under a new name (inserts)."""
    hit = (F.col("ts") >= cut) | ((F.col("ts") >= cut - F.make_interval(hours=F.lit(24))) & (F.col("user_id") % 5 == 1))
    return event_observations(ev.filter(hit)).withColumn(
        "name", F.concat("name", F.when(F.col("user_id") % 7 == 0, " new").otherwise("")))


def events_split(spark: SparkSession, sf_dir: str, hours: int = 12) -> Batch:
    """Stored state = events older than ``max(ts) - hours``; incoming batch =
    the newer events, reduced to one row per (name, store_id) with the
    cleaning rule (newest first, then lowest price).  Brand spelling of the
    batch differs for some users so product updates occur."""
    ev = read_table(spark, sf_dir, "events")
    cut = ev.select(F.max("ts") - F.make_interval(hours=F.lit(int(hours)))).scalar()
    stored = events_star(spark, sf_dir, ev.filter(F.col("ts") < cut))
    obs = split_incoming(ev, cut)
    row = F.struct(F.col("category_id"), F.concat(F.lit("brand "), (F.col("user_id") % 5).cast("string")).alias("brand"),
                   F.concat(F.lit("/item/"), F.col("product_id").cast("string")).alias("url"),
                   F.concat(F.lit("EV-"), F.col("product_id").cast("string")).alias("sku"),
                   F.col("value").alias("price"), F.lit(K.BASE_CURRENCY).alias("currency"),
                   (F.col("event_type") != "error").alias("availability"), F.col("ts").alias("scraped_at"))
    incoming = (obs.groupBy("name", "store_id")
                   .agg(F.max_by(row, F.struct(F.col("ts"), -F.col("value"), F.col("event_id"))).alias("r"))
                   .select("name", "store_id", "r.*"))
    run_time = ev.select(F.max("ts")).scalar()
    return Batch(stored, incoming, run_time)
