"""Load (L1-L11) and integrity checks (V1-V7) on plain Parquet tables.

The merge logic works on frames: ``current state + incoming batch -> what changes + action
column``; ``operators.state`` stores its results by version.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import price_change, price_change_pct
from pricetide.session import checkpoint_dir

PRODUCT_COLS = ["id", "name", "brand", "url", "sku", "category_id", "store_id", "created_at"]
PRICE_COLS = ["id", "product_id", "price", "currency", "availability", "price_change", "price_change_pct",
              "scraped_at", "obs_date"]

# ----------------------------------------------------------------------------
# L4: surrogate keys without a single-partition window
# ----------------------------------------------------------------------------


def assign_ids(df: DataFrame, order_cols: list[str], start: Column | int, out: str = "id",
               partitions: int | None = None) -> DataFrame:
    """Dense ids ``start + 1, start + 2, ...`` in ``order_cols`` order.

    Equivalent to ``start + row_number() over (order by order_cols)`` but
    distributed: rows are range-partitioned and sorted, each partition counts
    its rows, a running sum over the per-partition counts (one row per
    partition) gives each partition's offset.  The numbered rows are
    checkpointed to the shared checkpoint folder so a lost executor cannot
    renumber them.  ``order_cols`` must be unique."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    s = (ranged.sortWithinPartitions(*order_cols)
           .withColumn("__pid", F.spark_partition_id())
           .withColumn("__mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__base"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("__off", F.sum("__n").over(w) - F.col("__n"))   # rows = partitions
    start_c = start if isinstance(start, Column) else F.lit(int(start))
    return (s.join(F.broadcast(offsets), "__pid")
             .withColumn(out, (start_c + F.col("__off") + (F.col("__mid") - F.col("__base")) + 1).cast("bigint"))
             .drop("__pid", "__mid", "__n", "__base", "__off"))


# ----------------------------------------------------------------------------
# L1: product upsert
# ----------------------------------------------------------------------------


@dataclass
class Upserted:
    table: DataFrame        # next state
    actions: DataFrame      # one row per incoming key with its action


def merge_products(current: DataFrame, incoming: DataFrame, created_at: Column, max_id: Column | int,
                   extra: list[str] = ()) -> DataFrame:
    """L1 (+L4): one row per key of ``incoming`` as it is stored next, with ``action`` (update
    or insert), ``changed`` (some column differs) and the columns ``extra`` of ``current``.

    Key (name, store_id): existing keys get brand, url, sku and category_id from the batch
    (id and created_at kept); new keys get the next ids (ordered by name, store_id).  The
    stored side is only looked up: where it is bucketed by the key it is not shuffled."""
    key, facts = ["name", "store_id"], ["brand", "url", "sku", "category_id"]
    inc = incoming.select(*key, *facts)
    cur = current.select(*key, "id", "created_at", *[F.col(c).alias("__old_" + c) for c in facts], *extra)
    checkpoint_dir(inc.sparkSession)
    both = inc.join(cur, key, "left").checkpoint()        # looked up once for both parts
    differs = F.lit(False)
    for c in facts:
        differs = differs | ~F.col(c).eqNullSafe(F.col("__old_" + c))
    known = both.where("id IS NOT NULL").select("id", *key, *facts, "created_at", F.lit("update").alias("action"), differs.alias("changed"), *extra)
    new = assign_ids(both.where("id IS NULL").select(*key, *facts, *extra), key, max_id)
    new = new.withColumn("created_at", created_at).withColumn("action", F.lit("insert")).withColumn("changed", F.lit(True))
    return known.unionByName(new.select(*known.columns))


def upsert_products(current: DataFrame, incoming: DataFrame, created_at: Column) -> Upserted:
    """L1 (+L4) on whole frames: all products after the batch (see ``merge_products``).
    ``incoming`` must hold one row per key (the cleaning chain guarantees it)."""
    key = ["name", "store_id"]
    max_id = current.select(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    merged = merge_products(current, incoming, created_at, max_id)
    kept = current.select(*PRODUCT_COLS).join(incoming.select(*key), key, "left_anti")
    return Upserted(kept.select(*PRODUCT_COLS).unionByName(merged.select(*PRODUCT_COLS)), merged.select("id", *key, "action"))


# ----------------------------------------------------------------------------
# L2 + L3: one observation per product per day
# ----------------------------------------------------------------------------

ACTION_COLS = ["product_id", "obs_date", "price", "previous_price", "price_change", "price_change_pct", "action"]


def price_actions(stored: DataFrame, incoming: DataFrame, latest: DataFrame, key: list[str] = ("product_id",)) -> DataFrame:
    """What happens to each row of ``incoming``: ACTION_COLS, its other columns, and the stored
    row of its day (__id, __old_price, __old_ts).

    ``stored`` needs to hold the history of the batch's days only; ``latest`` (product_id,
    scraped_at, price) is the newest stored row of each product (or, with ``key``, of each
    product and day of the batch)."""
    inc = incoming.withColumn("obs_date", F.to_date("scraped_at"))
    latest = latest.select(*key, F.col("scraped_at").alias("__stored_ts"), F.col("price").alias("__stored"))
    in_order = Window.partitionBy("product_id").orderBy("obs_date")
    inc = inc.withColumn("__before", F.lag(F.struct("scraped_at", "price")).over(in_order))
    same_day = stored.select("product_id", "obs_date", F.col("id").alias("__id"),
                             F.col("price").alias("__old_price"), F.col("scraped_at").alias("__old_ts"))
    newer = F.col("__before").isNotNull() & (F.col("__stored_ts").isNull() | (F.col("__before.scraped_at") >= F.col("__stored_ts")))
    return (inc.join(latest, list(key), "left")
            .withColumn("previous_price", F.when(newer, F.col("__before.price")).otherwise(F.col("__stored")))
            .join(same_day, ["product_id", "obs_date"], "left")
            .withColumn("price_change", price_change(F.col("price"), F.col("previous_price")))
            .withColumn("price_change_pct", price_change_pct(F.col("price"), F.col("previous_price")))
            .withColumn("action", F.when(F.col("__id").isNull(), "insert")
                                   .when(F.col("__old_price") != F.col("price"), "update")
                                   .otherwise("noop"))
            .drop("__before", "__stored", "__stored_ts"))


def updated_prices(stored: DataFrame, actions: DataFrame) -> DataFrame:
    """``stored`` with the updates among ``actions``: price, currency, availability, change and
    pct are replaced, scraped_at and id kept."""
    cols = ["price", "currency", "availability", "price_change", "price_change_pct"]
    upd = actions.filter(F.col("action") == "update").select("product_id", "obs_date", *[F.col(c).alias("__u_" + c) for c in cols])
    hit = F.col("__u_price").isNotNull()
    return stored.join(upd, ["product_id", "obs_date"], "left").select(
        "id", "product_id", *[F.when(hit, F.col("__u_" + c)).otherwise(F.col(c)).alias(c) for c in cols], "scraped_at", "obs_date")


def new_prices(actions: DataFrame, max_id: Column | int) -> DataFrame:
    """The inserts among ``actions`` with the next ids."""
    ins = actions.filter(F.col("action") == "insert").select(*[c for c in PRICE_COLS if c != "id"])
    return assign_ids(ins, ["product_id", "obs_date"], max_id).select(*PRICE_COLS)


def load_prices(history: DataFrame, incoming: DataFrame, previous_day: bool = False) -> Upserted:
    """L2 + L3 on whole frames (``operators.state`` does the same by days).  ``incoming``:
    product_id, price, currency, availability, scraped_at (one row per product and day; days
    are loaded in order).

    L3: change against the latest stored row before the write, rows of the batch's
    earlier days among them (with ``previous_day=True`` only rows of earlier days count),
    so the result does not depend on how days are cut into batches.
    L2: (product_id, day) absent -> insert; present with a different price ->
    update price, currency, availability, change, pct and keep scraped_at and
    id; same price -> no change."""
    key, ref = ["product_id"], history
    if previous_day:
        key = ["product_id", "obs_date"]
        inc = incoming.select("product_id", F.to_date("scraped_at").alias("obs_date"))
        ref = (history.withColumnRenamed("obs_date", "__day").join(inc, "product_id")
               .filter(F.col("__day") < F.col("obs_date")))
    latest = (ref.groupBy(*key).agg(F.max(F.struct("scraped_at", "id", "price")).alias("__l"))
                 .select(*key, F.col("__l.scraped_at").alias("scraped_at"), F.col("__l.price").alias("price")))
    actions = price_actions(history, incoming, latest, key)
    max_id = history.select(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    table = updated_prices(history, actions).unionByName(new_prices(actions, max_id))
    return Upserted(table.select(*PRICE_COLS), actions.select(*ACTION_COLS))


# ----------------------------------------------------------------------------
# L5 .. L10
# ----------------------------------------------------------------------------


def insert_absent(dim: DataFrame, names: DataFrame, key: str = "name") -> DataFrame:
    """Add the names not yet in ``dim`` with the next ids (insert-or-ignore)."""
    new = names.select(key).distinct().join(dim.select(key), key, "left_anti")
    max_id = dim.select(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    added = assign_ids(new, [key], max_id)
    return dim.select("id", key).unionByName(added.select("id", key))


def load_counters(price_actions: DataFrame, found: DataFrame | int, clean: DataFrame | int | None = None) -> DataFrame:
    """Found / clean / inserted / updated / unchanged / saved / failed (one row).
    ``found`` is what the sources delivered, ``clean`` what the cleaning kept (default: the
    same); either may be given as its number of rows.  Every loaded row counts as saved (insert, update and no-op alike); failed are
    the clean rows that were not saved.  Rejects and duplicates are no failures."""
    a = price_actions.agg(F.count_if(F.col("action") == "insert").alias("inserted"),
                          F.count_if(F.col("action") == "update").alias("updated"),
                          F.count_if(F.col("action") == "noop").alias("unchanged"),
                          F.count_if(F.col("action").isin("insert", "update", "noop")).alias("products_saved"))
    size = lambda x: F.lit(x).cast("bigint") if isinstance(x, int) else x.select(F.count(F.lit(1))).scalar()
    return (a.select(size(found).alias("products_found"), size(found if clean is None else clean).alias("products_clean"), "*")
             .withColumn("products_failed", F.col("products_clean") - F.col("products_saved")))


def source_counts(batch: DataFrame, stores: DataFrame) -> DataFrame:
    """Per store: rows delivered (0 for a store that returned nothing)."""
    got = batch.groupBy("store_id").agg(F.count(F.lit(1)).alias("products"))
    return (stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"))
            .join(got, "store_id", "left").fillna(0, ["products"]))


def run_status(counters: DataFrame, per_source: DataFrame) -> DataFrame:
    """Success when something was saved and every source delivered;
    partial_success when something was saved; failure otherwise."""
    src = per_source.select(F.struct(F.count_if(F.col("products") > 0).alias("ok"),
                                     F.count(F.lit(1)).alias("total"))).scalar()
    saved = F.col("products_saved") > 0
    return (counters.select("*", src.getField("ok").alias("sources_ok"), src.getField("total").alias("sources_total"))
            .withColumn("status", F.when(saved & (F.col("sources_ok") == F.col("sources_total")), K.RUN_STATUS_SUCCESS)
                                   .when(saved, K.RUN_STATUS_PARTIAL).otherwise(K.RUN_STATUS_FAILURE)))


def run_summary(per_category: DataFrame, errors: dict[str, str] | None = None) -> DataFrame:
    """Per store: products, categories that delivered and that did not, its error (the
    text in ``errors`` by store name; else a store that delivered nothing) and one message line."""
    g = per_category.groupBy("store_name").agg(
        F.sum("products").alias("products"),
        F.count_if(F.col("products") > 0).alias("categories_ok"),
        F.count_if(F.col("products") == 0).alias("categories_fail"))
    told = F.lit(None).cast("string")
    for store, text in (errors or {}).items():
        told = F.when(F.col("store_name") == store, F.lit(text)).otherwise(told)
    g = g.withColumn("error", F.coalesce(told, F.when(F.col("products") == 0, F.lit("nothing delivered"))))
    return g.withColumn("message", F.when(told.isNotNull(), F.format_string("%s: failed (%s)", "store_name", "error"))
                        .otherwise(F.format_string("%s: %d products (%d categories ok, %d failed)",
                                                   "store_name", "products", "categories_ok", "categories_fail")))


def run_message(status: DataFrame, summary: DataFrame) -> DataFrame:
    """The run's message: status line, counts from found over clean to saved, then one
    part per store."""
    # one message per store: a bounded list
    parts = summary.select(F.array_join(F.array_sort(F.collect_list("message")), " | ")).scalar()
    return status.withColumn("stores_msg", parts).withColumn(
        "message", F.concat_ws(" | ", F.concat(F.lit("status "), F.col("status")),
                               F.format_string("%d found -> %d clean -> %d saved, %d failed", "products_found",
                                               "products_clean", "products_saved", "products_failed"),
                               F.col("stores_msg")))


def run_log_row(status_msg: DataFrame, run_id: Column, created_at: Column, elapsed_ms: Column,
                process_name: str = "price_etl") -> DataFrame:
    """The one-row run log record; the message is cut to 500 characters."""
    return status_msg.select(run_id.cast("bigint").alias("id"), F.lit(process_name).alias("process_name"),
                             "status", F.substring("message", 1, K.LOG_MESSAGE_MAX).alias("message"),
                             elapsed_ms.cast("int").alias("execution_time_ms"),
                             F.col("products_found").cast("int").alias("products_found"),
                             F.col("products_saved").cast("int").alias("products_saved"),
                             F.col("products_failed").cast("int").alias("products_failed"),
                             created_at.alias("created_at"))


def by_source(rows: DataFrame, source: str, keys: list) -> list[DataFrame]:
    """One input per source, as the runs of the sources leave them: written once,
    partitioned by source, so each is read by itself."""
    from pricetide.session import scratch_path
    import uuid
    path = scratch_path(rows.sparkSession, f"sources-{uuid.uuid4().hex}")
    rows.write.partitionBy(source).parquet(path)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return [back.filter(F.col(source) == k) for k in keys]


def consolidate(*frames: DataFrame) -> DataFrame:
    """The per-source results as one frame."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ----------------------------------------------------------------------------
# sinks (S5-S7) and versioned tables
# ----------------------------------------------------------------------------


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Create an empty table at ``path`` when absent (idempotent)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.schema(schema).parquet(path).limit(0).collect()
    except AnalysisException:
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def write_log(df: DataFrame, path: str) -> None:
    """The log rows of a run; a run that is repeated replaces its own rows."""
    (df.withColumn("run", F.col("id")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run").parquet(path))


def append_rows(df: DataFrame, path: str) -> None:
    """Append-only sink (run log)."""
    df.write.mode("append").parquet(path)


# ----------------------------------------------------------------------------
# V1 .. V7
# ----------------------------------------------------------------------------


def uniqueness(tables: dict[str, DataFrame]) -> DataFrame:
    """V1: number of duplicated keys per unique constraint."""
    checks = [("stores.name", "stores", ["name"]), ("categories.name", "categories", ["name"]),
              ("products.name_store", "products", ["name", "store_id"]),
              ("price_history.id", "price_history", ["id"]),
              ("price_history.product_scraped_at", "price_history", ["product_id", "scraped_at"])]
    out = None
    for label, t, cols in checks:
        d = (tables[t].groupBy(*cols).count().filter("count > 1")
             .agg(F.count(F.lit(1)).alias("violations")).select(F.lit(label).alias("constraint_name"), "violations"))
        out = d if out is None else out.unionByName(d)
    return out


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """V2: rows whose foreign key has no parent."""
    p, c, s, ph = tables["products"], tables["categories"], tables["stores"], tables["price_history"]
    parts = [
        ("products.category_id", p.join(c, p.category_id == c.id, "left_anti")),
        ("products.store_id", p.join(s, p.store_id == s.id, "left_anti")),
        ("price_history.product_id", ph.join(p.select(F.col("id").alias("pid")), ph.product_id == F.col("pid"),
                                             "left_anti")),
    ]
    out = None
    for label, d in parts:
        d = d.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(label).alias("constraint_name"), "violations")
        out = d if out is None else out.unionByName(d)
    return out


NOT_NULL = {"stores": ["name", "country", "created_at"], "categories": ["name"],
            "products": ["name", "category_id", "store_id", "created_at"],
            "price_history": ["product_id", "price", "currency", "availability", "scraped_at"],
            "pipeline_logs": ["process_name", "status", "created_at"]}
MAX_LEN = {"stores": {"name": 100, "country": 50}, "categories": {"name": 50},
           "products": {"name": 300, "brand": 100, "sku": 100},
           "price_history": {"currency": 10}, "pipeline_logs": {"process_name": 50, "status": 20}}


def null_counts(tables: dict[str, DataFrame], spec=NOT_NULL) -> DataFrame:
    """V3: NULLs in NOT NULL columns (one row per table.column)."""
    out = None
    for t, cols in spec.items():
        d = tables[t].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        d = d.select(F.explode(F.array(*[F.struct(F.lit(f"{t}.{c}").alias("column_name"),
                                                   F.col(c).alias("violations")) for c in cols])).alias("x")).select("x.*")
        out = d if out is None else out.unionByName(d)
    return out


def length_violations(tables: dict[str, DataFrame], spec=MAX_LEN) -> DataFrame:
    """V4: values longer than the column limit."""
    out = None
    for t, cols in spec.items():
        d = tables[t].agg(*[F.count_if(F.length(F.col(c)) > n).alias(c) for c, n in cols.items()])
        d = d.select(F.explode(F.array(*[F.struct(F.lit(f"{t}.{c}").alias("column_name"),
                                                   F.col(c).alias("violations")) for c in cols])).alias("x")).select("x.*")
        out = d if out is None else out.unionByName(d)
    return out


def delete_products(tables: dict[str, DataFrame], doomed: DataFrame) -> dict[str, DataFrame]:
    """V5: deleting products removes their price rows too (cascade)."""
    ids = doomed.select(F.col("id").alias("__del")).distinct()
    products = tables["products"].join(ids, F.col("id") == F.col("__del"), "left_anti")
    prices = tables["price_history"].join(ids, F.col("product_id") == F.col("__del"), "left_anti")
    return {**tables, "products": products, "price_history": prices}


def dims_in_use(tables: dict[str, DataFrame]) -> DataFrame:
    """V6: a category or store referenced by a product cannot be deleted."""
    p = tables["products"]
    cats = tables["categories"].select(F.lit("categories").alias("table_name"), "id", "name")
    stores = tables["stores"].select(F.lit("stores").alias("table_name"), "id", "name")
    c = cats.join(p.select(F.col("category_id").alias("id")).distinct().withColumn("in_use", F.lit(True)), "id", "left")
    s = stores.join(p.select(F.col("store_id").alias("id")).distinct().withColumn("in_use", F.lit(True)), "id", "left")
    return c.unionByName(s).withColumn("in_use", F.coalesce("in_use", F.lit(False))) \
            .withColumn("deletable", ~F.col("in_use"))


def fill_defaults(df: DataFrame, table: str, now: Column) -> DataFrame:
    """V7: column defaults for missing values."""
    defaults = {
        "stores": {"country": F.lit("México"), "created_at": now},
        "products": {"created_at": now},
        "price_history": {"currency": F.lit(K.BASE_CURRENCY), "availability": F.lit(True), "scraped_at": now},
        "pipeline_logs": {"created_at": now},
    }[table]
    out = df
    for c, v in defaults.items():
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), v))
    return out


# ----------------------------------------------------------------------------
# The scheduled batch run over stored state
# ----------------------------------------------------------------------------


LOG = ("id bigint, process_name string, status string, message string, execution_time_ms int, products_found int, "
       "products_saved int, products_failed int, created_at timestamp_ntz")


def run_etl(spark: SparkSession, raw: DataFrame, state_root: str, run_id: int,
            rate: float = K.USD_TO_MXN, process_name: str = "price_etl", source_errors: dict[str, str] | None = None) -> DataFrame:
    """Raw listings -> clean (C9) -> change within the batch (K1) -> product upsert
    (L1/L4) and daily price load (L2/L3) -> next state version, run log row (L6-L8) and run
    summary (L9).

    State lives under ``state_root`` (see :class:`pricetide.operators.state.VersionedState`);
    version 0 is created empty when absent (S5).  A run writes the next version; the newest
    run, repeated under its id, writes its own version again from the same base
    (idempotent), and repeating an older run is an error.  The same batch as a new run
    changes nothing but the version number.

    Found, clean, cleaner and calculator counters are taken by the steps that pass the rows
    (``clean_observed``); no raw row is read again to be counted.  ``source_errors`` (store name -> text) tells which
    extractions failed.  Returns the run log row, which is also written to
    ``state_root/pipeline_logs`` (S6); ``run_summaries`` reads the summaries.  Where the
    state can't be opened the row says so (failure) and nothing is written."""
    import time
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.sql import Observation
    from pricetide.operators.changes import batch_changes, change_counts
    from pricetide.operators.cleaning import METRICS, clean_observed, parse_scraped_at
    from pricetide.operators.state import VersionedState
    from pricetide.session import written
    t0 = time.time()
    elapsed = lambda: int((time.time() - t0) * 1000)
    try:
        state = VersionedState(spark, state_root)
        if state.latest_version() < 0:
            state.write(0, spark.createDataFrame([], VersionedState.PRODUCTS), spark.createDataFrame([], VersionedState.PRICES))
        version = state.place_of(run_id)
    except (Py4JJavaError, PySparkException) as e:
        text = f"status {K.RUN_STATUS_FAILURE} | state not opened: {str(e).splitlines()[0]}"[:K.LOG_MESSAGE_MAX]
        return spark.createDataFrame([(int(run_id), process_name, K.RUN_STATUS_FAILURE, text, elapsed(), 0, 0, 0, None)], LOG)
    stores, cats = [(int(i), n) for i, n, *_ in K.STORES], [int(i) for i, *_ in K.CATEGORIES]
    times = F.try_to_timestamp(F.col("scraped_at"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    cols = ["name", "store_id", "category_id", "brand", "url", "sku", "price", "currency", "availability", "scraped_at"]
    cleaned, n = clean_observed(raw, rate, cols)
    run_time = F.lit(cleaned.agg(F.max(times)).first()[0]).cast("timestamp_ntz")
    seen = Observation()
    cleaned = cleaned.withColumn("scraped_at", parse_scraped_at(F.col("scraped_at"), run_time))
    changed = batch_changes(cleaned, ["name", "store_id"], ["scraped_at", "price", "url"])
    batch = written(changed.observe(seen, *change_counts()), "batch").drop("price_change", "price_change_pct")
    calculated = seen.get
    merged = state.merge(batch.select(*cols), run_time, version, run_id)
    per_source = spark.createDataFrame([(i, name, n[f"from_{i}"]) for i, name in stores], "store_id bigint, store_name string, products bigint")
    per_cat = spark.createDataFrame([(name, c, n[f"from_{i}_{c}"]) for i, name in stores for c in cats],
                                    "store_name string, category_id bigint, products bigint")
    status = run_status(load_counters(merged.prices, n["rows_input"], n["rows_output"]), per_source)
    sources = run_summary(per_cat, source_errors)
    told = run_message(status, sources).checkpoint()
    log = run_log_row(told, F.lit(int(run_id)), run_time, F.lit(elapsed()), process_name).checkpoint()
    write_log(log, os.path.join(state_root, "pipeline_logs"))
    stat = lambda names, of: F.struct(*[F.lit(of[c]).cast("bigint").alias(c) for c in names])
    one = sources.select(F.array_sort(F.collect_list(F.struct("store_name", "products", "categories_ok", "categories_fail", "error")))).scalar()
    summary = told.select(F.lit(int(run_id)).cast("bigint").alias("id"), "status", "products_found", "products_clean", "products_saved",
                          "products_failed", F.lit(elapsed()).alias("execution_time_ms"), one.alias("sources"),
                          stat(METRICS, n).alias("cleaner_stats"), stat(list(calculated), calculated).alias("calculator_stats"), "message")
    write_log(summary, os.path.join(state_root, "run_summaries"))
    return log


def run_summaries(spark: SparkSession, state_root: str) -> DataFrame:
    """The summaries of all runs: counts, sources, cleaner_stats (C10), calculator_stats (K6), message."""
    return spark.read.parquet(os.path.join(state_root, "run_summaries")).drop("run")
