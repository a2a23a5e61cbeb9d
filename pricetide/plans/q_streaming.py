"""Registered streaming queries T1-T4: each runs its stream to completion
(``availableNow``) over the driver's parquet files and returns the sink read
back as a DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import round2
from pricetide.plans.catalog import query
from pricetide.plans.q_cleaning import CAT_SQL, OK_SQL, RAW_CTE, STORE_SQL, clean_name_sql
from pricetide.plans.q_load import split_cte
from pricetide.plans.sqltext import r2
from pricetide.sources.adapters import events_split, newest_per_group, split_incoming
from pricetide.sources.raw import retail_listings
from pricetide.sources.tables import read_table, table_path
from pricetide.streaming import jobs as T


def _listing_stream(spark, d):
    """Lineitem files as a stream, joined with the static dimension tables
    (stream-static joins) into raw listing records."""
    li_stream = T.file_stream(spark, table_path(d, "lineitem"))
    # the same derivation as the batch listings, applied to the streamed lineitem
    return retail_listings(spark, d, lineitem=li_stream)


@query("t01_stream_clean_r", f"""WITH {RAW_CTE},
named AS (SELECT * REPLACE ({clean_name_sql('name')} AS name) FROM raw),
mapped AS (SELECT *, {CAT_SQL} AS category_id, {STORE_SQL} AS store_id FROM named WHERE length(name) > 0),
conv AS (SELECT * REPLACE (
           CASE WHEN upper(currency) = 'USD' THEN {r2(f'price * {K.USD_TO_MXN}')} ELSE price END AS price,
           CASE WHEN upper(currency) = 'USD' THEN '{K.BASE_CURRENCY}' ELSE currency END AS currency)
         FROM mapped WHERE category_id IS NOT NULL AND store_id IS NOT NULL AND upper(currency) IN ('USD', 'MXN'))
SELECT l_orderkey, l_linenumber, name, store_id, category_id, price, currency FROM conv WHERE {OK_SQL}""")
def t01(spark, d):
    out = T.stream_clean(spark, _listing_stream(spark, d), T.run_dir(spark, "t01"))
    return spark.read.parquet(out).select("l_orderkey", "l_linenumber", "name", "store_id", "category_id", "price",
                                          "currency")


# Arrival of events: in N_ARRIVALS batches of DAYS days each; every fourth event of a batch's
# last day one batch later (within the watermark), every 41st of the first batch's first half
# two batches later (beyond it).
N_ARRIVALS, DAYS, LATE_WATERMARK = 3, 10, "2 days"
_ARRIVAL_SQL = f"""seen AS (
  SELECT *, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS day_no FROM events),
dated AS (SELECT *, least({N_ARRIVALS - 1}, day_no // {DAYS}) AS due, event_id % 41 = 0 AND day_no < {DAYS // 2} AS late FROM seen),
arrived AS (
  SELECT * EXCLUDE (due, day_no), CAST(due + CASE WHEN late THEN 2 WHEN event_id % 4 = 0 AND day_no = due * {DAYS} + {DAYS - 1} AND due < {N_ARRIVALS - 1} THEN 1 ELSE 0 END AS INT) AS batch
  FROM dated)"""


def _arriving(spark, d):
    ev = read_table(spark, d, "events")
    first = ev.select(F.to_date(F.min("ts"))).scalar()
    id_, no = F.col("event_id"), F.col("day_no")
    ev = ev.withColumn("day_no", F.date_diff(F.to_date("ts"), first)).withColumn("due", F.least(F.lit(N_ARRIVALS - 1), F.floor(no / DAYS)))
    last_day = (id_ % 4 == 0) & (no == F.col("due") * DAYS + DAYS - 1) & (F.col("due") < N_ARRIVALS - 1)
    return ev.withColumn("batch", (F.col("due") + F.when((id_ % 41 == 0) & (no < DAYS // 2), 2).when(last_day, 1).otherwise(0)).cast("int")).drop("due", "day_no")


def _product(c):
    from pricetide.sources.adapters import _event_type_no
    return F.col("user_id") * 10 + _event_type_no(c)


@query("t02_stream_daily_keys_e", f"""WITH {_ARRIVAL_SQL},
keyed AS (SELECT *, user_id * 10 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
            WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END AS product_id, CAST(ts AS DATE) AS obs_date FROM arrived),
sent AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY product_id, obs_date, batch ORDER BY ts DESC, event_id DESC) = 1)
SELECT product_id, obs_date, event_id, value, (SELECT count(*) FROM sent WHERE late) AS late_rows FROM sent WHERE NOT late
QUALIFY row_number() OVER (PARTITION BY product_id, obs_date ORDER BY batch) = 1""")
def t02(spark, d):
    """First arrival per product and day.  Events arrive in several micro-batches, each with
    its newest row per product and day; the watermark moves, and rows that come later than it
    are dropped and counted."""
    rows = _arriving(spark, d).withColumn("product", _product(F.col("event_type"))).withColumn("day", F.to_date("ts"))
    sent = newest_per_group(rows, ["product", "day", "batch"], ["ts", "event_id"]).drop("product", "day")
    root = T.run_dir(spark, "t02")
    runs = T.arrivals(sent, "batch", N_ARRIVALS, root + "/in", lambda: T.daily_keys_and_late_rows(
        spark, T.file_stream(spark, root + "/in", T.MANY_FILES), root, LATE_WATERMARK))
    late = F.lit(sum(n for _, n in runs)).cast("bigint")
    return spark.read.parquet(runs[-1][0]).select("product_id", "obs_date", "event_id", "value", late.alias("late_rows"))


@query("t03_stream_upsert_e", f"WITH {split_cte(per_day=True, by_days=True)}\nSELECT id, product_id, price, currency, availability, "
                              "price_change, price_change_pct, scraped_at, obs_date FROM nextph")
def t03(spark, d):
    """The batch's days arrive as files of their own: a micro-batch each."""
    b = events_split(spark, d)
    root = T.run_dir(spark, "t03")
    state = T.VersionedState(spark, root)
    state.write(0, b.stored.products, b.stored.price_history)
    # incoming rows: the events newer than the cut, as cleaned records
    ev_all = read_table(spark, d, "events")
    newest = ev_all.select(F.max("ts")).scalar()
    cut = ev_all.select(F.max("ts") - F.make_interval(hours=F.lit(12))).scalar()
    obs = split_incoming(ev_all, cut)
    ago = F.date_diff(F.to_date(newest), F.to_date("ts"))              # 36 hours: three days at most
    cleaned = lambda: T.file_stream(spark, root + "/in", T.MANY_FILES).select(
        "name", "store_id", "category_id", "event_id",
        F.concat(F.lit("brand "), (F.col("user_id") % 5).cast("string")).alias("brand"),
        F.concat(F.lit("/item/"), F.col("product_id").cast("string")).alias("url"),
        F.concat(F.lit("EV-"), F.col("product_id").cast("string")).alias("sku"),
        F.col("value").alias("price"), F.lit(K.BASE_CURRENCY).alias("currency"),
        (F.col("event_type") != "error").alias("availability"), F.col("ts").alias("scraped_at"))

    # one row per product and day of the batch: the newest, then the lowest price
    T.arrivals(obs.withColumn("batch", 2 - ago), "batch", 3, root + "/in",
               lambda: T.stream_upsert(spark, cleaned(), state, root + "/_checkpoint", lambda _one: newest))
    return state.prices(state.latest_version())


_EXACT_AVG = "CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / count(value)"


def _finished_sql(window: str) -> str:
    return f"{window} <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"


@query("t04_stream_window_stats_e", f"""WITH {_ARRIVAL_SQL}
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, {r2(_EXACT_AVG)} AS avg_price,
       min(value) AS min_price, max(value) AS max_price, count(*) AS price_records,
       {r2('stddev_samp(value)')} AS volatility
FROM arrived WHERE NOT late GROUP BY 1, 2 HAVING {_finished_sql("CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY")}""")
def t04(spark, d):
    """Finished one-day windows of events that arrive in several micro-batches; late rows are dropped."""
    root = T.run_dir(spark, "t04")
    out = T.arrivals(_arriving(spark, d), "batch", N_ARRIVALS, root + "/in", lambda: T.stream_finished_windows(
        spark, T.file_stream(spark, root + "/in", T.MANY_FILES), root, LATE_WATERMARK))[-1]
    r = spark.read.parquet(out)
    return r.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type",
                    round2(F.col("avg_price")).alias("avg_price"), "min_price", "max_price", "price_records",
                    round2(F.col("volatility")).alias("volatility"))


@query("t04_stream_sliding_stats_e", f"""WITH {_ARRIVAL_SQL},
w AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, value FROM arrived WHERE NOT late
  UNION ALL
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 1 DAY, event_type, value FROM arrived WHERE NOT late)
SELECT window_start, event_type, count(*) AS price_records, max(value) AS max_price, {r2(_EXACT_AVG)} AS avg_price
FROM w WHERE {_finished_sql("window_start + INTERVAL 2 DAY")} GROUP BY 1, 2""")
def t04_sliding(spark, d):
    """Finished two-day windows sliding by one day."""
    root = T.run_dir(spark, "t04s")
    out = T.arrivals(_arriving(spark, d), "batch", N_ARRIVALS, root + "/in", lambda: T.stream_finished_windows(
        spark, T.file_stream(spark, root + "/in", T.MANY_FILES), root, LATE_WATERMARK, window="2 days", slide="1 day"))[-1]
    r = spark.read.parquet(out)
    return r.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "price_records",
                    "max_price", round2(F.col("avg_price")).alias("avg_price"))


@query("t04_stream_weekday_stats_e", f"""
SELECT CAST(isodow(ts) AS INTEGER) AS day_number, {r2('avg(value)')} AS avg_price, min(value) AS min_price,
       max(value) AS max_price, count(*) AS price_records
FROM events GROUP BY 1""")
def t04_weekday(spark, d):
    """Best-time-to-buy statistics (A6 shape) maintained by a stream."""
    out = T.complete_to_folder(T.weekday_stats(T.file_stream(spark, table_path(d, "events"))),
                               T.run_dir(spark, "t04w"))
    r = spark.read.parquet(out)
    return r.select("day_number", round2(F.col("avg_price")).alias("avg_price"), "min_price", "max_price",
                    "price_records")
