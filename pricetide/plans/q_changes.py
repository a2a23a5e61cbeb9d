"""Registered change-detection queries K1-K8."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide.functions import round2
from pricetide.operators import changes as C
from pricetide.operators.analytics import latest_prices
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import COMMON_CTE, E_CTE, _EV_CASE, e_cte, r2
from pricetide.sources.adapters import event_observations, events_star, last_day_cut
from pricetide.sources.tables import read_table

_OBS_SQL = (f"SELECT event_id, user_id * 10 + CAST({_EV_CASE} AS BIGINT) AS product_id, value AS price, "
            f"ts AS scraped_at FROM events")


def _lag_sql(prev):
    return (f"{r2(f'price - {prev}')} AS price_change, "
            f"{r2(f'(price - {prev}) / nullif({prev}, 0.0) * 100.0')} AS price_change_pct")


_K1_SQL = f"""WITH o AS ({_OBS_SQL})
SELECT event_id, product_id, price, {_lag_sql('lag(price) OVER (PARTITION BY product_id ORDER BY scraped_at, event_id)')}
FROM o"""


def _k1(spark, d):
    obs = event_observations(read_table(spark, d, "events")).select(
        "event_id", "product_id", F.col("value").alias("price"), F.col("ts").alias("scraped_at"))
    return C.batch_changes(obs, ["product_id"], ["scraped_at", "event_id"])


@query("k01_batch_change_e", _K1_SQL)
def k01(spark, d):
    return _k1(spark, d).select("event_id", "product_id", "price", "price_change", "price_change_pct")


@query("k06_change_counters_e", f"""WITH k AS ({_K1_SQL})
SELECT count(*) AS products_processed, count(price_change) AS changes_calculated,
       count(*) FILTER (WHERE price_change IS NULL) AS first_records,
       count(*) FILTER (WHERE price_change > 0) AS price_increases,
       count(*) FILTER (WHERE price_change < 0) AS price_decreases,
       count(*) FILTER (WHERE price_change = 0) AS price_unchanged
FROM k""")
def k06(spark, d):
    return C.change_counters(_k1(spark, d))


_CUT = "(SELECT CAST(max(ts) AS DATE) FROM events)"


@query("k03_change_vs_stored_e", f"""WITH base AS (SELECT * FROM events WHERE CAST(ts AS DATE) < {_CUT}),
{e_cte('base')},{COMMON_CTE},
inc AS (SELECT event_id, event_type || ' #' || CAST(user_id AS VARCHAR) AS name, user_id % 3 + 1 AS store_id,
               value AS price, ts AS scraped_at FROM events WHERE CAST(ts AS DATE) >= {_CUT}),
sl AS (SELECT p.name, p.store_id, l.price AS stored_price FROM latest l JOIN products p ON l.product_id = p.id),
fp AS (SELECT name, store_id, price AS first_price FROM (
         SELECT *, row_number() OVER (PARTITION BY name, store_id ORDER BY scraped_at, event_id) AS frn FROM inc) x
       WHERE frn = 1),
chg AS (SELECT fp.name, fp.store_id, {r2('fp.first_price - sl.stored_price')} AS price_change,
               {r2('(fp.first_price - sl.stored_price) / nullif(sl.stored_price, 0.0) * 100.0')} AS price_change_pct
        FROM fp LEFT JOIN sl ON fp.name = sl.name AND fp.store_id = sl.store_id)
SELECT i.event_id, i.name, i.store_id, i.price, c.price_change, c.price_change_pct
FROM inc i LEFT JOIN chg c ON i.name = c.name AND i.store_id = c.store_id""")
def k03(spark, d):
    ev = read_table(spark, d, "events")
    cut = last_day_cut(ev)
    stored = events_star(spark, d, ev.filter(F.to_date("ts") < cut))
    stored_latest = (latest_prices(stored)
                     .join(stored.products.select(F.col("id").alias("product_id"), "name", "store_id"), "product_id")
                     .select("name", "store_id", F.col("price").alias("stored_price")))
    inc = event_observations(ev.filter(F.to_date("ts") >= cut)).select(
        "event_id", "name", "store_id", F.col("value").alias("price"), F.col("ts").alias("scraped_at"))
    return (C.change_vs_stored(inc, stored_latest, ["name", "store_id"], ["scraped_at", "event_id"])
            .select("event_id", "name", "store_id", "price", "price_change", "price_change_pct"))


@query("k04_scalar_change_r", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       {r2(f"{r2('l.l_extendedprice / nullif(l.l_quantity, 0.0)')} - p.p_retailprice")} AS price_change,
       {r2(f"({r2('l.l_extendedprice / nullif(l.l_quantity, 0.0)')} - p.p_retailprice) / nullif(p.p_retailprice, 0.0) * 100.0")} AS price_change_pct
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def k04(spark, d):
    li = read_table(spark, d, "lineitem")
    part = read_table(spark, d, "part").select("p_partkey", "p_retailprice")
    cur = round2(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)))
    chg, pct = C.scalar_change(cur, F.col("p_retailprice"))
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      chg.alias("price_change"), pct.alias("price_change_pct")))


@query("k05_last_price_e", f"""WITH o AS ({_OBS_SQL})
SELECT product_id, price AS last_price, scraped_at AS last_at FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, event_id DESC) AS rn FROM o) x
WHERE rn = 1""")
def k05(spark, d):
    obs = event_observations(read_table(spark, d, "events")).select(
        "event_id", "product_id", F.col("value").alias("price"), F.col("ts").alias("scraped_at"))
    return C.last_price(obs, "product_id", ["scraped_at", "event_id"])


@query("k07_asof_price_e", f"""WITH {E_CTE}
SELECT o.event_id, o.product_id, o.ts, ph.price AS asof_price, ph.scraped_at AS asof_ts
FROM (SELECT event_id, product_id, ts FROM ev) o
ASOF LEFT JOIN price_history ph ON o.product_id = ph.product_id AND o.ts > ph.scraped_at""")
def k07(spark, d):
    star = events_star(spark, d)
    probes = event_observations(read_table(spark, d, "events")).select("event_id", "product_id", "ts")
    return C.asof_join(probes, star.price_history, ["product_id"], "ts", "scraped_at", ["price"], strict=True) \
            .select("event_id", "product_id", "ts", F.col("asof_price"), "asof_ts")


_K8_PRICE = r2("l_extendedprice / nullif(l_quantity, 0.0)")


@query("k08_series_change_r", f"""WITH s AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {_K8_PRICE} AS price,
         lag({_K8_PRICE}) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS prev
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, {r2('price - prev')} AS price_change,
       CASE WHEN prev > 0 THEN {r2('(price - prev) / prev * 100.0')} END AS price_change_pct
FROM s""")
def k08(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        round2(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("price"))
    return (C.series_changes(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", "price_change",
                    "price_change_pct"))
