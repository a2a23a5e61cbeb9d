"""Registered derived metrics D1-D24."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide.operators import analytics as A
from pricetide.operators import derived as D
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import latest_since, r2, r4, since, weekday_case, with_star
from pricetide.sources.adapters import events_star, retail_star

# --- oracle CTEs for the question results the metrics start from -------------
A5 = f"""a5 AS (SELECT np.product_name, np.store_name, np.category_name, {r2('lw.price')} AS current_price,
       {r2('lw.price - lw.price_change')} AS previous_price, {r2('abs(lw.price_change)')} AS discount_amount,
       {r2('abs(lw.price_change_pct)')} AS discount_pct, lw.scraped_at
  FROM lw JOIN np ON lw.product_id = np.product_id WHERE lw.price_change_pct < 0
  ORDER BY lw.price_change_pct ASC, lw.product_id ASC LIMIT 10)"""
A3 = f"""a3 AS (SELECT np.store_name, {r2('avg(l.price)')} AS avg_price, {r2('min(l.price)')} AS min_price,
       {r2('max(l.price)')} AS max_price, count(l.product_id) AS product_count,
       CAST(row_number() OVER (ORDER BY avg(l.price) ASC NULLS LAST, np.store_name) AS INTEGER) AS rank
  FROM latest l JOIN np ON l.product_id = np.product_id GROUP BY np.store_name)"""
A12 = f"""a12 AS (SELECT np.category_name, np.store_name, {r2('avg(l.price)')} AS avg_price,
       count(l.product_id) AS product_count FROM latest l JOIN np ON l.product_id = np.product_id
  GROUP BY np.category_name, np.store_name)"""
A9 = f"""a9 AS (SELECT np.product_name, np.store_name, np.category_name, ph.price_change_pct, ph.price, ph.scraped_at
  FROM price_history ph JOIN np ON ph.product_id = np.product_id
  WHERE ph.scraped_at >= {since(30)} AND ph.price_change_pct IS NOT NULL)"""
A11 = """a11 AS (SELECT np.category_name, np.product_name, np.store_name, lw.price
  FROM lw JOIN np ON lw.product_id = np.product_id)"""
A8 = f"""a8 AS (SELECT np.category_name, count(l.product_id) AS product_count, {r2('avg(l.price)')} AS avg_price,
       {r2('min(l.price)')} AS min_price, {r2('max(l.price)')} AS max_price,
       {r2('avg(l.price_change_pct)')} AS avg_discount_pct
  FROM latest l JOIN np ON l.product_id = np.product_id GROUP BY np.category_name)"""
A6 = f"""g AS (SELECT CAST(isodow(ph.scraped_at) AS INTEGER) AS day_number, {r2('avg(ph.price)')} AS avg_price
  FROM price_history ph JOIN products p ON ph.product_id = p.id
  WHERE ph.scraped_at >= {since(90)} GROUP BY 1),
a6 AS (SELECT {weekday_case('day_number')} AS day_of_week, day_number, avg_price FROM g)"""

E, R = events_star, retail_star


@query("d01_discount_rollup_e", with_star("e", f"""
SELECT {r2('max(discount_pct)')} AS max_discount_pct, {r2('avg(discount_pct)')} AS mean_discount_pct,
       {r2('sum(discount_amount)')} AS total_discount_amount FROM a5""", f"{latest_since(30)},\n{A5}"))
def d01(spark, d):
    return D.discount_rollup(A.top_discounts(E(spark, d), 10, 30))


@query("d02_market_share_r", with_star("r", f"""
SELECT store_name, product_count, {r2('product_count / sum(product_count) OVER () * 100.0')} AS share_pct
FROM a3""", A3))
def d02(spark, d):
    return D.market_share(A.store_ranking(R(spark, d)))


@query("d03_coverage_kpis_r", with_star("r", f"""
SELECT CAST(sum(product_count) AS BIGINT) AS total_products, count(*) AS total_stores,
       {r2('avg(avg_price)')} AS mean_store_avg_price,
       arg_max(store_name, product_count * 1000 - rank) AS top_store, max(product_count) AS top_store_products
FROM a3""", A3))
def d03(spark, d):
    return D.coverage_kpis(A.store_ranking(R(spark, d)))


@query("d04_price_gap_r", with_star("r", f"""
SELECT cs AS cheapest_store, cmin AS cheapest_avg_price, ds AS dearest_store, dmax AS dearest_avg_price,
       {r2('dmax - cmin')} AS price_gap, {r2('(dmax - cmin) / nullif(dmax, 0.0) * 100.0')} AS gap_pct
FROM (SELECT (SELECT store_name FROM a3 ORDER BY avg_price, store_name LIMIT 1) AS cs, min(avg_price) AS cmin,
             (SELECT store_name FROM a3 ORDER BY avg_price DESC, store_name DESC LIMIT 1) AS ds,
             max(avg_price) AS dmax FROM a3) x""", A3))
def d04(spark, d):
    return D.price_gap(A.store_ranking(R(spark, d)))


@query("d05_cheapest_store_per_category_r", with_star("r", """
SELECT category_name, store_name, avg_price, product_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_name ORDER BY avg_price, store_name) AS rn FROM a12) x
WHERE rn = 1""", A12))
def d05(spark, d):
    return D.cheapest_store_per_category(A.store_category_comparison(R(spark, d)))


@query("d06_ranking_by_category_name_e", with_star("e", f"""
SELECT np.store_name, {r2('avg(l.price)')} AS avg_price, {r2('min(l.price)')} AS min_price,
       {r2('max(l.price)')} AS max_price, count(l.product_id) AS product_count,
       CAST(row_number() OVER (ORDER BY avg(l.price) ASC NULLS LAST, np.store_name) AS INTEGER) AS rank
FROM latest l JOIN np ON l.product_id = np.product_id
WHERE np.category_id = (SELECT id FROM categories WHERE name = 'purchase')
GROUP BY np.store_name"""))
def d06(spark, d):
    star = E(spark, d)
    # name -> id as a scalar sub-query, then the ranking restricted to it
    cid = star.categories.filter(F.col("name") == "purchase").select(F.min("id")).scalar()
    stores, cats = A._dims(star)
    lp = A.latest_prices(star).select("product_id", "price")
    p = star.products.filter(F.col("category_id") == cid).select(F.col("id").alias("product_id"), "store_id")
    g = (lp.join(p, "product_id").join(stores, "store_id").groupBy("store_name")
           .agg(F.avg("price").alias("raw_avg"), F.min("price").alias("mn"), F.max("price").alias("mx"),
                F.count("product_id").alias("product_count")))
    w = A.Window.orderBy(F.col("raw_avg").asc_nulls_last(), F.col("store_name"))
    return g.select("store_name", A.round2(F.col("raw_avg")).alias("avg_price"), A.round2(F.col("mn")).alias("min_price"),
                    A.round2(F.col("mx")).alias("max_price"), "product_count", F.row_number().over(w).alias("rank"))


_D7_NAME = "(SELECT name FROM products WHERE id = (SELECT min(id) FROM products))"
_D7 = f"""d7 AS (SELECT CAST(ph.scraped_at AS DATE) AS date, ph.price, ph.price_change, ph.price_change_pct,
       ph.availability, np.product_name, np.store_name
  FROM price_history ph JOIN np ON ph.product_id = np.product_id WHERE np.product_name = {_D7_NAME})"""


def _d7(star):
    name = star.products.filter(F.col("id") == star.products.select(F.min("id")).scalar()) \
                        .select(F.min("name")).scalar()
    return (star.price_history.join(A.named_products(star).filter(F.col("product_name") == name), "product_id")
            .select(F.to_date("scraped_at").alias("date"), "price", "price_change", "price_change_pct",
                    "availability", "product_name", "store_name"))


@query("d07_cross_store_evolution_r", with_star("r", "SELECT * FROM d7", _D7))
def d07(spark, d):
    return _d7(R(spark, d))


@query("d08_series_stats_r", with_star("r", f"""
SELECT min(price) AS min_price, max(price) AS max_price, {r2('max(price) - min(price)')} AS price_range,
       {r2('avg(price)')} AS mean_price FROM d7""", _D7))
def d08(spark, d):
    return D.series_stats(_d7(R(spark, d)))


_D9 = f"""{A9},
q AS (SELECT quantile_cont(price_change_pct, [0.05, 0.95]) AS q FROM a9),
d9 AS (SELECT price_change_pct, CASE WHEN price_change_pct < 0 THEN 'decrease' ELSE 'increase' END AS direction
  FROM a9, q WHERE price_change_pct >= q.q[1] AND price_change_pct <= q.q[2])"""


@query("d09_trimmed_changes_e", with_star("e", "SELECT * FROM d9", _D9))
def d09(spark, d):
    return D.trimmed_changes(D.held(A.price_changes(E(spark, d), 30)))


@query("d10_histogram_e", with_star("e", """
SELECT CAST(coalesce(least(floor((price_change_pct - lo) / nullif((hi - lo) / 20.0, 0.0)), 19), 0) AS INTEGER) AS bin,
       count(*) AS count, min(price_change_pct) AS min_value, max(price_change_pct) AS max_value
FROM d9, (SELECT min(price_change_pct) AS lo, max(price_change_pct) AS hi FROM d9) mm GROUP BY 1""", _D9))
def d10(spark, d):
    return D.histogram(D.trimmed_changes(D.held(A.price_changes(E(spark, d), 30))), "price_change_pct", 20)


@query("d11_change_summary_e", with_star("e", f"""
SELECT {r2('avg(price_change_pct)')} AS mean_pct, {r2('quantile_cont(price_change_pct, 0.5)')} AS median_pct,
       count(*) AS n_changes, (SELECT count(*) FROM d9 WHERE direction = 'decrease') AS n_decreases,
       {r2("(SELECT count(*) FROM d9 WHERE direction = 'decrease') / nullif(count(*), 0) * 100.0")} AS decrease_share_pct
FROM a9""", _D9))
def d11(spark, d):
    ch = D.held(A.price_changes(E(spark, d), 30))
    return D.change_summary(ch, D.trimmed_changes(ch))


@query("d12_box_stats_e", with_star("e", f"""
SELECT category_name, {r2('q[1]')} AS q1, {r2('q[2]')} AS median, {r2('q[3]')} AS q3, mean_price, stddev_price, n
FROM (SELECT category_name, quantile_cont(price, [0.25, 0.5, 0.75]) AS q, {r2('avg(price)')} AS mean_price,
             {r2('stddev_samp(price)')} AS stddev_price, count(*) AS n FROM a11 GROUP BY category_name) x""",
                                            f"{latest_since(30)},\n{A11}"))
def d12(spark, d):
    return D.box_stats(A.category_price_stats(E(spark, d), 30))


@query("d13_facets_r", with_star("r", """
SELECT DISTINCT 'category' AS facet, category_name AS value FROM np
UNION SELECT DISTINCT 'brand', brand FROM np WHERE brand IS NOT NULL AND brand <> ''
UNION SELECT DISTINCT 'store', store_name FROM np"""))
def d13(spark, d):
    return D.facets(A.named_products(R(spark, d)))


@query("d14_price_bounds_e", with_star("e", """
SELECT c.name AS category_name, coalesce(min(a11.price), 0.0) AS min_price, coalesce(max(a11.price), 50000.0) AS max_price
FROM categories c LEFT JOIN a11 ON a11.category_name = c.name GROUP BY c.name""", f"{latest_since(30)},\n{A11}"))
def d14(spark, d):
    star = E(spark, d)
    return D.price_bounds(A.category_price_stats(star, 30), star.categories)


_D15 = f"""{latest_since(365)},
{A11},
d15 AS (SELECT np.product_id, np.product_name, np.brand, np.store_name, b.current_price
  FROM np LEFT JOIN (SELECT product_name, min(price) AS current_price FROM a11 GROUP BY product_name) b
  ON np.product_name = b.product_name)"""


def _d15(spark, d):
    star = R(spark, d)
    rows = A.named_products(star).select("product_id", "product_name", "brand", "store_name")
    return D.lowest_price_by_name(A.category_price_stats(star, 365), rows) \
            .select("product_id", "product_name", "brand", "store_name", "current_price")


@query("d15_lowest_price_by_name_r", with_star("r", "SELECT * FROM d15", _D15))
def d15(spark, d):
    return _d15(spark, d)


@query("d16_faceted_filter_r", with_star("r", """
SELECT * FROM d15 WHERE brand = 'Brand#1' AND store_name = 'EUROPE' AND current_price BETWEEN 1000.0 AND 2000.0""",
                                         _D15))
def d16(spark, d):
    return D.faceted_filter(_d15(spark, d), brand="Brand#1", store="EUROPE", price_min=1000.0, price_max=2000.0)


@query("d17_category_header_e", with_star("e", """
SELECT a8.category_name, a8.product_count, s.store_count, a8.avg_price, a8.min_price, a8.max_price, a8.avg_discount_pct
FROM a8 LEFT JOIN (SELECT category_name, count(DISTINCT store_id) AS store_count FROM np GROUP BY category_name) s
ON a8.category_name = s.category_name""", A8))
def d17(spark, d):
    star = E(spark, d)
    return D.category_header(A.category_summary(star), A.named_products(star))


@query("d18_product_cards_e", with_star("e", """
SELECT product_id, arg_max(price, scraped_at) AS current_price, min(price) AS min_price, max(price) AS max_price,
       arg_max(price_change_pct, scraped_at) AS last_change_pct
FROM price_history GROUP BY product_id"""))
def d18(spark, d):
    return D.product_cards(E(spark, d).price_history)


@query("d19_recent_rows_e", with_star("e", """
SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, id DESC) AS rn FROM price_history) x
WHERE rn <= 5"""))
def d19(spark, d):
    return D.recent_rows(E(spark, d).price_history, 5)


@query("d20_volatile_series_e", with_star("e", f"""
SELECT v.product_id, ph.scraped_at AS date, {r2('ph.price')} AS price, ph.price_change_pct
FROM (SELECT np.product_id FROM price_history ph JOIN np ON ph.product_id = np.product_id
      WHERE np.category_id = 3 AND ph.scraped_at >= {since(30)} AND ph.price_change_pct IS NOT NULL
      GROUP BY np.product_id ORDER BY stddev_samp(ph.price_change_pct) DESC NULLS LAST, np.product_id LIMIT 5) v
JOIN price_history ph ON ph.product_id = v.product_id WHERE ph.scraped_at >= {since(30)}"""))
def d20(spark, d):
    star = E(spark, d)
    top = A.most_volatile_products(star, 3, 5, 30).select("product_id")
    hist = star.recent(30)
    return (hist.join(F.broadcast(top), "product_id")     # top: 5 rows
            .select("product_id", F.col("scraped_at").alias("date"), A.round2(F.col("price")).alias("price"),
                    "price_change_pct"))


@query("d21_weekday_saving_e", with_star("e", f"""
SELECT arg_max(day_of_week, avg_price * 1e6 - day_number) AS worst_day, max(avg_price) AS worst_avg,
       arg_min(day_of_week, avg_price * 1e6 + day_number) AS best_day, min(avg_price) AS best_avg,
       CASE WHEN max(avg_price) > 0 THEN {r2('(max(avg_price) - min(avg_price)) / max(avg_price) * 100.0')}
            ELSE 0.0 END AS saving_pct
FROM a6""", A6))
def d21(spark, d):
    return D.weekday_saving(A.best_time_to_buy(E(spark, d), days=90))


@query("d22_report_format_e", with_star("e", """
SELECT CASE WHEN length(product_name) > 40 THEN substring(product_name, 1, 40) || '...' ELSE product_name END AS product,
       store_name, '$' || format('{:,.2f}', current_price) AS price,
       CASE WHEN discount_pct IS NULL THEN 'N/A' ELSE printf('%+.2f%%', -discount_pct) END AS change,
       strftime(scraped_at, '%d/%m/%Y') AS date
FROM a5""", f"{latest_since(30)},\n{A5}"))
def d22(spark, d):
    return D.format_report(A.top_discounts(E(spark, d), 10, 30))


@query("d23_ordinal_e", with_star("e", f"""
SELECT store_name, {r2('avg(l.price)')} AS avg_price,
       CAST(row_number() OVER (ORDER BY {r2('avg(l.price)')}, store_name) AS INTEGER) AS n
FROM latest l JOIN np ON l.product_id = np.product_id GROUP BY store_name"""))
def d23(spark, d):
    s = A.store_detailed_stats(E(spark, d)).select("store_name", "avg_price")
    return D.with_ordinal(s, [F.col("avg_price"), F.col("store_name")])


@query("d24_weekday_label_r", with_star("r", f"""
SELECT CAST(isodow(scraped_at) AS INTEGER) AS day_number,
       {weekday_case('CAST(isodow(scraped_at) AS INTEGER)')} AS day_of_week, count(*) AS price_records
FROM price_history GROUP BY 1, 2"""))
def d24(spark, d):
    return A.weekday_numbers(R(spark, d))
