"""Registered analytic questions A1-A16 (adapter E, and R at scale)."""

from __future__ import annotations

from pricetide.operators import analytics as A
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import latest_since, r2, r4, since, weekday_case, with_star
from pricetide.sources.adapters import events_star, retail_star

# fixed parameters of the registered instances
PRODUCT_NAME = "view #1"        # A2: lowest id among names containing it
COMPARE_NAME = "purchase #1"    # A7
PRODUCT_ID = 15                 # A15 (user 1, 'view')
VOLATILE_CATEGORY = 3           # A14 ('purchase')


def _sql_kpi(a):
    return with_star(a, f"""
SELECT (SELECT count(*) FROM products) AS total_products,
       (SELECT count(*) FROM stores) AS total_stores,
       (SELECT count(*) FROM categories) AS total_categories,
       coalesce({r2('avg(price)')}, 0.0) AS avg_price_mxn,
       coalesce({r2('min(price)')}, 0.0) AS min_price_mxn,
       coalesce({r2('max(price)')}, 0.0) AS max_price_mxn,
       (SELECT count(*) FROM latest WHERE price_change < 0) AS products_with_discount,
       (SELECT count(*) FROM latest WHERE price_change > 0) AS products_price_up,
       max(scraped_at) AS last_update,
       count(*) AS total_price_records
FROM price_history""")


@query("a01_kpi_summary_e", _sql_kpi("e"))
def a01_e(spark, d):
    return A.kpi_summary(events_star(spark, d))


@query("a02_price_evolution_e", with_star("e", f"""
SELECT CAST(ph.scraped_at AS DATE) AS date, ph.price, ph.price_change, ph.price_change_pct, ph.availability,
       np.product_name, np.store_name
FROM price_history ph JOIN np ON ph.product_id = np.product_id
WHERE ph.product_id = (SELECT min(id) FROM products WHERE name ILIKE '%{PRODUCT_NAME}%')
  AND ph.scraped_at >= {since(30)}"""))
def a02_e(spark, d):
    return A.price_evolution(events_star(spark, d), product_name=PRODUCT_NAME, days=30)


def _sql_store_ranking(a):
    return with_star(a, f"""
SELECT np.store_name, {r2('avg(l.price)')} AS avg_price, {r2('min(l.price)')} AS min_price,
       {r2('max(l.price)')} AS max_price, count(l.product_id) AS product_count,
       CAST(row_number() OVER (ORDER BY avg(l.price) ASC NULLS LAST, np.store_name) AS INTEGER) AS rank
FROM latest l JOIN np ON l.product_id = np.product_id
GROUP BY np.store_name""")


@query("a03_store_ranking_e", _sql_store_ranking("e"))
def a03_e(spark, d):
    return A.store_ranking(events_star(spark, d))


@query("a03_store_ranking_r", _sql_store_ranking("r"))
def a03_r(spark, d):
    return A.store_ranking(retail_star(spark, d))


@query("a03_store_ranking_category_e", with_star("e", f"""
SELECT np.store_name, {r2('avg(l.price)')} AS avg_price, {r2('min(l.price)')} AS min_price,
       {r2('max(l.price)')} AS max_price, count(l.product_id) AS product_count,
       CAST(row_number() OVER (ORDER BY avg(l.price) ASC NULLS LAST, np.store_name) AS INTEGER) AS rank
FROM latest l JOIN np ON l.product_id = np.product_id
WHERE np.category_id = 2
GROUP BY np.store_name"""))
def a03_cat_e(spark, d):
    return A.store_ranking(events_star(spark, d), category_id=2)


def _sql_volatility(a, days, fn="stddev_samp"):
    return with_star(a, f"""
SELECT np.category_name, {r2(f'{fn}(ph.price_change_pct)')} AS volatility,
       {r2('avg(ph.price_change_pct)')} AS avg_change_pct, count(ph.id) AS price_records,
       count(DISTINCT ph.product_id) AS products_count
FROM price_history ph JOIN np ON ph.product_id = np.product_id
WHERE ph.scraped_at >= {since(days)} AND ph.price_change_pct IS NOT NULL
GROUP BY np.category_name""")


@query("a04_category_volatility_e", _sql_volatility("e", 30))
def a04_e(spark, d):
    return A.category_volatility(events_star(spark, d), days=30)


@query("a17_category_volatility_pop_e", _sql_volatility("e", 30, "stddev_pop"))
def a17_e(spark, d):
    return A.category_volatility(events_star(spark, d), days=30, kind="pop")


@query("a05_top_discounts_e", with_star("e", f"""
SELECT np.product_name, np.store_name, np.category_name, {r2('lw.price')} AS current_price,
       {r2('lw.price - lw.price_change')} AS previous_price, {r2('abs(lw.price_change)')} AS discount_amount,
       {r2('abs(lw.price_change_pct)')} AS discount_pct, lw.scraped_at
FROM lw JOIN np ON lw.product_id = np.product_id
WHERE lw.price_change_pct < 0
ORDER BY lw.price_change_pct ASC, lw.product_id ASC
LIMIT 10""", latest_since(30)))
def a05_e(spark, d):
    return A.top_discounts(events_star(spark, d), n=10, days=30)


@query("a05_top_discounts_r", with_star("r", f"""
SELECT np.product_name, np.store_name, np.category_name, {r2('lw.price')} AS current_price,
       {r2('lw.price - lw.price_change')} AS previous_price, {r2('abs(lw.price_change)')} AS discount_amount,
       {r2('abs(lw.price_change_pct)')} AS discount_pct, lw.scraped_at
FROM lw JOIN np ON lw.product_id = np.product_id
WHERE lw.price_change_pct < 0
ORDER BY lw.price_change_pct ASC, lw.product_id ASC
LIMIT 10""", latest_since(365)))
def a05_r(spark, d):
    return A.top_discounts(retail_star(spark, d), n=10, days=365)


def _sql_best_time(a, days, cat=None):
    cat_f = f" AND p.category_id = {int(cat)}" if cat is not None else ""
    return with_star(a, f"""
SELECT {weekday_case('day_number')} AS day_of_week, day_number, avg_price, min_price, max_price, price_records,
       day_number = (SELECT day_number FROM g ORDER BY avg_price, day_number LIMIT 1) AS is_best
FROM g""", f"""g AS (
  SELECT CAST(isodow(ph.scraped_at) AS INTEGER) AS day_number, {r2('avg(ph.price)')} AS avg_price,
         {r2('min(ph.price)')} AS min_price, {r2('max(ph.price)')} AS max_price, count(ph.id) AS price_records
  FROM price_history ph JOIN products p ON ph.product_id = p.id
  WHERE ph.scraped_at >= {since(days)}{cat_f}
  GROUP BY 1)""")


@query("a06_best_time_to_buy_e", _sql_best_time("e", 90))
def a06_e(spark, d):
    return A.best_time_to_buy(events_star(spark, d), days=90)


@query("a06_best_time_to_buy_category_e", _sql_best_time("e", 90, 4))
def a06_cat_e(spark, d):
    return A.best_time_to_buy(events_star(spark, d), category_id=4, days=90)


@query("a07_price_comparison_e", with_star("e", f"""
SELECT store_name, product_name, current_price, availability, last_updated,
       {r2('current_price - min(current_price) OVER ()')} AS price_diff_vs_cheapest,
       current_price = min(current_price) OVER () AS is_cheapest
FROM rows_""", f"""rows_ AS (
  SELECT coalesce(s.name, 'Unknown') AS store_name, p.name AS product_name, {r2('l.price')} AS current_price,
         l.availability, l.scraped_at AS last_updated
  FROM products p JOIN latest l ON l.product_id = p.id LEFT JOIN stores s ON p.store_id = s.id
  WHERE p.name ILIKE '%{COMPARE_NAME}%')"""))
def a07_e(spark, d):
    return A.price_comparison(events_star(spark, d), COMPARE_NAME)


def _sql_category_summary(a):
    return with_star(a, f"""
SELECT np.category_name, count(l.product_id) AS product_count, {r2('avg(l.price)')} AS avg_price,
       {r2('min(l.price)')} AS min_price, {r2('max(l.price)')} AS max_price,
       {r2('avg(l.price_change_pct)')} AS avg_discount_pct
FROM latest l JOIN np ON l.product_id = np.product_id
GROUP BY np.category_name""")


@query("a08_category_summary_e", _sql_category_summary("e"))
def a08_e(spark, d):
    return A.category_summary(events_star(spark, d))


@query("a08_category_summary_r", _sql_category_summary("r"))
def a08_r(spark, d):
    return A.category_summary(retail_star(spark, d))


@query("a09_price_changes_e", with_star("e", f"""
SELECT np.product_name, np.store_name, np.category_name, ph.price_change_pct, ph.price, ph.scraped_at
FROM price_history ph JOIN np ON ph.product_id = np.product_id
WHERE ph.scraped_at >= {since(30)} AND ph.price_change_pct IS NOT NULL"""))
def a09_e(spark, d):
    return A.price_changes(events_star(spark, d), days=30)


@query("a10_products_list_e", with_star("e", """
SELECT product_id AS id, product_name AS name, brand, category_id, category_name, store_id, store_name FROM np"""))
def a10_e(spark, d):
    return A.products_list(events_star(spark, d))


@query("a10_products_list_r", with_star("r", """
SELECT product_id AS id, product_name AS name, brand, category_id, category_name, store_id, store_name FROM np"""))
def a10_r(spark, d):
    return A.products_list(retail_star(spark, d))


@query("a11_category_price_stats_e", with_star("e", """
SELECT np.category_name, np.product_name, np.store_name, lw.price
FROM lw JOIN np ON lw.product_id = np.product_id""", latest_since(30)))
def a11_e(spark, d):
    return A.category_price_stats(events_star(spark, d), days=30)


def _sql_store_category(a):
    return with_star(a, f"""
SELECT np.category_name, np.store_name, {r2('avg(l.price)')} AS avg_price, count(l.product_id) AS product_count
FROM latest l JOIN np ON l.product_id = np.product_id
GROUP BY np.category_name, np.store_name""")


@query("a12_store_category_e", _sql_store_category("e"))
def a12_e(spark, d):
    return A.store_category_comparison(events_star(spark, d))


@query("a12_store_category_r", _sql_store_category("r"))
def a12_r(spark, d):
    return A.store_category_comparison(retail_star(spark, d))


def _sql_store_stats(a):
    return with_star(a, f"""
SELECT np.store_name, {r2('avg(l.price)')} AS avg_price, {r2('min(l.price)')} AS min_price,
       {r2('max(l.price)')} AS max_price, count(l.product_id) AS product_count,
       count(DISTINCT np.category_id) AS category_count, max(l.scraped_at) AS last_update
FROM latest l JOIN np ON l.product_id = np.product_id
GROUP BY np.store_name""")


@query("a13_store_stats_e", _sql_store_stats("e"))
def a13_e(spark, d):
    return A.store_detailed_stats(events_star(spark, d))


@query("a13_store_stats_r", _sql_store_stats("r"))
def a13_r(spark, d):
    return A.store_detailed_stats(retail_star(spark, d))


@query("a14_most_volatile_e", with_star("e", f"""
SELECT np.product_id, np.product_name, np.store_name, {r4('stddev_samp(ph.price_change_pct)')} AS volatility,
       {r2('avg(ph.price_change_pct)')} AS avg_change_pct, count(ph.id) AS price_records,
       {r2('max(l.price)')} AS current_price
FROM price_history ph JOIN np ON ph.product_id = np.product_id JOIN latest l ON l.product_id = ph.product_id
WHERE np.category_id = {VOLATILE_CATEGORY} AND ph.scraped_at >= {since(30)} AND ph.price_change_pct IS NOT NULL
GROUP BY np.product_id, np.product_name, np.store_name
ORDER BY stddev_samp(ph.price_change_pct) DESC NULLS LAST, np.product_id
LIMIT 5"""))
def a14_e(spark, d):
    return A.most_volatile_products(events_star(spark, d), VOLATILE_CATEGORY, top_n=5, days=30)


@query("a15_product_detail_e", with_star("e", f"""
SELECT scraped_at AS date, {r2('price')} AS price, availability, price_change, price_change_pct
FROM price_history WHERE product_id = {PRODUCT_ID} AND scraped_at >= {since(30)}"""))
def a15_e(spark, d):
    return A.product_detail(events_star(spark, d), PRODUCT_ID, days=30)


@query("a16_weekday_e", with_star("e", f"""
SELECT CAST(isodow(scraped_at) AS INTEGER) AS day_number,
       {weekday_case('CAST(isodow(scraped_at) AS INTEGER)')} AS day_of_week, count(*) AS price_records
FROM price_history GROUP BY 1, 2"""))
def a16_e(spark, d):
    return A.weekday_numbers(events_star(spark, d))
