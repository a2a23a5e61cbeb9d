"""SQL text shared by the Spark SQL variants and the DuckDB oracle.

The star-schema adapters are written once more here as plain SQL CTEs so the
oracle derives the same tables from the driver's parquet views.
"""

from __future__ import annotations

from pricetide import constants as K
from pricetide.sources.adapters import EVENT_TYPES


def r2(x: str) -> str:
    """SQL spelling of the engine rounding rule (half-up on the binary value)."""
    # e-notation literals are DOUBLE in both Spark SQL and DuckDB (100.0 would be DECIMAL in Spark)
    return f"(floor(({x}) * 1e2 + 5e-1) / 1e2)"


def r4(x: str) -> str:
    return f"(floor(({x}) * 1e4 + 5e-1) / 1e4)"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STORES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i} AS BIGINT), {_sq(n)}, {_sq(c)})" for i, n, c, *_ in K.STORES) + ") AS t(id, name, country)"

_EV_CASE = "CASE event_type " + " ".join(
    f"WHEN {_sq(t)} THEN {i}" for i, t in enumerate(EVENT_TYPES, 1)) + " ELSE 0 END"


def _changes_sql(src: str) -> str:
    prev = "lag(price) OVER (PARTITION BY product_id ORDER BY scraped_at)"
    return (f"SELECT *, {r2(f'price - {prev}')} AS price_change, "
            f"{r2(f'(price - {prev}) / nullif({prev}, 0.0) * 100.0')} AS price_change_pct FROM {src} WHERE rn = 1")


def e_cte(src: str = "events") -> str:
    """Adapter E as CTEs over the relation ``src`` (default: the events view)."""
    return f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST({_EV_CASE} AS BIGINT) AS category_id,
         user_id * 10 + CAST({_EV_CASE} AS BIGINT) AS product_id
  FROM {src}),
stores AS ({STORES_SQL}),
categories AS (SELECT * FROM (VALUES {", ".join(f"(CAST({i} AS BIGINT), {_sq(t)})" for i, t in enumerate(EVENT_TYPES, 1))}) AS t(id, name)),
products AS (
  SELECT product_id AS id, event_type || ' #' || CAST(user_id AS VARCHAR) AS name,
         'brand ' || CAST(user_id % 4 AS VARCHAR) AS brand, '/item/' || CAST(product_id AS VARCHAR) AS url,
         'EV-' || CAST(product_id AS VARCHAR) AS sku, category_id, user_id % 3 + 1 AS store_id,
         min(ts) AS created_at
  FROM ev GROUP BY product_id, user_id, event_type, category_id),
ph_day AS (
  SELECT product_id, event_id AS id, value AS price, event_type, ts AS scraped_at, CAST(ts AS DATE) AS obs_date,
         row_number() OVER (PARTITION BY product_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM ev),
ph_chg AS ({_changes_sql("ph_day")}),
price_history AS (
  SELECT id, product_id, price, '{K.BASE_CURRENCY}' AS currency, event_type <> 'error' AS availability,
         price_change, price_change_pct, scraped_at, obs_date FROM ph_chg)"""


E_CTE = e_cte("events")

R_CTE = f"""
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_shipdate,
         CAST(n.n_regionkey AS BIGINT) AS store_id, l.l_partkey * 10 + CAST(n.n_regionkey AS BIGINT) AS product_id
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
stores AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_name AS country FROM region),
categories AS (SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id, name
               FROM (SELECT DISTINCT p_type AS name FROM part) d),
products AS (
  SELECT pr.product_id AS id, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS name, p.p_brand AS brand,
         '/item/' || CAST(pr.product_id AS VARCHAR) AS url, 'R-' || CAST(pr.product_id AS VARCHAR) AS sku,
         c.id AS category_id, pr.store_id, pr.created_at
  FROM (SELECT product_id, l_partkey, store_id, min(l_shipdate) AS created_at FROM li
        GROUP BY product_id, l_partkey, store_id) pr
  JOIN part p ON pr.l_partkey = p.p_partkey JOIN categories c ON c.name = p.p_type),
ph_day AS (
  SELECT product_id, product_id * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS id,
         {r2("l_extendedprice / nullif(l_quantity, 0.0)")} AS price, l_shipdate AS scraped_at,
         CAST(l_shipdate AS DATE) AS obs_date,
         row_number() OVER (PARTITION BY product_id, CAST(l_shipdate AS DATE)
                            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM li),
ph_chg AS ({_changes_sql("ph_day")}),
price_history AS (
  SELECT id, product_id, price, '{K.BASE_CURRENCY}' AS currency, TRUE AS availability,
         price_change, price_change_pct, scraped_at, obs_date FROM ph_chg)"""

STAR_CTE = {"e": E_CTE, "r": R_CTE}

# common derived relations used by many oracle texts
COMMON_CTE = """
as_of AS (SELECT max(scraped_at) AS t FROM price_history),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, id DESC) AS lrn
    FROM price_history) x WHERE lrn = 1),
np AS (
  SELECT p.id AS product_id, p.name AS product_name, p.brand, p.category_id, c.name AS category_name,
         p.store_id, s.name AS store_name
  FROM products p JOIN stores s ON p.store_id = s.id JOIN categories c ON p.category_id = c.id)"""


def with_star(adapter: str, body: str, extra: str = "") -> str:
    """Oracle text: adapter CTEs + common CTEs (+ extra CTEs) + a query body."""
    more = f",\n{extra}" if extra else ""
    return f"WITH {STAR_CTE[adapter]},{COMMON_CTE}{more}\n{body}"


def latest_since(days: int, name: str = "lw") -> str:
    """CTE: latest row per product among the rows of the look-back."""
    return (f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id "
            f"ORDER BY scraped_at DESC, id DESC) AS wrn FROM price_history WHERE scraped_at >= {since(days)}) x "
            f"WHERE wrn = 1)")


def weekday_case(col: str) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN {k} THEN {_sq(v)}" for k, v in sorted(K.WEEKDAY_NAMES.items())) + " END"


def since(days: int) -> str:
    return f"(SELECT t FROM as_of) - INTERVAL {int(days)} DAY"
