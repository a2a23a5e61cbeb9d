"""Registered load (L1-L11) and integrity (V1-V7) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.operators import analytics as A
from pricetide.operators import cleaning as CL
from pricetide.operators import load as L
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import _EV_CASE, COMMON_CTE, E_CTE, R_CTE, e_cte, r2
from pricetide.sources.adapters import categories_dim, events_split, events_star, retail_star
from pricetide.sources.raw import retail_listings
from pricetide.sources.tables import read_table

# ----------------------------------------------------------------------------
# oracle building blocks for the split scenario (stored = older events,
# incoming = the last 12 hours reduced to one row per (name, store_id))
# ----------------------------------------------------------------------------
_CUT = "(SELECT max(ts) - INTERVAL 12 HOUR FROM events)"
_RUN = "(SELECT max(ts) FROM events)"
_NAME = "event_type || ' #' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 7 = 0 THEN ' new' ELSE '' END"


def split_cte(per_day: bool = False, by_days: bool = False) -> str:
    """CTEs of the split scenario: the next products and prices after the batch ``inc``
    (one row per product) or, with ``per_day``, after its rows of every day.  With ``by_days``
    each day is a batch, so new ids go by the day first."""
    return f"""base AS (SELECT * FROM events WHERE ts < {_CUT}),
{e_cte('base')},
inc0 AS (
  SELECT event_id, {_NAME} AS name, user_id % 3 + 1 AS store_id,
         CAST({_EV_CASE} AS BIGINT) AS category_id, 'brand ' || CAST(user_id % 5 AS VARCHAR) AS brand,
         '/item/' || CAST(user_id * 10 + CAST({_EV_CASE} AS BIGINT) AS VARCHAR) AS url,
         'EV-' || CAST(user_id * 10 + CAST({_EV_CASE} AS BIGINT) AS VARCHAR) AS sku,
         value AS price, '{K.BASE_CURRENCY}' AS currency, event_type <> 'error' AS availability, ts AS scraped_at
  FROM events WHERE ts >= {_CUT} OR (ts >= {_CUT} - INTERVAL 24 HOUR AND user_id % 5 = 1)),
inc AS (SELECT * EXCLUDE (irn) FROM (
  SELECT *, row_number() OVER (PARTITION BY name, store_id ORDER BY scraped_at DESC, price ASC, event_id DESC) AS irn
  FROM inc0) x WHERE irn = 1),
inc_d AS (SELECT * EXCLUDE (irn) FROM (
  SELECT *, row_number() OVER (PARTITION BY name, store_id{", CAST(scraped_at AS DATE)" if per_day else ""}
                               ORDER BY scraped_at DESC, price ASC, event_id DESC) AS irn
  FROM inc0) x WHERE irn = 1),
upd AS (
  SELECT p.id, p.name, p.store_id,
         CASE WHEN i.name IS NULL THEN p.brand ELSE i.brand END AS brand,
         CASE WHEN i.name IS NULL THEN p.url ELSE i.url END AS url,
         CASE WHEN i.name IS NULL THEN p.sku ELSE i.sku END AS sku,
         CASE WHEN i.name IS NULL THEN p.category_id ELSE i.category_id END AS category_id,
         p.created_at, CASE WHEN i.name IS NULL THEN 'keep' ELSE 'update' END AS action
  FROM products p LEFT JOIN inc i ON p.name = i.name AND p.store_id = i.store_id),
newp AS (
  SELECT (SELECT coalesce(max(id), 0) FROM products) + row_number() OVER (ORDER BY {"(SELECT min(CAST(f.scraped_at AS DATE)) FROM inc0 f WHERE f.name = i.name AND f.store_id = i.store_id), " if by_days else ""}i.name, i.store_id) AS id,
         i.name, i.store_id, i.brand, i.url, i.sku, i.category_id, {_RUN} AS created_at, 'insert' AS action
  FROM inc i WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.name = i.name AND p.store_id = i.store_id)),
nextp AS (SELECT * FROM upd UNION ALL SELECT * FROM newp),
inc1 AS (SELECT n.id AS product_id, i.price, i.currency, i.availability, i.scraped_at,
                CAST(i.scraped_at AS DATE) AS obs_date
         FROM inc_d i JOIN nextp n ON i.name = n.name AND i.store_id = n.store_id),
inc2 AS (SELECT *, lag(price) OVER d AS before_price, lag(scraped_at) OVER d AS before_ts FROM inc1
         WINDOW d AS (PARTITION BY product_id ORDER BY obs_date)),
storedp AS (SELECT product_id, price AS prev, scraped_at AS prev_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, id DESC) AS prn FROM price_history) x
  WHERE prn = 1),
prevp AS (SELECT inc2.product_id, inc2.obs_date,
                 CASE WHEN before_ts IS NOT NULL AND (prev_ts IS NULL OR before_ts >= prev_ts) THEN before_price ELSE prev END AS prev
          FROM inc2 LEFT JOIN storedp ON inc2.product_id = storedp.product_id),
j AS (
  SELECT inc2.* EXCLUDE (before_price, before_ts), prevp.prev AS previous_price,
         {r2('inc2.price - prevp.prev')} AS price_change,
         {r2('(inc2.price - prevp.prev) / nullif(prevp.prev, 0.0) * 100.0')} AS price_change_pct,
         CASE WHEN sd.id IS NULL THEN 'insert' WHEN sd.price <> inc2.price THEN 'update' ELSE 'noop' END AS action
  FROM inc2 LEFT JOIN prevp ON inc2.product_id = prevp.product_id AND inc2.obs_date = prevp.obs_date
  LEFT JOIN price_history sd ON sd.product_id = inc2.product_id AND sd.obs_date = inc2.obs_date),
kept AS (
  SELECT h.id, h.product_id,
         CASE WHEN j.action = 'update' THEN j.price ELSE h.price END AS price,
         CASE WHEN j.action = 'update' THEN j.currency ELSE h.currency END AS currency,
         CASE WHEN j.action = 'update' THEN j.availability ELSE h.availability END AS availability,
         CASE WHEN j.action = 'update' THEN j.price_change ELSE h.price_change END AS price_change,
         CASE WHEN j.action = 'update' THEN j.price_change_pct ELSE h.price_change_pct END AS price_change_pct,
         h.scraped_at, h.obs_date
  FROM price_history h LEFT JOIN j ON j.product_id = h.product_id AND j.obs_date = h.obs_date),
insp AS (
  SELECT (SELECT coalesce(max(id), 0) FROM price_history) + row_number() OVER (ORDER BY {"obs_date, product_id" if by_days else "product_id, obs_date"}) AS id,
         product_id, price, currency, availability, price_change, price_change_pct, scraped_at, obs_date
  FROM j WHERE action = 'insert'),
nextph AS (SELECT * FROM kept UNION ALL SELECT * FROM insp)"""


SPLIT_CTE = split_cte()

_PCOLS = "id, name, brand, url, sku, category_id, store_id, created_at"
_PHCOLS = "id, product_id, price, currency, availability, price_change, price_change_pct, scraped_at, obs_date"


def _split_state(spark, d):
    """The batch, and the stored star as the first version of a state (stored once per
    session and folder, as the stars are)."""
    from pricetide.operators.state import VersionedState
    from pricetide.sources.adapters import _memo
    from pricetide.streaming.jobs import run_dir

    def stored():
        b, state = events_split(spark, d), VersionedState(spark, run_dir(spark, "split"))
        state.write(0, b.stored.products, b.stored.price_history)
        return b, state
    return _memo("split", spark, d, stored)


def _run_split(spark, d):
    """The batch merged into the state: run 1, again for each query."""
    b, state = _split_state(spark, d)
    return b, state, state.merge(b.incoming, b.run_time, version=1, run_id=1)


@query("l01_product_upsert_e", f"WITH {SPLIT_CTE}\nSELECT {_PCOLS} FROM nextp")
def l01(spark, d):
    return _run_split(spark, d)[1].read(1)[0]


@query("l02_daily_price_upsert_e", f"WITH {SPLIT_CTE}\nSELECT {_PHCOLS} FROM nextph")
def l02(spark, d):
    return _run_split(spark, d)[1].prices(1)


@query("l03_change_at_load_e", f"""WITH {SPLIT_CTE}
SELECT product_id, obs_date, price, previous_price, price_change, price_change_pct, action FROM j""")
def l03(spark, d):
    return _run_split(spark, d)[2].prices


@query("l04_surrogate_keys_e", f"WITH {SPLIT_CTE}\nSELECT id, name, store_id, action FROM nextp WHERE action <> 'keep'")
def l04(spark, d):
    return _run_split(spark, d)[2].products


def _after_batch(body: str) -> str:
    """A question's SQL over the products and prices after the batch."""
    common = COMMON_CTE.replace("FROM price_history", "FROM nextph").replace("FROM products p", "FROM nextp p")
    return f"WITH {SPLIT_CTE},{common}\n{body}"


def _questions_sql() -> dict[str, str]:
    from pricetide.plans import q_analytics as Q
    body = lambda sql: sql.split("ON p.category_id = c.id)", 1)[1]
    kpi = body(Q._sql_kpi("e")).replace("FROM products", "FROM nextp").replace("FROM price_history", "FROM nextph")
    kpi = kpi.replace(r2("avg(price)"), r2("CAST(sum(CAST(price AS DECIMAL(18,6))) AS DOUBLE) / count(*)"))
    return {"a01_kpi_rollup_e": kpi, "a08_category_rollup_e": body(Q._sql_category_summary("e")),
            "a12_store_category_rollup_e": body(Q._sql_store_category("e")), "a13_store_rollup_e": body(Q._sql_store_stats("e"))}


def _batch_star(spark, d):
    b, state, merged = _run_split(spark, d)
    return state, merged.version, b.stored.stores, b.stored.categories


@query("a01_kpi_rollup_e")
def a01_rollup(spark, d):
    """Headline numbers after the batch, from the days' roll-ups and the latest rows that the merge kept up."""
    state, *rest = _batch_star(spark, d)
    return state.kpis(*rest)


@query("a08_category_rollup_e")
def a08_rollup(spark, d):
    state, *rest = _batch_star(spark, d)
    return A.category_summary(state.star(*rest))


@query("a12_store_category_rollup_e")
def a12_rollup(spark, d):
    state, *rest = _batch_star(spark, d)
    return A.store_category_comparison(state.star(*rest))


@query("a13_store_rollup_e")
def a13_rollup(spark, d):
    state, *rest = _batch_star(spark, d)
    return A.store_detailed_stats(state.star(*rest))


_COUNTERS_SQL = """SELECT (SELECT count(*) FROM inc) AS products_found, (SELECT count(*) FROM inc) AS products_clean,
       count(*) FILTER (WHERE action = 'insert') AS inserted,
       count(*) FILTER (WHERE action = 'update') AS updated,
       count(*) FILTER (WHERE action = 'noop') AS unchanged,
       count(*) FILTER (WHERE action IN ('insert', 'update', 'noop')) AS products_saved,
       (SELECT count(*) FROM inc) - count(*) FILTER (WHERE action IN ('insert', 'update', 'noop')) AS products_failed
FROM j"""


@query("l06_load_counters_e", f"WITH {SPLIT_CTE}\n{_COUNTERS_SQL}")
def l06(spark, d):
    b, _, merged = _run_split(spark, d)
    return L.load_counters(merged.prices, b.incoming)


_SRC_SQL = """src AS (SELECT s.id AS store_id, s.name AS store_name, count(i.name) AS products
        FROM stores s LEFT JOIN inc i ON i.store_id = s.id GROUP BY s.id, s.name),
cnt AS (""" + _COUNTERS_SQL + """),
st AS (SELECT cnt.*, (SELECT count(*) FILTER (WHERE products > 0) FROM src) AS sources_ok,
              (SELECT count(*) FROM src) AS sources_total FROM cnt),
st2 AS (SELECT *, CASE WHEN products_saved > 0 AND sources_ok = sources_total THEN 'success'
                       WHEN products_saved > 0 THEN 'partial_success' ELSE 'failure' END AS status FROM st)"""


@query("l07_run_status_e", f"WITH {SPLIT_CTE},\n{_SRC_SQL}\nSELECT * FROM st2")
def l07(spark, d):
    b, _, merged = _run_split(spark, d)
    return L.run_status(L.load_counters(merged.prices, b.incoming), L.source_counts(b.incoming, b.stored.stores))


def _per_category(b):
    grid = (F.broadcast(b.stored.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name")))
            .crossJoin(F.broadcast(b.stored.categories.select(F.col("id").alias("category_id")))))  # stores x categories
    got = b.incoming.groupBy("store_id", "category_id").agg(F.count(F.lit(1)).alias("products"))
    return grid.join(got, ["store_id", "category_id"], "left").fillna(0, ["products"])


_PERCAT_SQL = """pc AS (SELECT s.name AS store_name, c.id AS category_id, count(i.name) AS products
       FROM stores s CROSS JOIN categories c LEFT JOIN inc i ON i.store_id = s.id AND i.category_id = c.id
       GROUP BY s.name, c.id),
summ AS (SELECT store_name, CAST(sum(products) AS BIGINT) AS products, count(*) FILTER (WHERE products > 0) AS categories_ok,
                count(*) FILTER (WHERE products = 0) AS categories_fail FROM pc GROUP BY store_name),
summ2 AS (SELECT *, printf('%s: %d products (%d categories ok, %d failed)', store_name, products, categories_ok,
                           categories_fail) AS message, CASE WHEN products = 0 THEN 'nothing delivered' END AS error FROM summ)"""


@query("l09_run_summary_e", f"WITH {SPLIT_CTE},\n{_PERCAT_SQL}\nSELECT * FROM summ2")
def l09(spark, d):
    b = events_split(spark, d)
    return L.run_summary(_per_category(b))


@query("l08_run_log_e", f"""WITH {SPLIT_CTE},
{_SRC_SQL},
{_PERCAT_SQL},
msg AS (SELECT st2.*, concat_ws(' | ', 'status ' || status,
                 printf('%d found -> %d clean -> %d saved, %d failed', products_found, products_clean, products_saved, products_failed),
                 (SELECT string_agg(message, ' | ' ORDER BY message) FROM summ2)) AS message FROM st2)
SELECT CAST(1 AS BIGINT) AS id, 'price_etl' AS process_name, status, substring(message, 1, {K.LOG_MESSAGE_MAX}) AS message,
       CAST(0 AS INTEGER) AS execution_time_ms, CAST(products_found AS INTEGER) AS products_found,
       CAST(products_saved AS INTEGER) AS products_saved, CAST(products_failed AS INTEGER) AS products_failed,
       {_RUN} AS created_at
FROM msg""")
def l08(spark, d):
    b, _, merged = _run_split(spark, d)
    status = L.run_status(L.load_counters(merged.prices, b.incoming), L.source_counts(b.incoming, b.stored.stores))
    msg = L.run_message(status, L.run_summary(_per_category(b)))
    return L.run_log_row(msg, F.lit(1), b.run_time, F.lit(0))


@query("l05_insert_absent_r", """WITH dim AS (SELECT * FROM (VALUES """ + ", ".join(
    f"(CAST({i} AS BIGINT), '{n}')" for i, n, *_ in K.CATEGORIES) + """) AS t(id, name)),
new AS (SELECT DISTINCT p_type AS name FROM part WHERE p_type NOT IN (SELECT name FROM dim))
SELECT id, name FROM dim
UNION ALL
SELECT (SELECT max(id) FROM dim) + row_number() OVER (ORDER BY name) AS id, name FROM new""")
def l05(spark, d):
    names = read_table(spark, d, "part").select(F.col("p_type").alias("name"))
    return L.insert_absent(categories_dim(spark).select("id", "name"), names)


@query("l10_consolidate_sources_r", None)
def l10(spark, d):
    """The three sources' results as separate inputs: each store's spellings."""
    raw = retail_listings(spark, d)
    key = CL.lookup_id(F.col("store_name"), CL.store_ids(), K.STORE_ALIASES)
    sources = L.by_source(raw.withColumn("source", key), "source", [int(i) for i, *_ in K.STORES])
    return L.consolidate(*sources).groupBy("source", "store_name").agg(F.count(F.lit(1)).alias("rows"))


@query("l11_full_run_r", None)
def l11(spark, d):
    """First run into an empty state: clean -> upsert products -> load prices."""
    from pricetide.operators.state import VersionedState
    from pricetide.streaming.jobs import run_dir
    root = run_dir(spark, "l11")
    L.run_etl(spark, retail_listings(spark, d), root, 1)
    return VersionedState(spark, root).prices(1)


def _three_runs(spark, d):
    """The scheduled run into an empty state as run 10, with the same input as run 20, and
    run 20 once more (a replay)."""
    from pricetide.streaming.jobs import run_dir
    root, raw = run_dir(spark, "l11"), retail_listings(spark, d)
    return root, [L.run_etl(spark, raw, root, k) for k in (10, 20, 20)][:2]


@query("l11_etl_runs_r", None)
def l11_runs(spark, d):
    """The run log, the number of versions, and what the second run and its replay changed
    in the state (nothing)."""
    from pricetide.operators.state import VersionedState
    root, logs = _three_runs(spark, d)
    state = VersionedState(spark, root)
    (p1, h1), (p2, h2) = state.read(1), state.read(2)
    changed = (p1.exceptAll(p2).select("id").unionAll(p2.exceptAll(p1).select("id"))
               .unionAll(h1.exceptAll(h2).select("id")).unionAll(h2.exceptAll(h1).select("id"))).select(F.count(F.lit(1))).scalar()
    return logs[0].unionByName(logs[1]).select("id", "status", "products_found", "products_saved", "products_failed", changed.alias("rows_changed_by_run_20"),
                                               F.lit(state.latest_version()).cast("bigint").alias("versions"))


@query("l09_run_counters_r", None)
def l09_counters(spark, d):
    """The summaries of runs 10 and 20: cleaner and calculator counters, counts in the message."""
    root, _ = _three_runs(spark, d)
    return L.run_summaries(spark, root).select(
        "id", "status", "products_clean", F.element_at(F.split("message", r" \| "), 2).alias("counts"),
        F.size("sources").cast("bigint").alias("n_sources"), "cleaner_stats.*", "calculator_stats.*")


# l10 / l11 oracle texts (registered after the functions to reuse the cleaning SQL)
def _late_oracles():
    from pricetide.plans.catalog import ORACLE
    ORACLE.update({key: _after_batch(body) for key, body in _questions_sql().items()})
    from pricetide.plans.q_cleaning import METRICS_SQL, OK_SQL, STAGES_CTE, STORE_SQL
    from pricetide.sources.raw import RETAIL_LISTINGS_SQL
    ORACLE["l10_consolidate_sources_r"] = (
        f"WITH raw AS ({RETAIL_LISTINGS_SQL})\nSELECT {STORE_SQL} AS source, store_name, count(*) AS rows FROM raw "
        f"WHERE {STORE_SQL} IS NOT NULL GROUP BY ALL")
    ORACLE["l11_etl_runs_r"] = f"""WITH {STAGES_CTE}
SELECT CAST(id AS BIGINT) AS id, 'success' AS status, CAST((SELECT count(*) FROM raw) AS INTEGER) AS products_found,
       CAST((SELECT count(*) FROM d2 WHERE {OK_SQL}) AS INTEGER) AS products_saved, CAST(0 AS INTEGER) AS products_failed,
       CAST(0 AS BIGINT) AS rows_changed_by_run_20, CAST(2 AS BIGINT) AS versions
FROM (VALUES (10), (20)) AS t(id)"""
    ORACLE["l09_run_counters_r"] = f"""WITH {STAGES_CTE},
m AS ({METRICS_SQL})
SELECT CAST(t.id AS BIGINT) AS id, 'success' AS status, m.rows_output AS products_clean,
       printf('%d found -> %d clean -> %d saved, 0 failed', m.rows_input, m.rows_output, m.rows_output) AS counts,
       CAST({len(K.STORES)} AS BIGINT) AS n_sources, m.*, m.rows_output AS products_processed, CAST(0 AS BIGINT) AS changes_calculated,
       m.rows_output AS first_records, CAST(0 AS BIGINT) AS price_increases, CAST(0 AS BIGINT) AS price_decreases,
       CAST(0 AS BIGINT) AS price_unchanged
FROM (VALUES (10), (20)) AS t(id), m"""
    ORACLE["l11_full_run_r"] = f"""WITH {STAGES_CTE},
cl AS (SELECT * FROM d2 WHERE {OK_SQL}),
rt AS (SELECT max(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S')) AS t FROM cl),
p AS (SELECT row_number() OVER (ORDER BY name, store_id) AS pid, * FROM cl)
SELECT row_number() OVER (ORDER BY pid, CAST(coalesce(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S'), (SELECT t FROM rt)) AS DATE)) AS id,
       pid AS product_id, price, currency, availability, CAST(NULL AS DOUBLE) AS price_change,
       CAST(NULL AS DOUBLE) AS price_change_pct,
       coalesce(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S'), (SELECT t FROM rt)) AS scraped_at,
       CAST(coalesce(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S'), (SELECT t FROM rt)) AS DATE) AS obs_date
FROM p"""


_late_oracles()

# ----------------------------------------------------------------------------
# V1 .. V7 over the events star
# ----------------------------------------------------------------------------


def _tables(spark, d):
    s = events_star(spark, d)
    return {"stores": s.stores, "categories": s.categories, "products": s.products, "price_history": s.price_history}


# The events star with violations of every rule (valid in Spark SQL and DuckDB).
DAMAGED = {
    "stores": """SELECT id, name, country, CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) AS created_at FROM {stores}
        UNION ALL SELECT CAST(4 AS BIGINT), 'Temu', CAST(NULL AS STRING), CAST(NULL AS TIMESTAMP_NTZ)
        UNION ALL SELECT CAST(5 AS BIGINT), repeat('x', 101), repeat('y', 51), CAST(NULL AS TIMESTAMP_NTZ)""",
    "categories": """SELECT id, name FROM {categories} UNION ALL SELECT CAST(6 AS BIGINT), 'purchase'
        UNION ALL SELECT CAST(7 AS BIGINT), repeat('c', 51) UNION ALL SELECT CAST(8 AS BIGINT), CAST(NULL AS STRING)""",
    "products": """SELECT id, CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN repeat(name, 40) ELSE name END AS name,
          CASE WHEN id % 53 = 0 THEN repeat(brand, 20) ELSE brand END AS brand, url, CASE WHEN id % 47 = 0 THEN repeat(sku, 30) ELSE sku END AS sku,
          CASE WHEN id % 83 = 0 THEN 99 WHEN id % 43 = 0 THEN NULL ELSE category_id END AS category_id,
          CASE WHEN id % 73 = 0 THEN 77 WHEN id % 41 = 0 THEN NULL ELSE store_id END AS store_id,
          CASE WHEN id % 37 = 0 THEN NULL ELSE created_at END AS created_at FROM {products}
        UNION ALL SELECT id + 100000000, name, brand, url, sku, category_id, store_id, created_at FROM {products} WHERE id % 101 = 0""",
    "price_history": """SELECT CASE WHEN id % 71 = 0 THEN 1 ELSE id END AS id, CASE WHEN id % 79 = 0 THEN -1 WHEN id % 31 = 0 THEN NULL ELSE product_id END AS product_id,
          CASE WHEN id % 29 = 0 THEN NULL ELSE price END AS price, CASE WHEN id % 61 = 0 THEN 'pesos de plata' WHEN id % 23 = 0 THEN NULL ELSE currency END AS currency,
          CASE WHEN id % 59 = 0 THEN NULL ELSE availability END AS availability, CASE WHEN id % 67 = 0 THEN NULL ELSE scraped_at END AS scraped_at FROM {price_history}
        UNION ALL SELECT id + 100000000, product_id, price, currency, availability, scraped_at FROM {price_history} WHERE id % 103 = 0""",
    "pipeline_logs": """SELECT CASE WHEN product_id % 3 = 0 THEN NULL WHEN product_id % 5 = 0 THEN repeat('p', 51) ELSE 'price_etl' END AS process_name,
          CASE WHEN product_id % 7 = 0 THEN NULL WHEN product_id % 11 = 0 THEN repeat('s', 21) ELSE 'success' END AS status,
          CASE WHEN product_id % 13 = 0 THEN NULL ELSE scraped_at END AS created_at FROM {price_history}""",
}


def _damaged(spark, d):
    good = _tables(spark, d)
    return {t: spark.sql(sql, **{n: df for n, df in good.items() if "{" + n + "}" in sql}) for t, sql in DAMAGED.items()}


def _damaged_sql(*bodies: str) -> str:
    ctes = ",\n".join(f"bad_{t} AS ({sql.format(**{n: n for n in DAMAGED}).replace('TIMESTAMP_NTZ', 'TIMESTAMP')})" for t, sql in DAMAGED.items())
    return f"WITH {E_CTE},\n{ctes}\n" + "\nUNION ALL ".join(bodies)


def _twice(label: str, t: str, cols: str) -> str:
    return (f"SELECT '{label}' AS constraint_name, (SELECT count(*) FROM (SELECT {cols} FROM bad_{t} GROUP BY {cols} HAVING count(*) > 1) x) AS violations")


@query("v01_uniqueness_e", _damaged_sql(
    _twice("stores.name", "stores", "name"), _twice("categories.name", "categories", "name"), _twice("products.name_store", "products", "name, store_id"),
    _twice("price_history.id", "price_history", "id"), _twice("price_history.product_scraped_at", "price_history", "product_id, scraped_at")))
def v01(spark, d):
    return L.uniqueness(_damaged(spark, d))


@query("v01_uniqueness_r", f"""WITH {R_CTE}
""" + "\nUNION ALL ".join(_twice(*x).replace("bad_", "") for x in (
    ("stores.name", "stores", "name"), ("categories.name", "categories", "name"), ("products.name_store", "products", "name, store_id"),
    ("price_history.id", "price_history", "id"), ("price_history.product_scraped_at", "price_history", "product_id, scraped_at"))))
def v01_r(spark, d):
    s = retail_star(spark, d)
    return L.uniqueness({"stores": s.stores, "categories": s.categories, "products": s.products, "price_history": s.price_history})


def _lost(label: str, child: str, parent: str) -> str:
    t, col = label.split(".")
    return (f"SELECT '{label}' AS constraint_name, (SELECT count(*) FROM bad_{child} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM bad_{parent} p WHERE p.id = c.{col})) AS violations")


@query("v02_orphans_e", _damaged_sql(_lost("products.category_id", "products", "categories"), _lost("products.store_id", "products", "stores"),
                                     _lost("price_history.product_id", "price_history", "products")))
def v02(spark, d):
    return L.orphans(_damaged(spark, d))


def _where(t: str, c: str, cond: str) -> str:
    return f"SELECT '{t}.{c}' AS column_name, (SELECT count(*) FROM bad_{t} WHERE {cond}) AS violations"


@query("v03_not_null_e", _damaged_sql(*[_where(t, c, f"{c} IS NULL") for t, cols in L.NOT_NULL.items() for c in cols]))
def v03(spark, d):
    return L.null_counts(_damaged(spark, d))


@query("v04_length_e", _damaged_sql(*[_where(t, c, f"length({c}) > {n}") for t, cols in L.MAX_LEN.items() for c, n in cols.items()]))
def v04(spark, d):
    return L.length_violations(_damaged(spark, d))


@query("v05_delete_cascade_e", f"""WITH {E_CTE}
SELECT 'products' AS table_name, count(*) AS rows FROM products WHERE category_id <> 2
UNION ALL SELECT 'price_history', count(*) FROM price_history h
  WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.id = h.product_id AND p.category_id = 2)""")
def v05(spark, d):
    t = _tables(spark, d)
    after = L.delete_products(t, t["products"].filter(F.col("category_id") == 2))
    return (after["products"].agg(F.count(F.lit(1)).alias("rows")).select(F.lit("products").alias("table_name"), "rows")
            .unionByName(after["price_history"].agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit("price_history").alias("table_name"), "rows")))


@query("v06_dims_in_use_r", """WITH li AS (
  SELECT l.l_partkey, CAST(n.n_regionkey AS BIGINT) AS store_id FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
categories AS (SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id, name
               FROM (SELECT DISTINCT p_type AS name FROM part) d),
used_c AS (SELECT DISTINCT c.id FROM li JOIN part p ON li.l_partkey = p.p_partkey JOIN categories c ON c.name = p.p_type),
used_s AS (SELECT DISTINCT store_id AS id FROM li)
SELECT 'categories' AS table_name, c.id, c.name, c.id IN (SELECT id FROM used_c) AS in_use,
       NOT (c.id IN (SELECT id FROM used_c)) AS deletable FROM categories c
UNION ALL
SELECT 'stores', CAST(r_regionkey AS BIGINT), r_name, CAST(r_regionkey AS BIGINT) IN (SELECT id FROM used_s),
       NOT (CAST(r_regionkey AS BIGINT) IN (SELECT id FROM used_s)) FROM region""")
def v06(spark, d):
    s = retail_star(spark, d)
    return L.dims_in_use({"stores": s.stores, "categories": s.categories, "products": s.products})


@query("v07_default_fill_r", """SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
       CASE WHEN r_regionkey % 2 = 1 THEN 'México' ELSE r_name END AS country
FROM region""")
def v07(spark, d):
    region = read_table(spark, d, "region")
    stores = region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"),
                           F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")).alias("country"))
    return L.fill_defaults(stores, "stores", F.current_timestamp()).select("id", "name", "country")


@query("v07_default_fill_e", f"""WITH {E_CTE}
SELECT id, coalesce(CASE WHEN id % 3 <> 0 THEN currency END, '{K.BASE_CURRENCY}') AS currency,
       coalesce(CASE WHEN id % 5 <> 0 THEN availability END, TRUE) AS availability,
       coalesce(CASE WHEN id % 7 <> 0 THEN scraped_at END, (SELECT max(ts) FROM events)) AS scraped_at FROM price_history""")
def v07_e(spark, d):
    s = events_star(spark, d)
    gap = lambda c, k: F.when(F.col("id") % k != 0, F.col(c)).alias(c)
    rows = s.price_history.select("id", gap("currency", 3), gap("availability", 5), gap("scraped_at", 7))
    return L.fill_defaults(rows, "price_history", s.as_of)


# ----------------------------------------------------------------------------
# Sources and sinks
# ----------------------------------------------------------------------------


_RAW_COLS = "name, brand, price, currency, availability, url, sku, store_name, category, scraped_at"


@query("s01_raw_records_r", None)
def s01(spark, d):
    """Raw records written as JSON lines and read with the fixed schema."""
    from pricetide.sources.raw import read_raw
    from pricetide.streaming.jobs import run_dir
    path = run_dir(spark, "s01")
    retail_listings(spark, d).select(*_RAW_COLS.split(", ")).write.json(path)
    return read_raw(spark, path, "json")


@query("s05_create_if_absent_e", f"WITH {E_CTE}\nSELECT CAST(id AS BIGINT) AS id, name FROM categories")
def s05(spark, d):
    """A table that is made if absent, filled, and left as it is when made again."""
    from pricetide.streaming.jobs import run_dir
    path, schema = run_dir(spark, "s05"), "id bigint, name string"
    empty = L.ensure_table(spark, path, schema)
    assert empty.isEmpty()
    events_star(spark, d).categories.write.mode("append").parquet(path)
    return L.ensure_table(spark, path, schema)


@query("s06_append_e", f"WITH {E_CTE}\nSELECT {_PHCOLS} FROM price_history")
def s06(spark, d):
    """Price history appended in two parts, partitioned by day."""
    from pricetide.streaming.jobs import VersionedState, run_dir
    path, h = run_dir(spark, "s06"), events_star(spark, d).price_history
    for part in (0, 1):
        L.append_rows(h.filter(F.col("product_id") % 2 == part), path)
    return spark.read.schema(VersionedState.PRICES).parquet(path)


@query("s08_row_counts_r", f"""WITH {R_CTE}
SELECT 'products' AS table_name, count(*) AS rows FROM products UNION ALL SELECT 'price_history', count(*) FROM price_history""")
def s08(spark, d):
    s = retail_star(spark, d)
    one = lambda name, df: L.row_count(df).select(F.lit(name).alias("table_name"), "rows")
    return one("products", s.products).unionByName(one("price_history", s.price_history))


def _raw_oracle():
    from pricetide.plans.catalog import ORACLE
    from pricetide.sources.raw import RETAIL_LISTINGS_SQL
    ORACLE["s01_raw_records_r"] = f"WITH raw AS ({RETAIL_LISTINGS_SQL})\nSELECT {_RAW_COLS} FROM raw"


_raw_oracle()
