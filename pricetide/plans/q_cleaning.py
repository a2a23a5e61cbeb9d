"""Registered cleaning queries C1-C14 (documents and retail listings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import KEEP_CLASS, WS_CLASS, clean_name
from pricetide.operators import cleaning as CL
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import r2
from pricetide.sources.raw import RETAIL_LISTINGS_SQL, retail_listings
from pricetide.sources.tables import read_table, spread


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def clean_name_sql(c: str, max_chars: int = K.NAME_MAX_CHARS) -> str:
    s = strip_sql(f"CAST({c} AS VARCHAR)")
    s = f"regexp_replace({s}, '{WS_CLASS}+', ' ', 'g')"
    s = f"regexp_replace({s}, '[\\x{{0}}-\\x{{1F}}]', '', 'g')"
    s = f"regexp_replace({s}, '[^{KEEP_CLASS}]', '', 'g')"
    first = f"CASE WHEN substring({s}, 1, 1) = 'ß' THEN 'SS' ELSE upper(substring({s}, 1, 1)) END"
    return f"substring({first} || substring({s}, 2), 1, {max_chars})"


def lookup_sql(c: str, ids: dict, aliases: dict) -> str:
    exact = "CASE " + c + " " + " ".join(f"WHEN {_sq(k)} THEN {v}" for k, v in ids.items()) + " END"
    al = {a: ids[n] for a, n in aliases.items() if n in ids}
    alias = ("CASE lower(" + strip_sql(c) + ") " +
             " ".join(f"WHEN {_sq(k)} THEN {v}" for k, v in al.items()) + " END")
    return f"CAST(coalesce({exact}, {alias}) AS BIGINT)"


CAT_SQL = lookup_sql("category", CL.category_ids(), K.CATEGORY_ALIASES)
STORE_SQL = lookup_sql("store_name", CL.store_ids(), K.STORE_ALIASES)
LO_SQL = "CASE category_id " + " ".join(f"WHEN {i} THEN {float(a)}" for i, _, a, _ in K.CATEGORIES) + " END"
HI_SQL = "CASE category_id " + " ".join(f"WHEN {i} THEN {float(b)}" for i, _, _, b in K.CATEGORIES) + " END"
OK_SQL = f"(price IS NOT NULL AND NOT isnan(price) AND price > 0 AND (({LO_SQL}) IS NULL OR price BETWEEN {LO_SQL} AND {HI_SQL}))"

RAW_CTE = f"raw AS ({RETAIL_LISTINGS_SQL})"
STAGES_CTE = f"""{RAW_CTE},
named AS (SELECT * REPLACE ({clean_name_sql('name')} AS name) FROM raw),
mapped AS (SELECT *, {CAT_SQL} AS category_id, {STORE_SQL} AS store_id FROM named WHERE length(name) > 0),
conv AS (SELECT * REPLACE (
           CASE WHEN upper(currency) = 'USD' THEN {r2(f'price * {K.USD_TO_MXN}')} ELSE price END AS price,
           CASE WHEN upper(currency) = 'USD' THEN '{K.BASE_CURRENCY}' ELSE currency END AS currency),
           price AS price_original
         FROM mapped WHERE category_id IS NOT NULL AND store_id IS NOT NULL AND upper(currency) IN ('USD', 'MXN')),
d1 AS (SELECT * EXCLUDE (rn1) FROM (
         SELECT *, row_number() OVER (PARTITION BY name, store_id
            ORDER BY scraped_at DESC, price ASC, sku DESC, url DESC, brand DESC, currency DESC) AS rn1 FROM conv) x
       WHERE rn1 = 1),
d2 AS (SELECT * FROM d1 WHERE url IS NULL OR url = ''
       UNION ALL
       SELECT * EXCLUDE (rn2) FROM (
         SELECT *, row_number() OVER (PARTITION BY url, store_id ORDER BY scraped_at DESC, name ASC, price ASC) AS rn2
         FROM d1 WHERE url <> '') y WHERE rn2 = 1)"""

_OUT = "name, store_id, category_id, price, currency, url, sku, scraped_at"


def _raw(spark, d):
    return retail_listings(spark, d)


def _staged(spark, d):
    raw = _raw(spark, d)
    return CL.convert_currencies(CL.map_stores(CL.map_categories(CL.normalize_names(raw))))


@query("c01_names_documents", f"""
SELECT doc_id, name FROM (SELECT doc_id, {clean_name_sql('text', 1 << 30)} AS name FROM documents) x
WHERE length(name) > 0""")
def c01(spark, d):
    docs = spread(read_table(spark, d, "documents").select("doc_id", "text"))
    return CL.normalize_names(docs.withColumnRenamed("text", "name"), max_chars=None).select("doc_id", "name")


@query("c01_names_listings_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber, name FROM (
  SELECT l_orderkey, l_linenumber, {clean_name_sql('name')} AS name FROM raw) x WHERE length(name) > 0""")
def c01_r(spark, d):
    return CL.normalize_names(_raw(spark, d)).select("l_orderkey", "l_linenumber", "name")


@query("c02_category_lookup_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber, category, category_id FROM (
  SELECT l_orderkey, l_linenumber, category, {CAT_SQL} AS category_id FROM raw) x WHERE category_id IS NOT NULL""")
def c02(spark, d):
    return CL.map_categories(_raw(spark, d)).select("l_orderkey", "l_linenumber", "category", "category_id")


@query("c03_store_lookup_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber, store_name, store_id FROM (
  SELECT l_orderkey, l_linenumber, store_name, {STORE_SQL} AS store_id FROM raw) x WHERE store_id IS NOT NULL""")
def c03(spark, d):
    return CL.map_stores(_raw(spark, d)).select("l_orderkey", "l_linenumber", "store_name", "store_id")


@query("c04_currency_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber, price AS price_original,
       CASE WHEN upper(currency) = 'USD' THEN {r2(f'price * {K.USD_TO_MXN}')} ELSE price END AS price,
       CASE WHEN upper(currency) = 'USD' THEN '{K.BASE_CURRENCY}' ELSE currency END AS currency
FROM raw WHERE upper(currency) IN ('USD', 'MXN')""")
def c04(spark, d):
    return CL.convert_currencies(_raw(spark, d)).select("l_orderkey", "l_linenumber", "price_original", "price",
                                                        "currency")


@query("c05_dedup_name_r", f"WITH {STAGES_CTE}\nSELECT {_OUT} FROM d1")
def c05(spark, d):
    return CL.dedup_by_name(_staged(spark, d)).select(*_OUT.split(", "))


@query("c06_dedup_url_r", f"WITH {STAGES_CTE}\nSELECT {_OUT} FROM d2")
def c06(spark, d):
    return CL.dedup_by_url(CL.dedup_by_name(_staged(spark, d))).select(*_OUT.split(", "))


@query("c07_price_range_r", f"""WITH {RAW_CTE},
m AS (SELECT l_orderkey, l_linenumber, price, {CAT_SQL} AS category_id FROM raw)
SELECT l_orderkey, l_linenumber, category_id, price FROM m WHERE category_id IS NOT NULL AND {OK_SQL}""")
def c07(spark, d):
    return CL.validate_prices(CL.map_categories(_raw(spark, d))).select("l_orderkey", "l_linenumber",
                                                                          "category_id", "price")


@query("c09_clean_all_r", f"WITH {STAGES_CTE}\nSELECT {_OUT}, price_original FROM d2 WHERE {OK_SQL}")
def c09(spark, d):
    return CL.clean_all(_raw(spark, d)).data.select(*_OUT.split(", "), "price_original")


METRICS_SQL = f"""SELECT (SELECT count(*) FROM raw) AS rows_input,
       (SELECT count(*) FROM named WHERE length(name) > 0) AS rows_after_normalize,
       (SELECT count(*) FROM mapped WHERE category_id IS NULL) AS unmapped_categories,
       (SELECT count(*) FROM mapped WHERE category_id IS NOT NULL) AS rows_after_category_map,
       (SELECT count(*) FROM mapped WHERE category_id IS NOT NULL AND store_id IS NULL) AS unmapped_stores,
       (SELECT count(*) FROM mapped WHERE category_id IS NOT NULL AND store_id IS NOT NULL) AS rows_after_store_map,
       (SELECT count(*) FROM mapped WHERE category_id IS NOT NULL AND store_id IS NOT NULL
          AND upper(currency) = 'USD') AS prices_converted,
       (SELECT count(*) FROM conv) AS rows_after_currency,
       (SELECT count(*) FROM d2) AS rows_after_dedup,
       (SELECT count(*) FROM d2 WHERE NOT {OK_SQL}) AS invalid_prices,
       (SELECT count(*) FROM d2 WHERE {OK_SQL}) AS rows_output,
       (SELECT count(*) FROM conv) - (SELECT count(*) FROM d2) AS duplicates_removed,
       (SELECT count(*) FROM d2 WHERE {OK_SQL}) AS rows_after_validation"""


@query("c10_clean_metrics_r", f"WITH {STAGES_CTE}\n{METRICS_SQL}")
def c10(spark, d):
    return CL.clean_all(_raw(spark, d)).metrics


REJECTS_SQL = f"""early AS (
  SELECT CASE WHEN length(n.name) = 0 OR n.name IS NULL THEN 'empty_name'
              WHEN {CAT_SQL.replace('category', 'n.category')} IS NULL THEN 'unmapped_category'
              WHEN {STORE_SQL.replace('store_name', 'n.store_name')} IS NULL THEN 'unmapped_store'
              WHEN NOT coalesce(upper(n.currency) IN ('USD', 'MXN'), FALSE) THEN 'unsupported_currency' END AS reason,
         n.category, n.store_name, n.currency
  FROM named n),
rej AS (
  SELECT reason, CASE reason WHEN 'unmapped_category' THEN category WHEN 'unmapped_store' THEN store_name
                             WHEN 'unsupported_currency' THEN currency END AS value
  FROM early WHERE reason IS NOT NULL
  UNION ALL SELECT 'duplicate', NULL FROM conv
  UNION ALL SELECT 'invalid_price', NULL FROM d2 WHERE NOT {OK_SQL})
SELECT reason AS reject_reason, value, count(*) - CASE WHEN reason = 'duplicate' THEN (SELECT count(*) FROM d2) ELSE 0 END AS rows
FROM rej GROUP BY reason, value"""


@query("c11_reject_summary_r", f"WITH {STAGES_CTE},\n{REJECTS_SQL}")
def c11(spark, d):
    return CL.reject_summary(CL.rejects(_raw(spark, d)))


# a record is cut in the middle, or its price is no number
_CUT_LINE, _BAD_PRICE = "l_orderkey % 97 = 3", "l_orderkey % 89 = 5 AND l_linenumber > 1"


@query("c11_damaged_records_r", f"""WITH {STAGES_CTE.replace(RAW_CTE, f"raw AS (SELECT * FROM ({RETAIL_LISTINGS_SQL}) r WHERE NOT ({_CUT_LINE} OR {_BAD_PRICE}))")},
rejected AS ({REJECTS_SQL.replace("early AS (", "SELECT * FROM (WITH early AS (", 1)}) z)
SELECT * FROM rejected
UNION ALL SELECT 'malformed_record', NULL, count(*) FROM ({RETAIL_LISTINGS_SQL}) r WHERE {_CUT_LINE} OR {_BAD_PRICE} HAVING count(*) > 0""")
def c11_damaged(spark, d):
    """Rejects of a source with damaged JSON lines: what can't be read is a reject as well."""
    from pricetide.sources.raw import RAW_SCHEMA, read_raw_checked
    from pricetide.streaming.jobs import run_dir
    path = run_dir(spark, "c11")
    line = F.to_json(F.struct(*[c.split()[0] for c in RAW_SCHEMA.split(", ")]))
    cut = F.when(F.expr(_CUT_LINE), F.substring(line, 1, 40)).when(F.expr(_BAD_PRICE), F.regexp_replace(line, '"price":[^,]*', '"price":"sold out"'))
    _raw(spark, d).select(F.coalesce(cut, line).alias("value")).write.text(path)
    good, damaged = read_raw_checked(spark, path)
    return CL.reject_summary(CL.rejects(good, damaged))


@query("c11_out_of_range_examples_r", f"""WITH {STAGES_CTE},
bad AS (SELECT DISTINCT category_id, name FROM d2 WHERE price > 0 AND ({LO_SQL}) IS NOT NULL
        AND NOT (price BETWEEN {LO_SQL} AND {HI_SQL}))
SELECT category_id, name, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY name) AS rn FROM bad) x WHERE rn <= 3""")
def c11_examples(spark, d):
    raw = _raw(spark, d)
    staged = CL.convert_currencies(CL.map_stores(CL.map_categories(CL.normalize_names(raw))))
    return CL.out_of_range_examples(CL.dedup_by_url(CL.dedup_by_name(staged)))


@query("c12_clamp_r", f"""WITH {RAW_CTE},
m AS (SELECT l_orderkey, l_linenumber, price, {CAT_SQL} AS category_id FROM raw)
SELECT l_orderkey, l_linenumber, category_id,
       CASE WHEN ({LO_SQL}) IS NULL THEN price ELSE greatest({LO_SQL}, least({HI_SQL}, price)) END AS price
FROM m WHERE category_id IS NOT NULL""")
def c12(spark, d):
    return CL.clamp_to_range(CL.map_categories(_raw(spark, d))).select("l_orderkey", "l_linenumber",
                                                                         "category_id", "price")


@query("c13_ts_parse_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber,
       coalesce(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S'),
                (SELECT max(try_strptime(scraped_at, '%Y-%m-%d %H:%M:%S')) FROM raw)) AS scraped_ts
FROM raw""")
def c13(spark, d):
    raw = _raw(spark, d)
    default = raw.select(F.max(F.try_to_timestamp(F.col("scraped_at"), F.lit("yyyy-MM-dd HH:mm:ss"))
                               .cast("timestamp_ntz"))).scalar()
    return CL.parse_times(raw, default).select("l_orderkey", "l_linenumber", "scraped_ts")


@query("c14_null_safe_strings_r", f"""WITH {RAW_CTE}
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'NaN' ELSE brand END AS brand, url, sku,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) || '.0' END AS size
FROM raw""")
def c14(spark, d):
    n = F.col("l_linenumber")
    raw = _raw(spark, d).withColumn("brand", F.when(n == 1, None).when(n == 2, "NaN").otherwise(F.col("brand")))
    raw = raw.withColumn("size", F.when(n == 3, float("nan")).otherwise(n.cast("double")))
    return CL.null_safe_strings(raw, ["brand", "url", "sku", "size"]).select(
        "l_orderkey", "l_linenumber", "brand", "url", "sku", "size")
