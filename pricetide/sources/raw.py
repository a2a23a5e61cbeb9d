"""Raw listing records (S1) and their derivation from the driver's tables.

``RAW_SCHEMA`` is the 10-field listing record an extraction run emits.
``read_raw`` reads such records from json / csv / parquet with the explicit
schema (no inference).  ``retail_listings`` derives one raw record per
lineitem so the cleaning chain runs over data that grows with the tables; the
spelling of store, category and currency varies by key the way scraped text
does, so every cleaning branch (aliases, unmapped values, unsupported
currency, zero price, blank url, unparsable time) is exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.functions import round2
from pricetide.session import written
from pricetide.sources.tables import read_table, spread

RAW_SCHEMA = ("name string, brand string, price double, currency string, availability boolean, "
              "url string, sku string, store_name string, category string, scraped_at string")

# FIXED VALUES of the derivation (index = key modulo list length)
STORE_SPELLINGS = ["Mercado Libre", "AliExpress", "Temu", "mercadolibre", " ML ", "ali_express", "TEMU", "Amazon"]
CATEGORY_SPELLINGS = ["CPUs", "GPUs", "RAM", "SSD", "Laptops", "Monitores", "Placas madre", "cpus", " Laptop ",
                      "memory"]
CURRENCY_BY_REGION = ["MXN", "USD", "usd", "mxn", "EUR"]


def read_raw(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw listing records with the fixed schema; an empty source gives an
    empty frame with the same columns."""
    return spark.read.schema(RAW_SCHEMA).format(fmt).option("header", "true").load(path)


CORRUPT = "corrupt_record"


def read_raw_checked(spark: SparkSession, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """S1 on sources that may be damaged: the readable records, and the records (column
    ``corrupt_record``, whole text) that do not fit the fixed schema: cut lines, or a
    value of another type.  Every record is in one of the two."""
    rows = (spark.read.schema(f"{RAW_SCHEMA}, {CORRUPT} string").format(fmt).option("header", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(path))
    rows = written(rows, "records")          # parsed once; Spark refuses plans that parse for the damaged text alone
    bad = F.col(CORRUPT).isNotNull()
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(CORRUPT)


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def retail_listings(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """One raw listing per lineitem (plus the row keys l_orderkey, l_linenumber).
    ``lineitem`` may be a stream; the other tables are static dimensions."""
    li = (lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_shipdate")
    if not li.isStreaming:
        li = spread(li)       # the per-row text work below is CPU-heavy
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sup = supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey)  # nation: 25 rows
    j = li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
    ln = F.col("l_linenumber")
    name = (F.when(ln % 4 == 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
             .when(ln % 4 == 1, F.col("p_name"))
             .when(ln % 4 == 2, F.concat(F.col("p_name"), F.lit(" ®")))
             .otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("\t"))))
    price = F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(
        round2(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))))
    ts = F.timestamp_add("SECOND", F.col("l_orderkey") % 86400, F.col("l_shipdate"))
    scraped = F.when(ln == 7, F.date_format(ts, "dd/MM/yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    return j.select(
        "l_orderkey", "l_linenumber",
        name.alias("name"), F.col("p_brand").alias("brand"), price.alias("price"),
        _pick(CURRENCY_BY_REGION, F.col("n_regionkey")).alias("currency"),
        (price > 0).alias("availability"),
        F.when(ln <= 2, F.concat(F.lit("/item/"), F.col("l_partkey").cast("string"), F.lit(".html")))
         .otherwise(F.lit("")).alias("url"),
        F.concat(F.lit("MLM-"), F.col("l_partkey").cast("string")).alias("sku"),
        _pick(STORE_SPELLINGS, F.col("l_suppkey")).alias("store_name"),
        _pick(CATEGORY_SPELLINGS, F.col("l_partkey")).alias("category"),
        scraped.alias("scraped_at"))


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pick_sql(values: list[str], idx: str) -> str:
    return f"([{', '.join(_sq(v) for v in values)}])[({idx}) % {len(values)} + 1]"


RETAIL_LISTINGS_SQL = f"""
SELECT l.l_orderkey, l.l_linenumber,
       CASE l.l_linenumber % 4 WHEN 0 THEN '  ' || p.p_name || ' ' WHEN 1 THEN p.p_name
            WHEN 2 THEN p.p_name || ' ' || chr(174) ELSE replace(p.p_name, ' ', chr(9)) END AS name,
       p.p_brand AS brand,
       CASE WHEN l.l_discount = 0 THEN 0.0
            ELSE floor((l.l_extendedprice / nullif(l.l_quantity, 0.0)) * 1e2 + 5e-1) / 1e2 END AS price,
       {_pick_sql(CURRENCY_BY_REGION, 'n.n_regionkey')} AS currency,
       CASE WHEN l.l_discount = 0 THEN FALSE
            ELSE floor((l.l_extendedprice / nullif(l.l_quantity, 0.0)) * 1e2 + 5e-1) / 1e2 > 0 END AS availability,
       CASE WHEN l.l_linenumber <= 2 THEN '/item/' || CAST(l.l_partkey AS VARCHAR) || '.html' ELSE '' END AS url,
       'MLM-' || CAST(l.l_partkey AS VARCHAR) AS sku,
       {_pick_sql(STORE_SPELLINGS, 'l.l_suppkey')} AS store_name,
       {_pick_sql(CATEGORY_SPELLINGS, 'l.l_partkey')} AS category,
       CASE WHEN l.l_linenumber = 7
            THEN strftime(l.l_shipdate + to_seconds(l.l_orderkey % 86400), '%d/%m/%Y')
            ELSE strftime(l.l_shipdate + to_seconds(l.l_orderkey % 86400), '%Y-%m-%d %H:%M:%S') END AS scraped_at
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""
