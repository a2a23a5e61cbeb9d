"""Cleaning chain (C1-C14): raw listing records -> conformed records.

Lookups (category, store, price range) are fixed-size dictionaries, so they
are evaluated as literal map expressions (``try_element_at`` on a ``map``
literal): no join, no shuffle, no broadcast.  De-duplication by name is a hash
aggregate (``max_by`` with partial aggregation), by url a row_number with a group
limit, so a name or url holding a third of the rows is trimmed map-side instead of
landing in one window partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import clamp, in_range, parse_scraped_at, round2, strip_ws, with_clean_name
from pricetide.session import checkpoint_dir


def _map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def category_ids(categories=K.CATEGORIES) -> dict[str, int]:
    return {name: int(i) for i, name, *_ in categories}


def store_ids(stores=K.STORES) -> dict[str, int]:
    return {name: int(i) for i, name, *_ in stores}


# ----------------------------------------------------------------------------
# C1 .. C8
# ----------------------------------------------------------------------------


def normalize_names(df: DataFrame, col: str = "name", max_chars: int | None = K.NAME_MAX_CHARS) -> DataFrame:
    """Clean the name column and drop rows whose cleaned name is empty
    (NULL names are dropped as well).  ``max_chars`` is the length limit of product
    names; None keeps whole texts."""
    return (with_clean_name(df, col, (1 << 30) if max_chars is None else max_chars)
            .filter(F.length(F.col(col)) > 0).select(*df.columns))


def lookup_id(value: Column, ids: dict[str, int], aliases: dict[str, str]) -> Column:
    """Exact (case-sensitive, untrimmed) name first, then the lower-cased,
    trimmed alias; NULL when neither maps."""
    alias_ids = {a: ids[n] for a, n in aliases.items() if n in ids}
    return F.coalesce(F.try_element_at(_map(ids), value),
                      F.try_element_at(_map(alias_ids), F.lower(strip_ws(value)))).cast("bigint")


def map_categories(df: DataFrame, categories=K.CATEGORIES, aliases=K.CATEGORY_ALIASES) -> DataFrame:
    """Category text -> category_id; unmapped rows are dropped."""
    return (df.withColumn("category_id", lookup_id(F.col("category"), category_ids(categories), aliases))
              .filter(F.col("category_id").isNotNull()))


def map_stores(df: DataFrame, stores=K.STORES, aliases=K.STORE_ALIASES) -> DataFrame:
    """Store text -> store_id; unmapped rows are dropped."""
    return (df.withColumn("store_id", lookup_id(F.col("store_name"), store_ids(stores), aliases))
              .filter(F.col("store_id").isNotNull()))


def convert_currencies(df: DataFrame, rate: float = K.USD_TO_MXN) -> DataFrame:
    """C4: keep ``price_original``; USD (any case) -> price * rate rounded to
    cents and currency 'MXN'; MXN (any case) untouched; others dropped."""
    return in_base_currency(df.filter(F.upper(F.col("currency")).isin(*K.SUPPORTED_CURRENCIES)), rate)


def in_base_currency(df: DataFrame, rate: float = K.USD_TO_MXN) -> DataFrame:
    """The conversion of C4 alone: rows of other currencies stay as they are."""
    usd = F.upper(F.col("currency")) == "USD"
    return (df.withColumn("price_original", F.col("price"))
              .withColumn("price", F.when(usd, round2(F.col("price") * F.lit(float(rate)))).otherwise(F.col("price")))
              .withColumn("currency", F.when(usd, F.lit(K.BASE_CURRENCY)).otherwise(F.col("currency"))))


def dedup_by_name(df: DataFrame, also: list[str] = (), counts: dict[str, Column] | None = None) -> DataFrame:
    """One row per (name, store_id): newest scraped_at, then lowest price
    (remaining ties: highest sku, url, brand, currency).  Columns ``also`` belong to the key
    too; the aggregates ``counts`` are taken over all rows of a key."""
    key, counts = ["name", "store_id", *also], counts or {}
    cols = [c for c in df.columns if c not in key]
    order = F.struct(F.col("scraped_at"), -F.col("price"), F.col("sku"), F.col("url"), F.col("brand"),
                     F.col("currency"))
    return (df.groupBy(*key)
              .agg(F.max_by(F.struct(*cols), order).alias("r"), *[c.alias(n) for n, c in counts.items()])
              .select(*key, "r.*", *counts)
              .select(*df.columns, *counts))


def dedup_by_url(df: DataFrame) -> DataFrame:
    """Among rows with a non-empty url, one row per (url, store_id): newest
    scraped_at, then the smallest name; rows without url pass through (C5 has left one
    row per name and store, so the name makes each of them a group of its own).

    One row_number for all rows: its group limit lets every task keep one row of a hot
    url before the shuffle."""
    has_url = F.coalesce(F.col("url") != "", F.lit(False))
    w = (Window.partitionBy("url", "store_id", F.when(~has_url, F.col("name")))
         .orderBy(F.desc("scraped_at"), "name", "price"))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def price_range(category_id: Column, categories=K.CATEGORIES) -> tuple[Column, Column]:
    lo = _map({int(i): float(a) for i, _, a, _ in categories})
    hi = _map({int(i): float(b) for i, _, _, b in categories})
    return F.try_element_at(lo, category_id), F.try_element_at(hi, category_id)


def price_ok(price: Column, category_id: Column, categories=K.CATEGORIES) -> Column:
    """Positive, not NaN, and inside the inclusive range of the category
    (a category without a range accepts every positive price)."""
    lo, hi = price_range(category_id, categories)
    return (price.isNotNull() & ~F.isnan(price) & (price > 0) & in_range(price, lo, hi))


def validate_prices(df: DataFrame, categories=K.CATEGORIES) -> DataFrame:
    """Drop non-positive / missing prices and prices outside the range."""
    return df.filter(price_ok(F.col("price"), F.col("category_id"), categories))


# ----------------------------------------------------------------------------
# C9 .. C14
# ----------------------------------------------------------------------------


@dataclass
class Cleaned:
    data: DataFrame
    metrics: DataFrame


def clean_all(raw: DataFrame, rate: float = K.USD_TO_MXN) -> Cleaned:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6 -> C7, plus the C10 counters."""
    flagged = flag_stateless(raw)
    deduped = dedup_flagged(flagged, rate)
    return Cleaned(validate_prices(deduped), cleaning_metrics(flagged, deduped))


def dedup_flagged(flagged: DataFrame, rate: float = K.USD_TO_MXN) -> DataFrame:
    """C4-C6 over the rows that passed C1-C4's checks."""
    staged = (flagged.filter("__name_ok AND __cat_ok AND __store_ok AND __cur_ok")
                     .drop("__name_ok", "__cat_ok", "__store_ok", "__cur_ok"))
    return dedup_by_url(dedup_by_name(convert_currencies(staged, rate)))


def clean_observed(raw: DataFrame, rate: float = K.USD_TO_MXN, cols: list[str] | None = None) -> tuple[DataFrame, dict]:
    """C9 with its C10 counters: the cleaned rows (``cols`` of them; default: all), and the
    counters with what each store (from_<store>) and each of its categories
    (from_<store>_<category>) delivered.

    C5's aggregate counts the rows that it puts together, and those that C1-C4 drop are a
    few more keys of it (their name is NULL), so the raw rows pass once, none is written
    before it is thinned, and the sums are exact when tasks are repeated.  The counters of
    C6 and C7 are observed in the last stage of a write, where Spark counts each task once."""
    from pyspark.sql import Observation
    from pricetide.session import written
    kept, ok = Observation(), F.expr(" AND ".join(FLAGS))
    rows = in_base_currency(flag_stateless(raw).withColumn("__usd", F.coalesce(F.upper("currency") == "USD", F.lit(False))), rate)
    cols = cols or [c for c in rows.columns if c not in (*FLAGS, "__usd")]
    rows = rows.select(*cols, *FLAGS, "__usd").withColumn("name", F.when(ok, F.col("name")))
    counts = {"__rows": F.count(F.lit(1)), "__converted": F.count_if("__usd"),
              **{f"__of_{c}": F.count_if(F.col("category_id") == c) for c in category_ids().values()}}
    named = written(dedup_by_name(rows, FLAGS, counts), "named")
    n = named.agg(*row_counts("__rows", "__converted"), *delivered_counts()).first().asDict()
    deduped = dedup_by_url(named.where(ok).select(*cols))
    data = written(validate_prices(deduped.observe(kept, *dedup_counts())), "cleaned")
    n |= kept.get
    n["duplicates_removed"] = n["rows_after_currency"] - n["rows_after_dedup"]
    n["rows_after_validation"] = n["rows_output"]
    return data, n


FLAGS = ["__name_ok", "__cat_ok", "__store_ok", "__cur_ok"]


def flag_stateless(raw: DataFrame) -> DataFrame:
    """Row-wise outcome of the stateless steps C1-C4 as boolean flags (names,
    ids and the cleaned name are computed once)."""
    d = with_clean_name(raw, "name", more={
        "category_id": lookup_id(F.col("category"), category_ids(), K.CATEGORY_ALIASES),
        "store_id": lookup_id(F.col("store_name"), store_ids(), K.STORE_ALIASES)})
    return d.select("*", F.coalesce(F.length("name") > 0, F.lit(False)).alias("__name_ok"),
                    F.col("category_id").isNotNull().alias("__cat_ok"),
                    F.col("store_id").isNotNull().alias("__store_ok"),
                    F.coalesce(F.upper("currency").isin(*K.SUPPORTED_CURRENCIES), F.lit(False)).alias("__cur_ok"))


def _total(number: str, where: Column) -> Column:
    return F.coalesce(F.sum(F.when(where, F.col(number))), F.lit(0)).cast("bigint")


def row_counts(rows: str | None = None, converted: str | None = None) -> list[Column]:
    """C10 counters over the rows of ``flag_stateless``, or over groups of them, whose columns
    ``rows`` and ``converted`` hold the number of all rows and of those in USD."""
    n, c, s, cu = (F.col(x) for x in FLAGS)
    some = lambda where: F.count_if(where) if rows is None else _total(rows, where)
    usd = F.count_if(n & c & s & (F.upper("currency") == "USD")) if converted is None else _total(converted, n & c & s)
    return [some(F.lit(True)).alias("rows_input"),
            some(n).alias("rows_after_normalize"),
            some(n & ~c).alias("unmapped_categories"),
            some(n & c).alias("rows_after_category_map"),
            some(n & c & ~s).alias("unmapped_stores"),
            some(n & c & s).alias("rows_after_store_map"),
            usd.alias("prices_converted"),
            some(n & c & s & cu).alias("rows_after_currency")]


def delivered_counts() -> list[Column]:
    """What each store, and each of its categories, delivered: a fixed number of counters over
    the groups of ``clean_observed``."""
    cats, stores = category_ids().values(), store_ids().values()
    return [_total(f"__of_{c}", F.col("store_id") == i).alias(f"from_{i}_{c}") for i in stores for c in cats] + [
        _total("__rows", F.col("store_id") == i).alias(f"from_{i}") for i in stores]


def dedup_counts() -> list[Column]:
    """C10 counters over the de-duplicated rows."""
    ok = price_ok(F.col("price"), F.col("category_id"))
    return [F.count(F.lit(1)).alias("rows_after_dedup"), F.count_if(~ok).alias("invalid_prices"), F.count_if(ok).alias("rows_output")]


METRICS = ["rows_input", "rows_after_normalize", "unmapped_categories", "rows_after_category_map", "unmapped_stores",
           "rows_after_store_map", "prices_converted", "rows_after_currency", "rows_after_dedup", "invalid_prices",
           "rows_output", "duplicates_removed", "rows_after_validation"]


def cleaning_metrics(flagged: DataFrame, deduped: DataFrame) -> DataFrame:
    """The counters of a cleaning run (one row)."""
    b = deduped.select(F.struct(*dedup_counts())).scalar()
    return (flagged.agg(*row_counts())
             .select("*", *[b.getField(c).alias(c) for c in ("rows_after_dedup", "invalid_prices", "rows_output")])
             .withColumn("duplicates_removed", F.col("rows_after_currency") - F.col("rows_after_dedup"))
             .withColumn("rows_after_validation", F.col("rows_output")))


REJECT_COLS = ["name", "category", "store_name", "currency", "price", "reject_reason"]


def malformed(damaged: DataFrame) -> DataFrame:
    """C11 rows of records that could not be read (``read_raw_checked``): their text as the name."""
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    return damaged.select(F.col("corrupt_record").alias("name"), none("category", "string"), none("store_name", "string"),
                          none("currency", "string"), none("price", "double"), F.lit("malformed_record").alias("reject_reason"))


def rejects(raw: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """C11: every dropped row with the first reason that dropped it:
    empty_name, unmapped_category, unmapped_store, unsupported_currency,
    duplicate, invalid_price; with ``damaged``, malformed_record too."""
    # written once: the stages below read the cleaned rows, not the chain that cleans them
    checkpoint_dir(raw.sparkSession)
    flagged = flag_stateless(raw).withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    reason = (F.when(~F.col("__name_ok"), "empty_name")
               .when(~F.col("__cat_ok"), "unmapped_category")
               .when(~F.col("__store_ok"), "unmapped_store")
               .when(~F.col("__cur_ok"), "unsupported_currency"))
    stateless = flagged.withColumn("reject_reason", reason)
    early = stateless.filter(F.col("reject_reason").isNotNull())
    kept = convert_currencies(stateless.filter(F.col("reject_reason").isNull())
                              .drop("__name_ok", "__cat_ok", "__store_ok", "__cur_ok", "reject_reason"))
    winners = dedup_by_url(dedup_by_name(kept)).select("__row", F.lit(True).alias("__won"))
    late = (kept.join(winners, "__row", "left")
            .withColumn("reject_reason", F.when(F.col("__won").isNull(), "duplicate")
                        .when(~price_ok(F.col("price"), F.col("category_id")), "invalid_price"))
            .filter(F.col("reject_reason").isNotNull()))
    out = early.select(*REJECT_COLS).unionByName(late.select(*REJECT_COLS))
    return out if damaged is None else out.unionByName(malformed(damaged))


def reject_summary(rej: DataFrame) -> DataFrame:
    """C11 report: rows per (reason, offending value)."""
    value = (F.when(F.col("reject_reason") == "unmapped_category", F.col("category"))
              .when(F.col("reject_reason") == "unmapped_store", F.col("store_name"))
              .when(F.col("reject_reason") == "unsupported_currency", F.col("currency")))
    return rej.groupBy("reject_reason", value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def out_of_range_examples(cleaned_pre_validation: DataFrame, per_category: int = 3) -> DataFrame:
    """C11: up to ``per_category`` example names (smallest first) of rows whose
    price is outside the category range.  The limit is the feature; it plans
    as a per-partition WindowGroupLimit before the shuffle."""
    lo, hi = price_range(F.col("category_id"))
    bad = cleaned_pre_validation.filter(
        (F.col("price") > 0) & ~in_range(F.col("price"), lo, hi)).select("category_id", "name").distinct()
    w = Window.partitionBy("category_id").orderBy("name")
    return bad.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= per_category)


def clamp_to_range(df: DataFrame, price: str = "price") -> DataFrame:
    """Price limited to the inclusive range of its category."""
    lo, hi = price_range(F.col("category_id"))
    return df.withColumn(price, F.when(lo.isNull(), F.col(price)).otherwise(clamp(F.col(price), lo, hi)))


def parse_times(df: DataFrame, default: Column, col: str = "scraped_at", out: str = "scraped_ts") -> DataFrame:
    """C13: 'yyyy-MM-dd HH:mm:ss' text -> timestamp, unparsable -> ``default``."""
    return df.withColumn(out, parse_scraped_at(F.col(col), default))


def null_safe_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """C14: every column as text; missing values (NULL, and NaN of a number column) are
    NULL, all texts stay as they are."""
    kinds = dict(df.dtypes)
    out = df
    for c in cols:
        missing = F.isnan(c) if kinds[c] in ("float", "double") else F.lit(False)
        out = out.withColumn(c, F.when(~missing, F.col(c).cast("string")))
    return out
