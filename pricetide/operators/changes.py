"""Change detection (K1-K8) and the two skew-safe ordered primitives it needs.

``segmented_lag`` and ``asof_join`` order the rows of a key.  Keys of up to ``MOST`` rows are
window partitions.  The rows of larger ones are dealt to slices by range over (key, order),
with bounds that Spark takes from a sample, so a product, a product-hour or a single time
that holds a third of all rows is many tasks; the value that crosses a slice's bound
comes from one carry row per slice and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions import price_change, price_change_pct, round2
from pricetide.session import written


MOST = 1_000_000                 # rows of a key that one task orders
MANY_KEYS = 100_000              # larger keys are broadcast up to so many, else joined by shuffle


def _join_null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Left join on equal columns, NULL being equal to NULL as in a window's partitions."""
    named = right.select(*[F.col(c).alias(f"__r_{c}") if c in cols else F.col(c) for c in right.columns])
    on = None
    for c in cols:
        one = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = one if on is None else on & one
    return left.join(named, on, "left").drop(*[f"__r_{c}" for c in cols])


def by_size(df: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with up to ``most`` rows, and those of larger ones (None: there are
    none).  One partial aggregate finds the keys; only their number goes to the driver."""
    large = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most)
                    .select(*[F.col(k).alias(f"__r_{k}") for k in keys]), "large_keys")
    n = large.count()
    if n == 0:
        return df, None
    large = F.broadcast(large) if n <= MANY_KEYS else large
    on = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = one if on is None else on & one
    return df.join(large, on, "left_anti"), df.join(large, on, "left_semi")


def _sliced(df: DataFrame, by: list[str], slices: int | None) -> DataFrame:
    """``df`` in slices in the order of ``by``, numbered (column __bk); written, as the numbers must not change."""
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return written(ranged.withColumn("__bk", F.spark_partition_id()), "sliced")


def segmented_lag(df: DataFrame, keys: list[str], order_cols: list[str], value: str,
                  bucket: Column | None = None, out: str = "prev", most: int = MOST, slices: int | None = None) -> DataFrame:
    """``lag(value) over (partition by keys order by order_cols)``.

    Keys of more than ``most`` rows are cut into slices (``slices``: default the session's
    shuffle partitions), with a carry of the previous slice's last value.  With ``bucket``
    (monotone in the ordering, of bounded size) all keys are cut by it.  Rows with NULL
    keys are one group, as in a window."""
    if bucket is not None:
        return _lag_by_bucket(df.withColumn("__bk", bucket), keys, order_cols, value, out)
    few, many = by_size(df, keys, most)
    lagged = few.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order_cols)))
    if many is None:
        return lagged
    return lagged.unionByName(_lag_by_bucket(_sliced(many, [*keys, *order_cols], slices), keys, order_cols, value, out))


def _lag_by_bucket(d: DataFrame, keys: list[str], order_cols: list[str], value: str, out: str) -> DataFrame:
    b, first, pin, ptail, last = "__bk", "__first", "__prev_in", "__prev_tail", "__last"
    w_in = Window.partitionBy(*keys, b).orderBy(*order_cols)
    tails = (d.groupBy(*keys, b)
              .agg(F.max_by(F.col(value), F.struct(*order_cols)).alias(last)))
    tails = tails.select(*keys, b, F.lag(last).over(Window.partitionBy(*keys).orderBy(b)).alias(ptail))
    d = (d.withColumn(pin, F.lag(value).over(w_in))
          .withColumn(first, F.row_number().over(w_in) == 1))
    d = _join_null_safe(d, tails, [*keys, b])
    return (d.withColumn(out, F.when(F.col(first), F.col(ptail)).otherwise(F.col(pin)))
             .drop(b, first, pin, ptail))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
              values: list[str], strict: bool = True, prefix: str = "asof_", most: int = MOST, slices: int | None = None) -> DataFrame:
    """For every left row, the ``values`` of the newest right row of the same key
    with ``right_ts < left_ts`` (``<=`` when not strict).  Left rows without a
    match keep NULLs (left outer as-of join); NULL keys match nothing.  Right timestamps
    must be unique per key.

    Plan: a window over the union of probes and lookups of each key; keys of more than
    ``most`` rows are cut into slices, with a carry of the last lookup of earlier ones."""
    t, side, bk, m, carry = "__t", "__side", "__bk", "__m", "__carry"
    probe_side, look_side = (0, 1) if strict else (1, 0)
    payload = F.struct(*[F.col(v).alias(prefix + v) for v in values], F.col(right_ts).alias(prefix + "ts"))
    for k in keys:
        right = right.filter(F.col(k).isNotNull())
    look = right.select(*keys, F.col(right_ts).alias(t), payload.alias(m), F.lit(look_side).alias(side))
    probes = left.withColumn(t, F.col(left_ts)).withColumn(side, F.lit(probe_side)) \
                 .withColumn(m, F.lit(None).cast(look.schema[m].dataType))
    both = probes.unionByName(look, allowMissingColumns=True)
    upto = lambda *by: (Window.partitionBy(*keys, *by).orderBy(t, side)
                        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    few, many = by_size(both, keys, most)
    out = few.withColumn(m, F.last(m, ignorenulls=True).over(upto())).filter(F.col(side) == probe_side)
    if many is not None:
        cut = _sliced(many, [*keys, t, side], slices)
        tails = cut.groupBy(*keys, bk).agg(F.max_by(m, F.when(F.col(side) == look_side, F.col(t))).alias(m))     # a row per slice and key
        earlier = Window.partitionBy(*keys).orderBy(bk).rowsBetween(Window.unboundedPreceding, -1)
        carried = tails.select(*keys, bk, F.last(m, ignorenulls=True).over(earlier).alias(carry))
        cut = cut.withColumn("__in", F.last(m, ignorenulls=True).over(upto(bk))).filter(F.col(side) == probe_side)
        cut = _join_null_safe(cut, carried, [*keys, bk]).withColumn(m, F.coalesce("__in", carry)).drop(bk, "__in", carry)
        out = out.unionByName(cut)
    cols = [c for c in left.columns] + [F.col(f"{m}.{prefix}{v}").alias(prefix + v) for v in values] + \
           [F.col(f"{m}.{prefix}ts").alias(prefix + "ts")]
    return out.select(*cols)


# ----------------------------------------------------------------------------
# K1 .. K8
# ----------------------------------------------------------------------------


def batch_changes(df: DataFrame, keys: list[str], order_cols: list[str], price: str = "price",
                  bucket: Column | None = None) -> DataFrame:
    """K1: change and percent change against the previous row of the same key
    (first row of a key: NULL)."""
    d = segmented_lag(df, keys, order_cols, price, bucket, out="__prev")
    return (d.withColumn("price_change", price_change(F.col(price), F.col("__prev")))
             .withColumn("price_change_pct", price_change_pct(F.col(price), F.col("__prev")))
             .drop("__prev"))


def change_counts() -> list[Column]:
    """K6 counters over rows with price_change."""
    c = F.col("price_change")
    return [F.count(F.lit(1)).alias("products_processed"),
            F.count_if(c.isNotNull()).alias("changes_calculated"),
            F.count_if(c.isNull()).alias("first_records"),
            F.count_if(c > 0).alias("price_increases"),
            F.count_if(c < 0).alias("price_decreases"),
            F.count_if(c == 0).alias("price_unchanged")]


def change_counters(changed: DataFrame) -> DataFrame:
    """K6: processed / calculated / first / up / down / unchanged (one row)."""
    return changed.agg(*change_counts())


def change_vs_stored(incoming: DataFrame, stored_latest: DataFrame, keys: list[str],
                     order_cols: list[str], price: str = "price") -> DataFrame:
    """K2/K3: per key, the first incoming row's price against the latest stored
    price; the same change is attached to every incoming row of that key.
    Keys absent from storage get NULL (first observation).

    ``stored_latest`` has the key columns and ``stored_price``; it is a
    one-row-per-key table (the semi join of the reference's pair lookup)."""
    first = incoming.groupBy(*keys).agg(F.min_by(F.col(price), F.struct(*order_cols)).alias("__first_price"))
    chg = (first.join(stored_latest, keys, "left")
                .select(*keys,
                        price_change(F.col("__first_price"), F.col("stored_price")).alias("price_change"),
                        price_change_pct(F.col("__first_price"), F.col("stored_price")).alias("price_change_pct")))
    return incoming.join(chg, keys, "left")


def scalar_change(cur: Column, prev: Column) -> tuple[Column, Column]:
    """K4: (change, pct); prev NULL -> (NULL, NULL); prev 0 -> (change, NULL)."""
    return price_change(cur, prev), price_change_pct(cur, prev)


def last_price(df: DataFrame, key: str, order_cols: list[str], price: str = "price") -> DataFrame:
    """K5: last price and its time per key (partial aggregate, skew-safe)."""
    r = F.max_by(F.struct(F.col(price).alias("last_price"), F.col(order_cols[0]).alias("last_at")),
                 F.struct(*order_cols))
    return df.groupBy(key).agg(r.alias("r")).select(key, "r.*")


def series_changes(df: DataFrame, keys: list[str], order_cols: list[str], price: str = "price",
                   bucket: Column | None = None) -> DataFrame:
    """K8: change against the previous element of the series; the percent
    change is NULL when the previous price is not positive."""
    d = segmented_lag(df, keys, order_cols, price, bucket, out="__prev")
    prev = F.col("__prev")
    return (d.withColumn("price_change", round2(F.col(price) - prev))
             .withColumn("price_change_pct",
                         F.when(prev > 0, round2((F.col(price) - prev) / prev * F.lit(100.0))))
             .drop("__prev"))
