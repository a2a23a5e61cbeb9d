import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.operators import changes as C
from tests.conftest import rows


def _series(spark, n_hot=400, n_cold=30, seed=7):
    """One hot key holding most rows (spread over many days) plus cold keys."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = []
    rid = 0
    for key, n in [(1, n_hot)] + [(k, rnd.randint(1, 5)) for k in range(2, n_cold)]:
        for _ in range(n):
            rid += 1
            ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40))
            data.append((rid, key, ts, round(rnd.uniform(0, 50), 2)))
    return spark.createDataFrame(data, "id long, key long, ts timestamp_ntz, price double")


def test_segmented_lag_equals_plain_lag(spark):
    df = _series(spark)
    got = C.segmented_lag(df, ["key"], ["ts", "id"], "price", F.to_date("ts"), out="prev")
    ref = df.withColumn("prev", F.lag("price").over(Window.partitionBy("key").orderBy("ts", "id")))
    assert rows(got, "id", "prev") == rows(ref, "id", "prev")


def test_asof_join_matches_brute_force(spark):
    # the operator requires unique lookup times per key (random minutes can collide)
    look = _series(spark, seed=1).select("key", F.col("ts").alias("t"), "price").dropDuplicates(["key", "t"])
    probes = _series(spark, seed=2).select("id", "key", "ts")
    got = C.asof_join(probes, look, ["key"], "ts", "t", ["price"], strict=True)
    # brute force: all earlier lookups, newest wins (test-sized data only)
    cand = probes.join(look, "key").filter(F.col("t") < F.col("ts"))
    best = cand.groupBy("id").agg(F.max_by("price", "t").alias("asof_price"), F.max("t").alias("asof_ts"))
    ref = probes.join(best, "id", "left")
    assert rows(got, "id", "asof_price", "asof_ts") == rows(ref, "id", "asof_price", "asof_ts")


def test_asof_non_strict_sees_equal_time(spark):
    t = dt.datetime(2024, 1, 5, 12)
    look = spark.createDataFrame([(1, t, 3.0)], "key long, t timestamp_ntz, price double")
    probes = spark.createDataFrame([(10, 1, t)], "id long, key long, ts timestamp_ntz")
    strict = C.asof_join(probes, look, ["key"], "ts", "t", ["price"], strict=True).first()
    loose = C.asof_join(probes, look, ["key"], "ts", "t", ["price"], strict=False).first()
    assert strict["asof_price"] is None and loose["asof_price"] == 3.0


def test_batch_changes_and_counters(spark):
    df = spark.createDataFrame([
        (1, "a", dt.datetime(2024, 1, 1), 10.0), (2, "a", dt.datetime(2024, 1, 2), 12.0),
        (3, "a", dt.datetime(2024, 1, 3), 12.0), (4, "b", dt.datetime(2024, 1, 1), 5.0),
        (5, "b", dt.datetime(2024, 1, 1, 5), 4.0)], "id long, name string, scraped_at timestamp_ntz, price double")
    ch = C.batch_changes(df, ["name"], ["scraped_at", "id"])
    assert rows(ch, "id", "price_change", "price_change_pct") == [
        (1, None, None), (2, 2.0, 20.0), (3, 0.0, 0.0), (4, None, None), (5, -1.0, -20.0)]
    c = C.change_counters(ch).first().asDict()
    assert c == {"products_processed": 5, "changes_calculated": 3, "first_records": 2, "price_increases": 1,
                 "price_decreases": 1, "price_unchanged": 1}


def test_series_changes_pct_null_when_prev_not_positive(spark):
    df = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), 0.0), (2, 1, dt.datetime(2024, 1, 2), 5.0)],
                               "id long, k long, scraped_at timestamp_ntz, price double")
    got = rows(C.series_changes(df, ["k"], ["scraped_at", "id"]), "id", "price_change", "price_change_pct")
    assert got == [(1, None, None), (2, 5.0, None)]


def test_change_vs_stored(spark):
    inc = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 2, 1), 11.0), ("a", 1, dt.datetime(2024, 1, 2, 2), 15.0),
                                 ("n", 1, dt.datetime(2024, 1, 2), 3.0)],
                                "name string, store_id long, scraped_at timestamp_ntz, price double")
    stored = spark.createDataFrame([("a", 1, 10.0)], "name string, store_id long, stored_price double")
    got = rows(C.change_vs_stored(inc, stored, ["name", "store_id"], ["scraped_at"]), "name", "price",
               "price_change", "price_change_pct")
    assert got == [("a", 11.0, 1.0, 10.0), ("a", 15.0, 1.0, 10.0), ("n", 3.0, None, None)]


def test_null_keys_are_one_group_for_lag_and_match_nothing_as_of(spark):
    import datetime as dt
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    df = spark.createDataFrame([(None, at(1), 1.0), (None, at(2), 3.0), ("a", at(1), 5.0), ("a", at(1, 1), 6.0)], "k string, ts timestamp_ntz, v double")
    got = {(r.k, r.v): r.prev for r in C.segmented_lag(df, ["k"], ["ts"], "v", F.date_trunc("hour", F.col("ts"))).collect()}
    assert got == {(None, 1.0): None, (None, 3.0): 1.0, ("a", 5.0): None, ("a", 6.0): 5.0}
    out = C.asof_join(df.withColumnRenamed("ts", "t"), df, ["k"], "t", "ts", ["v"], strict=False).collect()
    assert {(r.k, r.v): r.asof_v for r in out} == {(None, 1.0): None, (None, 3.0): None, ("a", 5.0): 5.0, ("a", 6.0): 6.0}


def test_a_product_day_with_a_third_of_all_rows(spark):
    rows_ = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("k"),
                                     (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("id") * 10)).alias("ts"),
                                     F.col("id").cast("double").alias("v"))
    got = C.segmented_lag(rows_, ["k"], ["ts"], "v", F.date_trunc("hour", F.col("ts")))
    plain = rows_.withColumn("want", F.expr("lag(v) OVER (PARTITION BY k ORDER BY ts)"))
    assert got.join(plain, ["k", "ts"]).where("NOT prev <=> want").isEmpty() and got.count() == 6000


def _hot(spark, n=9000):
    """One product-hour with a third of all rows, most of them at one and the same second."""
    at = F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("k"),
        F.when((F.col("id") % 3 == 0) & (F.col("id") % 30 > 0), at).otherwise(at + F.make_interval(secs=F.col("id") % 3500)).alias("ts"),
        (F.col("id") * 7919 % n).alias("id"), F.col("id").cast("double").alias("v"))


def test_a_product_hour_with_a_third_of_all_rows_is_many_tasks(spark):
    df = _hot(spark)
    few, many = C.by_size(df, ["k"], 500)
    assert rows(many.select("k").distinct(), "k") == [("hot",)] and few.count() + many.count() == 9000
    cut = C._sliced(many, ["k", "ts", "id"], 12).groupBy("__bk").count()
    assert cut.count() >= 10 and cut.agg(F.max("count")).first()[0] < 2 * 3000 / 12
    got = C.segmented_lag(df, ["k"], ["ts", "id"], "v", most=500, slices=12)
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == 9000


def test_as_of_over_a_hot_key(spark):
    df = _hot(spark)
    look = df.dropDuplicates(["k", "ts"]).select("k", F.col("ts").alias("t"), "v")
    for strict in (True, False):
        got = C.asof_join(df, look, ["k"], "ts", "t", ["v"], strict, most=300, slices=9)
        want = C.asof_join(df, look, ["k"], "ts", "t", ["v"], strict)
        assert got.exceptAll(want).isEmpty() and got.count() == 9000
        plan = want._jdf.queryExecution().optimizedPlan().toString()
        assert "__bk" not in plan                          # no key is large: one window


def test_null_keys_may_be_the_hot_ones(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), F.col("id").alias("ts"), F.col("id").cast("double").alias("v"))
    got = C.segmented_lag(df, ["k"], ["ts"], "v", most=150, slices=5)
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("ts")))
    assert got.exceptAll(want).isEmpty() and got.count() == 900
