import pytest
from pyspark.sql import functions as F

from pricetide.operators import analytics as A
from pricetide.sources import adapters as S
from tests.conftest import SF01


def _plan(df):
    df.collect()                                       # runs the plan that is returned
    return df._jdf.queryExecution().executedPlan()


def _scanned(plan):
    """Rows that the scans of a finished plan gave."""
    n, todo = 0, [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif name == "FileSourceScanExec":
            n += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return n


def test_latest_rows_join_products_without_a_shuffle(spark):
    star = S.events_star(spark, SF01)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = A.latest_prices(star).join(star.products, F.col("product_id") == star.products["id"])
        text = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in text and text.count("Bucketed: true") == 2


@pytest.mark.parametrize("days", [None, 3, 30])
def test_kept_latest_rows_are_the_found_ones(spark, days):
    star = S.events_star(spark, SF01)
    found = S.newest_per_group(star.price_history if days is None else star.recent(days), ["product_id"], ["scraped_at", "id"])
    kept = A.latest_prices(star, days)
    assert kept.exceptAll(found).isEmpty() and found.exceptAll(kept).isEmpty()


def test_one_product_reads_its_row_groups(spark, monkeypatch):
    """The rows read for one product are those of the row groups that may hold it."""
    monkeypatch.setattr(S, "ROW_GROUP", 500)
    star = S._stored(spark, S._events_star(spark, SF01, spark.read.parquet(f"{SF01}/events.parquet")))
    total = star.price_history.count()
    pid = star.products.agg(F.min("id")).first()[0]
    one = star.price_history.where(F.col("product_id") == pid)
    n = one.count()
    read = _scanned(_plan(one))
    assert 0 < n <= read <= 1000 < total


def test_new_files_are_seen_after_forget(spark, tmp_path):
    folder = str(tmp_path)
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    for t in ("events",):
        ev.where("event_id % 2 = 0").write.parquet(f"{folder}/{t}.parquet")
    first = S.events_star(spark, folder).price_history.count()
    ev.where("event_id % 2 = 1").write.mode("append").parquet(f"{folder}/events.parquet")
    assert S.events_star(spark, folder).price_history.count() == first
    S.forget(spark, folder)
    assert S.events_star(spark, folder).price_history.count() > first


OBS = "product_id long, price double, scraped_at timestamp_ntz, event_id long"


def _observations(spark):
    """Days of several rows, ties, missing times and products, one product of many rows."""
    from datetime import datetime
    at = lambda d, h: datetime(2024, 1, d, h)
    data = [(1, 10.0, at(1, 1), 1), (1, 11.0, at(1, 5), 2), (1, 12.0, at(1, 5), 3), (1, 9.0, at(3, 0), 4), (2, None, at(1, 0), 5),
            (2, 5.0, at(2, 0), 6), (3, 1.0, None, 7), (3, 2.0, None, 8), (3, 4.0, at(1, 0), 9), (None, 7.0, at(1, 0), 10),
            (None, 8.0, at(2, 0), 11), (None, 6.0, at(2, 0), None), (4, 3.0, None, None)]
    data += [(5, float(k % 7 + 1), at(k % 28 + 1, k % 24), 100 + k) for k in range(300)]
    return spark.createDataFrame(data, OBS)


@pytest.mark.parametrize("heavy", [S.HEAVY, 100, 0])
def test_stored_rows_are_the_daily_changes(spark, heavy):
    obs, order = _observations(spark), ["scraped_at", "event_id"]
    want = S.with_daily_changes(obs, order)
    kept = S.daily_rows(obs, order, heavy)
    got = S._changes(kept.withColumn("obs_date", F.to_date("scraped_at")), F.col("previous")).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    newest = S.newest_per_group(want, ["product_id"], order).select(*obs.columns)
    flagged = kept.where("newest").select(*obs.columns)
    assert flagged.exceptAll(newest).isEmpty() and newest.exceptAll(flagged).isEmpty()


def test_stored_rows_take_one_shuffle_by_product(spark):
    """No sort before the shuffle, and the days' and the products' windows share it."""
    kept = S.daily_rows(_observations(spark), ["scraped_at", "event_id"])
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" not in text and text.count("Sort [") == 1
    thinned = S.daily_rows(_observations(spark), ["scraped_at", "event_id"], 100)
    assert "WindowGroupLimit" in thinned._jdf.queryExecution().executedPlan().toString()


def test_bloom_filters_of_the_history_fit_its_row_groups(spark, monkeypatch):
    """A filter is as large as a row group's products need, not a megabyte each."""
    import glob
    import os
    monkeypatch.setattr(S, "ROW_GROUP", 500)
    star = S._stored(spark, S._events_star(spark, SF01, spark.read.parquet(f"{SF01}/events.parquet")))
    files = [f.split(":", 1)[1] for f in star.price_history.inputFiles()]
    assert files and sum(os.path.getsize(f) for f in files) < 100 * star.price_history.count() + 20_000 * len(files)
