import datetime as dt
import os
import time

from pyspark.sql import functions as F

from pricetide.session import checkpoint_dir
from pricetide.streaming import jobs as T
from tests.conftest import SF01, rows

EV = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _write_batches(spark, batches, root):
    """Each batch as its own parquet file, with increasing modification times
    (the file source orders files by modification time)."""
    os.makedirs(root, exist_ok=True)
    for i, b in enumerate(batches):
        p = os.path.join(root, f"batch{i}")
        spark.createDataFrame(b, EV).coalesce(1).write.mode("overwrite").parquet(p)
        for f in os.listdir(p):
            if f.endswith(".parquet"):
                os.replace(os.path.join(p, f), os.path.join(root, f"part-{i:03d}.parquet"))
                t = time.time() + i
                os.utime(os.path.join(root, f"part-{i:03d}.parquet"), (t, t))


def test_daily_keys_first_arrival_and_late_drop(spark):
    root = T.run_dir(spark, "test-t2")
    d0 = dt.datetime(2024, 1, 10, 8)
    b1 = [(1, d0, 1, "view", 5.0, "{}"), (2, d0 + dt.timedelta(hours=2), 1, "view", 9.0, "{}")]
    b2 = [(3, d0 + dt.timedelta(days=6), 2, "view", 1.0, "{}")]           # advances the watermark
    b3 = [(4, d0 - dt.timedelta(days=5), 3, "view", 2.0, "{}")]           # too late: dropped
    _write_batches(spark, [b1, b2, b3], root + "/in")
    out = T.stream_daily_keys(spark, T.file_stream(spark, root + "/in"), root + "/out", watermark="2 days")
    got = spark.read.parquet(out)
    assert rows(got, "product_id", "event_id") == [(15, 1), (25, 3)]


def test_window_stats_stream_equals_batch(spark):
    root = T.run_dir(spark, "test-t4")
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    out = T.stream_window_stats(spark, T.file_stream(spark, f"{SF01}/events.parquet"), root)
    s = spark.read.parquet(out).select(F.col("w.start").alias("ws"), "event_type", "price_records", "max_price")
    b = T.window_stats(ev).select(F.col("w.start").alias("ws"), "event_type", "price_records", "max_price")
    assert rows(s) == rows(b)


def test_versioned_state_commit_marker(spark):
    root = T.run_dir(spark, "test-state")
    st = T.VersionedState(spark, root)
    assert st.latest_version() == -1
    p = spark.createDataFrame([], T.VersionedState.PRODUCTS)
    h = spark.createDataFrame([], T.VersionedState.PRICES)
    st.write(0, p, h)
    st.write(1, p, h)
    assert st.latest_version() == 1


def test_checkpoint_dir_from_session(spark):
    d = checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")


def test_finished_windows_are_emitted_once_and_state_is_dropped(spark):
    root = T.run_dir(spark, "test-t4-append")
    day = lambda d, h=8: dt.datetime(2024, 1, d, h)
    recs = [(i, day(d, 1 + i % 20), 1, "view", float(i), "{}", (d - 1) // 3) for i, d in enumerate([1, 1, 2, 3, 4, 4, 5, 7, 8, 9, 10, 12])]
    recs += [(50, day(1, 9), 1, "view", 99.0, "{}", 3), (51, day(3, 23), 1, "view", 7.0, "{}", 1)]      # too late; late, but in time
    rows_ = spark.createDataFrame(recs, EV + ", batch int")
    seen = []

    def run():
        out = T.stream_finished_windows(spark, T.file_stream(spark, root + "/in", T.MANY_FILES), root, "2 days")
        got = [r.start.day for r in spark.read.parquet(out).select("w.start").collect()]
        assert len(got) == len(set(got))                       # once each
        seen.append(sorted(got))
        return out
    out = T.arrivals(rows_, "batch", 4, root + "/in", run)[-1]
    assert seen == [[], [1, 2], [1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 7, 8, 9]]
    got = {r.d: (r.price_records, r.max_price) for r in spark.read.parquet(out).select(F.day("w.start").alias("d"), "price_records", "max_price").collect()}
    assert got[1] == (2, 1.0) and got[3] == (2, 7.0)


def test_late_rows_are_counted(spark):
    root = T.run_dir(spark, "test-t2-late")
    at = lambda d: dt.datetime(2024, 1, d, 8)
    recs = [(1, at(1), 1, "view", 1.0, "{}", 0), (2, at(10), 2, "view", 1.0, "{}", 1), (3, at(20), 3, "view", 1.0, "{}", 2),
            (4, at(2), 4, "view", 1.0, "{}", 3), (5, at(3), 5, "view", 1.0, "{}", 3), (6, at(20), 3, "view", 5.0, "{}", 3)]
    late = T.arrivals(spark.createDataFrame(recs, EV + ", batch int"), "batch", 4, root + "/in", lambda: T.daily_keys_and_late_rows(
        spark, T.file_stream(spark, root + "/in", T.MANY_FILES), root, "3 days"))
    assert sum(n for _, n in late) == 2
    assert rows(spark.read.parquet(late[-1][0]), "event_id") == [(1,), (2,), (3,)]
