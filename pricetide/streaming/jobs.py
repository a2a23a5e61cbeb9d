"""Structured Streaming versions of the incremental load.

The reference repeats a daily batch run; the streaming form processes new
files as they land:

* T1 ``stream_clean``: file source -> the stateless cleaning steps -> file sink.
* T2 ``stream_daily_keys``: one observation per (product, UTC day) with a
  watermark bounding the de-duplication state (first arrival wins).
* T3 ``stream_upsert``: ``foreachBatch`` running the batch merge (L1-L3) into the
  stored state; an epoch writes its own version of the days that it touches, so a
  replayed epoch after a failure rewrites the same files (idempotent).
* T4 ``stream_finished_windows``: windowed price statistics in append mode: a window
  is emitted once, when the watermark passes its end, and its state is dropped then.
  (``stream_window_stats`` gives all windows, open ones too, in complete mode.)

All checkpoints and sinks live under the shared folder named by
``spark.checkpoint.dir`` (see :func:`pricetide.session.checkpoint_dir`).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.operators import cleaning as CL
from pricetide.operators.state import VersionedState
from pricetide.session import checkpoint_dir
from pricetide.sources.adapters import _event_type_no


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


MANY_FILES = 1_000_000           # all that have come are one micro-batch


def file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Parquet file source with the schema of the files already present.

    ``path`` may be a folder (every new file is picked up) or one file, which
    is watched as its folder filtered to that file name."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)       # any file system that Spark reads
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return reader.parquet(path)


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# ----------------------------------------------------------------------------
# T1
# ----------------------------------------------------------------------------


def clean_stateless(raw: DataFrame, rate: float = K.USD_TO_MXN) -> DataFrame:
    """The per-row part of the cleaning chain (C1-C4 and C7); de-duplication
    is the stateful part and is handled by T2/T3."""
    d = CL.convert_currencies(CL.map_stores(CL.map_categories(CL.normalize_names(raw))), rate)
    return CL.validate_prices(d)


def stream_clean(spark: SparkSession, raw_stream: DataFrame, out: str) -> str:
    """Run the stateless cleaning over every new file and append to ``out``."""
    q = (clean_stateless(raw_stream).writeStream.format("parquet")
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True).start())
    _await(q)
    return out + "/data"


# ----------------------------------------------------------------------------
# T2
# ----------------------------------------------------------------------------


def daily_keys(events: DataFrame, watermark: str = "3 days") -> DataFrame:
    """T2 transformation: product-day keys of an events stream, de-duplicated
    within the watermark (state for a day is dropped once the watermark
    passes it)."""
    ev = (events.withColumn("event_ts", F.col("ts").cast("timestamp"))
                .withColumn("product_id", F.col("user_id") * 10 + _event_type_no(F.col("event_type")))
                .withColumn("obs_date", F.to_date("ts")))
    return (ev.withWatermark("event_ts", watermark)
              .dropDuplicatesWithinWatermark(["product_id", "obs_date"])
              .select("product_id", "obs_date", "event_id", "value", "ts"))


def stream_daily_keys(spark: SparkSession, events_stream: DataFrame, out: str, watermark: str = "3 days") -> str:
    return daily_keys_and_late_rows(spark, events_stream, out, watermark)[0]


def daily_keys_and_late_rows(spark: SparkSession, events_stream: DataFrame, out: str, watermark: str = "3 days") -> tuple[str, int]:
    """The sink's folder and how many rows came too late (from the query's progress)."""
    q = (daily_keys(events_stream, watermark).writeStream.format("parquet")
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True).start())
    _await(q)
    late = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return out + "/data", late


def arrivals(rows: DataFrame, batch: str, n: int, folder: str, run) -> list:
    """``rows`` as files in order of arrival: batch 0, 1, ... n - 1 of the column ``batch`` is
    added to ``folder``, then ``run()`` is called, as a scheduled job that takes what has come."""
    out = []
    for i in range(n):
        rows.where(F.col(batch) == i).drop(batch).write.mode("append").parquet(folder)
        out.append(run())
    return out


# ----------------------------------------------------------------------------
# T3
# ----------------------------------------------------------------------------


def upsert_batch(state: VersionedState, batch: DataFrame, epoch_id: int, run_time_col) -> None:
    """T3 body: one micro-batch of cleaned rows (see ``VersionedState.merge``) merged into
    version ``epoch_id`` as version ``epoch_id`` + 1 (version 0 = initial); an epoch that is
    repeated writes the same version again."""
    state.merge(batch, run_time_col(batch), version=epoch_id + 1, run_id=epoch_id)


def stream_upsert(spark: SparkSession, stream: DataFrame, state: VersionedState, ckpt: str, created_at=None) -> int:
    """Run ``upsert_batch`` for every micro-batch; returns the last version.
    ``created_at`` gives the time of new products (default: the batch's newest)."""
    def body(df, epoch_id):
        upsert_batch(state, df, int(epoch_id), created_at or (lambda one: one.select(F.max("scraped_at")).scalar()))
    q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    _await(q)
    return state.latest_version()


# ----------------------------------------------------------------------------
# T4
# ----------------------------------------------------------------------------


def window_stats(events: DataFrame, window: str = "1 day", slide: str | None = None) -> DataFrame:
    """T4 transformation: price statistics per time window and event type."""
    # windows over the wall-clock (TIMESTAMP_NTZ) column: no session time zone involved
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (events.groupBy(w.alias("w"), "event_type")
              .agg((F.sum(F.col("value").cast("decimal(18,6)")).cast("double") / F.count("value")).alias("avg_price"),   # the same in any order of rows
                   F.min("value").alias("min_price"), F.max("value").alias("max_price"), F.count(F.lit(1)).alias("price_records"),
                   F.stddev_samp("value").alias("volatility")))


def stream_finished_windows(spark: SparkSession, events_stream: DataFrame, out: str, watermark: str, window: str = "1 day",
                            slide: str | None = None) -> str:
    """T4: statistics of each finished window, appended once.  State holds the windows that
    the watermark has not passed; rows that are later than that are dropped."""
    timed = events_stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    q = (window_stats(timed, window, slide).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data").trigger(availableNow=True).start())
    _await(q)
    return out + "/data"


def weekday_stats(events: DataFrame) -> DataFrame:
    """T4 (A6 form): price statistics per ISO weekday of an events stream."""
    from pricetide.functions import iso_weekday
    return (events.groupBy(iso_weekday(F.col("ts")).alias("day_number"))
                  .agg(F.avg("value").alias("avg_price"), F.min("value").alias("min_price"),
                       F.max("value").alias("max_price"), F.count(F.lit(1)).alias("price_records")))


def complete_to_folder(agg: DataFrame, out: str) -> str:
    """Run a complete-mode aggregation; every micro-batch replaces the result
    folder with the full, exact table (equal to the batch result at the end).
    State holds one row per group (windows x types, or weekdays)."""
    def body(df, epoch_id):
        df.write.mode("overwrite").parquet(out + "/data")
    q = (agg.writeStream.outputMode("complete").foreachBatch(body)
         .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    _await(q)
    return out + "/data"


def stream_window_stats(spark: SparkSession, events_stream: DataFrame, out: str, window: str = "1 day",
                        slide: str | None = None) -> str:
    """T4: tumbling (or sliding, with ``slide``) window statistics."""
    return complete_to_folder(window_stats(events_stream, window, slide), out)
