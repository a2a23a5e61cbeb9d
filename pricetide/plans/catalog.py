"""Registry of named queries: Spark callables and their DuckDB oracle texts.

Keys follow the operator ids of the survey (a01 .. a16, q01 .., k.., c.., l..,
v.., d.., x.., t..) with an adapter suffix (_e events, _r retail)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _iso_dates(df: DataFrame) -> DataFrame:
    """Report DATE columns as ISO text ('yyyy-MM-dd'): the same text in every
    engine and client, whatever its date type mapping."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType
    if not any(isinstance(f.dataType, DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DateType)
                       else F.col(f.name) for f in df.schema.fields])


def query(key: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``key``.

    ``dates`` names the DATE columns of the result; they are reported as ISO
    text on both sides (Spark result and oracle text)."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the engine compares wall-clock timestamps in UTC (see session.BASE_CONF)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _iso_dates(fn(spark, sf_dir))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = iso_dates_sql(sql, dates)
        return fn
    return deco


def iso_dates_sql(sql: str, dates: tuple[str, ...]) -> str:
    if not dates:
        return sql
    rep = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


# DATE columns of registered results (reported as ISO text on both sides)
DATE_COLUMNS = {
    "a02_price_evolution_e": ("date",), "q06_price_evolution_like_e": ("date",),
    "l02_daily_price_upsert_e": ("obs_date",), "l03_change_at_load_e": ("obs_date",),
    "l11_full_run_r": ("obs_date",), "d07_cross_store_evolution_r": ("date",),
    "d19_recent_rows_e": ("obs_date",), "t02_stream_daily_keys_e": ("obs_date",),
    "t03_stream_upsert_e": ("obs_date",), "s06_append_e": ("obs_date",),
}
_DONE: set[str] = set()


def load_all() -> None:
    """Import every module that registers queries."""
    from pricetide.plans import (q_analytics, q_variants, q_changes, q_cleaning,  # noqa: F401
                                 q_load, q_derived, q_extract, q_streaming)
    for k, cols in DATE_COLUMNS.items():
        if k in ORACLE and k not in _DONE:
            ORACLE[k] = iso_dates_sql(ORACLE[k], cols)
            _DONE.add(k)
