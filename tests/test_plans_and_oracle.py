"""Plan-shape checks and a DuckDB oracle smoke run at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from pricetide.sources.tables import TABLES
from tests.conftest import SF001

SAMPLE = ["a01_kpi_summary_e", "a03_store_ranking_r", "a05_top_discounts_e", "a14_most_volatile_e",
          "q02_category_summary_e", "k07_asof_price_e", "k08_series_change_r", "c09_clean_all_r",
          "l02_daily_price_upsert_e", "v02_orphans_e", "d09_trimmed_changes_e", "d19_recent_rows_e",
          "x04_listings_pages", "x11_canonical_urls_pages", "c01_names_documents"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", SAMPLE)
def test_no_python_in_plan(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_top_n_per_product_uses_group_limit(spark):
    df = E.queries()["d19_recent_rows_e"](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString() or \
        "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_scan_prunes_columns(spark):
    df = E.queries()["a01_kpi_summary_e"](spark, SF001)
    plan = _plan(df)
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_dimensions_are_broadcast(spark):
    assert "BroadcastExchange" in _plan(E.queries()["a03_store_ranking_e"](spark, SF001))


def test_entry_smoke(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 3 and [x["rank"] for x in r] == [1, 2, 3]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _canon(records):
    def norm(v):
        if isinstance(v, float):
            return round(v, 9)
        if hasattr(v, "tolist"):
            return tuple(v.tolist())
        if isinstance(v, list):
            return tuple(v)
        return v
    return sorted((tuple(sorted((k, repr(norm(v))) for k, v in r.items())) for r in records))


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_matches(spark, duck, key):
    sdf = E.queries()[key](spark, SF001).toPandas()
    odf = duck.execute(E.oracle_sql()[key]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    s = _canon(sdf.astype(object).where(sdf.notna(), None).to_dict("records"))
    o = _canon(odf.astype(object).where(odf.notna(), None).to_dict("records"))
    assert s == o


def test_results_do_not_depend_on_session_time_zone(spark, duck):
    key = "t04_stream_window_stats_e"
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        sdf = E.queries()[key](spark, SF001).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    odf = duck.execute(E.oracle_sql()[key]).df()
    s = _canon(sdf.astype(object).where(sdf.notna(), None).to_dict("records"))
    o = _canon(odf.astype(object).where(odf.notna(), None).to_dict("records"))
    assert s == o
