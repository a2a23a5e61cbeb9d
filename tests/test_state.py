import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pricetide.operators import load as L
from pricetide.operators import state as S
from pricetide.sources.raw import RAW_SCHEMA
from pricetide.streaming import jobs as T
from tests.conftest import rows

COLS = ("name string, store_id bigint, category_id bigint, brand string, url string, sku string, price double, "
        "currency string, availability boolean, scraped_at timestamp_ntz")


def run_time():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


def batch(spark, recs):
    return spark.createDataFrame([(n, 1, 2, b, "u", "s", p, "MXN", True, None if t is None else dt.datetime.fromisoformat(t)) for n, b, p, t in recs], COLS)


def new_state(spark, buckets=4):
    state = S.VersionedState(spark, T.run_dir(spark, "test-state"), buckets)
    state.write(0, spark.createDataFrame([], S.VersionedState.PRODUCTS), spark.createDataFrame([], S.VersionedState.PRICES))
    return state


def files(root, table):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(os.path.join(root, table)) for n in names if n.endswith(".parquet"))


def by_day(root):
    return {f.split("obs_date=")[1].split("/part")[0] for f in files(root, "prices")}


def test_a_version_writes_the_days_it_touches(spark):
    st = new_state(spark)
    st.merge(batch(spark, [("a", "x", 1.0, "2024-01-01 10:00:00"), ("b", "x", 5.0, "2024-01-02 10:00:00")]), run_time())
    before = set(files(st.root, "prices"))
    m = st.merge(batch(spark, [("a", "x", 2.0, "2024-01-02 09:00:00"), ("b", "x", 5.0, "2024-01-02 12:00:00")]), run_time())
    assert rows(m.prices, "product_id", "previous_price", "action") == [(1, 1.0, "insert"), (2, 5.0, "noop")]
    assert before < set(files(st.root, "prices"))
    assert by_day(st.root) == {"2024-01-01/version=1", "2024-01-02/version=1", "2024-01-02/version=2"}
    assert rows(st.prices(2), "id", "product_id", "price") == [(1, 1, 1.0), (2, 2, 5.0), (3, 1, 2.0)]
    assert rows(st.prices(1), "id") == [(1,), (2,)]
    m = st.merge(batch(spark, [("a", "x", 2.0, "2024-01-02 09:00:00")]), run_time())             # nothing changes
    assert rows(m.prices, "action") == [("noop",)] and by_day(st.root) == by_day(st.root) and st.latest_version() == 3
    assert not [d for d in by_day(st.root) if d.endswith("version=3")]
    assert rows(st.prices(3)) == rows(st.prices(2)) and rows(st.products(3)) == rows(st.products(2))


def test_reads_only_the_days_of_a_batch(spark):
    st = new_state(spark)
    st.merge(batch(spark, [("a", "x", 1.0, f"2024-01-{d:02d} 10:00:00") for d in range(1, 21)]), run_time())
    some = st.prices(1, [dt.date(2024, 1, 3)])
    assert [f.split("obs_date=")[1][:10] for f in some.inputFiles()] == ["2024-01-03"]
    pruned = st.prices(1).where("obs_date = DATE'2024-01-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in pruned and "2024-01-04" in pruned.split("PartitionFilters")[1] or "PushedFilters: []" in pruned


def test_stored_products_are_not_shuffled(spark):
    st = new_state(spark)
    for v in range(3):
        st.merge(batch(spark, [(f"p{i}", f"b{v}", 1.0, f"2024-01-0{v + 1} 10:00:00") for i in range(40)]), run_time())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = batch(spark, [("p1", "b", 1.0, "2024-01-09 10:00:00")]).select("name", "store_id").join(st.products(3), ["name", "store_id"], "left")
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert st.products(3).where("brand = 'b2'").count() == 40


def test_compaction_keeps_every_product(spark, monkeypatch):
    monkeypatch.setattr(S, "COMPACT", 2)
    st = new_state(spark)
    for v in range(5):
        st.merge(batch(spark, [(f"p{v}", "x", float(v), f"2024-01-0{v + 1} 10:00:00"), ("a", f"b{v}", 10.0 + v, f"2024-01-0{v + 1} 11:00:00")]), run_time())
    assert st.commit_of(5)["first"] == 4 and st.products(5).count() == 6
    assert rows(st.products(5).where("name = 'a'"), "brand", "last_price") == [("b4", 14.0)]
    assert rows(st.products(3).where("name = 'a'"), "brand") == [("b2",)]


def test_latest_row_follows_updates_and_late_days(spark):
    st = new_state(spark)
    st.merge(batch(spark, [("a", "x", 1.0, "2024-01-05 10:00:00")]), run_time())
    st.merge(batch(spark, [("a", "x", 3.0, "2024-01-05 18:00:00")]), run_time())                 # same day: the stored time stays
    assert rows(st.products(2), "last_id", "last_price", "last_scraped_at") == [(1, 3.0, dt.datetime(2024, 1, 5, 10))]
    m = st.merge(batch(spark, [("a", "x", 9.0, "2024-01-02 10:00:00")]), run_time())             # an older day does not become the latest
    assert rows(m.prices, "previous_price") == [(3.0,)]
    assert rows(st.products(3), "last_id", "last_price") == [(1, 3.0)]
    m = st.merge(batch(spark, [("a", "x", 4.0, None)]), run_time())                              # no time: that of the run
    assert rows(m.prices, "obs_date", "previous_price") == [(dt.date(2024, 3, 1), 3.0)]
    # the same as on whole frames
    h = st.prices(2)
    inc = spark.createDataFrame([(1, 9.0, "MXN", True, dt.datetime(2024, 1, 2, 10))],
                                "product_id bigint, price double, currency string, availability boolean, scraped_at timestamp_ntz")
    assert rows(L.load_prices(h, inc).table) == rows(st.prices(3))


def test_replays_and_run_ids(spark):
    root = T.run_dir(spark, "test-replays")
    base = dict(name="gpu a", brand="b", price=1500.0, currency="MXN", availability=True, url="", sku=None, store_name="Temu",
                category="GPUs", scraped_at="2024-01-02 10:00:00")
    raw = lambda **k: spark.createDataFrame([{**base, **k}], RAW_SCHEMA)
    L.run_etl(spark, raw(), root, 10)
    L.run_etl(spark, raw(price=1600.0, scraped_at="2024-01-03 10:00:00"), root, 20)
    st = S.VersionedState(spark, root)
    was = [os.path.dirname(f) for f in files(root, "prices")], rows(st.prices(2)), rows(st.products(2))
    log = L.run_etl(spark, raw(price=1600.0, scraped_at="2024-01-03 10:00:00"), root, 20).first()
    assert st.latest_version() == 2 and log.status == "partial_success"
    assert was == ([os.path.dirname(f) for f in files(root, "prices")], rows(st.prices(2)), rows(st.products(2)))
    with pytest.raises(ValueError, match="run 10 is version 1"):
        L.run_etl(spark, raw(), root, 10)
    assert [r.id for r in L.run_summaries(spark, root).orderBy("id").collect()] == [10, 20]


def test_run_summary_counts_and_source_errors(spark):
    root = T.run_dir(spark, "test-summary")
    base = dict(name="gpu a", brand="b", price=1500.0, currency="MXN", availability=True, url="", sku=None, store_name="Temu",
                category="GPUs", scraped_at="2024-01-02 10:00:00")
    recs = [{}, {}, {"name": " "}, {"name": "gpu b", "currency": "usd", "price": 100.0}, {"name": "c", "category": "none"}, {"name": "d", "price": -1.0}]
    L.run_etl(spark, spark.createDataFrame([{**base, **r} for r in recs], RAW_SCHEMA), root, 1, source_errors={"AliExpress": "TimeoutError: no answer"})
    s = L.run_summaries(spark, root).first()
    c, k = s.cleaner_stats, s.calculator_stats
    assert (c.rows_input, c.rows_after_normalize, c.unmapped_categories, c.prices_converted, c.duplicates_removed, c.invalid_prices, c.rows_output) == (6, 5, 1, 1, 1, 1, 2)
    assert (k.products_processed, k.first_records, k.changes_calculated) == (2, 2, 0)
    assert (s.products_found, s.products_clean, s.products_saved) == (6, 2, 2) and "6 found -> 2 clean -> 2 saved, 0 failed" in s.message
    assert "AliExpress: failed (TimeoutError: no answer)" in s.message
    assert {x.store_name: x.error for x in s.sources}["AliExpress"] == "TimeoutError: no answer"


def test_a_state_that_cannot_be_opened_is_a_failure(spark):
    log = L.run_etl(spark, spark.createDataFrame([], RAW_SCHEMA), "nosuchfs://x/state", 7).first()
    assert (log.id, log.status) == (7, "failure") and "state not opened" in log.message


def test_rollups_equal_the_full_questions_after_each_batch(spark):
    from pricetide.operators import analytics as A
    from pricetide.sources.adapters import Star, categories_dim, stores_dim
    st, dims = new_state(spark), (stores_dim(spark), categories_dim(spark))
    days = [[("a", "x", 1.1, "2024-01-01 10:00:00"), ("b", "x", 5.0, "2024-01-02 10:00:00")], [("a", "x", 2.2, "2024-01-02 09:00:00")],
            [("a", "x", 3.3, "2024-01-02 19:00:00"), ("c", "x", 0.5, "2024-01-01 10:00:00")], [("b", "y", 4.0, "2024-01-04 10:00:00")]]
    for v, day in enumerate(days, 1):
        st.merge(batch(spark, day), run_time())
        kept, found = st.star(v, *dims), Star(*dims, st.read(v)[0], st.prices(v))
        for question in (A.category_summary, A.store_category_comparison, A.store_detailed_stats, A.store_ranking):
            assert rows(question(kept)) == rows(question(found))
        assert rows(st.kpis(v, *dims)) == rows(A.kpi_summary(found))
        assert rows(A.latest_prices(kept)) == rows(A.latest_prices(found).select(kept.latest.columns))
