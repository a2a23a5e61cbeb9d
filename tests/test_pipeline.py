from pyspark.sql import functions as F

from pricetide.operators import load as L
from pricetide.sources.raw import RAW_SCHEMA
from pricetide.streaming import jobs as T
from tests.conftest import rows


def _raw(spark, recs):
    base = dict(name="gpu x", brand="b", price=1500.0, currency="MXN", availability=True, url="",
                sku=None, store_name="Temu", category="GPUs", scraped_at="2024-01-02 10:00:00")
    return spark.createDataFrame([{**base, **r} for r in recs], RAW_SCHEMA)


def test_run_etl_twice_is_noop_and_next_day_changes(spark):
    root = T.run_dir(spark, "test-etl")
    day1 = _raw(spark, [{"name": "gpu a", "price": 2000.0}, {"name": "gpu b", "price": 3000.0, "currency": "USD",
                                                           "price": 100.0}])
    log1 = L.run_etl(spark, day1, root, run_id=1).first()
    assert log1.status == "partial_success" and log1.products_saved == 2   # only one of three stores delivered
    st = T.VersionedState(spark, root)
    p1, h1 = st.read(1)
    log2 = L.run_etl(spark, day1, root, run_id=2).first()
    p2, h2 = st.read(2)
    assert rows(p2) == rows(p1) and rows(h2) == rows(h1)
    day2 = _raw(spark, [{"name": "gpu a", "price": 1800.0, "scraped_at": "2024-01-03 09:00:00"}])
    L.run_etl(spark, day2, root, run_id=3)
    _, h3 = st.read(3)
    new = h3.filter(F.col("obs_date") == F.lit("2024-01-03").cast("date")).first()
    assert (new.price, new.price_change, new.price_change_pct) == (1800.0, -200.0, -10.0)
    logs = spark.read.parquet(root + "/pipeline_logs")
    assert sorted(r.id for r in logs.collect()) == [1, 2, 3]


def test_rerun_of_same_run_id_rewrites_same_version(spark):
    root = T.run_dir(spark, "test-etl-replay")
    day1 = _raw(spark, [{"name": "gpu a"}])
    L.run_etl(spark, day1, root, run_id=1)
    L.run_etl(spark, day1, root, run_id=1)        # replay after a failure
    st = T.VersionedState(spark, root)
    assert st.latest_version() == 1
    assert st.read(1)[1].count() == 1


def test_rejects_and_duplicates_are_no_failures_and_sources_are_judged_by_delivery(spark):
    root = T.run_dir(spark, "test-etl-counters")
    raw = _raw(spark, [{"name": "gpu a"}, {"name": "gpu a"}, {"name": ""}, {"category": "nothing"}, {"currency": "EUR"},
                       {"name": "gpu b", "store_name": "Mercado Libre", "price": 1.0}])
    log = L.run_etl(spark, raw, root, run_id=1).first()
    assert (log.products_found, log.products_saved, log.products_failed) == (6, 1, 0)
    assert "Mercado Libre: 1 products (1 categories ok, 6 failed)" in log.message
    assert log.status == "partial_success"                  # the third store delivered nothing


def test_replayed_version_holds_no_day_of_an_earlier_attempt(spark):
    root = T.run_dir(spark, "test-replay-days")
    L.run_etl(spark, _raw(spark, [{"name": "gpu a"}]), root, run_id=1)
    L.run_etl(spark, _raw(spark, [{"name": "gpu a", "scraped_at": "2024-01-05 10:00:00"}]), root, run_id=1)
    _, h = T.VersionedState(spark, root).read(1)
    assert [str(r.obs_date) for r in h.collect()] == ["2024-01-05"]
    assert spark.read.parquet(root + "/pipeline_logs").count() == 1


def _cleaned(spark, recs):
    cols = "name string, store_id bigint, category_id bigint, brand string, url string, sku string, price double, currency string, availability boolean, scraped_at timestamp_ntz"
    import datetime as dt
    return spark.createDataFrame([(n, 1, 2, "b", "u", "s", p, "MXN", True, dt.datetime.fromisoformat(t)) for n, p, t in recs], cols)


def _stream_state(spark, batches):
    state = T.VersionedState(spark, T.run_dir(spark, "test-cuts"))
    state.write(0, spark.createDataFrame([], T.VersionedState.PRODUCTS), spark.createDataFrame([], T.VersionedState.PRICES))
    for i, b in enumerate(batches):
        T.upsert_batch(state, _cleaned(spark, b), i, lambda one: F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    _, h = state.read(len(batches))
    return sorted(tuple(map(str, r)) for r in h.select("product_id", "scraped_at", "price", "price_change", "price_change_pct").collect())


def test_result_does_not_depend_on_micro_batch_cuts(spark):
    days = [[("a", 10.0, "2024-01-01 10:00:00"), ("b", 5.0, "2024-01-01 09:00:00")], [("a", 12.0, "2024-01-02 10:00:00")],
            [("a", 9.0, "2024-01-03 10:00:00"), ("b", 5.0, "2024-01-03 10:00:00")]]
    one = _stream_state(spark, [sum(days, [])])
    assert len(one) == 5 and one == _stream_state(spark, days) == _stream_state(spark, [days[0] + days[1], days[2]])
    assert [r[3] for r in one] == ["None", "2.0", "-3.0", "None", "0.0"]
