import datetime as dt

from pyspark.sql import functions as F

from pricetide.operators import load as L
from tests.conftest import rows

P = "id bigint, name string, brand string, url string, sku string, category_id bigint, store_id bigint, created_at timestamp_ntz"
H = ("id bigint, product_id bigint, price double, currency string, availability boolean, price_change double, "
     "price_change_pct double, scraped_at timestamp_ntz, obs_date date")
D1 = dt.datetime(2024, 1, 1, 9)
D2 = dt.datetime(2024, 1, 2, 9)


def _state(spark):
    products = spark.createDataFrame([(1, "a", "old", "/a", "s1", 1, 1, D1), (2, "b", "x", "/b", "s2", 2, 1, D1)], P)
    hist = spark.createDataFrame([(10, 1, 100.0, "MXN", True, None, None, D1, D1.date()),
                                  (11, 2, 50.0, "MXN", True, None, None, D1, D1.date())], H)
    return products, hist


def test_assign_ids_dense_and_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k")).repartition(7)
    got = L.assign_ids(df, ["k"], 100)
    r = rows(got, "k", "id")
    assert r == [(k, 101 + k) for k in range(500)]


def test_product_upsert(spark):
    products, _ = _state(spark)
    inc = spark.createDataFrame([("a", 1, "new", "/a2", "s1", 3), ("c", 1, "z", "/c", "s3", 1), ("d", 2, None, "", None, 2)],
                                "name string, store_id bigint, brand string, url string, sku string, category_id bigint")
    up = L.upsert_products(products, inc, F.lit(D2).cast("timestamp_ntz"))
    t = {r.name: r for r in up.table.collect()}
    assert (t["a"].id, t["a"].brand, t["a"].category_id, t["a"].created_at) == (1, "new", 3, D1)
    assert t["b"].brand == "x"
    assert (t["c"].id, t["d"].id) == (3, 4) and t["c"].created_at == D2
    assert rows(up.actions, "name", "action") == [("a", "update"), ("c", "insert"), ("d", "insert")]


def test_daily_price_upsert_scenarios(spark):
    _, hist = _state(spark)
    inc = spark.createDataFrame([
        (1, 120.0, "MXN", True, dt.datetime(2024, 1, 1, 18)),   # same day, new price -> update, keep time
        (2, 50.0, "MXN", False, dt.datetime(2024, 1, 1, 20)),   # same day, same price -> no-op
        (3, 7.0, "MXN", True, D2)],                             # new product -> insert
        "product_id bigint, price double, currency string, availability boolean, scraped_at timestamp_ntz")
    res = L.load_prices(hist, inc)
    t = {r.product_id: r for r in res.table.collect()}
    assert t[1].price == 120.0 and t[1].scraped_at == D1 and t[1].id == 10 and t[1].price_change == 20.0
    assert t[2].availability is True and t[2].price == 50.0
    assert t[3].id == 12 and t[3].price_change is None
    assert rows(res.actions, "product_id", "action") == [(1, "update"), (2, "noop"), (3, "insert")]


def test_next_day_insert_and_rerun_is_noop(spark):
    _, hist = _state(spark)
    inc = spark.createDataFrame([(1, 90.0, "MXN", True, D2)],
                                "product_id bigint, price double, currency string, availability boolean, scraped_at timestamp_ntz")
    first = L.load_prices(hist, inc).table.cache()
    r = {(x.product_id, x.obs_date): x for x in first.collect()}
    assert r[(1, D2.date())].price_change == -10.0 and r[(1, D2.date())].price_change_pct == -10.0
    second = L.load_prices(first, inc)
    assert rows(second.actions, "action") == [("noop",)]
    assert rows(second.table) == rows(first)


def test_previous_day_option(spark):
    _, hist = _state(spark)
    inc = spark.createDataFrame([(1, 120.0, "MXN", True, dt.datetime(2024, 1, 1, 18))],
                                "product_id bigint, price double, currency string, availability boolean, scraped_at timestamp_ntz")
    same_day = L.load_prices(hist, inc).actions.first()
    prev_day = L.load_prices(hist, inc, previous_day=True).actions.first()
    assert same_day.previous_price == 100.0 and prev_day.previous_price is None


def test_checks(spark):
    products, hist = _state(spark)
    stores = spark.createDataFrame([(1, "S", "México")], "id bigint, name string, country string")
    cats = spark.createDataFrame([(1, "c1")], "id bigint, name string")
    t = {"stores": stores, "categories": cats, "products": products, "price_history": hist}
    orph = {r.constraint_name: r.violations for r in L.orphans(t).collect()}
    assert orph == {"products.category_id": 1, "products.store_id": 0, "price_history.product_id": 0}
    uniq = {r.constraint_name: r.violations for r in L.uniqueness(t).collect()}
    assert all(v == 0 for v in uniq.values())
    after = L.delete_products(t, products.filter("id = 1"))
    assert after["price_history"].count() == 1
    use = {(r.table_name, r.id): r.in_use for r in L.dims_in_use(t).collect()}
    assert use == {("categories", 1): True, ("stores", 1): True}


def test_ensure_table_idempotent(spark, tmp_path):
    p = str(tmp_path / "t")
    a = L.ensure_table(spark, p, "id bigint")
    b = L.ensure_table(spark, p, "id bigint")
    assert a.count() == 0 and b.count() == 0
