import datetime as dt

from pricetide.operators import analytics as A
from pricetide.operators import derived as D
from pricetide.sources.adapters import Star
from tests.conftest import rows

H = ("id bigint, product_id bigint, price double, currency string, availability boolean, price_change double, "
     "price_change_pct double, scraped_at timestamp_ntz, obs_date date")


def _star(spark, hist):
    stores = spark.createDataFrame([(1, "S1", "x"), (2, "S2", "y")], "id bigint, name string, country string")
    cats = spark.createDataFrame([(1, "c1"), (2, "c2")], "id bigint, name string")
    products = spark.createDataFrame([(1, "p1", "b", "/1", "s", 1, 1, None), (2, "p2", "b", "/2", "s", 2, 2, None)],
                                     "id bigint, name string, brand string, url string, sku string, "
                                     "category_id bigint, store_id bigint, created_at timestamp_ntz")
    return Star(stores, cats, products, spark.createDataFrame(hist, H))


def _h(i, pid, price, ts, chg=None, pct=None):
    return (i, pid, price, "MXN", True, chg, pct, ts, ts.date())


def test_weekday_monday_is_one_and_tie_picks_lowest_day(spark):
    mon, tue, sun = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 7, 10)
    star = _star(spark, [_h(1, 1, 10.0, mon), _h(2, 1, 10.004, tue), _h(3, 2, 30.0, sun)])
    got = rows(A.best_time_to_buy(star, days=90), "day_number", "day_of_week", "avg_price", "is_best")
    assert got == [(1, "Lunes", 10.0, True), (2, "Martes", 10.0, False), (7, "Domingo", 30.0, False)]


def test_single_observation_sample_stddev_is_null(spark):
    t = dt.datetime(2024, 1, 3)
    star = _star(spark, [_h(1, 1, 10.0, t, 1.0, 5.0), _h(2, 2, 20.0, t, 2.0, 3.0), _h(3, 2, 22.0, t + dt.timedelta(days=1), 2.0, 7.0)])
    got = {r.category_name: r.volatility for r in A.category_volatility(star, days=30).collect()}
    assert got["c1"] is None and got["c2"] == 2.83
    pop = {r.category_name: r.volatility for r in A.category_volatility(star, days=30, kind="pop").collect()}
    assert pop["c1"] == 0.0


def test_latest_and_discounts(spark):
    t = dt.datetime(2024, 1, 3)
    star = _star(spark, [_h(1, 1, 10.0, t, None, None), _h(2, 1, 8.0, t + dt.timedelta(days=1), -2.0, -20.0),
                         _h(3, 2, 20.0, t, 1.0, 5.26)])
    top = A.top_discounts(star, n=5, days=30).collect()
    assert [(r.product_name, r.current_price, r.previous_price, r.discount_pct) for r in top] == [("p1", 8.0, 10.0, 20.0)]
    k = A.kpi_summary(star).first()
    assert (k.products_with_discount, k.products_price_up, k.total_price_records) == (1, 1, 3)
    roll = D.discount_rollup(A.top_discounts(star, n=5, days=30)).first()
    assert roll.total_discount_amount == 2.0


def test_price_comparison_ties_all_cheapest(spark):
    t = dt.datetime(2024, 1, 3)
    star = _star(spark, [_h(1, 1, 10.0, t), _h(2, 2, 10.0, t)])
    got = rows(A.price_comparison(star, "P"), "product_name", "is_cheapest", "price_diff_vs_cheapest")
    assert got == [("p1", True, 0.0), ("p2", True, 0.0)]
