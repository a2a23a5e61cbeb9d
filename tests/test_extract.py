from pyspark.sql import functions as F

from pricetide.operators import extract as X
from tests.conftest import rows

PAGES = "page_id bigint, url string, html string"


def _pages(spark, recs):
    return spark.createDataFrame(recs, PAGES)


def test_cards_fields_listings(spark):
    html = ('<html><title>t</title><ul><li><a href="/item/1.html">  gpu   one </a> US$ 1,234.50</li>'
            '<li><b>second</b></li><li></li></ul></html>')
    lst = X.listings(X.card_fields(X.cards(_pages(spark, [(1, "https://shop.example.com/s?q=1", html)]))))
    got = rows(lst, "card_no", "name", "price", "availability", "url")
    assert got == [(1, "Gpu one", 1234.5, True, "https://shop.example.com/item/1.html"),
                   (2, "Second", 0.0, False, "")]


def test_cards_fallback_pattern(spark):
    c = X.cards(_pages(spark, [(1, "u", "<p>x</p><p>y</p>")]))
    assert rows(c, "card_no", "card") == [(1, "x"), (2, "y")]


STORE_PAGES = "page_id bigint, store_key string, category string, page_no bigint, url string, html string"


def _store_pages(spark, recs):
    """(page_id, store, html) as pages of one category."""
    return spark.createDataFrame([(i, s, "CPUs", i, f"https://s.example/{i}", h) for i, s, h in recs], STORE_PAGES)


def test_classifiers_follow_each_stores_rules(spark):
    captcha, both, title = "<title>Captcha check</title><body>x</body>", "<title>Captcha</title><body>slide to verify</body>", "<title>ok</title><body>captcha</body>"
    p = _store_pages(spark, [
        (1, "mercadolibre", captcha), (2, "aliexpress", captcha), (3, "aliexpress", both), (4, "mercadolibre", title),
        (5, "temu", "<title>Just a moment...</title><body>x</body>"), (6, "mercadolibre", "<title>Just a moment...</title>"),
        (7, "temu", "<title>ok</title><body>Your access has been restricted</body>"), (8, "aliexpress", "<body>access denied</body>"),
        (9, "temu", "<body>no items found</body>"), (10, "aliexpress", '<div class="no-result">'), (11, "aliexpress", "<body>no items found</body>"),
        (12, "temu", '<div id="captcha_verify_container">'), (13, "temu", '<form id="challenge-form">'), (14, "temu", "<p>Ray ID: 1</p>"), (15, "unknown", captcha)])
    flags = ("is_captcha", "is_challenge", "is_blocked", "is_no_results")
    got = {r["page_id"]: [f for f in flags if r[f]] for r in X.classify_pages(p).collect()}
    assert got == {1: ["is_captcha"], 2: [], 3: ["is_captcha"], 4: [], 5: ["is_challenge"], 6: [], 7: ["is_blocked"], 8: [], 9: ["is_no_results"],
                   10: ["is_no_results"], 11: [], 12: ["is_captcha"], 13: ["is_challenge"], 14: ["is_challenge"], 15: []}


def test_cut_after_block(spark):
    df = spark.createDataFrame([("s", 1, False), ("s", 2, True), ("s", 3, False), ("t", 1, False)],
                               "store string, page int, blocked boolean")
    got = rows(X.cut_after_block(df, F.col("store"), "page", "blocked"), "store", "page")
    assert got == [("s", 1), ("t", 1)]


def test_fallback_links_per_store(spark):
    links = lambda form: "".join(f'<a href="{form % i}">x</a>' for i in range(100))
    html = links("/MLM-%d") + links("/item/%d.html") + links("/t-g-%d.html") + "<a href='/other'>"
    p = _store_pages(spark, [(1, "mercadolibre", html), (2, "aliexpress", html), (3, "temu", html), (4, "temu", html), (5, "temu", "<a>")])
    cards = spark.createDataFrame([(1, 0), (4, 3)], "page_id bigint, n_cards bigint")
    got = X.fallback_links(p, cards)
    assert {r["page_id"]: r["count"] for r in got.groupBy("page_id").count().collect()} == {1: 100, 2: 60, 3: 40}
    assert got.where("page_id = 2 AND link_no = 60").first()["href"] == "/item/59.html"


def test_a_fetched_page_is_kept_whole(spark):
    """The limit is looked at before a page is fetched, never inside one."""
    p = _store_pages(spark, [(i, s, "x") for s, base in (("mercadolibre", 0), ("temu", 10)) for i in range(base + 1, base + 5)])
    lst = spark.createDataFrame([(i, c) for i in (1, 2, 3, 4, 11, 12, 13, 14) for c in range(1, 41)], "page_id bigint, card_no int")
    got = {r["page_id"]: r["count"] for r in X.stop_pages(lst, p, 2).groupBy("page_id").count().collect()}
    assert got == {1: 40, 2: 40, 3: 40, 11: 40, 12: 40, 13: 40, 14: 40}      # 96 listings are reached on page 3; no limit for the other


def test_unnamed_cards_do_not_count(spark):
    rules = {"mercadolibre": {"per_page": 2}}
    p = _store_pages(spark, [(1, "mercadolibre", "x"), (2, "mercadolibre", "x"), (3, "mercadolibre", "x")])
    lst = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "page_id bigint, card_no int")     # the card 1 of page 1 has no name
    assert rows(X.stop_pages(lst, p, 1, rules), "page_id", "card_no") == [(1, 2), (1, 3)]


def test_running_before(spark):
    df = spark.createDataFrame([("a", i, i % 3) for i in range(50)] + [("b", 7, 5)], "k string, o bigint, v bigint")
    got = {(r["k"], r["o"]): r["before"] for r in X.running_before(df, ["k"], "o", "v", width=8).collect()}
    assert got == {**{("a", i): sum(j % 3 for j in range(i)) for i in range(50)}, ("b", 7): 0}


def test_detail_prices(spark):
    p = _store_pages(spark, [(1, "mercadolibre", 'x <span class="fraction">1,234</span><span class="cents">50</span>'), (2, "aliexpress", "now € 5,20 only"),
                             (3, "temu", "none"), (4, "mercadolibre", '<span class="fraction">99</span>')])
    assert rows(X.detail_prices(p), "page_id", "price", "currency", "availability") == [
        (1, 1234.5, "MXN", True), (2, 5.2, "USD", True), (3, None, "USD", False), (4, 99.0, "MXN", True)]


def test_counters(spark):
    p = _store_pages(spark, [(1, "temu", "<p>access denied</p>"), (2, "temu", "ok"), (3, "aliexpress", '<div id="nc_1_wrapper">')])
    lst = spark.createDataFrame([("temu", 1.0), ("temu", 0.0)], "store_key string, price double")
    got = rows(X.extraction_counters(lst, X.classify_pages(p)), "store_key", "pages", "captcha_pages", "blocked_pages", "blocked_categories", "found", "saved", "failed")
    assert got == [("aliexpress", 1, 1, 0, "CPUs", 0, 0, 0), ("temu", 2, 0, 1, "CPUs", 2, 1, 1)]


def test_every_rule_meets_pages_that_fire_it(spark):
    """Branch counts of the registered pages: nothing is green for want of cases."""
    from pricetide.plans import catalog
    catalog.load_all()
    q = lambda k: catalog.QUERIES[k](spark, "/root/testdata/sf0.01")
    classes = q("x12_page_classes_pages").selectExpr(*[f"sum(int({c})) AS {c}" for c in ("is_captcha", "is_challenge", "is_blocked", "is_no_results")]).first()
    assert all(classes[c] > 0 for c in classes.asDict())
    for key, cond in (("x03_fields_pages", "price_text IS NOT NULL"), ("x04_listings_pages", "availability"), ("x08_brand_inference_r", "brand_inferred IS NOT NULL"),
                      ("x09_sku_pages", "sku_extracted LIKE 'MLM-%'"), ("x09_sku_pages", "sku_extracted LIKE 'AE-%'"), ("x09_sku_pages", "sku_extracted LIKE 'TEMU-%'"),
                      ("x11_canonical_urls_pages", "canonical <> url"), ("x19_detail_prices_pages", "price IS NOT NULL"), ("x19_detail_prices_pages", "price IS NULL"),
                      ("x20_drift_pages", "changed"), ("x20_drift_pages", "prev_len IS NOT NULL AND NOT changed"), ("x21_counters_pages", "saved > 0 AND blocked_pages > 0"),
                      ("x21_counters_pages", "blocked_categories <> ''")):
        assert q(key).where(cond).count() > 0, (key, cond)
    assert q("x17_fallback_links_pages").where("page_id % 13 >= 10").isEmpty() and not q("x17_fallback_links_pages").isEmpty()
    assert q("x18_listing_cap_pages").count() < q("x04_listings_pages").count()


def test_infer_brand_first_in_list_order(spark):
    df = spark.createDataFrame([("Intel core i7 AMD", 1), ("Kingston ram", 3), ("plain", 2)],
                               "name string, category_id bigint")
    got = rows(df.select("name", X.infer_brand(F.col("name"), F.col("category_id")).alias("b")), "name", "b")
    assert got == [("Intel core i7 AMD", "AMD"), ("Kingston ram", "Kingston"), ("plain", None)]


def test_drift(spark):
    p = _pages(spark, [(1, "https://a.com/x?v=1", "a" * 100), (2, "https://a.com/x?v=2", "a" * 105),
                       (3, "https://a.com/x", "a" * 130)])
    key = F.substring_index(F.col("url"), "?", 1)
    got = rows(X.drift(p, key, "page_id"), "page_id", "changed")
    assert got == [(1, False), (2, False), (3, True)]


def test_frontier(spark):
    cats = spark.createDataFrame([("GPUs",), ("Tablets",)], "name string")
    f = {(r.store_key, r.category, r.page): r.url for r in X.frontier(spark, cats).collect()}
    assert f[("mercadolibre", "GPUs", 2)] == \
        "https://listado.mercadolibre.com.mx/tarjeta-grafica-gpu_Desde_49_NoIndex_True"
    assert f[("temu", "Tablets", 1)] == "https://www.temu.com/search_result.html?search_key=tablets&page=1"
    assert ("temu", "GPUs", 2) not in f
