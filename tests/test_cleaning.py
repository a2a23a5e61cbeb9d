import re

from pyspark.sql import functions as F

from pricetide.operators import cleaning as CL
from pricetide.sources.raw import RAW_SCHEMA
from tests.conftest import rows


def _raw(spark, recs):
    base = dict(name="gpu x", brand=None, price=1500.0, currency="MXN", availability=True, url="",
                sku=None, store_name="Temu", category="GPUs", scraped_at="2024-01-02 10:00:00")
    return spark.createDataFrame([{**base, **r} for r in recs], RAW_SCHEMA)


def test_category_lookup(spark):
    df = _raw(spark, [{"category": c} for c in ["CPUs", "cpu", " Laptop ", "cpus", "Placas madre", "xyz"]])
    got = rows(CL.map_categories(df), "category", "category_id")
    assert got == sorted([(" Laptop ", 5), ("CPUs", 1), ("Placas madre", 7), ("cpu", 1)])


def test_store_lookup(spark):
    df = _raw(spark, [{"store_name": s} for s in ["Temu", " ML ", "ali_express", "Amazon"]])
    assert rows(CL.map_stores(df), "store_name", "store_id") == sorted([("Temu", 3), (" ML ", 1), ("ali_express", 2)])


def test_currency(spark):
    df = _raw(spark, [{"currency": c, "price": 10.0} for c in ["USD", "usd", "MXN", "mxn", "EUR", None]])
    got = rows(CL.convert_currencies(df), "currency", "price", "price_original")
    assert got == sorted([("MXN", 175.0, 10.0), ("MXN", 175.0, 10.0), ("MXN", 10.0, 10.0), ("mxn", 10.0, 10.0)])


def test_dedup_phases(spark):
    df = _raw(spark, [
        {"name": "a", "scraped_at": "2024-01-01 00:00:00", "price": 5.0},
        {"name": "a", "scraped_at": "2024-01-02 00:00:00", "price": 7.0},    # newest wins
        {"name": "b", "scraped_at": "2024-01-02 00:00:00", "price": 9.0},
        {"name": "b", "scraped_at": "2024-01-02 00:00:00", "price": 8.0},    # same time: lowest price
        {"name": "c", "url": "/u1", "scraped_at": "2024-01-03 00:00:00"},
        {"name": "d", "url": "/u1", "scraped_at": "2024-01-03 00:00:00"},    # same url+time: smallest name
        {"name": "e", "url": "", "scraped_at": "2024-01-01 00:00:00"},
        {"name": "f", "url": None, "scraped_at": "2024-01-01 00:00:00"},
    ]).withColumn("store_id", F.lit(3).cast("bigint"))
    d1 = CL.dedup_by_name(df)
    assert rows(d1, "name", "price") == [("a", 7.0), ("b", 8.0), ("c", 1500.0), ("d", 1500.0), ("e", 1500.0),
                                         ("f", 1500.0)]
    d2 = CL.dedup_by_url(d1)
    assert [r[0] for r in rows(d2, "name")] == ["a", "b", "c", "e", "f"]


def test_validate_prices(spark):
    df = _raw(spark, [{"price": p} for p in [1000.0, 60000.0, 999.99, 60000.01, 0.0, -5.0, None]]) \
        .withColumn("category_id", F.lit(2).cast("bigint"))
    assert [r[0] for r in rows(CL.validate_prices(df), "price")] == [1000.0, 60000.0]


def test_clean_all_metrics_add_up(spark):
    df = _raw(spark, [
        {"name": "😀"}, {"category": "cpus"}, {"store_name": "Amazon"}, {"currency": "EUR"},
        {"name": "ok one"}, {"name": "ok one"}, {"name": "cheap", "price": 1.0}, {"name": "fine", "currency": "USD",
                                                                                   "price": 100.0},
    ])
    res = CL.clean_all(df)
    m = res.metrics.first().asDict()
    assert m["rows_input"] == 8
    assert m["rows_after_normalize"] == 7
    assert m["unmapped_categories"] == 1 and m["unmapped_stores"] == 1
    assert m["rows_after_currency"] == 4 and m["prices_converted"] == 1
    assert m["rows_after_dedup"] == 3 and m["duplicates_removed"] == 1
    assert m["invalid_prices"] == 1 and m["rows_output"] == 2
    assert res.data.count() == m["rows_output"]
    rej = {(r.reject_reason): r.rows for r in CL.reject_summary(CL.rejects(df)).collect()}
    assert rej["duplicate"] == 1 and rej["invalid_price"] == 1 and rej["empty_name"] == 1


def test_damaged_records_are_rejects(spark, tmp_path):
    from pricetide.sources.raw import read_raw_checked
    path = str(tmp_path / "raw")
    good = '{"name":"gpu a","price":1500.0,"currency":"MXN","store_name":"Temu","category":"GPUs","url":""}'
    lines = [good, good.replace("gpu a", "gpu b"), good[:30], good.replace("1500.0", '"sold out"'), "no json", '{"name":"only a name"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    ok, damaged = read_raw_checked(spark, path)
    assert sorted(r.name for r in ok.collect()) == ["gpu a", "gpu b", "only a name"]
    assert sorted(r.corrupt_record for r in damaged.collect()) == sorted(lines[2:5])
    assert damaged.count() == 3 and ok.count() == 3
    got = {r.reject_reason: r.rows for r in CL.reject_summary(CL.rejects(ok, damaged)).collect()}
    assert got == {"malformed_record": 3, "unmapped_category": 1}


def test_row_wise_cleaning_is_compiled(spark):
    """A lambda function would leave the row-wise steps to interpreted expressions."""
    text = CL.flag_stateless(_raw(spark, [{"name": "gpu"}]))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in text and "lambda" not in text


def test_cleaned_names_are_the_plain_ones(spark):
    """The compiled steps against plain Python, over thousands of characters in and around a name."""
    from pricetide import constants as K
    from pricetide.functions import clean_name, with_clean_name
    chars = [chr(i) for i in (*range(0x3100), *range(0xA700, 0xA800), *range(0xFF00, 0x10100))]
    texts = [None, "", " ", "a", "plain words here", "two  spaces", "é à", "~!", "tail ", "line\n", "x" * 400, "w " * 5000,
             *[f"a{c}b" for c in chars], *[f"{c}b {c}" for c in chars]]

    def plain(s):
        s = re.sub(r"\s+", " ", s.strip())
        return "".join(c for c in s if any(lo <= ord(c) <= hi for lo, hi in K.NAME_KEEP_RANGES))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, name string")
    got = with_clean_name(df.withColumn("was", clean_name(F.col("name"), 20_000)), "name", 20_000).collect()
    assert len(got) == len(texts)
    for r in got:
        want = texts[r.i] if texts[r.i] is None else plain(texts[r.i])
        assert r.name == r.was and (r.name is None) == (want is None)
        if want is not None:                      # Python may know other capitals than Java
            assert r.name == want[:1].upper() + want[1:] if want[:1].isascii() else r.name.endswith(want[1:])


def test_observed_cleaning_counts_without_writing_the_raw_rows(spark):
    """Rows are thinned before they are written; the counters are those of the whole chain."""
    import glob

    from pricetide.session import checkpoint_dir
    recs = [{"name": f"gpu {i % 5}", "price": 1500.0 + i, "currency": ("MXN", "usd", "EUR", None, "mxn")[i % 5],
             "category": ("GPUs", "cpu", "nothing", None)[i % 4], "store_name": ("Temu", " ML ", "Amazon")[i % 3], "url": ("", "/u", None)[i % 3]}
            for i in range(600)] + [{"name": n} for n in (None, "", " ", "😀") for _ in range(50)] + [{"name": "gpu 1", "price": 1.0, "scraped_at": "2025-01-01 00:00:00"}]
    raw = _raw(spark, recs)
    tables = lambda: set(glob.glob(f"{checkpoint_dir(spark)}/*"))
    before = tables()
    data, n = CL.clean_observed(raw)
    written = sum(spark.read.parquet(t).count() for t in tables() - before if glob.glob(f"{t}/*.parquet"))
    whole = CL.clean_all(raw)
    assert {c: n[c] for c in CL.METRICS} == whole.metrics.first().asDict()
    assert rows(data.select("name", "store_id", "price")) == rows(whole.data.select("name", "store_id", "price"))
    assert set(data.columns) == set(whole.data.columns)
    assert written < 150 < len(recs)
    flagged = CL.flag_stateless(raw)
    for i in (1, 2, 3):
        assert n[f"from_{i}"] == flagged.where(F.col("store_id") == i).count()
        for c in range(1, 8):
            assert n[f"from_{i}_{c}"] == flagged.where((F.col("store_id") == i) & (F.col("category_id") == c)).count()


def test_observed_cleaning_of_nothing(spark):
    data, n = CL.clean_observed(spark.createDataFrame([], RAW_SCHEMA), cols=["name", "store_id", "category_id", "brand", "url", "sku", "price", "currency", "scraped_at"])
    assert data.count() == 0 and set(n.values()) == {0}
