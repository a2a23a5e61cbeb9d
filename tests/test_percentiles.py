import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.operators import derived as D


@pytest.mark.parametrize("kind", ["outlier", "spread", "few", "hot"])
def test_exact_and_no_slice_is_large(spark, kind):
    rnd = random.Random(kind)
    n = 20_000
    values = {"outlier": [rnd.random() for _ in range(n - 2)] + [1e12, -1e12],
              "spread": [10 ** rnd.uniform(-9, 15) for _ in range(n)],
              "few": [float(rnd.randrange(3)) for _ in range(n)],
              "hot": [7.0] * (n // 3) + [rnd.gauss(7, 1) for _ in range(2 * n // 3)]}[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double")
    ps = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = D.percentiles(df, "v", ps, slices=16).first()["q"]
    assert np.allclose(got, np.quantile(values, ps), rtol=1e-12, atol=0)
    counted = df.where("v IS NOT NULL").groupBy(F.lit(0).alias("k"), "v").agg(F.count(F.lit(1)).alias("n"))
    parts = D.ranged(counted, ["k"], 16).groupBy("part").count()
    distinct = len(set(values))
    assert parts.agg(F.max("count")).first()[0] <= max(2 * distinct / 16, 3)


def test_groups_of_any_size(spark):
    rnd = random.Random(5)
    rows = [("big", rnd.gauss(0, 1e6)) for _ in range(3000)] + [("one", 4.0)] + [("two", 1.0), ("two", 2.0)] + [("none", None)]
    got = {r["g"]: r["q"] for r in D.percentiles(spark.createDataFrame(rows, "g string, v double"), "v", [0.25, 0.5, 0.75], ["g"], 8).collect()}
    assert set(got) == {"big", "one", "two"}
    for g in got:
        assert np.allclose(got[g], np.quantile([v for k, v in rows if k == g], [0.25, 0.5, 0.75]), rtol=1e-12)


def test_empty(spark):
    assert D.percentiles(spark.createDataFrame([], "v double"), "v", [0.5]).collect() == []
