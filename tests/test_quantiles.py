"""Quantiles by refinement against sorted values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gevel.functions import quantiles as Q

PROBS = {"low": 0.0, "a": 0.25, "mid": 0.5, "b": 0.7, "top": 1.0}


@pytest.mark.parametrize("most", [2, 7, 1000])
def test_any_spread_of_values(spark, most):
    rng = np.random.default_rng(most)
    groups = {
        "even": rng.uniform(-5, 5, 900), "close": 1e6 + rng.uniform(0, 1e-6, 900), "powers": 2.0 ** -rng.integers(0, 300, 900), "copies": rng.integers(0, 9, 900).astype(float),
        "one": np.array([3.5]), "far": np.concatenate([rng.uniform(0, 1, 500), [1e300, -1e300]]),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("even", None), ("none", None)]
    got = Q.group_quantiles(spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v", PROBS, most=most).collect()
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(groups[r["k"]], p), rel=1e-12, abs=1e-300)


def test_a_million_values_in_one_unit(spark):
    """One group whose values all lie within one thousandth: no task orders more than a thousandth of them."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.pmod(F.col("id") * 7919, F.lit(n)) / F.lit(1e9)).alias("v"))
    got = Q.group_quantiles(df, ["k"], "v", PROBS).first()
    assert [got[name] for name in PROBS] == pytest.approx([(n - 1) * p / 1e9 for p in PROBS.values()], rel=1e-12)
    counted = df.groupBy("k", F.col("v").alias("_v")).agg(F.count("*").alias("_c"))
    ranges = Q.narrowed(counted, ["k"], PROBS)
    assert ranges.agg(F.max("_d")).first()[0] <= Q.MOST and ranges.count() <= 2 * len(PROBS)


def test_counted_values_whole_numbers_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 1), ("a", 10, 4)], "k string, v long, n long")
    got = Q.group_quantiles(df, ["k"], "v", {"mid": 0.5, "up": 0.9}, count="n", most=1).first()
    assert (got["mid"], got["up"]) == (np.quantile([1] * 5 + [3] + [10] * 4, 0.5), 10)
    assert Q.group_quantiles(df.limit(0), ["k"], "v", {"mid": 0.5}).collect() == []
