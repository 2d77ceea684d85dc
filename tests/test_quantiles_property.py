import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionkit.functions.quantiles import exact_quantiles


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=400),
       probs=st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=1, max_size=4))
def test_exact_quantiles_equal_numpy(spark, values, probs):
    df = spark.createDataFrame([(float(v) / 4,) for v in values], "x double").repartition(3)
    x = np.array(values, dtype=float) / 4
    got = exact_quantiles(df, ["x"], probs)["x"]
    assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)
    disc = exact_quantiles(df, ["x"], probs, discrete=True)["x"]
    s = np.sort(x)
    assert disc == [s[max(math.ceil(p * len(s)) - 1, 0)] for p in probs]


def test_ties_nulls_and_several_columns(spark):
    vals = [0.0] * 800 + [1.0] * 150 + [float(i) for i in range(2, 52)]
    df = spark.createDataFrame([(v, None, -v, float("nan") if v > 3 else v) for v in vals],
                               "x double, none double, y double, z double").repartition(4)
    probs = [0.25, 0.5, 0.8, 0.85, 0.95, 0.97, 1.0]
    got = exact_quantiles(df, ["x", "none", "y", "z"], probs)
    assert np.allclose(got["x"], np.quantile(np.array(vals), probs), rtol=0, atol=1e-12)
    assert np.allclose(got["y"], np.quantile(-np.array(vals), probs), rtol=0, atol=1e-12)
    assert np.allclose(got["z"], np.quantile([v for v in vals if v <= 3], probs), rtol=0, atol=1e-12)
    assert got["none"] == [None] * len(probs)


def _jobs(spark, rows):
    spark.sparkContext.setJobGroup(f"quantile-{rows}", "")
    df = spark.range(rows).select((F.col("id") * 7919 % rows).cast("double").alias("x"),
                                  (F.col("id") % 5).cast("double").alias("y"))
    got = exact_quantiles(df, ["x", "y"], [0.1, 0.5, 0.9])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantile-{rows}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return got, jobs


def test_job_count_does_not_depend_on_rows(spark):
    (small, few), (large, many) = _jobs(spark, 100), _jobs(spark, 300_000)
    assert few == many > 0
    assert np.allclose(large["x"], np.quantile(np.arange(300_000.0), [0.1, 0.5, 0.9]))
    assert small["y"] == [0.0, 2.0, 4.0]
