import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripkiln.operators import quality as Q


def test_drop_repeated(spark):
    data = [(1, "a", 3.0), (1, "a", 3.0), (1, "b", 1.0), (2, None, 2.0), (2, "c", 1.0), (None, "x", 1.0), (None, "w", 9.0)]
    df = spark.createDataFrame(data, "k int, s string, v double").repartition(4)
    assert sorted(rows(Q.drop_repeated(df)), key=str) == sorted(set(data), key=str)
    assert sorted(rows(Q.drop_repeated(df, ["k"])), key=str) == sorted([(1, "a", 3.0), (2, None, 2.0), (None, "w", 9.0)], key=str)
    by_value = Q.drop_repeated(df, ["k"], ["v"])
    assert by_value.columns == df.columns
    assert sorted(rows(by_value), key=str) == sorted([(1, "b", 1.0), (2, "c", 1.0), (None, "x", 1.0)], key=str)
    assert Q.drop_repeated(df.limit(0), ["k"]).count() == 0


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(100_000, numPartitions=8).select((F.col("id") % 3).alias("k"), "id")
    out = Q.drop_repeated(df, ["k"], ["id"])
    assert sorted(rows(out)) == [(0, 0), (1, 1), (2, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def _quantile(values, share, below):
    values = sorted(values)
    return next(v for k, v in enumerate(values, 1) if k * below >= len(values) * share)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 101, 3000])
def test_quantiles_are_exact(spark, n):
    rng = random.Random(n)
    data = [(rng.choice([1.5, rng.gauss(0, 9), 7.0]), rng.randrange(5), None) for _ in range(n)]
    data += [(None, None, None), (math.nan, 3, None)]
    df = spark.createDataFrame(data, "x double, i int, nothing double").repartition(5)
    shares = [(0, 1), (1, 4), (1, 2), (99, 100), (1, 1)]
    got = {r["name"]: r for r in Q.quantiles(df, ["x", "i", "nothing"], shares).collect()}
    assert set(got) == {"x", "i"}
    for c, at in (("x", 0), ("i", 1)):
        values = [float(r[at]) for r in data if r[at] is not None and not math.isnan(r[at])]
        assert got[c]["n"] == len(values) and got[c]["q"] == [_quantile(values, a, b) for a, b in shares]


def test_outliers(spark):
    data = [(float(k % 10), k % 4) for k in range(100)] + [(99.0, 1), (-50.0, 2), (None, 3), (math.nan, 3), (4.0, 40)]
    df = spark.createDataFrame(data, "x double, i int")
    bounds = {r["name"]: (r["q1"], r["q3"], r["low"], r["high"]) for r in Q.outlier_bounds(df).collect()}
    assert bounds == {"x": (2.0, 7.0, -5.5, 14.5), "i": (1.0, 3.0, -2.0, 6.0)}
    flagged = {(str(r["x"]), r["i"]): (r["x_outlier"], r["i_outlier"]) for r in Q.flag_outliers(df).collect()}
    assert flagged["99.0", 1] == (True, False) and flagged["-50.0", 2] == (True, False) and flagged["4.0", 40] == (False, True)
    assert flagged["None", 3] == (None, False) and flagged["nan", 3] == (None, False)
    kept = Q.drop_outliers(df)
    assert kept.count() == 102 and kept.columns == df.columns
    assert Q.drop_outliers(df, ["x"]).count() == 103
    assert Q.drop_outliers(df.limit(0)).count() == 0 and Q.flag_outliers(df.limit(0)).columns == ["x", "i", "x_outlier", "i_outlier"]


def test_statistics_pass_over_the_input_once_a_use(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    plan = Q.flag_outliers(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0]
