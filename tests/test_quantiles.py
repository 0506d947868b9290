import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.operators import quantiles
from monthmill.operators.quantiles import approximate_quantiles, exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.6, 0.9, 0.99, 1.0]


def values(kind, n=3000):
    dice = random.Random(n)
    return {
        "continuous": [dice.random() * 1000 for _ in range(n)],
        "ties": [float(dice.choice([1, 1, 1, 1, 2, 3, 50])) for _ in range(n)],
        "constant": [4.0] * n,
        "two": [0.0] * (n // 2) + [1.0] * (n - n // 2),
        "skewed": [1.0] * (n // 3) + [float(i) for i in range(n - n // 3)],
    }[kind]


@pytest.fixture(params=["usual", "many passes"])
def effort(request, monkeypatch):
    """The second setting narrows brackets slowly, so that all branches are taken."""
    if request.param == "many passes":
        monkeypatch.setattr(quantiles, "GATHER", 5)
        monkeypatch.setattr(quantiles, "SKETCH", 20)
        monkeypatch.setattr(quantiles, "ERROR", 0.02)
        monkeypatch.setattr(quantiles, "GRID", 10)


@pytest.mark.parametrize("kind", ["continuous", "ties", "constant", "two", "skewed"])
def test_linear_equals_numpy(spark, effort, kind):
    data = values(kind)
    df = spark.createDataFrame([(v,) for v in data], "v double").repartition(5)
    found = exact_quantiles(df, {"v": F.col("v")}, PROBABILITIES)["v"]
    assert found == pytest.approx(list(np.quantile(data, PROBABILITIES)), rel=1e-12)


def test_lower_takes_an_element(spark, effort):
    data = values("continuous", 1001)
    df = spark.createDataFrame([(v,) for v in data], "v double")
    ordered = sorted(data)
    wanted = [ordered[max(math.ceil(p * len(data)) - 1, 0)] for p in PROBABILITIES]
    assert exact_quantiles(df, {"v": F.col("v")}, PROBABILITIES, method="lower")["v"] == wanted


def test_many_columns_with_gaps(spark, effort):
    data = [(float(i), i if i % 3 else None, None) for i in range(1000)]
    df = spark.createDataFrame(data, "a double, b int, c double")
    columns = {n: F.col(n) for n in "abc"} | {f"a{n}": F.col("a") + n for n in range(20)}
    found = exact_quantiles(df, columns, [0.5])
    assert found["a"] == [499.5] and found["c"] == [None] and found["a19"] == [518.5]
    assert found["b"] == [np.quantile([i for i in range(1000) if i % 3], 0.5)]


def test_nan_is_ignored(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, [0.5, 1.0])["v"] == [2.0, 3.0]
    assert approximate_quantiles(df, {"v": F.col("v")}, [1.0])["v"] == [3.0]


def test_empty_table(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, [0.5])["v"] == [None]
    assert approximate_quantiles(df, {"v": F.col("v")}, [0.5])["v"] == [None]


def test_a_bracket_that_misses_is_left_again(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    wrong = quantiles._Interval("v", 20.0, 30.0, 9)
    found, pending = quantiles._look(df, {("v", 10): wrong, ("v", 90): wrong})
    assert not found
    found, pending = quantiles._look(df, {t: quantiles._Interval("v", i.low, i.high, 101) for t, i in pending.items()})
    assert found == {("v", 10): 10.0, ("v", 90): 90.0}


def test_no_task_takes_a_state_from_every_scan_task(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(1000).selectExpr("cast(id as double) as v", "cast(id % 7 as double) as w").write.parquet(folder)
    table = spark.read.parquet(folder)
    states = [quantiles._Interval("v", None, None, 2**62), quantiles._Interval("w", 1.0, 5.0, 100)]
    plan = quantiles.merged_states(table, dict(enumerate(states)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    # by salt, then by interval
    assert text.count("Exchange") == text.count("Exchange hashpartitioning(") == 2
    assert text.count("Exchange hashpartitioning(n#") == 1


def test_a_sketch_is_within_its_rank_error(spark):
    data = spark.range(300_000).select(F.abs(F.xxhash64("id") % 1_000_003).cast("double").alias("v"))
    found = approximate_quantiles(data, {"v": F.col("v")}, [0.01, 0.5, 0.9])["v"]
    n = data.count()
    for p, value in zip([0.01, 0.5, 0.9], found, strict=True):
        assert abs(data.where(F.col("v") <= value).count() / n - p) <= 0.001
