import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthmill.functions import scoring
from monthmill.plans import rfm


@pytest.mark.parametrize("n", [5, 6, 7, 11, 100, 4338])
def test_quintile_of_rank_equals_qcut(spark, n):
    rank = F.col("id") + 1
    found = spark.range(n).select("id", scoring.quintile_of_rank(rank, F.lit(n)).alias("q")).orderBy("id")
    want = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert [r.q for r in found.collect()] == list(want)


def test_quintile_of_value_equals_qcut(spark):
    dice = random.Random(5)
    data = [dice.randrange(40) for _ in range(700)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v int")
    edges = rfm.quintile_edges(df, "v")
    found = df.select("i", (6 - scoring.quintile_of_value(F.col("v"), edges)).alias("q")).orderBy("i")
    want = pd.qcut(pd.Series(data), 5, labels=[5, 4, 3, 2, 1]).astype(int)
    assert [r.q for r in found.collect()] == list(want)


def test_coinciding_edges_are_an_error(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(2,)], "v int")
    with pytest.raises(ValueError, match="not distinct"):
        rfm.quintile_edges(df, "v")


def test_segments_in_order_of_the_rules(spark):
    scores = [(r, f) for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame(scores, "r int, f int").withColumn("s", scoring.rfm_segment(F.col("r"), F.col("f")))
    got = {(row.r, row.f): row.s for row in df.collect()}
    assert got[4, 4] == "Champions" and got[3, 3] == "Loyal" and got[5, 3] == "Loyal"
    assert got[4, 2] == "New/Promising" and got[3, 2] == "Needs Attention"
    assert got[2, 4] == got[2, 5] == got[2, 3] == "At Risk"
    assert got[1, 4] == "Cant Lose Them" and got[1, 3] == "Needs Attention" and got[2, 2] == "Lost"
