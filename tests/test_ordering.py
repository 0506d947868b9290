import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthmill.operators.ordering import global_rank, running_totals


@pytest.fixture(params=[1, 3, 16])
def buckets(request):
    return request.param


def test_running_totals_over_heavy_ties(spark, buckets):
    dice = random.Random(3)
    rows = [(n, Decimal(dice.choice([1, 1, 1, 2, 7]))) for n in range(500)]
    df = spark.createDataFrame(rows, "id int, v decimal(10,2)").repartition(4)
    order = [F.desc("v"), F.col("id")]
    out = running_totals(
        df, order, {"pos": F.lit(1), "sum": F.col("v")}, {"n": "pos", "all": "sum"}, buckets=buckets
    ).toPandas()
    want = pd.DataFrame(rows, columns=["id", "v"]).sort_values(["v", "id"], ascending=[False, True])
    out = out.sort_values("pos").reset_index(drop=True)
    assert list(out.id) == list(want.id)
    assert list(out["sum"]) == list(want.v.cumsum())
    assert set(out.n) == {500} and set(out["all"]) == {want.v.sum()}
    assert set(out.columns) == {"id", "v", "pos", "sum", "n", "all"}


def test_rank_does_not_depend_on_the_number_of_partitions(spark):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("v"))
    ranks = []
    for partitions in ("2", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        ranks.append(sorted(map(tuple, global_rank(df, [F.col("v"), F.col("id")], "r").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert ranks[0] == ranks[1]
    assert sorted(r[2] for r in ranks[0]) == list(range(1, 301))


def test_empty_table(spark):
    assert global_rank(spark.range(0), [F.col("id")], "r", total="n").count() == 0
