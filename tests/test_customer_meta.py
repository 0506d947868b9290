from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.functions import hashing, scoring
from monthmill.plans import customer_meta


def test_size_bounds_belong_to_the_larger_tier(frame, column):
    df = frame("r double", (1.0,), (60.0,), (90.0,))
    assert column(df, scoring.company_size(F.col("r"), 60.0, 90.0)) == ["Small", "Medium", "Large"]


def test_regions(frame, column):
    df = frame("c string", ("United Kingdom",), ("EIRE",), ("Japan",), (None,))
    assert column(df, scoring.region(F.col("c"))) == ["UK", "Western Europe", "Rest of World", "Rest of World"]


def test_managers(frame, column):
    df = frame("s string, id bigint", ("Small", 6), ("Medium", 6), ("Large", 11))
    found = column(df, scoring.account_manager(F.col("s"), F.col("id")))
    assert found == ["Self-Serve", "Sarah Bennett", "Mohammed Al-Rashid"]


def test_limits(frame, column):
    df = frame("x double, vip boolean", (-3.0, False), (999.0, False), (1000.0, True), (12600.0, True))
    limit = scoring.floor_to_step(F.col("x"))
    assert column(df, limit) == [250, 750, 1000, 12500]
    assert column(df, scoring.vip_minimum(limit, F.col("vip"))) == [250, 750, 10000, 12500]


def test_most_frequent_country_lowest_name_on_ties(frame):
    schema = "CustomerID int, Revenue decimal(18,4), InvoiceNo string, InvoiceDate timestamp_ntz, Country string"
    rows = [(1, None, "1", None, c) for c in ("Spain", "Italy", "Spain", "Italy", "Malta")]
    assert customer_meta.customer_stats(frame(schema, *rows)).first().primary_country == "Italy"


@pytest.fixture(scope="module")
def many(spark):
    size = F.element_at(F.array(*[F.lit(s) for s in fixed.TERMS_WEIGHTS]), (F.col("id") % 3 + 1).cast("int"))
    base = spark.range(30_000).select(
        F.col("id").alias("CustomerID"), size.alias("company_size"), F.lit(0).alias("is_vip")
    )
    return customer_meta.add_generated(base)


def test_weights_are_met(many):
    rows = many.collect()
    share = Counter(r.vertical for r in rows)
    assert all(abs(share[v] / len(rows) - p) < 0.015 for v, p in fixed.VERTICALS.items())
    for size, weights in fixed.TERMS_WEIGHTS.items():
        terms = [r.payment_terms_days for r in rows if r.company_size == size]
        assert all(abs(terms.count(d) / len(terms) - p) < 0.02 for d, p in zip(fixed.TERMS_DAYS, weights))
    for size, weights in fixed.CHANNEL_WEIGHTS.items():
        channels = [r.onboard_channel for r in rows if r.company_size == size]
        assert all(abs(channels.count(c) / len(channels) - p) < 0.02 for c, p in zip(fixed.CHANNELS, weights))


def test_noise_has_the_given_level(many):
    stats = many.groupBy("company_size").agg(
        F.avg("credit_limit_gbp").alias("m"), F.avg("years_in_business").alias("y"),
        F.min("credit_limit_gbp").alias("low"), F.max(F.col("credit_limit_gbp") % 250).alias("rest"),
    )
    got = {r.company_size: r for r in stats.collect()}
    for size in ("Medium", "Large"):
        mean, sd = fixed.CREDIT_LIMIT[size]
        assert abs(got[size].m - (mean - 125)) < 0.05 * mean + 30
        assert abs(got[size].y - fixed.YEARS_TRADING[size][0]) < 0.5
    assert all(r.low >= 250 and r.rest == 0 for r in got.values())


def test_attributes_do_not_depend_on_partitioning(spark):
    keys = spark.range(500)
    draw = hashing.standard_normal(F.col("id"), "x").alias("v")
    assert sorted(map(tuple, keys.select("id", draw).collect())) == sorted(
        map(tuple, keys.repartition(7).select("id", draw).collect())
    )
