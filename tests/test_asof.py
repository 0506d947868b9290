import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from monthmill.operators import asof, skew
from monthmill.staging import settled

DAY0 = date(2023, 1, 1)
LOANS = "loan_id int, Customer_ID string, snapshot_date date"
FEATURE = "Customer_ID string, snapshot_date date, value int"


def day(n):
    return DAY0 + timedelta(days=n)


@pytest.fixture
def random_tables(frame):
    dice = random.Random(7)
    # one customer holds a third of all loans; some keys and dates are missing
    loans = [
        (
            n,
            "hot" if n % 3 == 0 else None if n % 31 == 0 else f"c{dice.randrange(12)}",
            None if n % 37 == 0 else day(dice.randrange(20)),
        )
        for n in range(900)
    ]
    feature = {(f"c{dice.randrange(14)}", day(dice.randrange(25))): n for n in range(60)}
    feature |= {("hot", day(5)): 1000, ("hot", day(9)): 1001}
    rows = [(c, d, v) for (c, d), v in feature.items()] + [(None, day(1), -1), ("c1", None, -2)]
    return loans, rows, frame(LOANS, *loans), frame(FEATURE, *rows)


def expected(loans, rows):
    out = {}
    for loan, customer, moment in loans:
        known = [(d, v) for c, d, v in rows if None not in (c, d, customer, moment) and c == customer and d <= moment]
        best = max(known) if known else None
        out[loan] = (best[1], (moment - best[0]).days) if best else (None, None)
    return out


def test_asof_equals_brute_force(random_tables):
    loans, rows, left, feature = random_tables
    joined = asof.asof_join(left, asof.Feature("f", feature)).collect()
    assert len(joined) == len(loans)
    assert {r.loan_id: (r.value, r.f_lag_days) for r in joined} == expected(loans, rows)


def test_splitting_hot_keys_changes_nothing(random_tables):
    loans, rows, left, feature = random_tables
    joined = asof.with_records(left, [asof.Feature("f", feature)], share=1 / 100).collect()
    assert len(joined) == len(loans)
    assert {r.loan_id: (r.value, r.f_lag_days) for r in joined} == expected(loans, rows)


def test_several_features_share_one_timeline(random_tables):
    loans, rows, left, feature = random_tables
    later = [(c, d + timedelta(days=3), v * 2) for c, d, v in rows if c and d]
    second = left.sparkSession.createDataFrame(later, FEATURE.replace("value", "double"))
    features = [asof.Feature("f", feature), asof.Feature("g", second)]
    joined = asof.with_records(left, features, share=1 / 50).collect()
    assert {r.loan_id: (r.value, r.f_lag_days) for r in joined} == expected(loans, rows)
    assert {r.loan_id: (r.double, r.g_lag_days) for r in joined} == expected(loans, later)


def test_exact_table_with_copies_multiplies_rows(frame):
    left = frame(LOANS, (1, "a", day(0)), (2, "b", day(0)))
    clicks = frame("Customer_ID string, snapshot_date date, c int", ("a", day(0), 1), ("a", day(0), 2))
    joined = asof.with_records(left, [], exact=[clicks])
    assert sorted((r.loan_id, r.c) for r in joined.fillna(0).collect()) == [(1, 1), (1, 2), (2, 0)]


def test_two_loans_of_a_customer_on_one_date(frame):
    left = frame(LOANS, (2, "a", day(3)), (1, "a", day(3)), (3, "b", day(3)))
    feature = asof.Feature("f", frame(FEATURE, ("a", day(1), 7)))
    assert sorted(r.loan_id for r in asof.asof_join(left, feature).collect()) == [1, 2, 3]
    collapsed = asof.asof_join(left, feature, collapse_on="loan_id")
    assert sorted((r.loan_id, r.value) for r in collapsed.fillna(0).collect()) == [(1, 7), (3, 0)]


def test_records_of_one_date_are_chosen_by_the_tie_break(frame):
    left = frame(LOANS, (1, "a", day(3)))
    schema = "Customer_ID string, snapshot_date date, value int, version int"
    rows = frame(schema, ("a", day(1), 7, 1), ("a", day(1), 5, 2))
    assert asof.asof_join(left, asof.Feature("f", rows, ("version",))).first().value == 5
    assert asof.asof_join(left, asof.Feature("f", rows)).first().value == 7


def test_nulls_inside_the_latest_record_are_not_filled_from_older_ones(frame):
    left = frame(LOANS, (1, "a", day(9)))
    rows = frame(FEATURE, ("a", day(1), 7), ("a", day(2), None))
    row = asof.asof_join(left, asof.Feature("f", rows)).first()
    assert (row.value, row.f_lag_days) == (None, 7)


def test_match_rate(random_tables):
    loans, rows, left, feature = random_tables
    found = asof.match_rate(left, [asof.Feature("f", feature)]).first()
    matched = sum(v is not None for v, _ in expected(loans, rows).values())
    assert (found.total_rows, found.f_matched) == (len(loans), matched)


def test_left_joins_with_hot_and_missing_keys(random_tables):
    loans, rows, left, feature = random_tables
    other = feature.withColumnRenamed("value", "other")
    keys = ["Customer_ID", "snapshot_date"]
    joined = skew.left_joins(left, [feature, other], keys, share=1 / 100)
    plain = left.join(feature, keys, "left").join(other, keys, "left")
    columns = ["loan_id", "value", "other"]
    assert sorted(map(str, joined.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


def test_hot_keys_are_cut_into_pieces_of_a_fair_share(frame):
    left = frame("k string, n int", *[("hot", n) for n in range(600)], *[(f"k{n}", n) for n in range(400)])
    split = skew.Split(left, ["k"], share=1 / 10)
    assert [tuple(r) for r in split.hot.collect()] == [("hot", 6)]
    sizes = split.spread().where("k = 'hot'").groupBy("_piece").count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) <= 200
    assert split.repeat(frame("k string", ("hot",), ("k1",))).count() == 7


def test_even_keys_are_joined_without_pieces(frame):
    left = frame("k string, n int", *[(f"k{n % 40}", n) for n in range(400)])
    split = skew.Split(left, ["k"], share=1 / 10)
    assert not split.uneven and split.spread() is split.left
    assert split.repeat(left) is left and split.join(left, left.select("k").distinct()).count() == 400
    # many rows without a key are dealt out as well
    gaps = frame("k string, n int", *[(None if n % 2 else f"k{n % 40}", n) for n in range(400)])
    split = skew.Split(gaps, ["k"], share=1 / 10)
    assert split.uneven and split.spread().where("k is null").select("_piece").distinct().count() > 3


def test_copies_of_one_row_are_dealt_out(spark):
    left = spark.range(1000).select(F.lit("x").alias("k"), F.lit(1).alias("v")).repartition(4)
    split = skew.Split(left, ["k"], share=1 / 10)
    assert split.spread().select("_piece").distinct().count() == 10


def test_only_shuffled_tables_are_staged(spark):
    scan = spark.range(10).withColumn("x", F.col("id") + 1)
    assert settled(scan) is scan
    shuffled = scan.repartition(3)
    assert settled(shuffled) is not shuffled
