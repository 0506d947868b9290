from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthmill.functions import cleaning, retail as expr
from monthmill.operators import profile
from monthmill.plans import churn, retail

SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
    "UnitPrice double, CustomerID bigint, Country string"
)


def line(invoice, customer=1, when=datetime(2011, 1, 3, 9), qty=1, price=1.0, code="A", text="a", country="United Kingdom"):
    return (invoice, code, text, qty, when, price, customer, country)


@pytest.fixture
def sales(frame):
    return lambda *rows: retail.clean_sales(frame(SCHEMA, *rows))


def test_valid_sales(sales):
    kept = sales(
        line("1"), line("C2"), line("3", customer=None), line("4", qty=0), line("5", price=0.0),
        line("6", qty=None), line("7", price=-1.0), line("8", qty=3, price=2.55),
    )
    assert {r.InvoiceNo: float(r.Revenue) for r in kept.collect()} == {"1": 1.0, "8": 7.65}


def test_non_product_codes_ignore_case(frame, column):
    df = frame("c string", ("post",), ("Pads",), ("85123A",), (None,))
    test = lambda codes: column(df, expr.is_non_product(F.col("c"), codes))
    from monthmill import fixed_values as fixed

    assert test(fixed.NON_PRODUCT_CODES) == [True, False, False, False]
    assert test(fixed.NON_PRODUCT_CODES_WIDE) == [True, True, False, False]


def test_elapsed_days_are_whole_days_not_calendar_days(frame, column):
    rows = (datetime(2011, 1, 1, 23), datetime(2011, 1, 3, 1)), (datetime(2011, 1, 1, 1), datetime(2011, 1, 3, 1))
    df = frame("a timestamp_ntz, b timestamp_ntz", *rows)
    assert column(df, expr.elapsed_days(F.col("a"), F.col("b"))) == [1, 2]


def test_weekdays_without_orders_are_listed(sales):
    table = retail.orders_by_weekday(sales(line("1"), line("1"), line("2"))).orderBy("day_number").collect()
    assert [(r.DayOfWeek, r.Orders) for r in table][:2] == [("Monday", 2), ("Tuesday", 0)]
    assert len(table) == 7


def test_peak_month_takes_the_earliest_on_ties(sales):
    table = sales(line("1", when=datetime(2011, 5, 1)), line("2", when=datetime(2011, 3, 1)))
    assert retail.peak_month(table).first().YearMonth == "2011-03"


def test_products_without_description_are_left_out(sales):
    table = retail.product_revenue(sales(line("1"), line("2", text=None), line("3", code="pads")))
    assert [(r.StockCode, r.Unique_orders) for r in table.collect()] == [("A", 1)]


def test_basket_customer_does_not_depend_on_row_order(sales):
    table = retail.baskets(sales(line("1", customer=9), line("1", customer=3)))
    assert table.first().Customer == 3


def test_curve_ends_at_the_whole(sales):
    table = sales(*[line(str(n), customer=n % 7, price=float(n)) for n in range(1, 60)])
    curve = retail.pareto_customers(table).orderBy("Position").collect()
    assert (curve[-1].CumRevPct, curve[-1].CustPct) == (100.0, 100.0)
    best = retail.top_share(retail.pareto_customers(table), 30).first().top_revenue_pct
    assert best == max(r.CumRevPct for r in curve if r.CustPct <= 30)


def test_shares_are_rounded_half_to_even(frame, column):
    df = frame("v double", (2.5,), (3.5,), (0.125,))
    assert column(df, F.bround("v", 0)) == [2.0, 4.0, 0.0]
    assert column(df, F.bround("v", 2))[2] == 0.12


def test_histogram_equals_numpy(spark):
    for data, bins in [([1, 1, 2, 5, 9, 200, 340], 60), ([3.0, 3.0], 5), (list(np.linspace(0, 1, 101)), 10)]:
        df = spark.createDataFrame([(float(v),) for v in data], "v double")
        out = profile.histogram(df, cleaning.cap(F.col("v"), 200.0), bins).orderBy("bin").toPandas()
        counts, edges = np.histogram(np.minimum(data, 200.0), bins=bins)
        assert list(out.row_count) == list(counts)
        assert list(out.lower_edge) == pytest.approx(list(edges[:-1]))
        assert out.upper_edge.iloc[-1] == edges[-1]


def test_summary_equals_pandas(spark):
    data = pd.DataFrame({"a": [1.5, 2.0, None, 10.0, 3.25], "b": [5, 1, 1, 1, 9]})
    df = spark.createDataFrame([(None if np.isnan(a) else float(a), int(b)) for a, b in data.values], "a double, b int")
    out = profile.numeric_summary(df, {c: F.col(c) for c in "ab"}).toPandas().set_index("column_name")
    want = data.describe().round(2).T
    want.columns = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    assert np.allclose(out.loc[["a", "b"], want.columns].astype(float), want)


def test_null_profile_lists_only_columns_with_gaps(frame):
    df = frame("a int, b string", (1, None), (2, "x"), (None, None))
    got = {r.column_name: (r.missing_count, r.missing_pct) for r in profile.null_profile(df.select("a", "b", F.lit(1).alias("c"))).collect()}
    assert got == {"a": (1, 33.33), "b": (2, 66.67)}


def test_churn_bounds_are_midnights(sales):
    table = sales(
        line("1", customer=1, when=datetime(2011, 8, 30)),
        line("2", customer=1, when=datetime(2011, 8, 31, 10)),  # after the bound: label window
        line("3", customer=2, when=datetime(2011, 8, 31)),  # exactly the bound: observed
        line("4", customer=2, when=datetime(2011, 12, 9, 8)),  # after the label window
        line("5", customer=3, when=datetime(2011, 10, 1)),  # never observed
        line("6", customer=4, when=datetime(2011, 1, 1)),
        line("7", customer=4, when=datetime(2011, 12, 9)),  # last moment of the label window
    )
    labels = churn.churn_labels(table)
    assert {r.CustomerID: r.Churned for r in labels.collect()} == {1: 0, 2: 1, 4: 0}
    rate = churn.churn_rate(labels).first()
    assert (rate.customers, rate.churned, rate.churned_pct, rate.retained, rate.retained_pct) == (3, 1, 33.3, 2, 66.7)
