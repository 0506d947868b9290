import pytest
from pyspark.sql import functions as F

from monthmill.functions import cleaning
from monthmill.plans import silver


def texts(frame, *values):
    return frame("v string", *[(v,) for v in values])


def test_lenient_int_accepts_what_a_lenient_cast_accepts(frame, column):
    df = texts(frame, "3", "3.0", "3.7", "-3.7", " 4 ", ".5", "5.", "+6", "1e3", "x", "", None, "99999999999")
    assert column(df, cleaning.lenient_int(F.col("v"))) == [
        3, 3, 3, -3, 4, 0, 5, 6, None, None, None, None, None,
    ]


def test_dirty_number_strips_trailing_underscores_only(frame, column):
    df = texts(frame, "52312.68_", "12__", "_12", "__10000__", "_", " ", "", "abc", None, "7_ ")
    found = column(df, cleaning.dirty_number(F.col("v"), "double"))
    assert found == [52312.68, 12.0, None, None, None, None, None, None, None, None]


def test_patterns_are_tried_only_on_texts_that_can_match(frame, column):
    values = [
        "5_", "5_\n", "_5_\n_", "__", "_", "5", " 5 ", "5.", ".", " . ", ".5\n", "\t.5", "5.7_", "5.\n", "5.7\n", "-.", "1.2.3",
        "5\n", "5\r\n", "\u00a05", "x.", "", None,
    ]
    df = texts(frame, *values)
    v = F.col("v")
    assert column(df, cleaning.strip_trailing_underscores(v)) == column(df, F.regexp_replace(v, "_+$", ""))
    whole = F.regexp_replace(F.trim(v), r"\.\d*$", "").try_cast("int")
    fraction = v.rlike(r"^\s*[+-]?\.\d*\s*$")
    assert column(df, cleaning.lenient_int(v)) == column(df, F.when(fraction, 0).otherwise(whole))
    plan = df.select(cleaning.dirty_number(v, "int"))._jdf.queryExecution().analyzed().toString().lower()
    assert "contains(v" in plan and plan.index("contains(v") < plan.index("regexp_replace(v")


def test_bad_casts_do_not_raise_under_ansi(spark, frame, column):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert column(texts(frame, "x"), cleaning.cast_text(F.col("v"), "date")) == [None]


def test_sentinel_is_compared_as_text(frame, column):
    df = texts(frame, "-1", "-1.0", "1", None)
    assert column(df, cleaning.sentinel_to_null(F.col("v"), "-1")) == [None, "-1.0", "1", None]


def test_dummy_text(frame, column):
    df = texts(frame, "_______", "______", " ", "", "Cook", None)
    found = column(df, cleaning.dummy_text_to_null(F.col("v"), "_______"))
    assert found == [None, "______", None, None, "Cook", None]


@pytest.mark.parametrize(
    ("bounds", "expected"),
    [((0, None), [None, 0.0, 48.0, 49.0, None]), ((None, 48), [-1.0, 0.0, 48.0, None, None])],
)
def test_ranges_are_closed_and_null_stays_null(frame, column, bounds, expected):
    df = frame("v double", (-1.0,), (0.0,), (48.0,), (49.0,), (None,))
    assert column(df, cleaning.within_or_null(F.col("v"), *bounds)) == expected


def test_cap_keeps_null(frame, column):
    df = frame("v int", (1,), (500,), (None,))
    assert column(df, cleaning.cap(F.col("v"), 200)) == [1, 200, None]


def test_attributes(frame):
    raw = frame(
        "Customer_ID string, snapshot_date string, Name string, Age string, SSN string, Occupation string",
        ("a", "2023-01-01", "n", "18_", "123-45-6789", "Cook"),
        ("b", "2023-01-01", "n", "17", "123-45-67890", "_______"),
        ("c", "2023-01-01", "n", "100", None, " "),
        (None, "2023-01-01", "n", "50", None, None),
        ("d", None, "n", "50", None, None),
    )
    clean = silver.clean_attributes(raw)
    assert "Name" not in clean.columns
    rows = {r.Customer_ID: (r.Age, r.SSN, r.Occupation) for r in clean.collect()}
    assert rows == {"a": (18, "123-45-6789", "Cook"), "b": (None, None, None), "c": (None, None, None)}


def test_attributes_without_a_name_column(frame):
    raw = frame(
        "Customer_ID string, snapshot_date string, Age string, SSN string, Occupation string",
        ("a", "2023-01-01", "30", None, None),
    )
    assert silver.clean_attributes(raw).count() == 1


def test_financial_rules(spark):
    from monthmill import fixed_values as fixed

    row = {name: "1" for name in (*fixed.FINANCIAL_NUMERIC_TYPES, *fixed.FINANCIAL_TEXT_COLUMNS)}
    row |= {"snapshot_date": "2023-01-01", "Annual_Income": "-5", "Interest_Rate": "48.5"}
    row |= {"Credit_Utilization_Ratio": "100", "Monthly_Balance": "-0.1_", "Num_of_Loan": "3.9_"}
    clean = silver.clean_financials(spark.createDataFrame([row]))
    got = clean.first()
    assert (got.Annual_Income, got.Interest_Rate, got.Monthly_Balance) == (None, None, None)
    assert (got.Credit_Utilization_Ratio, got.Num_of_Loan) == (100.0, 3)
    types = dict(clean.dtypes)
    assert all(types[n] == t for n, t in fixed.FINANCIAL_NUMERIC_TYPES.items())
    assert types["snapshot_date"] == "date"
