from datetime import date

from pyspark.sql import functions as F

from monthmill.functions import loans
from monthmill.plans import labels, silver

SCHEMA = (
    "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, "
    "loan_amt double, due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date"
)


def loan(name, due, overdue, number=6, balance=1.0):
    day = date(2023, 7, 1)
    return (name, "c", date(2023, 1, 1), 10, number, 100.0, due, 0.0, overdue, balance, day)


def clean(frame, *rows):
    return {r.loan_id: r for r in silver.clean_loans(frame(SCHEMA, *rows)).collect()}


def test_delinquency(frame):
    rows = clean(frame, loan("fine", 10.0, 0.0), loan("part", 10.0, 5.0), loan("two", 10.0, 15.0))
    assert (rows["fine"].installments_missed, rows["fine"].first_missed_date, rows["fine"].dpd) == (0, None, 0)
    assert (rows["part"].installments_missed, rows["part"].first_missed_date) == (1, date(2023, 6, 1))
    assert (rows["two"].installments_missed, rows["two"].dpd) == (2, 61)
    assert rows["two"].mob == 6


def test_missing_numbers_become_zero_before_the_delay(frame):
    row = clean(frame, loan("gap", 10.0, None, balance=None))["gap"]
    assert (row.overdue_amt, row.balance, row.installments_missed, row.dpd) == (0.0, 0.0, 0, 0)


def test_overdue_without_an_installment_due(frame):
    row = clean(frame, loan("free", 0.0, 20.0))["free"]
    assert (row.installments_missed, row.first_missed_date, row.dpd) == (0, None, None)
    table = silver.clean_loans(frame(SCHEMA, loan("free", 0.0, 20.0)))
    assert labels.default_labels(table).first().label == 0


def test_amounts_are_32_bit(frame):
    types = dict(silver.clean_loans(frame(SCHEMA, loan("a", 1.0, 0.0))).dtypes)
    assert types["overdue_amt"] == "float"
    assert (types["mob"], types["installments_missed"], types["dpd"]) == ("int", "int", "int")


def test_labels_only_at_the_given_month(frame):
    raw = frame(SCHEMA, loan("a", 10.0, 10.0), loan("b", 10.0, 10.0, number=5), loan("c", 10.0, 0.0))
    table = silver.clean_loans(raw)
    got = {r.loan_id: (r.label, r.label_def) for r in labels.default_labels(table).collect()}
    assert got == {"a": (1, "30dpd_6mob"), "c": (0, "30dpd_6mob")}
    other = labels.default_labels(table, dpd=31, mob=5).collect()
    assert [(r.loan_id, r.label, r.label_def) for r in other] == [("b", 0, "31dpd_5mob")]


def test_ratio_is_null_when_the_denominator_is_zero(frame, column):
    df = frame("a float, b int", (6.0, 2), (6.0, -1), (None, 2))
    assert column(df, loans.per_one_more(F.col("a"), F.col("b"))) == [2.0, None, None]
