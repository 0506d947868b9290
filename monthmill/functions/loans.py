"""Loan facts: delinquency, labels, ages and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole installments that the overdue amount covers, rounded up; null when due is 0."""
    owed = F.try_divide(overdue.cast("double"), due.cast("double"))
    return F.ceil(owed).try_cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_label(dpd: Column, threshold: int) -> Column:
    """1 from the threshold on; an unknown delay counts as 0."""
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int, mob: int) -> Column:
    return F.lit(f"{dpd}dpd_{mob}mob")


def loan_age_days(snapshot: Column, start: Column) -> Column:
    return F.datediff(snapshot, start)


def per_one_more(amount: Column, count: Column) -> Column:
    """``amount / (count + 1)``, null when the denominator is 0."""
    return F.try_divide(amount.cast("double"), count.cast("double") + 1)


def ratio_features(delay_amount: str = "installments_missed") -> dict[str, Column]:
    """The five ratio columns; ``delay_amount`` is the numerator of ``delay_frequency``."""
    pairs = {
        "emi_to_income": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
        "debt_to_income": ("Outstanding_Debt", "Annual_Income"),
        "debt_per_loan": ("Outstanding_Debt", "Num_of_Loan"),
        "util_per_card": ("Credit_Utilization_Ratio", "Num_Credit_Card"),
        "delay_frequency": (delay_amount, "mob"),
    }
    return {name: per_one_more(F.col(top), F.col(bottom)) for name, (top, bottom) in pairs.items()}
