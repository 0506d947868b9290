"""Raw snapshots to clean, typed tables. Each is one projection over one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.functions import cleaning, loans
from monthmill.sources import schemas
from monthmill.sources.readers import SNAPSHOT


def clean_loans(raw: DataFrame) -> DataFrame:
    """Typed loans with months on book, missed installments, first missed date and days past due.

    Missing numbers become 0 once the missed installments are known, in every numeric column.
    """
    typed = raw.select(*cleaning.cast_all(schemas.LOAN_TYPES, raw.columns))
    missed = loans.installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    counted = typed.withColumns({"mob": F.col("installment_num"), "installments_missed": missed})
    filled = counted.na.fill(0)
    snapshot, first_missed = F.col(SNAPSHOT), F.col("first_missed_date")
    dated = filled.withColumn(
        "first_missed_date", loans.first_missed_date(snapshot, F.col("installments_missed"))
    )
    return dated.withColumn("dpd", loans.days_past_due(snapshot, first_missed, F.col("overdue_amt")))


def clean_financials(raw: DataFrame) -> DataFrame:
    """Repaired and typed numbers; impossible values become null."""
    columns = []
    for name in raw.columns:
        value = F.col(name)
        if name in fixed.FINANCIAL_NUMERIC_TYPES:
            value = cleaning.dirty_number(value, fixed.FINANCIAL_NUMERIC_TYPES[name])
            if name in fixed.FINANCIAL_RANGES:
                value = cleaning.within_or_null(value, *fixed.FINANCIAL_RANGES[name])
        elif name == SNAPSHOT:
            value = value.try_cast("date")
        columns.append(value.alias(name))
    return raw.select(*columns)


def clean_attributes(raw: DataFrame) -> DataFrame:
    """Customers without a key are dropped, so is the name; age, SSN and occupation are checked."""
    age = cleaning.lenient_int(cleaning.strip_trailing_underscores(F.col("Age")))
    return (
        raw.dropna(subset=["Customer_ID", SNAPSHOT])
        .drop("Name")
        .withColumns(
            {
                "Age": cleaning.within_or_null(age, *fixed.AGE_RANGE),
                "SSN": cleaning.matching_or_null(F.col("SSN"), fixed.SSN_PATTERN),
                "Occupation": cleaning.dummy_text_to_null(F.col("Occupation"), fixed.OCCUPATION_DUMMY),
                SNAPSHOT: F.col(SNAPSHOT).try_cast("date"),
            }
        )
    )


def clean_clickstream(raw: DataFrame) -> DataFrame:
    """Typed features; the text ``-1`` stands for missing."""
    features = {
        name: cleaning.sentinel_to_null(F.col(name), fixed.CLICKSTREAM_MISSING).try_cast("float")
        for name in fixed.CLICKSTREAM_FEATURES
    }
    return raw.dropna(subset=["Customer_ID", SNAPSHOT]).withColumns(
        {**features, SNAPSHOT: F.col(SNAPSHOT).try_cast("date")}
    )
