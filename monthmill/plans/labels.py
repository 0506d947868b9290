"""Default labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.functions import loans


def default_labels(
    silver_loans: DataFrame, dpd: int = fixed.LABEL_DPD, mob: int = fixed.LABEL_MOB
) -> DataFrame:
    """One row per loan at ``mob`` months on book: 1 if at least ``dpd`` days past due."""
    return silver_loans.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        loans.default_label(F.col("dpd"), dpd).alias("label"),
        loans.label_definition(dpd, mob).alias("label_def"),
        "snapshot_date",
    )
