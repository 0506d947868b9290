"""Recency, frequency and monetary scores and the segments built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.functions import scoring
from monthmill.functions.retail import elapsed_days
from monthmill.operators.ordering import global_rank
from monthmill.operators.quantiles import exact_quantiles
from monthmill.staging import stage


def rfm_base(sales: DataFrame) -> DataFrame:
    """Whole days since the last order (seen one day after the last sale of all), orders, revenue.

    The sales are read once: the table per customer is staged and gives the last sale too.
    """
    customers = sales.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("last_order"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.sum("Revenue").alias("Monetary"),
    )
    customers = stage(customers, "rfm")
    seen = customers.agg(F.max("last_order")).scalar() + F.expr("interval 1 day")
    return customers.select(
        "CustomerID", elapsed_days(F.col("last_order"), seen).alias("Recency"), "Frequency", "Monetary"
    )


def quintile_edges(df: DataFrame, column: str) -> list[float]:
    """The four inner quintile edges; edges that coincide are an error, as no bin lies between them."""
    points = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    edges = exact_quantiles(df, {column: F.col(column)}, points)[column]
    if None in edges or len(set(edges)) < len(edges):
        raise ValueError(f"the quintile edges of {column} are not distinct: {edges}")
    return edges[1:-1]


def rfm_scores(sales: DataFrame) -> DataFrame:
    """Scores 1 to 5 (5 best), their sum and the segment of each customer.

    Recency is cut by value, so equal recencies score alike; frequency and monetary value are
    cut by position, ties in order of the customer number.
    """
    base = rfm_base(sales)
    edges = quintile_edges(base, "Recency")
    by_frequency = global_rank(base, [F.col("Frequency"), F.col("CustomerID")], "_f", total="_rows")
    ranked = global_rank(by_frequency, [F.col("Monetary"), F.col("CustomerID")], "_m")
    rows = F.col("_rows")
    scored = ranked.withColumns(
        {
            "Monetary": F.col("Monetary").cast("double"),
            "R_score": 6 - scoring.quintile_of_value(F.col("Recency"), edges),
            "F_score": scoring.quintile_of_rank(F.col("_f"), rows),
            "M_score": scoring.quintile_of_rank(F.col("_m"), rows),
        }
    )
    total = F.col("R_score") + F.col("F_score") + F.col("M_score")
    segment = scoring.rfm_segment(F.col("R_score"), F.col("F_score"))
    return scored.withColumns({"RFM_score": total, "Segment": segment}).drop("_f", "_m", "_rows")


def segment_summary(scores: DataFrame) -> DataFrame:
    """Customers and mean measures per segment, largest first."""
    return (
        scores.groupBy("Segment")
        .agg(
            F.count("CustomerID").alias("Count"),
            F.bround(F.avg("Recency"), 1).alias("Avg_Recency"),
            F.bround(F.avg("Frequency"), 1).alias("Avg_Frequency"),
            F.bround(F.avg("Monetary"), 1).alias("Avg_Monetary"),
        )
        .orderBy(F.desc("Count"), "Segment")
    )
