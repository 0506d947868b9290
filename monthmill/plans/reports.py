"""All retail reports of a transaction table, written to one folder each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.functions.cleaning import cap
from monthmill.operators import profile
from monthmill.operators.quantiles import exact_quantiles
from monthmill.plans import churn, retail, rfm
from monthmill.staging import settled, stage, staging_scope

Report = Callable[[DataFrame], DataFrame]

CARDINALITY = ["InvoiceNo", "StockCode", "Description", "CustomerID", "Country"]
MEASURES = ("Quantity", "UnitPrice", "CustomerID")


def _columns(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def _capped_at_p99(table: DataFrame, name: str, bins: int) -> DataFrame:
    bound = exact_quantiles(table, _columns(name), [0.99])[name][0]
    return profile.histogram(table, cap(F.col(name).cast("double"), bound), bins)


# On all transactions.
RAW: dict[str, Report] = {
    "date_range": lambda t: profile.date_range(t, "InvoiceDate"),
    "column_cardinality": lambda t: profile.distinct_counts(t, CARDINALITY),
    "numeric_summary": lambda t: profile.numeric_summary(t, _columns(*MEASURES)),
    "missing_values": profile.null_profile,
    "anomalies": retail.anomaly_counts,
    "maxima": lambda t: profile.column_maxima(t, ["Quantity", "UnitPrice"]),
}

# On lines with a positive quantity and price.
POSITIVE: dict[str, Report] = {
    "quantity_histogram": lambda t: profile.histogram(t, cap(F.col("Quantity"), 200), 60),
    "price_histogram": lambda t: profile.histogram(t, cap(F.col("UnitPrice"), 30), 60),
    "upper_quantiles": lambda t: profile.quantile_report(t, _columns("Quantity", "UnitPrice"), [0.99]),
}

# On valid sales.
SALES: dict[str, Report] = {
    "clean_size": retail.table_size,
    "monthly_revenue": retail.monthly_revenue,
    "peak_month": retail.peak_month,
    "orders_by_hour": retail.orders_by_hour,
    "orders_by_weekday": retail.orders_by_weekday,
    "countries": retail.country_revenue,
    "home_vs_abroad": retail.home_vs_abroad,
    "customers": retail.customer_summary,
    "customer_statistics": retail.customer_statistics,
    "order_count_shares": retail.order_count_shares,
    "pareto_customers": retail.pareto_customers,
    "top_products": retail.top_products,
    "top_products_share": retail.top_products_share,
    "product_long_tail": retail.product_long_tail,
    "basket_statistics": retail.basket_statistics,
    "rfm": rfm.rfm_scores,
    "churn_labels": churn.churn_labels,
}

# On reports written before.
DERIVED: dict[str, tuple[str, Report]] = {
    "orders_histogram": ("customers", lambda t: profile.histogram(t, cap(F.col("Orders"), 30), 30)),
    "pareto_top_share": ("pareto_customers", retail.top_share),
    "long_tail_80": ("product_long_tail", retail.products_within),
    "rfm_segments": ("rfm", rfm.segment_summary),
    "segment_counts": ("rfm", lambda t: profile.frequency_table(t, "Segment")),
    "recency_histogram": ("rfm", lambda t: profile.histogram(t, F.col("Recency"), 50)),
    "frequency_histogram": ("rfm", lambda t: profile.histogram(t, cap(F.col("Frequency"), 30), 30)),
    "monetary_histogram": ("rfm", lambda t: profile.histogram(t, cap(F.col("Monetary"), 10000.0), 50)),
    "churn_rate": ("churn_labels", churn.churn_rate),
}


def write_reports(transactions: DataFrame, folder: str) -> None:
    """Compute every report and write it below ``folder``; the sales are staged once for all."""
    spark = transactions.sparkSession
    with staging_scope(spark):
        raw = settled(transactions, "transactions")
        sales = stage(retail.clean_sales(raw), "sales")
        positive = retail.positive_lines(raw)
        for table, reports in ((raw, RAW), (positive, POSITIVE), (sales, SALES)):
            for name, report in reports.items():
                report(table).write.mode("overwrite").parquet(f"{folder}/{name}")
        baskets = stage(retail.baskets(sales), "baskets")
        for name in ("Revenue", "Items", "SKUs"):
            bars = _capped_at_p99(baskets, name, 50)
            bars.write.mode("overwrite").parquet(f"{folder}/basket_{name.lower()}_histogram")
        for name, (source, report) in DERIVED.items():
            table = spark.read.parquet(f"{folder}/{source}")
            report(table).write.mode("overwrite").parquet(f"{folder}/{name}")
