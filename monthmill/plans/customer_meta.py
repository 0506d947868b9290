"""Customer metadata: tiers and rules from sales, further attributes by keyed hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.functions import hashing, scoring
from monthmill.operators.quantiles import exact_quantiles
from monthmill.staging import settled

COLUMNS = (
    "CustomerID",
    "company_size",
    "vertical",
    "onboard_channel",
    "region",
    "account_manager",
    "credit_limit_gbp",
    "payment_terms_days",
    "years_in_business",
    "is_vip",
)


def customer_stats(sales: DataFrame) -> DataFrame:
    """Revenue, orders, first order and most frequent country (lowest name on ties).

    The state of the mode is one counter per country of a customer, so it stays small.
    """
    return sales.groupBy("CustomerID").agg(
        F.sum("Revenue").alias("total_revenue"),
        F.count_distinct("InvoiceNo").alias("order_count"),
        F.min("InvoiceDate").alias("first_order"),
        F.mode("Country", deterministic=True).alias("primary_country"),
    )


def add_tiers(stats: DataFrame) -> DataFrame:
    """Company size by revenue percentile (from the 60th Medium, from the 90th Large) and VIP flag."""
    stats = settled(stats, "customers")
    revenue = F.col("total_revenue").cast("double")
    medium, large = exact_quantiles(stats, {"r": revenue}, [0.6, 0.9])["r"]
    return stats.withColumns(
        {
            "company_size": scoring.company_size(revenue, F.lit(medium), F.lit(large)),
            "is_vip": (revenue >= F.lit(large)).cast("int"),
        }
    )


def add_placement(tiers: DataFrame) -> DataFrame:
    """Region from the country, account manager from size and customer number."""
    manager = scoring.account_manager(F.col("company_size"), F.col("CustomerID"))
    return tiers.withColumns(
        {"region": scoring.region(F.col("primary_country")), "account_manager": manager}
    )


def add_generated(tiers: DataFrame, seed: int = 42) -> DataFrame:
    """Attributes no transaction shows, drawn per customer with probabilities by company size."""
    key, size = F.col("CustomerID"), F.col("company_size")

    def uniform(name: str):
        return hashing.hash_uniform(key, f"{seed}-{name}")

    def noisy(name: str, levels: dict):
        return hashing.noisy_level(size, hashing.standard_normal(key, f"{seed}-{name}"), levels)

    limit = scoring.floor_to_step(noisy("limit", fixed.CREDIT_LIMIT))
    years = F.greatest(F.lit(1), F.bround(noisy("years", fixed.YEARS_TRADING)).cast("int"))
    return tiers.withColumns(
        {
            "vertical": hashing.weighted_choice(uniform("vertical"), fixed.VERTICALS),
            "onboard_channel": hashing.weighted_choice_by(
                size, uniform("channel"), fixed.CHANNELS, fixed.CHANNEL_WEIGHTS
            ),
            "credit_limit_gbp": scoring.vip_minimum(limit, F.col("is_vip") == 1),
            "payment_terms_days": hashing.weighted_choice_by(
                size, uniform("terms"), fixed.TERMS_DAYS, fixed.TERMS_WEIGHTS
            ),
            "years_in_business": years,
        }
    )


def customer_metadata(sales: DataFrame, seed: int = 42) -> DataFrame:
    """The full metadata table, one row per customer."""
    whole = add_generated(add_placement(add_tiers(customer_stats(sales))), seed)
    return whole.select(*COLUMNS).withColumnRenamed("CustomerID", "customer_id")


def vip_share(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        F.sum("is_vip").alias("vip_customers"),
        F.bround(F.avg("is_vip") * 100, 1).alias("vip_pct"),
    )
