"""RFM scores and segments, company tiers and the rules derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed


def quintile_of_value(value: Column, edges: list[float]) -> Column:
    """1 to 5 by value: bins closed on the right, equal values share a bin."""
    return sum((F.when(value > edge, 1).otherwise(0) for edge in edges), F.lit(1))


def quintile_of_rank(rank: Column, rows: Column) -> Column:
    """1 to 5 by position: the smallest k with ``rank <= 1 + (rows - 1) * k / 5``."""
    return F.greatest(F.lit(1), F.ceil(F.try_divide((rank - 1) * 5, rows - 1))).cast("int")


def rfm_segment(recency: Column, frequency: Column) -> Column:
    """Segment of a customer from the R and F scores; the first rule that holds wins."""
    rules = [
        ((recency >= 4) & (frequency >= 4), "Champions"),
        ((recency >= 3) & (frequency >= 3), "Loyal"),
        ((recency >= 4) & (frequency <= 2), "New/Promising"),
        ((recency == 2) & (frequency >= 3), "At Risk"),
        ((recency <= 2) & (frequency >= 4), "Cant Lose Them"),
        ((recency <= 2) & (frequency <= 2), "Lost"),
    ]
    chain = F.when(*_as_literal(rules[0]))
    for rule in rules[1:]:
        chain = chain.when(*_as_literal(rule))
    return chain.otherwise(F.lit("Needs Attention"))


def _as_literal(rule: tuple[Column, str]) -> tuple[Column, Column]:
    return rule[0], F.lit(rule[1])


def company_size(revenue: Column, medium_from: Column | float, large_from: Column | float) -> Column:
    return (
        F.when(revenue >= large_from, F.lit("Large"))
        .when(revenue >= medium_from, F.lit("Medium"))
        .otherwise(F.lit("Small"))
    )


def region(country: Column) -> Column:
    return (
        F.when(country == fixed.HOME_COUNTRY, F.lit("UK"))
        .when(country.isin(*fixed.WESTERN_EUROPE), F.lit("Western Europe"))
        .otherwise(F.lit("Rest of World"))
    )


def account_manager(size: Column, customer: Column) -> Column:
    """Small customers serve themselves; the others get a manager by customer number."""
    pool = F.array(*[F.lit(name) for name in fixed.ACCOUNT_MANAGERS])
    turn = F.pmod(customer, F.lit(len(fixed.ACCOUNT_MANAGERS))).cast("int")
    return F.when(size == "Small", F.lit(fixed.NO_MANAGER)).otherwise(F.element_at(pool, turn + 1))


def floor_to_step(amount: Column, step: int = fixed.CREDIT_STEP) -> Column:
    """Down to a multiple of ``step``, at least one step."""
    return F.greatest(F.lit(step), F.floor(amount / step) * step).cast("int")


def vip_minimum(limit: Column, vip: Column, minimum: int = fixed.VIP_MIN_LIMIT) -> Column:
    return F.when(vip, F.greatest(limit, F.lit(minimum))).otherwise(limit)
