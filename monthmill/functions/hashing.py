"""Repeatable pseudo-random attributes: a function of the key, not of row order or partitioning."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def hash_uniform(key: Column, salt: str) -> Column:
    """A number in (0, 1) from the first 32 bits of md5(key and salt)."""
    digits = F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / _SPAN


def weighted_choice(uniform: Column, weights: Mapping[object, float]) -> Column:
    """Category whose cumulative weight first exceeds ``uniform``."""
    *head, last = weights.items()
    total, chain = 0.0, F.when(F.lit(False), F.lit(last[0]))
    for value, weight in head:
        total += weight
        chain = chain.when(uniform < round(total, 10), F.lit(value))
    return chain.otherwise(F.lit(last[0]))


def weighted_choice_by(
    group: Column, uniform: Column, values: Sequence[object], weights: Mapping[str, Sequence[float]]
) -> Column:
    """As ``weighted_choice`` with weights that depend on ``group``; other groups give null."""
    chain = None
    for name, row in weights.items():
        picked = weighted_choice(uniform, dict(zip(values, row)))
        chain = F.when(group == name, picked) if chain is None else chain.when(group == name, picked)
    return chain


def standard_normal(key: Column, salt: str) -> Column:
    """Box-Muller transform of two hash uniforms."""
    radius = F.sqrt(-2 * F.log(hash_uniform(key, f"{salt}-radius")))
    return radius * F.cos(2 * math.pi * hash_uniform(key, f"{salt}-angle"))


def noisy_level(group: Column, normal: Column, levels: Mapping[str, tuple[float, float]]) -> Column:
    """``mean + sd * normal`` with mean and sd chosen by ``group``."""
    chain = None
    for name, (mean, sd) in levels.items():
        value = F.lit(float(mean)) + F.lit(float(sd)) * normal
        chain = F.when(group == name, value) if chain is None else chain.when(group == name, value)
    return chain
