"""Cleaning rules as column expressions, safe under ANSI mode (bad input gives null)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_int(value: Column, to: str = "int") -> Column:
    """Text to whole number: ``3.7`` is 3, ``.7`` is 0, other text and overflow are null."""
    bare_fraction = value.rlike(r"^\s*[+-]?\.\d*\s*$")
    whole = F.regexp_replace(F.trim(value), r"\.\d*$", "")
    cut = F.when(bare_fraction, F.lit(0).cast(to)).otherwise(whole.try_cast(to))
    # no pattern is tried on the many texts without a point, which none of them can match
    return F.when(value.contains("."), cut).otherwise(F.trim(value).try_cast(to))


def cast_text(value: Column, to: str) -> Column:
    """Text to ``to``; what does not parse becomes null."""
    return lenient_int(value, to) if to in ("int", "bigint") else value.try_cast(to)


def strip_trailing_underscores(value: Column) -> Column:
    return F.when(value.contains("_"), F.regexp_replace(value, "_+$", "")).otherwise(value)


def dirty_number(value: Column, to: str) -> Column:
    """Strip trailing ``_`` and blanks, turn blank into null, cast."""
    return cast_text(F.nullif(F.trim(strip_trailing_underscores(value)), F.lit("")), to)


def sentinel_to_null(value: Column, sentinel: str) -> Column:
    return F.nullif(value, F.lit(sentinel))


def dummy_text_to_null(value: Column, dummy: str) -> Column:
    """``dummy`` or blank text becomes null."""
    return F.when((value == dummy) | (F.trim(value) == ""), None).otherwise(value)


def matching_or_null(value: Column, pattern: str) -> Column:
    return F.when(value.rlike(pattern), value)


def within_or_null(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Values outside the closed range become null; a missing bound is open."""
    kept = F.lit(True)
    if lower is not None:
        kept = kept & (value >= lower)
    if upper is not None:
        kept = kept & (value <= upper)
    return F.when(kept, value)


def cap(value: Column, upper: Column | float) -> Column:
    """Values above ``upper`` become ``upper``; null stays null."""
    bound = upper if isinstance(upper, Column) else F.lit(upper)
    return F.when(value.isNotNull(), F.least(value, bound))


def cast_all(types: dict[str, str], names: Iterable[str]) -> list[Column]:
    """One projection that casts the listed columns and keeps the others as they are."""
    return [F.col(n).try_cast(types[n]).alias(n) if n in types else F.col(n) for n in names]
