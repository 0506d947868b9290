"""Operators Spark has no single call for: as-of join, skew-safe join, global order, exact quantiles."""
