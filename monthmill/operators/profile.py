"""Table profiles: null counts, cardinalities, summaries, quantiles, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.functions.retail import percent
from monthmill.operators import bitmaps, skew
from monthmill.operators.ordering import running_totals
from monthmill.operators.quantiles import exact_quantiles
from monthmill.staging import settled, stage


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing count and percentage per column, one scan; by default only columns with gaps."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    long = counts.unpivot(["total"], list(df.columns), "column_name", "missing_count")
    report = long.select(
        "column_name",
        "missing_count",
        F.bround(percent(F.col("missing_count"), F.col("total")), 2).alias("missing_pct"),
    )
    return report.where("missing_count > 0") if only_missing else report


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, as one row per column."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in columns])
        return row.unpivot([], list(columns), "column_name", "distinct_count")
    return bitmaps.distinct_counts(df, columns)


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).cast("date").alias("first_date"), F.max(column).cast("date").alias("last_date")
    )


def column_maxima(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.max(c).alias(f"max_{c}") for c in columns])


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.dropna(subset=[column])
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def _moments(value: Column, places: int) -> Column:
    value = value.cast("double")
    return F.struct(
        F.count(value).alias("count"),
        F.bround(F.avg(value), places).alias("mean"),
        F.bround(F.stddev_samp(value), places).alias("std"),
        F.bround(F.min(value), places).alias("min"),
        F.bround(F.max(value), places).alias("max"),
    )


def numeric_summary(
    df: DataFrame, columns: Mapping[str, Column], places: int = 2
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column."""
    base = settled(df.select(*[v.alias(n) for n, v in columns.items()]), "summary")
    values = {name: F.col(f"`{name}`") for name in columns}
    quartiles = exact_quantiles(base, values, [0.25, 0.5, 0.75])
    rows = base.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    _moments(value, places).alias("m"),
                    *[
                        F.bround(F.lit(q).cast("double"), places).alias(label)
                        for label, q in zip(("q25", "q50", "q75"), quartiles[name])
                    ],
                )
                for name, value in values.items()
            ]
        ).alias("summaries")
    )
    return rows.select(F.inline("summaries")).select(
        "column_name", "m.count", "m.mean", "m.std", "m.min", "q25", "q50", "q75", "m.max"
    )


def grouped_quantiles(
    counted: DataFrame, group: str, value: str, weight: str, probabilities: Sequence[float]
) -> DataFrame:
    """Interpolated quantiles per group of values that stand for ``weight`` rows each.

    ``counted`` has one row per group and value, neither null. The rows are ordered by group and value over
    all tasks and their weights added up; the places wanted in a group follow from where its
    rows begin, and only the rows that cover such a place are brought together. So no task holds
    the values of a group, and a group with a third of all rows is spread like the others.
    """
    ordered = stage(
        running_totals(counted, [F.col(group), F.col(value)], {"_upto": F.col(weight)}), "group-ranks"
    )
    groups = ordered.groupBy(group).agg(
        F.min(F.col("_upto") - F.col(weight)).alias("_before"), F.sum(weight).alias("_size")
    )
    placed = skew.left_joins(ordered, [groups], [group])
    first, end = F.col("_upto") - F.col(weight) - F.col("_before"), F.col("_upto") - F.col("_before")
    covers, cuts = F.lit(False), []
    for p in probabilities:
        place = F.lit(float(p)) * (F.col("_size") - 1)
        low, high = F.floor(place), F.ceil(place)
        at_low, at_high = (first <= low) & (low < end), (first <= high) & (high < end)
        covers = covers | at_low | at_high
        start, stop = F.max(F.when(at_low, F.col(value))), F.max(F.when(at_high, F.col(value)))
        part = F.max(place - low)
        cuts.append(F.when(part == 0, start).otherwise(start + (stop - start) * part))
    return placed.where(covers).groupBy(group).agg(F.array(*cuts).alias("q"))


def grouped_summary(df: DataFrame, group: str, value: str, places: int = 0) -> DataFrame:
    """The same summary of one column for each value of a category column.

    Values are counted before the quartiles are taken, so many equal rows cost no more than one.
    """
    rows = df.select(F.col(group), F.col(value).cast("double").alias("_value")).dropna(subset=[group])
    rows = settled(rows, "grouped")
    moments = rows.groupBy(group).agg(_moments(F.col("_value"), places).alias("m"))
    seen = rows.where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    counted = seen.groupBy(group, "_value").agg(F.count(F.lit(1)).alias("_rows"))
    quartiles = grouped_quantiles(counted, group, "_value", "_rows", [0.25, 0.5, 0.75])
    found = moments.join(quartiles, group, "left")
    cuts = [F.bround(F.get("q", k), places).alias(name) for k, name in enumerate(("q25", "q50", "q75"))]
    return found.select(
        F.col(group).cast("string").alias(group), "m.count", "m.mean", "m.std", "m.min", *cuts, "m.max"
    )


def quantile_report(
    df: DataFrame, columns: Mapping[str, Column], probabilities: Sequence[float]
) -> DataFrame:
    """Exact interpolated quantiles, one row per column and probability."""
    found = exact_quantiles(df, columns, probabilities)
    rows = [(name, p, q) for name, qs in found.items() for p, q in zip(probabilities, qs)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, probability double, quantile double"
    )


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width counts between the smallest and largest value, empty bins included.

    Bins are closed on the left, the last one on both sides. Without any spread the range is
    half a unit to both sides.
    """
    values = settled(df.select(value.cast("double").alias("v")), "histogram")
    values = values.where("v is not null and not isnan(v)")
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    flat = ends.getField("low") == ends.getField("high")
    low = F.when(flat, ends.getField("low") - 0.5).otherwise(ends.getField("low"))
    high = F.when(flat, ends.getField("high") + 0.5).otherwise(ends.getField("high"))
    step = (F.col("high") - F.col("low")) / bins

    def edge(index: Column) -> Column:
        return F.when(index == bins, F.col("high")).otherwise(F.col("low") + index * step)

    # the division can land one bin off next to an edge, so compare with the edges themselves
    guess = F.least(F.floor((F.col("v") - F.col("low")) / step), F.lit(bins - 1))
    index_of = (
        F.when(F.col("v") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("v") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = (
        values.withColumns({"low": low, "high": high})
        .withColumn("guess", guess)
        .groupBy(index_of.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    index = F.col("bin")
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .withColumns({"low": low, "high": high})
        .select(
            "bin",
            edge(index).alias("lower_edge"),
            edge(index + 1).alias("upper_edge"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
        )
    )
