"""One month of the feature store without reading the history.

A state table holds, per customer, the last record known on a day, with the date of that record. The state
of a day is that of an earlier day and the records in between, so each run reads one state and the
records since. The as-of features of a month need its loans, its clicks and its states only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.operators import asof, sketches
from monthmill.operators.impute import fill_missing
from monthmill.plans.feature_store import build_features
from monthmill.sinks import writers
from monthmill.sources import journal, readers
from monthmill.sources.readers import SNAPSHOT

AS_OF = "as_of"


def advance(
    rows: DataFrame,
    day: str | date,
    state: DataFrame | None = None,
    since: str | date | None = None,
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """The last record of every customer up to ``day``: from ``rows`` dated after ``since``, else from ``state``.

    ``rows`` and ``state`` have the columns of a feature table; ``state`` has one row per customer. Records of one
    customer and date are chosen as the as-of join chooses them. Rows without customer or date are left out.
    """
    dated = F.col(SNAPSHOT).cast("date")
    new = rows.where(dated <= F.lit(str(day)).cast("date"))
    if since is not None:
        new = new.where(dated > F.lit(str(since)).cast("date"))
    if state is not None:
        new = new.unionByName(state.select(*rows.columns))
    records = asof.one_record_per_date(asof.Feature("record", new, tie_break))
    latest = records.groupBy(asof.KEY).agg(F.max_by("record", SNAPSHOT).alias("record"))
    date_of = F.col(f"record.{asof.FEATURE_DATE}").alias(SNAPSHOT)
    found = {asof.KEY: F.col(asof.KEY), SNAPSHOT: date_of}
    return latest.select(*[found.get(c, F.col(f"record.`{c}`").alias(c)) for c in rows.columns])


def _states(spark: SparkSession, root: str) -> DataFrame:
    return journal.current(spark, root, AS_OF, lambda folders, options: spark.read.options(**options).parquet(*folders))


def last_state(spark: SparkSession, root: str, before: str | date) -> str | None:
    """The last day before ``before`` that has a stored state."""
    if not journal.Layer(spark, root, AS_OF).has_months():
        return None
    # folder names alone: no column of the states is read
    day = F.col(AS_OF).cast("string")
    return _states(spark, root).where(day < str(before)).agg(F.max(day)).first()[0]


def read_state(spark: SparkSession, root: str, day: str | date) -> DataFrame:
    """The state of a stored day."""
    return _states(spark, root).where(F.col(AS_OF) == F.lit(str(day)).cast("date")).drop(AS_OF)


def store_state(spark: SparkSession, layer: str, root: str, day: str | date) -> DataFrame:
    """Store the state of ``day``, from the last stored state before it and the layer's rows since.

    Storing a day again replaces its state. A day before others leaves those as they are: store
    them again in order after old records have changed."""
    since = last_state(spark, root, day)
    rows = readers.read_layer(spark, layer)
    previous = None if since is None else read_state(spark, root, since)
    state = advance(rows, day, previous, since)
    dated = state.withColumn(AS_OF, F.lit(str(day)).cast("date"))
    writers.swap_in(dated, root, AS_OF, start=day, end=day)
    return read_state(spark, root, day)


def month_features(
    spark: SparkSession,
    day: str | date,
    silver_loans: str,
    silver_clickstream: str,
    financial_states: str,
    attribute_states: str,
    **options,
) -> DataFrame:
    """The features of one snapshot before imputation, as the whole as-of join has them.

    The states of ``day`` must be stored. Options as for ``build_features``."""
    return build_features(
        read_state(spark, financial_states, day),
        readers.read_layer(spark, silver_loans, day),
        readers.read_layer(spark, silver_clickstream, day),
        read_state(spark, attribute_states, day),
        **options,
    )


def refresh_month(
    spark: SparkSession,
    day: str | date,
    datamart: str,
    fit_period: tuple[str | None, str | None] = (None, None),
    **options,
) -> DataFrame:
    """Replace one month of a stored feature store: states are advanced to ``day``, medians come from the
    sketches kept beside the store, and no other month is read or written. Give the category lists
    that the store was made with."""
    layers, store = f"{datamart}/silver", f"{datamart}/gold/feature_store"
    states = {name: f"{datamart}/state/{name}" for name in ("financials", "attributes")}
    for name, root in states.items():
        store_state(spark, f"{layers}/{name}", root, day)
    built = month_features(
        spark, day, f"{layers}/loan_daily", f"{layers}/clickstream", states["financials"], states["attributes"], **options
    )
    stored = readers.read_layer(spark, f"{store}_sketches")
    filled = fill_missing(built, sketches.medians_by_column(stored, *fit_period))
    writers.write_layer(filled, store, start=day, end=day)
    return readers.read_layer(spark, store, day)
