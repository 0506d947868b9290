"""Registered Spark queries by name; each takes the session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.catalog import views
from monthmill.functions import cleaning, credit, loans
from monthmill.functions import retail as retail_expr
from monthmill.operators import asof, bitmaps, encode, impute, profile, sketches
from monthmill.plans import churn, customer_meta, feature_store, labels, medallion, monthly, retail, rfm, silver
from monthmill.session import tuned
from monthmill.sinks import writers
from monthmill.sources import calendar, readers
from monthmill.staging import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Categories of the test data, given so that the columns do not depend on the rows.
CREDIT_MIXES = ("Bad", "Good", "Standard", "_")
LOAN_TYPES = ("Auto Loan", "Credit-Builder Loan", "Home Equity Loan", "Payday Loan")


def register(query: Query) -> Query:
    """The session may have been built elsewhere, so it gets the settings it lacks."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tuned(spark), sf_dir)

    QUERIES[query.__name__] = run
    return run


def widened(df: DataFrame) -> DataFrame:
    """32-bit floats as doubles, so that every engine prints them alike."""
    return df.select(
        *[F.col(f"`{n}`").cast("double").alias(n) if t == "float" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


# --- cleaned layers ----------------------------------------------------------------


def _loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_loans(views.loan_daily(spark, sf_dir))


def _financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_financials(views.financials_raw(spark, sf_dir))


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_attributes(views.attributes_raw(spark, sf_dir))


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_clickstream(views.clickstream_raw(spark, sf_dir))


@register
def loan_silver(spark, sf_dir):
    return widened(_loans(spark, sf_dir))


@register
def financials_silver(spark, sf_dir):
    return widened(_financials(spark, sf_dir))


@register
def attributes_silver(spark, sf_dir):
    return _attributes(spark, sf_dir)


@register
def clickstream_silver(spark, sf_dir):
    return widened(_clicks(spark, sf_dir))


@register
def label_store(spark, sf_dir):
    return labels.default_labels(_loans(spark, sf_dir))


# --- encodings ---------------------------------------------------------------------


def _keyed(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select("Customer_ID", "snapshot_date", *columns)


@register
def history_age(spark, sf_dir):
    text = F.col("Credit_History_Age")
    months = credit.history_age_months(text).alias("Credit_History_Age_months")
    return _keyed(_financials(spark, sf_dir), text, months)


@register
def payment_ordinal(spark, sf_dir):
    text = F.col("Payment_Behaviour")
    ordinal = credit.payment_ordinal(text).alias("Payment_Behaviour_encoded")
    return _keyed(_financials(spark, sf_dir), text, ordinal)


@register
def credit_mix_onehot(spark, sf_dir):
    base = _keyed(_financials(spark, sf_dir), "Credit_Mix")
    return encode.one_hot(base, "Credit_Mix", "credit_mix_")


@register
def loan_type_flags(spark, sf_dir):
    base = _keyed(_financials(spark, sf_dir), "Type_of_Loan")
    return encode.multi_hot(base, "Type_of_Loan", "has_loan_")


@register
def loan_type_tokens(spark, sf_dir):
    """Frequency of each loan type after splitting the lists."""
    types = credit.loan_types(F.col("Type_of_Loan"))
    tokens = _financials(spark, sf_dir).select(F.explode(types).alias("loan_type"))
    return profile.frequency_table(tokens, "loan_type")


# --- point-in-time joins -------------------------------------------------------------


@register
def pit_join(spark, sf_dir):
    joined = asof.with_records(_loans(spark, sf_dir), [], exact=[_clicks(spark, sf_dir)])
    return widened(joined.select("loan_id", "Customer_ID", "snapshot_date", "fe_1", "fe_10", "fe_20"))


@register
def exact_join(spark, sf_dir):
    joined = feature_store.join_exact(
        _loans(spark, sf_dir), _clicks(spark, sf_dir), _financials(spark, sf_dir), _attributes(spark, sf_dir)
    )
    return widened(joined.select("loan_id", "snapshot_date", "fe_1", "Annual_Income", "Age", "Occupation"))


@register
def asof_financials(spark, sf_dir):
    joined = asof.asof_join(_loans(spark, sf_dir), asof.Feature("financials", _financials(spark, sf_dir)))
    kept = ("Annual_Income", "Num_of_Loan", "Credit_Mix", "Monthly_Balance", "financials_lag_days")
    return widened(joined.select("loan_id", "Customer_ID", "snapshot_date", *kept))


@register
def asof_attributes(spark, sf_dir):
    joined = asof.asof_join(_loans(spark, sf_dir), asof.Feature("attributes", _attributes(spark, sf_dir)))
    kept = ("Age", "SSN", "Occupation", "attributes_lag_days")
    return joined.select("loan_id", "Customer_ID", "snapshot_date", *kept)


@register
def asof_collapsed(spark, sf_dir):
    """One loan per customer and date, the one with the smallest id."""
    feature = asof.Feature("financials", _financials(spark, sf_dir))
    joined = asof.asof_join(_loans(spark, sf_dir), feature, collapse_on="loan_id")
    return widened(
        joined.select("loan_id", "Customer_ID", "snapshot_date", "Annual_Income", "financials_lag_days")
    )


@register
def asof_match_rate(spark, sf_dir):
    features = [
        asof.Feature("financials", _financials(spark, sf_dir)),
        asof.Feature("attributes", _attributes(spark, sf_dir)),
    ]
    return asof.match_rate(_loans(spark, sf_dir), features)


# --- feature store -------------------------------------------------------------------


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        _financials(spark, sf_dir),
        _loans(spark, sf_dir),
        _clicks(spark, sf_dir),
        _attributes(spark, sf_dir),
    )


@register
def loan_ratios(spark, sf_dir):
    """Loan age and the five ratios before imputation."""
    built = feature_store.build_features(
        *_inputs(spark, sf_dir), credit_mixes=CREDIT_MIXES, loan_types=LOAN_TYPES
    )
    return built.select("loan_id", "snapshot_date", "loan_age_days", *loans.ratio_features())


def _store(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return widened(
        feature_store.feature_store(
            *_inputs(spark, sf_dir),
            exact_medians=True,
            credit_mixes=CREDIT_MIXES,
            loan_types=LOAN_TYPES,
            **options,
        )
    )


@register
def feature_store_asof(spark, sf_dir):
    return _store(spark, sf_dir)


@register
def feature_store_discovered(spark, sf_dir):
    """With the categories that the data hold instead of given ones."""
    return widened(feature_store.feature_store(*_inputs(spark, sf_dir), exact_medians=True))


@register
def feature_store_exact(spark, sf_dir):
    return _store(spark, sf_dir, mode="exact")


@register
def feature_store_collapsed(spark, sf_dir):
    return _store(spark, sf_dir, collapse=True)


@register
def feature_store_fit_period(spark, sf_dir):
    """Medians from the snapshots up to the end of 1998 only."""
    return _store(spark, sf_dir, fit_period=(None, "1998-12-31"))


@register
def month_from_states(spark, sf_dir):
    """Features of one month before imputation, from states that were advanced over three snapshots."""
    folder = new_folder(spark, "mart")
    financials, loan_rows, clicks, attributes = _inputs(spark, sf_dir)
    parts = {"loan_daily": loan_rows, "clickstream": clicks, "financials": financials, "attributes": attributes}
    for name, rows in parts.items():
        writers.write_layer(rows, f"{folder}/silver/{name}")
    for day in ("1996-02-01", "1997-09-01", "1998-06-01"):
        for name in ("financials", "attributes"):
            monthly.store_state(spark, f"{folder}/silver/{name}", f"{folder}/state/{name}", day)
    built = monthly.month_features(
        spark, "1998-06-01", f"{folder}/silver/loan_daily", f"{folder}/silver/clickstream",
        f"{folder}/state/financials", f"{folder}/state/attributes", credit_mixes=CREDIT_MIXES, loan_types=LOAN_TYPES,
    )
    return widened(built)


@register
def sketch_medians(spark, sf_dir):
    """Medians of the features up to the end of 1998 from stored monthly sketches, and whether each has
    the rank it should have to 0.1 %."""
    features = feature_store.staged_features(
        *_inputs(spark, sf_dir), credit_mixes=CREDIT_MIXES, loan_types=LOAN_TYPES,
        keep=lambda built: [readers.SNAPSHOT, *impute.imputed_columns(built)],
    ).rows()
    columns = impute.imputed_columns(features)
    stored = sketches.store_sketches(features, columns, new_folder(spark, "sketches"))
    medians = sketches.medians_by_column(stored, None, "1998-12-31")
    ranks = sketches.rank_errors(readers.in_period(features, None, "1998-12-31"), medians, columns)
    return ranks.select(
        "column_name", "n_values", F.coalesce(F.col("rank_error") <= 0.001, F.col("n_values") == 0).alias("within_error")
    )


@register
def median_impute(spark, sf_dir):
    """Gaps punched into customers and line items, filled with exact medians."""
    c = F.col("c_custkey")
    customers = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(c % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(c % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.lit(None).cast("double").alias("never_known"),
    )
    return impute.median_impute(customers, keep=["c_custkey"], exact=True)


@register
def lineitem_medians(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    found = impute.column_medians(items, names, exact=True)
    return spark.createDataFrame(list(found.items()), "column_name string, median double")


# --- layers on storage ---------------------------------------------------------------


def _sources(spark: SparkSession, sf_dir: str) -> str:
    """The four source files as CSV."""
    folder = new_folder(spark, "sources")
    makers = {
        "loan_daily": views.loan_daily,
        "financials": views.financials_raw,
        "attributes": views.attributes_raw,
        "clickstream": views.clickstream_raw,
    }
    for name, maker in makers.items():
        writers.write_csv(maker(spark, sf_dir), f"{folder}/{medallion.TABLES[name].source_file}", "gzip")
    return folder


@register
def pipeline_labels(spark, sf_dir):
    """Loan file to bronze, silver and label store, read back."""
    folder, source = new_folder(spark, "mart"), new_folder(spark, "source")
    writers.write_csv(views.loan_daily(spark, sf_dir), source, "gzip")
    medallion.ingest_bronze(spark, "loan_daily", source, f"{folder}/bronze")
    medallion.refine_silver(spark, "loan_daily", f"{folder}/bronze", f"{folder}/silver")
    return medallion.store_labels(spark, f"{folder}/silver", f"{folder}/labels")


@register
def relabel_rerun(spark, sf_dir):
    """Labels stored for one loan age, then for another on the same folder: only the second stays."""
    folder = new_folder(spark, "labels")
    clean = f"{folder}/silver"
    writers.write_layer(_loans(spark, sf_dir), clean)
    medallion.store_labels(spark, clean, f"{folder}/gold", mob=6)
    medallion.store_labels(spark, clean, f"{folder}/gold", mob=0)
    return readers.read_layer(spark, f"{folder}/gold")


@register
def silver_rerun(spark, sf_dir):
    """A month whose rows lose their keys between two runs is gone after the second."""
    folder, source = new_folder(spark, "mart"), new_folder(spark, "source")
    raw = views.attributes_raw(spark, sf_dir)
    gone = F.col("snapshot_date") == "1995-06-01"
    for number, rows in enumerate((raw, raw.withColumn("Customer_ID", F.when(~gone, F.col("Customer_ID"))))):
        writers.write_csv(rows, f"{source}/{number}")
        medallion.ingest_bronze(spark, "attributes", f"{source}/{number}", f"{folder}/bronze")
        medallion.refine_silver(spark, "attributes", f"{folder}/bronze", f"{folder}/silver")
    return readers.read_layer(spark, f"{folder}/silver").select("Customer_ID", "snapshot_date")


@register
def calendar_backfill(spark, sf_dir):
    """A start inside a month loads that month; snapshots inside a month are not loaded."""
    folder, source = new_folder(spark, "mart"), new_folder(spark, "source")
    raw = views.loan_daily(spark, sf_dir)
    inside = raw.withColumn("snapshot_date", F.date_add("snapshot_date", 16))
    writers.write_csv(raw.unionByName(inside), source, "gzip")
    period = ("1997-05-15", "1998-02-10")
    medallion.ingest_bronze(spark, "loan_daily", source, f"{folder}/bronze", *period, calendar=True)
    clean = medallion.refine_silver(spark, "loan_daily", f"{folder}/bronze", f"{folder}/silver")
    return clean.select("loan_id", "installment_num", "snapshot_date")


@register
def calendar_months(spark, sf_dir):
    """The months that the backfill asks for, kept to those in which a loan has a snapshot."""
    found = views.loan_daily(spark, sf_dir).select("snapshot_date").distinct()
    return calendar.month_calendar(spark, "1997-05-15", "1998-02-10").join(found, "snapshot_date", "left_semi")


@register
def quoted_transactions(spark, sf_dir):
    """Descriptions with commas, quotes and line breaks written as CSV and scanned again."""
    folder = new_folder(spark, "transactions")
    raw = views.retail_tx(spark, sf_dir)
    odd = F.concat("Description", F.lit(', "'), "StockCode", F.lit('"\n end'))
    text = raw.withColumns({"Description": odd, "InvoiceDate": F.date_format("InvoiceDate", "M/d/yyyy H:mm")})
    text.write.options(**writers.CSV).csv(folder, encoding="ISO-8859-1")
    back = readers.read_transactions(spark, folder, multi_line=True)
    return back.select("InvoiceNo", "StockCode", "Description", "Quantity", "Country")


@register
def metadata_file(spark, sf_dir):
    """The metadata table written as CSV with a header and read back."""
    folder = new_folder(spark, "metadata")
    table = QUERIES["customer_metadata"](spark, sf_dir)
    writers.write_csv(table, folder)
    return spark.read.schema(table.schema).options(**writers.CSV).csv(folder)


@register
def pipeline_features(spark, sf_dir):
    """All four files through all layers; the stored features are read back."""
    folder = new_folder(spark, "mart")
    _, features = medallion.run_pipeline(
        spark, _sources(spark, sf_dir), folder, None, None,
        exact_medians=True, credit_mixes=CREDIT_MIXES, loan_types=LOAN_TYPES,
    )
    return widened(features)


@register
def pipeline_audit(spark, sf_dir):
    """What a run says about its layers: rows per table and snapshot, and how many features matched."""
    folder = new_folder(spark, "mart")
    medallion.run_pipeline(
        spark, _sources(spark, sf_dir), folder, None, None, credit_mixes=CREDIT_MIXES, loan_types=LOAN_TYPES
    )
    return spark.read.parquet(f"{folder}/audit")


@register
def raw_layer(spark, sf_dir):
    """Raw attribute file to bronze and back, every value as text."""
    folder, source = new_folder(spark, "mart"), new_folder(spark, "source")
    writers.write_csv(views.attributes_raw(spark, sf_dir), source)
    bronze = medallion.ingest_bronze(spark, "attributes", source, folder)
    return bronze.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@register
def transactions_file(spark, sf_dir):
    """Transactions written as CSV and scanned again, then revenue per country."""
    folder = new_folder(spark, "transactions")
    raw = views.retail_tx(spark, sf_dir)
    text = raw.withColumn("InvoiceDate", F.date_format("InvoiceDate", "M/d/yyyy H:mm"))
    text.write.csv(folder, header=True, encoding="ISO-8859-1")
    sales = retail.clean_sales(readers.read_transactions(spark, folder))
    return retail.country_revenue(sales)


@register
def snapshot_dates(spark, sf_dir):
    return calendar.snapshot_dates(views.loan_daily(spark, sf_dir))


@register
def month_calendar(spark, sf_dir):
    return calendar.month_range(views.loan_daily(spark, sf_dir))


@register
def rows_per_snapshot(spark, sf_dir):
    return calendar.rows_per_snapshot(_loans(spark, sf_dir))


@register
def snapshot_slice(spark, sf_dir):
    """One month of the loans."""
    return widened(readers.on_day(_loans(spark, sf_dir), "1998-06-01"))


# --- retail profile ------------------------------------------------------------------


def _tx(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return views.retail_tx(spark, sf_dir, *columns)


def _sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Valid sales with the needed columns; those that the test for validity needs come along."""
    needed = ("InvoiceNo", "CustomerID", "Quantity", "UnitPrice")
    if columns:
        columns = (*needed, *[c for c in columns if c not in needed])
    return retail.clean_sales(views.retail_tx(spark, sf_dir, *columns))


@register
def null_profile(spark, sf_dir):
    return profile.null_profile(_tx(spark, sf_dir))


@register
def column_cardinality(spark, sf_dir):
    names = ["InvoiceNo", "StockCode", "Description", "CustomerID", "Country"]
    return profile.distinct_counts(_tx(spark, sf_dir, *names), names)


@register
def distinct_by_period(spark, sf_dir):
    """Distinct customers, products, countries and invoices per month, quarter and in all, from the
    same stored bitmaps. The store is filled in two runs, the second of which repeats months of the first."""
    names = ["CustomerID", "StockCode", "Country", "InvoiceNo"]
    lines = stage(_tx(spark, sf_dir, *names, "InvoiceDate"), "lines")
    store = bitmaps.BitmapStore(spark, new_folder(spark, "bitmaps"))
    day = F.col("InvoiceDate").cast("date")
    store.store(lines.where(day < "1998-01-01"), day, names, None, "1997-12-01")
    store.store(lines.where(day >= "1997-06-01"), day, names, "1997-06-01", None)
    month = F.col(bitmaps.PERIOD)
    return (
        store.counts(month, "month")
        .unionByName(store.counts(F.trunc(month, "quarter"), "quarter"))
        .unionByName(store.counts())
    )


@register
def numeric_summary(spark, sf_dir):
    names = ("Quantity", "UnitPrice", "CustomerID")
    return profile.numeric_summary(_tx(spark, sf_dir, *names), {n: F.col(n) for n in names})


@register
def anomaly_counts(spark, sf_dir):
    return retail.anomaly_counts(_tx(spark, sf_dir, "InvoiceNo", "StockCode", "Quantity", "UnitPrice"))


@register
def date_range(spark, sf_dir):
    return profile.date_range(_tx(spark, sf_dir, "InvoiceDate"), "InvoiceDate")


@register
def clean_size(spark, sf_dir):
    return retail.table_size(_sales(spark, sf_dir, "CustomerID"))


@register
def upper_quantiles(spark, sf_dir):
    lines = retail.positive_lines(_tx(spark, sf_dir, "Quantity", "UnitPrice"))
    return profile.quantile_report(lines, {n: F.col(n) for n in ("Quantity", "UnitPrice")}, [0.99])


@register
def column_maxima(spark, sf_dir):
    return profile.column_maxima(_tx(spark, sf_dir, "Quantity", "UnitPrice"), ["Quantity", "UnitPrice"])


@register
def histogram_quantity(spark, sf_dir):
    lines = retail.positive_lines(_tx(spark, sf_dir, "Quantity", "UnitPrice"))
    return profile.histogram(lines, cleaning.cap(F.col("Quantity"), 200), 60)


@register
def histogram_price(spark, sf_dir):
    lines = retail.positive_lines(_tx(spark, sf_dir, "Quantity", "UnitPrice"))
    return profile.histogram(lines, cleaning.cap(F.col("UnitPrice"), 30), 60)


# --- retail reports ------------------------------------------------------------------


@register
def monthly_revenue(spark, sf_dir):
    return retail.monthly_revenue(_sales(spark, sf_dir, "InvoiceDate"))


@register
def peak_month(spark, sf_dir):
    return retail.peak_month(_sales(spark, sf_dir, "InvoiceDate"))


@register
def orders_by_hour(spark, sf_dir):
    return retail.orders_by_hour(_sales(spark, sf_dir, "InvoiceDate"))


@register
def orders_by_weekday(spark, sf_dir):
    return retail.orders_by_weekday(_sales(spark, sf_dir, "InvoiceDate"))


@register
def country_revenue(spark, sf_dir):
    return retail.country_revenue(_sales(spark, sf_dir, "Country"))


@register
def top_countries(spark, sf_dir):
    return retail.country_revenue(_sales(spark, sf_dir, "Country"), top=10)


@register
def home_vs_abroad(spark, sf_dir):
    return retail.home_vs_abroad(_sales(spark, sf_dir, "Country"))


@register
def customer_summary(spark, sf_dir):
    return retail.customer_summary(_sales(spark, sf_dir, "InvoiceDate"))


@register
def customer_statistics(spark, sf_dir):
    return retail.customer_statistics(_sales(spark, sf_dir, "InvoiceDate"))


@register
def order_count_shares(spark, sf_dir):
    return retail.order_count_shares(_sales(spark, sf_dir, "CustomerID"))


@register
def histogram_orders(spark, sf_dir):
    """Orders per customer, capped at 30."""
    customers = retail.customer_summary(_sales(spark, sf_dir, "InvoiceDate"))
    return profile.histogram(customers, cleaning.cap(F.col("Orders"), 30), 30)


@register
def pareto_customers(spark, sf_dir):
    return retail.pareto_customers(_sales(spark, sf_dir, "CustomerID"))


@register
def pareto_top_share(spark, sf_dir):
    return retail.top_share(retail.pareto_customers(_sales(spark, sf_dir, "CustomerID")))


@register
def top_products(spark, sf_dir):
    return retail.top_products(_sales(spark, sf_dir, "StockCode", "Description"))


@register
def top100_share(spark, sf_dir):
    return retail.top_products_share(_sales(spark, sf_dir, "StockCode", "Description"))


@register
def product_revenue(spark, sf_dir):
    products = retail.product_revenue(_sales(spark, sf_dir, "StockCode", "Description"))
    return products.withColumn("Revenue", F.col("Revenue").cast("double"))


@register
def product_long_tail(spark, sf_dir):
    return retail.product_long_tail(_sales(spark, sf_dir, "StockCode", "Description"))


@register
def long_tail_80(spark, sf_dir):
    curve = retail.product_long_tail(_sales(spark, sf_dir, "StockCode", "Description"))
    return retail.products_within(curve)


@register
def basket_summary(spark, sf_dir):
    return retail.baskets(_sales(spark, sf_dir, "StockCode"))


@register
def basket_statistics(spark, sf_dir):
    return retail.basket_statistics(_sales(spark, sf_dir, "StockCode"))


def _basket_histogram(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    """A basket measure, capped at its 99th percentile."""
    table = stage(retail.baskets(_sales(spark, sf_dir, "StockCode")).select(measure), "baskets")
    bound = profile.exact_quantiles(table, {measure: F.col(measure)}, [0.99])[measure][0]
    return profile.histogram(table, cleaning.cap(F.col(measure).cast("double"), bound), 50)


@register
def histogram_basket(spark, sf_dir):
    return _basket_histogram(spark, sf_dir, "Revenue")


@register
def histogram_basket_items(spark, sf_dir):
    return _basket_histogram(spark, sf_dir, "Items")


@register
def histogram_basket_skus(spark, sf_dir):
    return _basket_histogram(spark, sf_dir, "SKUs")


# --- segments, churn, metadata -------------------------------------------------------


@register
def rfm_base(spark, sf_dir):
    base = rfm.rfm_base(_sales(spark, sf_dir, "InvoiceDate"))
    return base.withColumn("Monetary", F.col("Monetary").cast("double"))


@register
def rfm_scores(spark, sf_dir):
    return rfm.rfm_scores(_sales(spark, sf_dir, "InvoiceDate"))


@register
def rfm_segments(spark, sf_dir):
    return rfm.segment_summary(rfm.rfm_scores(_sales(spark, sf_dir, "InvoiceDate")))


@register
def histogram_recency(spark, sf_dir):
    return profile.histogram(rfm.rfm_base(_sales(spark, sf_dir, "InvoiceDate")), F.col("Recency"), 50)


@register
def histogram_frequency(spark, sf_dir):
    """Orders of the RFM table, capped at 30."""
    base = rfm.rfm_base(_sales(spark, sf_dir, "InvoiceDate"))
    return profile.histogram(base, cleaning.cap(F.col("Frequency"), 30), 30)


@register
def histogram_monetary(spark, sf_dir):
    """Revenue of the RFM table, capped."""
    base = rfm.rfm_base(_sales(spark, sf_dir, "InvoiceDate"))
    return profile.histogram(base, cleaning.cap(F.col("Monetary").cast("double"), 10000.0), 50)


def _churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _sales(spark, sf_dir, "InvoiceDate")
    return churn.churn_labels(sales, views.OBSERVED_UNTIL, views.LABELLED_UNTIL)


@register
def churn_label(spark, sf_dir):
    return _churn(spark, sf_dir)


@register
def churn_rate(spark, sf_dir):
    return churn.churn_rate(_churn(spark, sf_dir))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_meta.customer_stats(_sales(spark, sf_dir, "InvoiceDate", "Country"))


@register
def customer_stats(spark, sf_dir):
    return _stats(spark, sf_dir).withColumn("total_revenue", F.col("total_revenue").cast("double"))


@register
def customer_tiers(spark, sf_dir):
    tiers = customer_meta.add_tiers(_stats(spark, sf_dir))
    return tiers.select("CustomerID", "company_size", "is_vip")


@register
def customer_region(spark, sf_dir):
    placed = customer_meta.add_placement(customer_meta.add_tiers(_stats(spark, sf_dir)))
    return placed.select("CustomerID", "primary_country", "region")


@register
def account_manager(spark, sf_dir):
    placed = customer_meta.add_placement(customer_meta.add_tiers(_stats(spark, sf_dir)))
    return placed.select("CustomerID", "company_size", "account_manager")


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_meta.customer_metadata(_sales(spark, sf_dir, "InvoiceDate", "Country"))


@register
def weighted_assignment(spark, sf_dir):
    return _metadata(spark, sf_dir).select(
        "customer_id", "vertical", "onboard_channel", "payment_terms_days"
    )


@register
def noisy_numbers(spark, sf_dir):
    return _metadata(spark, sf_dir).select("customer_id", "credit_limit_gbp", "years_in_business")


@register
def customer_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir)


@register
def metadata_preview(spark, sf_dir):
    """The first five customers."""
    return _metadata(spark, sf_dir).orderBy("customer_id").limit(5)


@register
def vertical_distribution(spark, sf_dir):
    return profile.frequency_table(_metadata(spark, sf_dir), "vertical")


@register
def region_distribution(spark, sf_dir):
    return profile.frequency_table(_metadata(spark, sf_dir), "region")


@register
def size_distribution(spark, sf_dir):
    return profile.frequency_table(_metadata(spark, sf_dir), "company_size")


@register
def credit_limit_by_size(spark, sf_dir):
    return profile.grouped_summary(_metadata(spark, sf_dir), "company_size", "credit_limit_gbp")


@register
def price_by_part_group(spark, sf_dir):
    """Summary of a continuous column; a third of all rows is in one group."""
    part = F.col("l_partkey")
    group = F.when(part % 3 == 0, F.lit("thirds")).otherwise(F.concat(F.lit("g"), (part % 20).cast("string")))
    items = views.table(spark, sf_dir, "lineitem").select(
        group.alias("part_group"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price")
    )
    return profile.grouped_summary(items, "part_group", "net_price", 2)


@register
def vip_share(spark, sf_dir):
    return customer_meta.vip_share(_metadata(spark, sf_dir))
