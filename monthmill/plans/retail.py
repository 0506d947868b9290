"""Revenue, basket, customer and product reports on retail transactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.functions import retail as expr
from monthmill.operators.ordering import running_totals
from monthmill.operators.profile import numeric_summary
from monthmill.staging import settled


def _money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def clean_sales(transactions: DataFrame) -> DataFrame:
    """Valid sales with their revenue: not cancelled, known customer, positive amounts."""
    valid = expr.is_valid_sale(*[F.col(c) for c in ("InvoiceNo", "CustomerID", "Quantity", "UnitPrice")])
    revenue = expr.revenue(F.col("Quantity"), F.col("UnitPrice"))
    return transactions.where(valid).withColumn("Revenue", revenue)


def positive_lines(transactions: DataFrame) -> DataFrame:
    return transactions.where(expr.is_priced(F.col("Quantity"), F.col("UnitPrice")))


def table_size(transactions: DataFrame, customer: str = "CustomerID") -> DataFrame:
    """Rows and customers of a transaction table."""
    return transactions.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(customer).alias("customers")
    )


def anomaly_counts(
    transactions: DataFrame, codes: Iterable[str] = fixed.NON_PRODUCT_CODES
) -> DataFrame:
    """Cancelled, negative, free and non-product lines, counted in one scan."""
    cancelled = F.count_if(expr.is_cancelled(F.col("InvoiceNo")))
    return transactions.agg(
        cancelled.alias("cancelled_rows"),
        F.count_if(F.col("Quantity") < 0).alias("negative_quantity_rows"),
        F.count_if(F.col("UnitPrice") < 0).alias("negative_price_rows"),
        F.count_if(F.col("UnitPrice") == 0).alias("zero_price_rows"),
        F.count_if(expr.is_non_product(F.col("StockCode"), codes)).alias("non_product_rows"),
        F.bround(expr.percent(cancelled, F.count(F.lit(1))), 2).alias("cancelled_pct"),
    )


def _totals_by(sales: DataFrame, group: Column, name: str) -> DataFrame:
    """Revenue, orders and customers per group.

    Lines are first summed per invoice: two distinct counts triple their input, which should
    not happen to every line.
    """
    invoices = sales.groupBy(group.alias(name), "InvoiceNo", "CustomerID").agg(
        F.sum("Revenue").alias("Revenue")
    )
    return invoices.groupBy(name).agg(
        F.sum("Revenue").alias("Revenue"),
        F.count_distinct("InvoiceNo").alias("Orders"),
        F.count_distinct("CustomerID").alias("Customers"),
    )


def _share_of_all(name: str, places: int) -> Column:
    """Percentage of the total over all rows; for tables of a few rows, such as countries."""
    whole = F.sum(name).over(Window.partitionBy())
    return F.bround(expr.percent(F.col(name), whole), places)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue, orders and customers per month."""
    months = _totals_by(sales, expr.year_month(F.col("InvoiceDate")), "YearMonth")
    return months.withColumn("Revenue", _money("Revenue"))


def peak_month(sales: DataFrame) -> DataFrame:
    """The month with the highest revenue, the earliest on ties."""
    months = sales.groupBy(expr.year_month(F.col("InvoiceDate")).alias("YearMonth")).agg(
        F.sum("Revenue").alias("Revenue")
    )
    best = months.orderBy(F.desc("Revenue"), "YearMonth").limit(1)
    return best.withColumn("Revenue", _money("Revenue"))


def orders_by_hour(sales: DataFrame) -> DataFrame:
    hour = F.hour("InvoiceDate").alias("Hour")
    return sales.groupBy(hour).agg(F.count_distinct("InvoiceNo").alias("Orders"))


def orders_by_weekday(sales: DataFrame) -> DataFrame:
    """Orders for each of the seven weekdays, 0 where there are none."""
    counted = sales.groupBy(expr.weekday_name(F.col("InvoiceDate")).alias("DayOfWeek")).agg(
        F.count_distinct("InvoiceNo").alias("Orders")
    )
    names = F.array(*[F.lit(name) for name in fixed.WEEKDAYS])
    week = sales.sparkSession.range(1).select(F.posexplode(names).alias("day_number", "DayOfWeek"))
    return week.join(counted, "DayOfWeek", "left").select(
        "day_number", "DayOfWeek", F.coalesce("Orders", F.lit(0)).alias("Orders")
    )


def country_revenue(sales: DataFrame, top: int | None = None) -> DataFrame:
    """Revenue, orders and customers per country and the share of all revenue, best first."""
    countries = _totals_by(sales.dropna(subset=["Country"]), F.col("Country"), "Country")
    report = countries.select(
        "Country",
        "Orders",
        "Customers",
        _money("Revenue"),
        _share_of_all("Revenue", 2).alias("Revenue_pct"),
    ).orderBy(F.desc("Revenue"), "Country")
    return report if top is None else report.limit(top)


def home_vs_abroad(sales: DataFrame, home: str = fixed.HOME_COUNTRY) -> DataFrame:
    """Revenue of the home country against all others, with shares."""
    side = F.when(F.col("Country") == home, F.lit(home)).otherwise(F.lit("International"))
    sides = sales.dropna(subset=["Country"]).groupBy(side.alias("Market")).agg(
        F.sum("Revenue").alias("Revenue")
    )
    return sides.select(
        "Market", _money("Revenue"), _share_of_all("Revenue", 1).alias("Revenue_pct")
    )


def customer_summary(sales: DataFrame) -> DataFrame:
    """Orders, revenue, items, first and last order, average order value and tenure."""
    customers = sales.groupBy("CustomerID").agg(
        F.count_distinct("InvoiceNo").alias("Orders"),
        F.sum("Revenue").alias("Revenue"),
        F.sum("Quantity").alias("Items"),
        F.min("InvoiceDate").alias("FirstOrder"),
        F.max("InvoiceDate").alias("LastOrder"),
    )
    return customers.withColumns(
        {
            "Revenue": F.col("Revenue").cast("double"),
            "AvgOrderValue": F.col("Revenue").cast("double") / F.col("Orders"),
            "TenureDays": expr.elapsed_days(F.col("FirstOrder"), F.col("LastOrder")),
        }
    )


def customer_statistics(sales: DataFrame) -> DataFrame:
    """Summary of the customer table's measures."""
    names = ("Orders", "Revenue", "AvgOrderValue", "TenureDays")
    return numeric_summary(customer_summary(sales), {n: F.col(n) for n in names})


def order_count_shares(sales: DataFrame, many: int = 5) -> DataFrame:
    """Customers with a single order and with at least ``many``, as counts and percentages."""
    orders = sales.groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("Orders"))
    single, frequent = F.col("Orders") == 1, F.col("Orders") >= many
    everyone = F.count(F.lit(1))
    return orders.agg(
        F.count_if(single).alias("single_order_customers"),
        F.bround(expr.percent(F.count_if(single), everyone), 1).alias("single_order_pct"),
        F.count_if(frequent).alias("frequent_customers"),
        F.bround(expr.percent(F.count_if(frequent), everyone), 1).alias("frequent_pct"),
    )


def revenue_curve(table: DataFrame, key: list[str], position: str, share: str | None = None) -> DataFrame:
    """Rows by falling revenue with position, cumulative revenue % and optionally position %."""
    order = [F.desc("Revenue"), *[F.col(k) for k in key]]
    ranked = running_totals(
        table.select(*key, "Revenue"),
        order,
        running={position: F.lit(1).cast("bigint"), "_running": F.col("Revenue")},
        totals={"_rows": position, "_whole": "_running"},
    )
    columns = {"CumRevPct": expr.percent(F.col("_running"), F.col("_whole"))}
    if share:
        columns[share] = F.col(position) / F.col("_rows") * 100
    return ranked.withColumns(columns).withColumn("Revenue", _money("Revenue")).drop(
        "_running", "_whole", "_rows"
    )


def pareto_customers(sales: DataFrame) -> DataFrame:
    """Customers by revenue with cumulative share of revenue and of customers."""
    customers = sales.groupBy("CustomerID").agg(F.sum("Revenue").alias("Revenue"))
    return revenue_curve(customers, ["CustomerID"], "Position", "CustPct")


def top_share(curve: DataFrame, percent_of_customers: float = 20) -> DataFrame:
    """Cumulative revenue share reached within the given share of customers."""
    within = F.when(F.col("CustPct") <= percent_of_customers, F.col("CumRevPct"))
    return curve.agg(F.max(within).alias("top_revenue_pct"))


def product_revenue(
    sales: DataFrame, codes: Iterable[str] = fixed.NON_PRODUCT_CODES_WIDE
) -> DataFrame:
    """Revenue, quantity, orders and customers per product; lines without a description are left out."""
    products = sales.dropna(subset=["StockCode", "Description"]).where(
        ~expr.is_non_product(F.col("StockCode"), codes)
    )
    # lines are summed per invoice first; two distinct counts over raw lines would triple them
    per_order = products.groupBy("StockCode", "Description", "InvoiceNo", "CustomerID").agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Quantity").alias("Quantity")
    )
    per_customer = per_order.groupBy("StockCode", "Description", "CustomerID").agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Quantity").alias("Quantity")
    )
    totals = per_customer.groupBy("StockCode", "Description").agg(
        F.sum("Revenue").alias("Revenue"),
        F.sum("Quantity").alias("Qty_sold"),
        F.count("CustomerID").alias("Unique_customers"),
    )
    orders = per_order.groupBy("StockCode", "Description", "InvoiceNo").agg(F.lit(1).alias("one"))
    orders = orders.groupBy("StockCode", "Description").agg(F.count("InvoiceNo").alias("Unique_orders"))
    return totals.join(orders, ["StockCode", "Description"]).select(
        "StockCode", "Description", "Revenue", "Qty_sold", "Unique_orders", "Unique_customers"
    )


def _best_products(products: DataFrame, top: int) -> DataFrame:
    return products.orderBy(F.desc("Revenue"), "StockCode", "Description").limit(top)


def top_products(sales: DataFrame, top: int = 15) -> DataFrame:
    """The products with the highest revenue.

    They are found by revenue alone; only their lines go through the distinct counts.
    """
    best = _best_products(_product_totals(sales), top).select("StockCode", "Description")
    lines = sales.join(F.broadcast(best), ["StockCode", "Description"], "left_semi")
    products = product_revenue(lines).orderBy(F.desc("Revenue"), "StockCode", "Description")
    return products.withColumn("Revenue", _money("Revenue"))


def _product_totals(sales: DataFrame) -> DataFrame:
    kept = sales.dropna(subset=["StockCode", "Description"]).where(
        ~expr.is_non_product(F.col("StockCode"), fixed.NON_PRODUCT_CODES_WIDE)
    )
    return kept.groupBy("StockCode", "Description").agg(F.sum("Revenue").alias("Revenue"))


def top_products_share(sales: DataFrame, top: int = 100) -> DataFrame:
    """Number of products and the share of revenue of the best ``top``."""
    products = settled(_product_totals(sales), "products")
    whole = products.agg(F.struct(F.sum("Revenue").alias("r"), F.count(F.lit(1)).alias("n"))).scalar()
    best = _best_products(products, top).agg(F.sum("Revenue").alias("best"))
    return best.select(
        whole.getField("n").alias("products"),
        F.bround(expr.percent(F.col("best"), whole.getField("r")), 1).alias("top_revenue_pct"),
    )


def product_long_tail(sales: DataFrame) -> DataFrame:
    """Products by revenue with cumulative share of revenue."""
    return revenue_curve(_product_totals(sales), ["StockCode", "Description"], "Position")


def products_within(curve: DataFrame, percent_of_revenue: float = 80) -> DataFrame:
    """How many products stay within the given cumulative share of revenue."""
    within = F.count_if(F.col("CumRevPct") <= percent_of_revenue)
    return curve.agg(within.alias("products_within"), F.count(F.lit(1)).alias("products"))


def baskets(sales: DataFrame) -> DataFrame:
    """Revenue, items, distinct products and (smallest) customer per invoice."""
    invoices = sales.groupBy("InvoiceNo").agg(
        F.sum("Revenue").alias("Revenue"),
        F.sum("Quantity").alias("Items"),
        F.count_distinct("StockCode").alias("SKUs"),
        F.min("CustomerID").alias("Customer"),
    )
    return invoices.withColumn("Revenue", _money("Revenue"))


def basket_statistics(sales: DataFrame) -> DataFrame:
    """Summary of the basket measures."""
    return numeric_summary(baskets(sales), {n: F.col(n) for n in ("Revenue", "Items", "SKUs")})
