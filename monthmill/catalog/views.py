"""Raw inputs of the jobs, derived from the star-schema test tables with column expressions.

``oracle.VIEWS`` holds the same definitions in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Churn windows that fit the dates of the test tables.
OBSERVED_UNTIL = "2000-08-31"
LABELLED_UNTIL = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task makes where each row of a table becomes many.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, key: str, grows: int = 0) -> DataFrame:
    """Deal out the rows of a table whose file cannot be read by all cores at once.

    The test tables are single small files; tables with enough splits stay as they are. Where each row
    becomes ``grows`` rows, there are as many tasks as bound the rows that one makes.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if grows:
        tasks = max(tasks, -(-df.count() * grows // ROWS_PER_TASK))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key)


def _text(value: Column) -> Column:
    return value.cast("string")


def _every(value: Column, n: int, rest: int = 0) -> Column:
    return value % n == rest


def retail_tx(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Retail transactions; only the dimension tables that the wanted columns need are joined."""
    wanted = columns or (
        "InvoiceNo", "StockCode", "Description", "Quantity",
        "InvoiceDate", "UnitPrice", "CustomerID", "Country",
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate"
    )
    rows = spread(lines, "l_orderkey").join(orders, "l_orderkey")
    if "Country" in wanted:
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
        )
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        rows = rows.join(customers.join(nations, "n_nationkey", "left"), "o_custkey", "left")
    if "Description" in wanted:
        parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        rows = rows.join(parts, "l_partkey", "left")
    k, p, nation = F.col("l_orderkey"), F.col("l_partkey"), F.col("n_nationkey")
    cancelled = (F.col("o_orderstatus") == "P") & _every(k, 10)
    quantity = F.col("l_quantity").cast("int")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double") / 4
    seconds = (k * 613) % 86400
    definitions = {
        "InvoiceNo": F.when(cancelled, F.concat(F.lit("C"), _text(k))).otherwise(_text(k)),
        "StockCode": F.when(_every(p, 97), "POST").when(_every(p, 89), "pads").otherwise(_text(p)),
        "Description": F.when(~_every(p, 53), F.col("p_name")) if "Description" in wanted else None,
        "Quantity": F.when(cancelled, -quantity).otherwise(quantity),
        "InvoiceDate": F.col("o_orderdate") + F.make_dt_interval(secs=seconds),
        "UnitPrice": F.when((F.col("l_linenumber") == 7) & _every(p, 11), 0.0)
        .when(_every(p, 499), -1.0)
        .otherwise(price),
        "CustomerID": F.when(~_every(k, 4), F.col("o_custkey")),
        "Country": F.when(nation < 10, "United Kingdom")
        .when(nation == 10, "Germany")
        .when(nation == 11, "France")
        .when(nation == 12, "EIRE")
        .otherwise(F.col("n_name"))
        if "Country" in wanted
        else None,
    }
    return rows.select(*[definitions[name].alias(name) for name in wanted])


def loan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven monthly snapshots per loan, one loan per order."""
    k, i, total = F.col("o_orderkey"), F.col("i"), F.col("o_totalprice")
    start = F.trunc("o_orderdate", "month")
    paying = (i > 0) & ((k + i) % 5 != 0)
    late = (i > 0) & ((k + i) % 5 == 0)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return (
        spread(orders, "o_orderkey", grows=7)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(6))))
        .select(
            F.concat(F.lit("L"), _text(k)).alias("loan_id"),
            F.concat(F.lit("CUS_"), _text(F.col("o_custkey"))).alias("Customer_ID"),
            start.alias("loan_start_date"),
            F.lit(6).alias("tenure"),
            i.alias("installment_num"),
            F.floor(total).cast("double").alias("loan_amt"),
            F.when((i == 0) | _every(k, 101), 0.0)
            .otherwise(F.floor(total / 6).cast("double"))
            .alias("due_amt"),
            F.when(paying, F.floor(total / 6).cast("double")).otherwise(0.0).alias("paid_amt"),
            F.when(_every(k, 37), None)
            .when(late, F.floor(total / 6 * (k % 4 + 0.5)).cast("double"))
            .otherwise(0.0)
            .alias("overdue_amt"),
            F.floor(total * (6 - i) / 6).cast("double").alias("balance"),
            F.add_months(start, i).alias("snapshot_date"),
        )
    )


def _customer_months(spark: SparkSession, sf_dir: str, months: int, a: int, b: int) -> DataFrame:
    """Customers with ``j`` in 0..months-1 and a snapshot date text that moves with both."""
    month = (F.col("c_custkey") * a + F.col("j") * b) % 80
    day = F.add_months(F.lit("1995-01-01").cast("date"), month.cast("int"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    steps = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    return spread(customers, "c_custkey", grows=months).withColumn("j", steps).withColumn("snapshot_date", _text(day))


def financials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dirty financial snapshots per customer, all text."""
    c, j = F.col("c_custkey"), F.col("j")

    def rest(n: int, shift: int = 0) -> Column:
        return _text(c % n + shift) if shift else _text(c % n)

    income = _text(c + j + 20000)
    columns = {
        "Customer_ID": F.concat(F.lit("CUS_"), _text(c)),
        "snapshot_date": F.col("snapshot_date"),
        "Annual_Income": F.when(_every(c, 11), "")
        .when(_every(c, 13), "-500")
        .when(_every(c, 7), F.concat(income, F.lit("_")))
        .otherwise(income),
        "Num_of_Loan": F.when(_every(c, 6), F.concat(rest(9), F.lit("__"))).otherwise(rest(9)),
        "Interest_Rate": F.when(_every(c, 50), "5789").otherwise(rest(48)),
        "Credit_Mix": F.when(_every(c, 13), "_")
        .when(_every(c, 5), "Bad")
        .when(c % 5 < 3, "Standard")
        .otherwise("Good"),
        "Type_of_Loan": F.when(_every(c, 4, 1), "Auto Loan")
        .when(_every(c, 4, 2), "Payday Loan, Home Equity Loan")
        .when(_every(c, 4, 3), "Auto Loan, Credit-Builder Loan, and Payday Loan"),
        "Credit_History_Age": F.when(_every(c, 17), "NA")
        .when(_every(c, 19), "3 Years")
        .otherwise(F.concat(rest(30), F.lit(" Years and "), _text(j + 1), F.lit(" Months"))),
        "Monthly_Inhand_Salary": rest(3000, 2000),
        "Num_Bank_Accounts": rest(12),
        "Num_Credit_Inquiries": rest(15),
        "Num_Credit_Card": F.concat(rest(7), F.lit("_")),
        "Delay_from_due_date": rest(60, -5),
        "Num_of_Delayed_Payment": F.when(_every(c, 31), "").otherwise(
            F.concat(rest(25), F.lit(".0"))
        ),
        "Changed_Credit_Limit": F.when(_every(c, 41), "_").otherwise(rest(20)),
        "Outstanding_Debt": F.concat(_text(c + 500), F.lit("_")),
        "Credit_Utilization_Ratio": rest(125),
        "Payment_of_Min_Amount": F.when(_every(c, 3), "Yes").when(_every(c, 3, 1), "No").otherwise("NM"),
        "Total_EMI_per_month": rest(400),
        "Amount_invested_monthly": F.when(_every(c, 43), "__10000__").otherwise(rest(900)),
        "Payment_Behaviour": F.when(_every(c, 6), "Poor")
        .when(_every(c, 6, 1), "Standard")
        .when(_every(c, 6, 2), "Good")
        .when(_every(c, 6, 3), "Excellent")
        .when(_every(c, 6, 4), "!@9#%8"),
        "Monthly_Balance": rest(700, -20),
    }
    rows = _customer_months(spark, sf_dir, 3, 7, 23)
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def attributes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dirty attribute snapshots per customer, all text."""
    c = F.col("c_custkey")
    number = _text(c * 7919 + 100000000)
    columns = {
        "Customer_ID": F.when(~_every(c, 29), F.concat(F.lit("CUS_"), _text(c))),
        "snapshot_date": F.col("snapshot_date"),
        "Name": F.col("c_name"),
        "Age": F.when(_every(c, 8), F.concat(_text(c % 130), F.lit("_"))).otherwise(_text(c % 130)),
        "SSN": F.when(_every(c, 9), "#F%$D@*&8").otherwise(
            F.concat_ws(
                "-", F.substring(number, 1, 3), F.substring(number, 4, 2), F.substring(number, 6, 4)
            )
        ),
        "Occupation": F.when(_every(c, 10), "_______")
        .when(_every(c, 23), " ")
        .otherwise(F.col("c_mktsegment")),
    }
    rows = _customer_months(spark, sf_dir, 2, 5, 41)
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def clickstream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """87 monthly click snapshots of every customer, all text; a tenth of them without a key."""
    c, m = F.col("c_custkey"), F.col("m")
    first = F.lit("1995-01-01").cast("date")
    # the text of a month is made once, not in every row
    months = F.array(*[F.struct(F.lit(i).alias("m"), _text(F.add_months(first, i)).alias("day")) for i in range(87)])
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return (
        spread(customers, "c_custkey", grows=87)
        .select("c_custkey", F.inline(months))
        .select(
            F.when(c % 10 != 9, F.concat(F.lit("CUS_"), _text(c))).alias("Customer_ID"),
            F.col("day").alias("snapshot_date"),
            *[_text((c * i + m * 7) % 200 - 1).alias(f"fe_{i}") for i in range(1, 21)],
        )
    )
