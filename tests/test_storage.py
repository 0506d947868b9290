from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from monthmill import api
from monthmill.catalog import views
from monthmill.plans import medallion, retail
from monthmill.plans.reports import DERIVED, POSITIVE, RAW, SALES, write_reports
from monthmill.sinks import writers
from monthmill.sources import calendar, readers
from monthmill.staging import stage, staging_scope

ATTRIBUTES = "Customer_ID string, snapshot_date string, Name string, Age string, SSN string, Occupation string"


@pytest.fixture
def attributes_csv(frame, tmp_path):
    path = str(tmp_path / "attributes.csv")
    rows = [(f"c{n}", f"2023-0{m}-01", "x", f"{20 + n}_", None, " ") for n in range(5) for m in (1, 2, 3)]
    rows += [("late", "", "x", "1", None, None), ("none", None, "x", "1", None, None)]
    writers.write_csv(frame(ATTRIBUTES, *rows), path)
    return path


def contents(df):
    return sorted(map(str, df.collect()))


def test_raw_values_survive_bronze(spark, attributes_csv, tmp_path):
    bronze = medallion.ingest_bronze(spark, "attributes", attributes_csv, str(tmp_path / "b"))
    row = bronze.where("Customer_ID = 'c1'").first()
    assert (row.Age, row.Occupation, bronze.count()) == ("21_", " ", 15)


def test_rerun_of_a_month_changes_no_other_month(spark, attributes_csv, tmp_path):
    bronze, clean = str(tmp_path / "b"), str(tmp_path / "s")
    medallion.ingest_bronze(spark, "attributes", attributes_csv, bronze)
    medallion.refine_silver(spark, "attributes", bronze, clean)
    before = contents(readers.read_layer(spark, clean))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")}
    api.process_silver_attributes("2023-02-01", bronze, clean, spark)
    assert contents(readers.read_layer(spark, clean)) == before
    for path, stamp in files.items():
        if "2023-02-01" not in str(path):
            assert path.stat().st_mtime_ns == stamp


def test_one_date_at_a_time_equals_all_at_once(spark, attributes_csv, tmp_path):
    whole, single, clean = str(tmp_path / "all"), str(tmp_path / "one"), str(tmp_path / "clean")
    medallion.ingest_bronze(spark, "attributes", attributes_csv, whole)
    for day in api.source_dates(spark, attributes_csv):
        got = api.process_bronze_attributes(day, single, spark, source=attributes_csv)
        assert got.count() == 5
        api.process_silver_attributes(date.fromisoformat(day), single, clean, spark)
    assert contents(readers.read_layer(spark, whole)) == contents(readers.read_layer(spark, single))
    assert readers.read_layer(spark, clean).count() == 15


def test_a_wrong_date_text_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        api.process_bronze_financials("2023-13-01", str(tmp_path), spark, source="unused")


def test_snapshot_dates_skip_blanks(spark, attributes_csv):
    assert api.source_dates(spark, attributes_csv) == ["2023-01-01", "2023-02-01", "2023-03-01"]


def test_snapshot_filter_prunes_partitions(spark, attributes_csv, tmp_path):
    bronze = str(tmp_path / "b")
    medallion.ingest_bronze(spark, "attributes", attributes_csv, bronze)
    plan = readers.read_layer(spark, bronze, "2023-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert readers.read_layer(spark, bronze, date(2023, 2, 1)).count() == 5


def test_loans_through_all_layers_by_date(spark, tmp_path):
    raw = views.loan_daily(spark, "/root/testdata/sf0.001")
    source, mart = str(tmp_path / "loans.csv"), tmp_path / "mart"
    writers.write_csv(raw, source)
    bronze, clean, gold = str(mart / "b"), str(mart / "s"), str(mart / "g")
    for day in ("1998-06-01", "1998-07-01"):
        api.process_bronze_table(day, bronze, spark, source=source)
        api.process_silver_table(day, bronze, clean, spark)
        api.process_labels_gold_table(day, clean, gold, spark, 30, 6)
    stored = readers.read_layer(spark, clean)
    assert calendar.rows_per_snapshot(stored).count() == 2
    labels = readers.read_layer(spark, gold)
    assert labels.count() == stored.where("mob = 6").count() > 0
    assert dict(labels.dtypes)["snapshot_date"] == "date"
    assert list((mart / "b").glob("**/*.csv"))


def test_feature_store_is_replaced_as_a_whole(frame, spark, tmp_path):
    root = str(tmp_path / "g")
    writers.replace_layer(frame("snapshot_date date, v int", (date(2023, 1, 1), 1), (date(2023, 2, 1), 2)), root)
    writers.replace_layer(frame("snapshot_date date, v int", (date(2023, 3, 1), 3)), root)
    assert [r.v for r in readers.read_layer(spark, root).collect()] == [3]


def test_month_calendar(spark):
    assert api.generate_first_of_month_dates(spark, "2022-11-15", "2023-02-01") == [
        "2022-11-01", "2022-12-01", "2023-01-01", "2023-02-01",
    ]
    assert len(api.generate_first_of_month_dates(spark, "2023-01-01", "2024-12-01")) == 24
    assert api.generate_first_of_month_dates(spark, "2023-05-01", "2023-01-01") == []


def test_latin1_transactions(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_bytes(
        "Country,InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID\n"
        'EIRE,536365,85123A,"CAFÉ, £5",6,12/1/2010 8:26,2.55,17850\n'
        "France,C536366,22633,,-6,bad,1.85,\n".encode("latin-1")
    )
    first, second = readers.read_transactions(spark, str(path)).collect()
    assert (first.Description, first.InvoiceDate, first.CustomerID) == ("CAFÉ, £5", datetime(2010, 12, 1, 8, 26), 17850)
    assert (second.InvoiceDate, second.CustomerID, second.Quantity) == (None, None, -6)


def test_quoted_text_is_read_as_written(spark, tmp_path):
    path = tmp_path / "data.csv"
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    path.write_text(head + '536365,1,"BOX ""HEARTS"", red",6,12/1/2010 8:26,2.55,17850,United Kingdom\n'
                    '536366,2,"two\nlines",1,12/1/2010 8:26,1,17850,France\n')
    rows = readers.read_transactions(spark, str(path), multi_line=True).collect()
    assert [(r.Description, r.Quantity, r.CustomerID, r.Country) for r in rows] == [
        ('BOX "HEARTS", red', 6, 17850, "United Kingdom"), ("two\nlines", 1, 17850, "France")]


def test_months_that_lost_their_rows_are_removed(frame, spark, tmp_path):
    root = str(tmp_path / "layer")
    schema = "snapshot_date date, v int"
    writers.write_layer(frame(schema, (date(2023, 1, 1), 1), (date(2023, 2, 1), 2), (date(2023, 3, 1), 3)), root)
    writers.write_layer(frame(schema, (date(2023, 2, 1), 5)), root, start="2023-02-01", end="2023-03-01")
    stored = readers.read_layer(spark, root, schema=frame(schema).schema)
    assert sorted(r.v for r in stored.collect()) == [1, 5]
    writers.write_layer(frame(schema), root, start="2023-01-01", end="2023-02-01")
    assert readers.read_layer(spark, root, schema=frame(schema).schema).count() == 0


def test_scopes_of_two_threads_do_not_touch_each_other(spark):
    from concurrent.futures import ThreadPoolExecutor

    def job(number):
        with staging_scope(spark):
            tables = [stage(spark.range(number + k)) for k in range(3)]
            return [t.count() for t in tables]

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(job, range(1, 9))) == [[n, n + 1, n + 2] for n in range(1, 9)]


def test_times_do_not_depend_on_the_session_zone(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("InvoiceDate,Quantity,UnitPrice,CustomerID\n3/13/2011 2:30,1,1,1\nbad,1,1,1\n")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # no such time there
    try:
        rows = readers.read_transactions(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.InvoiceDate for r in rows] == [datetime(2011, 3, 13, 2, 30), None]


def test_index_returns(spark, tmp_path):
    path = tmp_path / "index.csv"
    path.write_text("Date,EWU,^FTAS,^FTMC,^FTSE\n2011-01-04,0.5,0.25,,-0.125\n")
    row = readers.read_index_returns(spark, str(path)).first()
    assert row.asDict() == {"date": date(2011, 1, 4), "ewu": 0.5, "ftas": 0.25, "ftmc": None, "ftse": -0.125}


def test_loans_with_columns_in_another_order(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("snapshot_date,loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance\n2023-01-01,L1,C1,2023-01-01,10,0.0,100,0,0,x,100\n")
    row = readers.read_loans(spark, str(path)).first()
    assert (row.loan_id, row.installment_num, row.overdue_amt, row.snapshot_date) == ("L1", 0, None, date(2023, 1, 1))


def test_staged_tables_are_removed_with_their_scope(spark):
    with staging_scope(spark):
        path = stage(spark.range(3)).inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_all_reports_are_written(spark, tmp_path):
    write_reports(views.retail_tx(spark, "/root/testdata/sf0.001"), str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert {*RAW, *POSITIVE, *SALES, *DERIVED, "basket_items_histogram"} <= names
    for name in names:
        assert spark.read.parquet(str(tmp_path / name)).count() > 0


def test_metadata_is_written_with_a_header(spark, frame, tmp_path):
    sales = retail.clean_sales(views.retail_tx(spark, "/root/testdata/sf0.001"))
    from monthmill.plans.customer_meta import customer_metadata

    path = str(tmp_path / "meta")
    writers.write_csv(customer_metadata(sales), path)
    back = spark.read.csv(path, header=True)
    assert back.columns[0] == "customer_id" and back.count() == sales.select("CustomerID").distinct().count()
    assert back.where(F.col("company_size").isNull()).count() == 0
