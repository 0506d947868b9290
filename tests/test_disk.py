"""Finished jobs leave no shuffle files, and a large table is joined and stored part by part."""

import time
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from monthmill.catalog import queries
from monthmill.plans import feature_store
from monthmill.sinks import writers
from monthmill.sources import readers
from monthmill.staging import CLEAN, shuffles_removed, stage, staging_scope

SF = "/root/testdata/sf0.001"
OPTIONS = {"credit_mixes": queries.CREDIT_MIXES, "loan_types": queries.LOAN_TYPES}


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(n).getName() for n in range(files.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_behind(spark, before):
    for _ in range(20):  # Spark removes the files a moment later
        if not shuffle_files(spark) - before:
            return set()
        time.sleep(0.25)
    return shuffle_files(spark) - before


def same_rows(found, wanted):
    counts = [Counter(map(tuple, df.collect())) for df in (found, wanted)]
    return found.columns == wanted.columns and counts[0] == counts[1]


def counted_parts(monkeypatch, rows):
    """The loans of each part that is joined, if parts are for so many rows."""
    monkeypatch.setattr(feature_store, "PART_ROWS", rows)
    joined, real = [], feature_store._derived
    monkeypatch.setattr(feature_store, "_derived", lambda *a: joined.append(a[1].count()) or real(*a))
    return joined


@pytest.fixture(scope="module")
def layers(spark):
    """The four silver tables, with loans that lack a customer or a date."""
    few = F.xxhash64("Customer_ID") % 8 == 0
    financials, loans, clicks, attributes = (stage(df.where(few)) for df in queries._inputs(spark, SF))
    odd = loans.limit(30).withColumns({"Customer_ID": F.lit(None).cast("string")})
    undated = loans.limit(20).withColumns({"snapshot_date": F.lit(None).cast("date")})
    loans = stage(loans.unionByName(odd).unionByName(undated).unionByName(loans.limit(15)))
    return financials, loans, clicks, attributes


def test_a_staged_table_leaves_no_shuffle_files(spark):
    rows = spark.range(2000).selectExpr("id % 50 as k", "id as v")
    before = shuffle_files(spark)
    table = stage(rows.groupBy("k").agg(F.sum("v").alias("s")).join(rows.hint("merge"), "k"))
    assert not left_behind(spark, before)
    assert table.count() == 2000 and spark.conf.get(CLEAN, None) is None


def test_the_setting_is_put_back(spark):
    spark.conf.set(CLEAN, "false")
    try:
        with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
            assert spark.conf.get(CLEAN) == "true"
            1 / 0  # noqa: B018
        assert spark.conf.get(CLEAN) == "false"
    finally:
        spark.conf.unset(CLEAN)


@pytest.mark.parametrize("chosen", [{}, {"mode": "exact"}, {"collapse": True}])
def test_parts_have_the_rows_of_the_whole_join(spark, layers, monkeypatch, chosen):
    whole = feature_store.build_features(*layers, **OPTIONS, **chosen)
    joined = counted_parts(monkeypatch, 500)
    with staging_scope(spark):
        assert same_rows(feature_store.staged_features(*layers, **OPTIONS, **chosen).rows(), whole)
    assert 2 <= len(joined) <= feature_store.PARTS
    assert sum(joined) == layers[1].count() and max(joined) < sum(joined)


def test_the_parts_of_a_table_are_bounded(monkeypatch):
    assert [feature_store.parts_of(n * feature_store.PART_ROWS) for n in (0, 1, 3, 8, 9, 1000)] == [1, 1, 3, 8, 8, 8]


def test_blocks_hold_whole_snapshots(spark, layers, monkeypatch):
    monkeypatch.setattr(feature_store, "PART_ROWS", 300)
    with staging_scope(spark):
        staged = feature_store.staged_features(*layers, **OPTIONS, in_blocks=True)
        whole = staged.rows().count()
        days, rows = [], 0
        for number, block in enumerate(staged.handed_over()):
            found = block.groupBy("snapshot_date").count().collect()
            days += [row.snapshot_date for row in found]
            rows += sum(row["count"] for row in found)
            if number:  # the one before is gone
                with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                    staged.rows(number - 1)
        assert number >= 3 and len(days) == len(set(days)) and None in days and rows == whole


def test_a_layer_written_in_parts_is_the_whole(spark, frame, tmp_path):
    root, schema = str(tmp_path / "layer"), "snapshot_date date, v int"
    writers.replace_layer(frame(schema, (date(2022, 1, 1), 9)), root)

    def parts(seen):
        yield frame(schema, (date(2023, 1, 1), 1), (None, 0))
        seen.append(sorted(row.v for row in readers.read_layer(spark, root).collect()))
        yield frame(schema)
        yield frame(schema, (date(2023, 2, 1), 2), (date(2023, 3, 1), 3))

    seen, before = [], shuffle_files(spark)
    writers.replace_in_parts(parts(seen), spark, root)
    assert seen == [[9]] and sorted(row.v for row in readers.read_layer(spark, root).collect()) == [0, 1, 2, 3]
    assert not left_behind(spark, before)


def test_text_layers_can_be_packed(spark, frame, tmp_path):
    loans = frame("snapshot_date string, loan_id string, v int", ("2023-01-01", " L1", 1), ("2023-02-01", None, 2))
    writers.write_layer(loans, str(tmp_path), "csv", compression="gzip")
    assert len(list(tmp_path.glob("snapshot_date=*/*.csv.gz"))) == 2
    assert sorted(str(row.loan_id) for row in readers.read_raw_csv(spark, str(tmp_path)).collect()) == [" L1", "None"]


def test_sketches_take_the_staged_parts(spark, monkeypatch):
    joined = counted_parts(monkeypatch, 5000)
    found = queries.QUERIES["sketch_medians"](spark, SF).collect()
    assert len(joined) > 1 and len(found) == 57 and all(row.within_error for row in found)
