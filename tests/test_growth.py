"""Steps that are worked out once, and rows that need not move."""

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas, workloads
from tallyloom.functions import dates, text
from tallyloom.operators import shape
from tallyloom.plans import conform, forms as form_plans, movements
from tallyloom.session import split_methods
from tallyloom.sources import forms
from tallyloom.workloads import adapters, loads

CELLS = "file string, row int, col int, value string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_form_rows_are_summed_once_and_never_joined(spark, rows):
    cells = [("f", 22, 0, "a"), ("f", 22, 9, "3"), ("f", 23, 0, "b"), ("f", 24, 9, "7"), ("f", 25, 0, "c"), ("f", 30, 1, "x")]
    cells += [("g", 22, 0, "a"), ("g", 2, 3, "S @ A1"), (None, 22, 0, "a"), (None, 40, 1, "x"), ("h", 23, 0, "a"), ("h", 24, 5, "x")]
    df = spark.createDataFrame(cells, CELLS)
    assert rows(forms.body_end(df)) == [("f", 24, True), ("g", 23, False), ("h", 22, True)]
    assert rows(forms.body_lines(df), "file", "row", "style", "ttl_qty") == [("f", 22, "a", "3"), ("f", 23, "b", None)]
    assert forms.body_end(df).schema["end_row"].dataType == df.schema["row"].dataType
    assert "Join" not in plan(forms.body_lines(df)) + plan(forms.body_end(df))
    assert rows(forms.named_scales(df)) == [("A1",)]


def test_lines_are_not_dealt_by_scale(spark):
    cells = spark.createDataFrame([("f", 22, 0, "s"), ("f", 22, 9, "6"), ("f", 3, 7, "A1/pack"), ("f", 3, 10, "PREPACK"), ("f", 30, 1, "x")], CELLS)
    labels = spark.createDataFrame([("s", ["S", "M"])], "STYLE string, labels array<string>")
    scales = spark.createDataFrame([("A1", "1/S 2/M"), ("B1", "2/S")], "SIZE_SCALE_CODE string, SIZE_SCALE_DESC string")
    _, lines, found = form_plans.read_forms(cells, labels, scales)
    assert [tuple(r) for r in lines.select("file", "kind", "s1", "s2", "adds_up").collect()] == [("f", "PPK", 2, 4, 1)]
    assert "hashpartitioning(scale_code" not in plan(lines)
    used = form_plans._used_scales(cells, form_plans.form_headers(cells), scales)
    assert [r["scale_code"] for r in used.collect()] == ["A1"]
    assert {r["check_id"] for r in found.collect()} == {"form_category"}


def test_totals_rows_are_found_first(spark, rows):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 2, "total"), ("g", 1, "b"), ("g", 3, "total")], "f string, n int, v string")
    kept = shape.drop_last(df, ["f"], ["n"])
    assert rows(kept) == [("f", 1, "a"), ("g", 1, "b")]
    assert "BroadcastHashJoin" in plan(kept) and "SortMergeJoin" not in plan(kept)


def test_dates_are_parsed_and_ids_padded_once(spark, rows):
    df = spark.createDataFrame([("1/2/2020", "-5"), (None, None), ("12/31/1999", "1234567"), ("2/29/2020", "")], "d string, v string")
    out = df.select(dates.us_date("d").alias("d"), text.zfill("v", 6).alias("v"))
    assert plan(out).count("gettimestamp") == 1 and "repeat(" not in plan(out)
    got = [(str(d), v) for d, v in rows(out)]
    assert got == [("1999-12-31", "1234567"), ("2020-01-02", "-00005"), ("2020-02-29", "000000"), ("None", None)]
    with pytest.raises(Exception, match="not a month/day/year date"):
        spark.createDataFrame([("2/30/2020",)], "d string").select(dates.us_date("d")).collect()


def test_queries_have_wide_methods_split(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    try:
        spark.conf.set(limit, "65535")
        assert workloads.case("q")(lambda spark, folder: spark.conf.get(limit))(spark, "") is not None
        assert workloads.QUERIES.pop("q")(spark, "") == "8000"
        spark.conf.set(limit, "9000")
        split_methods(spark)
        assert spark.conf.get(limit) == "9000"
    finally:
        spark.conf.set(limit, "8000")


def test_seasons_of_the_order_feed_are_listed_once_each(spark, tmp_path, monkeypatch):
    days = "2000-01-01"
    lines = [(k, 5, 3, 1, 2.0, 3.0, "N", "O", days) for k in (1, 2, 3)]
    fields = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    spark.createDataFrame(lines, f"{fields}, l_linestatus string, l_shipdate string").write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(1, 7, "P", days, "1-URGENT"), (2, 7, "O", days, "1-URGENT"), (3, 7, "O", "2000-08-01", "1-URGENT")]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string"
    spark.createDataFrame(orders, names).write.parquet(str(tmp_path / "orders.parquet"))
    given = []
    load = loads.orders.load_orders
    monkeypatch.setattr(loads.orders, "load_orders", lambda *args, seasons: given.append(seasons) or load(*args, seasons=seasons))
    new = loads._load_orders(spark, str(tmp_path), 3)
    assert sorted(tuple(r) for r in given[0].collect()) == [("FA-00",), ("SP-00",)] and given[0].inputFiles()
    assert "hashpartitioning(SEASON" not in plan(new) and new.count() == 3


def _one_order(spark, folder, orders):
    day = "2000-01-01"
    fields = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    lines = [(k, p, 3, 1, 2.0, 3.0, "N", "O", day) for k in (1, 2, 3) for p in (5, None)]
    spark.createDataFrame(lines, f"{fields}, l_linestatus string, l_shipdate string").write.parquet(str(folder / "lineitem.parquet"))
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string"
    spark.createDataFrame([(k, 7, s, day, "2-HIGH") for k, s in orders], names).write.parquet(str(folder / "orders.parquet"))
    return str(folder)


def test_stored_lines_are_told_by_their_order(spark, rows, tmp_path):
    folder = _one_order(spark, tmp_path, [(1, "O"), (1, "P"), (2, "O"), (3, None), (3, "F"), (None, "F")])
    lines = adapters.shared_lines(spark, folder, "GREEN_BAR", "STYLE", "COLOR", "STATUS", "STORED")
    assert lines.columns == ["GREEN_BAR", "STYLE", "COLOR", "STATUS", "STORED"] and not [f for f in lines.inputFiles() if "lineitem" in f]
    key = ["GREEN_BAR", "STYLE", "COLOR"]
    kept = lines.join(lines.filter("STATUS <> 'O'").select(*key), key, "left_semi")
    assert kept.count() == 4
    assert rows(lines.filter("STORED").na.drop(subset=["STYLE", "COLOR"]), *key, "STATUS") == rows(kept, *key, "STATUS")
    assert "STORED" not in adapters.order_lines(spark, folder).columns


def test_lines_of_purchase_orders_are_not_joined_with_themselves_or_dealt_by_season(spark, tmp_path):
    folder = _one_order(spark, tmp_path, [(1, "P"), (2, "O"), (3, "F")])
    limit = "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(limit, "1k")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        done = plan(loads.load_po_lines(spark, folder))
        assert "LeftSemi" not in done and "hashpartitioning(_season" not in done
    finally:
        spark.conf.set(limit, "10m")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def containers(spark, pending):
    state = conform(
        spark.createDataFrame([("000011", "ABCD1234567", 3)], "HFC_NBR string, CONTAINER_NBR string, CARTON_CTN int"), schemas.TABLES["HFC_CONTAINER"]
    )
    sheet = spark.createDataFrame(
        [("S1", "2020-05-01", "ABCD1234567", "000011", 5), ("S1", "2020-05-01", "ABCD7654321", "000012", 6)],
        "SHIPMENT_NBR string, ETA string, CONTAINER_NBR string, HFC_NBR string, CARTON_CTN int",
    ).withColumn("ETA", F.to_date("ETA"))
    receiving = spark.createDataFrame(
        [("9", "11", "ABCD1234567", "I0"), *pending], "CTRL_NBR string, HFC string, CONTAINER_NBR string, INVOICE_NBR string"
    ).withColumns({"STYLE": F.lit("1"), "COLOR": F.lit("1"), "REC_DATE": F.lit("2020-05-03")})
    whse = spark.createDataFrame([("ABCD1234567", "2020-05-05")], "CONTAINER_NBR string, WHSE_REC_DATE string")
    headers = spark.createDataFrame([("000011", "SP-20", 1, 2), ("000012", "SP-20", 1, 2)], "HFC_NBR string, SEASON string, DIV int, CARTON_SIZE int")
    details = spark.createDataFrame([("000011", "1", "1", 20, 0)], "HFC_NBR string, STYLE string, COLOR_CODE string, TTL_QTY long, CXL int")
    short = spark.createDataFrame([("000011", "1", "1", 2)], "HFC string, STYLE string, COLOR string, DIFF int")
    return movements.load_containers(state, sheet, receiving, whse, headers, details, short)


def test_checks_of_containers_do_not_count_cartons_to_come(spark, rows):
    load = containers(spark, [(None, "12", "ABCD7654321", "I1"), (None, "12", "ABCD7654321 ", "I1")])
    assert "TTL_QTY" not in plan(load.exceptions) and "TTL_QTY" in plan(load.states["HFC_CONTAINER"])
    got = rows(load.states["HFC_CONTAINER"], "HFC_NBR", "CONTAINER_NBR", "CARTON_CTN", "RECVD", "INVOICE_NBR", "CTN_TO_COME")
    assert got == [("000011", "ABCD1234567", 5, 1, None, 6), ("000012", "ABCD7654321", 6, 0, "I1", None)]


def test_two_pending_invoices_of_a_pair_stop_the_load(spark):
    with pytest.raises(Exception, match="repeated key in source"):
        containers(spark, [(None, "12", "ABCD7654321", "I1"), (None, "12", "ABCD7654321", "I2")])


def test_lines_under_quarantine_are_summed_once(spark, tmp_path):
    days = "2000-01-01"
    spark.createDataFrame([(1, 5, 3, 2.0, days)], "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate string").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    spark.createDataFrame([(1, "P", days)], "o_orderkey long, o_orderstatus string, o_orderdate string").write.parquet(str(tmp_path / "orders.parquet"))
    stored, feed = loads._buy_lines(spark, str(tmp_path))
    assert not [f for df in (stored, feed) for f in df.inputFiles() if "lineitem" in f]
    assert [tuple(r) for r in feed.select("HFC", "STYLE", "COLOR", "UNITS", "SSN").collect()] == [("000001", "000005", "3", 2, "SP-00")]
