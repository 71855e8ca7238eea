"""Loads that move and write less: rows are shuffled once, narrow, and staged in few bytes."""

import datetime as dt
import time
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.plans import invoices, movements, orders
from tallyloom.session import shuffles_removed, stage
from tallyloom.workloads import adapters, reconcile

DAY = "2000-01-01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder, lines, heads):
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    names += ", l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
    spark.createDataFrame(lines, names).write.parquet(str(folder / "lineitem.parquet"))
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    spark.createDataFrame(heads, names).write.parquet(str(folder / "orders.parquet"))
    return str(folder)


def test_staged_frames_take_little_room(spark):
    assert all(".zst" in f for f in stage(spark.range(3).toDF("n")).inputFiles())


def test_shuffle_files_of_staged_frames_do_not_stay(spark, rows):
    flag = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = {kept.keySet().toString()}
    found = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    old = set(before.pop()[4:-1].replace(" ", "").split(","))
    back = stage(found)
    for _ in range(50):
        left = set(kept.keySet().toString()[4:-1].replace(" ", "").split(",")) - old
        if not left - {""}:
            break
        time.sleep(0.2)
    assert not left - {""}
    assert rows(back) == rows(found) and spark.conf.get(flag, "false") == "false"
    with shuffles_removed(spark):
        assert spark.conf.get(flag) == "true"


def test_order_lines_are_shuffled_once_as_they_are_read(spark, rows, tmp_path):
    line = lambda key, nbr, flag, status, day=DAY: (key, 5, 3, nbr, 2.0, 3.0, 0.0, 0.0, flag, status, day)
    lines = [line(1, 1, "N", "O"), line(1, 1, "A", "F", "2000-02-01"), line(1, 2, "A", "O"), line(1, 3, "R", "O"), line(1, 4, None, "O")]
    folder = tables(spark, tmp_path, [*lines, line(2, 1, "N", None), line(None, 1, "N", "O"), line(9, 1, "N", "O")], [(1, 7, "P", 1.0, DAY, "1-URGENT"), (2, 7, "O", 1.0, DAY, "2-HIGH")])
    found = adapters.order_lines(spark, folder)
    text = plan(found)
    assert "hashpartitioning(l_orderkey" in text and not [x for x in text.splitlines() if "hashpartitioning(l_orderkey" in x and "l_partkey" in x]
    got = rows(found, "GREEN_BAR", "ORDERED_UNITS", "SHIPPED_UNITS", "PICK_UNITS", "BAL", "S1", "S2", "S4", "SHIP_ON_DATE", "START_SHIP")
    assert got == [("000001", 10, 2, 2, 4, 2, 2, 0, dt.date(2000, 2, 1), dt.date(2000, 1, 1)), ("000002", 2, 0, 0, 0, 0, 0, 0, None, dt.date(2000, 1, 1))]


def test_only_due_lines_are_looked_up(spark, rows):
    names = "FILE string, CUST_NBR string, CUST_PO string, GREEN_BAR string, STYLE string, SHIPPED_UNITS long, PICK_UNITS long, SHIP_ON_DATE date, CXL_SHIP date"
    sent, late = dt.date(2000, 1, 5), dt.date(2009, 1, 1)
    lines = spark.createDataFrame(
        [
            ("f", "00001", "p", "g", "a", 3, 0, sent, sent), ("f", "00001", "p", "g", "b", 0, 0, None, sent), ("f", "00001", "p", "g", "c", 0, 1, None, sent),
            ("f", "00001", "p", "g", "d", 0, None, None, sent), ("f", "00001", "p", "g", "e", 0, 0, None, None), ("f", "00001", "p", "g", "f", 0, 0, None, late),
            ("f", "00007", "x", "g", "g", 0, 0, None, sent), ("f", None, None, "g", "h", 0, 0, None, sent), ("f", "00007", "p", None, "i", 0, 0, None, sent),
            ("f", "00001", "q", "g2", "j", 0, 0, sent, sent), (None, "00001", "p", "g", "k", 0, 0, None, sent),
        ],
        names,
    )
    found = orders.impute_ship_date(lines, DAY, green_bar_customers=["00007"])
    assert [s for s, d in rows(found, "STYLE", "SHIP_ON_DATE") if d == sent] == ["a", "b", "g", "j"] and found.count() == 11
    assert found.columns == lines.columns
    limit = "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(limit, "-1")
        looked = plan(orders.impute_ship_date(lines.withColumn("n", F.lit(1)), DAY))
    finally:
        spark.conf.set(limit, "10m")
    assert "Union" in looked


def test_no_two_orders_share_a_container(spark, rows, tmp_path):
    keys = [5, 9_999_999, 10_000_000, 10_000_001, 123_456_789]
    lines = [(k, 5, 250_000, n, 2.0, 3.0, 0.0, 0.0, "N", "F" if k % 2 else "O", DAY) for k in keys for n in (1, 2)]
    heads = [(k, 7, "P", 1.0, DAY, "1-URGENT" if k == 10_000_001 else "2-HIGH") for k in keys]
    folder = tables(spark, tmp_path, [*lines, (200_000_000, 5, 250_000, 1, 2.0, 3.0, 0.0, 0.0, "N", "O", DAY)], [*heads, (200_000_000, 7, "O", 1.0, DAY, "2-HIGH")])
    spark.createDataFrame([(250_000, 2)], "s_suppkey long, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    inputs = reconcile._container_inputs(spark, folder)
    sheet = rows(inputs[1], "CONTAINER_NBR")
    assert [c for (c,) in sheet] == ["AB10000001", "ABCD0000005", "ABCD9999999", "ABCE0000000", "ABCP3456789"]
    assert "hashpartitioning(ok" not in plan(inputs[1])
    new = movements.container_state(*inputs)
    got = {c: (n, got) for c, n, got in rows(new, "CONTAINER_NBR", "CARTON_CTN", "RECVD")}
    assert got["ABCD0000005"] == (2, 1) and got["ABCE0000000"] == (2, 0) and got["ABCP3456789"] == (2, 1)
    assert new.count() == 6  # the urgent order is there with a short number and with a stored one
    _, boxes = reconcile._invoice_boxes(spark, folder)
    assert rows(boxes, "CONTAINER_NBR") == [("ABCD0000005",), ("ABCD9999999",), ("ABCE0000001",), ("ABCP3456789",)]


def test_rows_of_an_invoice_stay_together_until_they_are_summed(spark, rows):
    lines = [("i", "h", 2, 0.1, 0.2), ("i", "h", 3, 0.2, None), ("i", "g", 1, None, None), (None, "h", 4, 1.0, 1.0), (None, "h", 5, 1.0, 1.0)]
    lines = spark.createDataFrame(lines, "INVOICE_NBR string, HFC string, PCS long, LINE_AMT double, DUTY_FREE_LINE_AMT double")
    boxes = spark.createDataFrame([("i", "h", 2), ("i", "h", 1), ("j", "h", 4), ("j", None, None)], "INVOICE_NBR string, HFC_NBR string, CARTON_CTN int")
    sums = invoices.order_sums(lines, boxes)
    text = plan(sums)
    assert text.count("Exchange") == 1 and "hashpartitioning(INVOICE_NBR" in text and "Exchange hashpartitioning(INVOICE_NBR#" in text and ", HFC#" not in text.split("hashpartitioning(")[1].split(")")[0]
    got = {(r["INVOICE_NBR"], r["HFC"]): (r["PCS"], r["LINE_AMT"], r["DUTY_FREE_LINE_AMT"], r["CTN_SUM"], r["LINES"], r["BOXES"]) for r in sums.collect()}
    assert got[("i", "h")] == (5, Decimal("0.3"), Decimal("0.2"), 3, 1, 1) and got[("i", "g")] == (1, None, None, None, 1, None)
    assert got[(None, "h")] == (9, 2, 2, None, 1, None) and got[("j", "h")] == (None, None, None, 4, None, 1) and len(got) == 5
    assert [(r["PCS"], r["CTN_SUM"]) for r in invoices.invoice_sums(sums).filter("INVOICE_NBR = 'i'").collect()] == [(6, 3)]
