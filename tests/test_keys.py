"""Dimensions that must be unique stop the job when a key repeats, instead of copying rows."""

import pytest

from tallyloom import schemas
from tallyloom.operators.checks import prepack_mismatch
from tallyloom.plans import conform, invoices, orders, purchase_orders


def table(spark, name, ddl, *rows):
    return conform(spark.createDataFrame(list(rows), ddl), schemas.TABLES[name])


def stops(df):
    with pytest.raises(Exception, match="repeated key"):
        df.collect()


def header(spark, *ids):
    rows = [(i, "SP-20", 1, 10, 0, "61050") for i in ids]
    return table(spark, "HFC_HEADER", "HFC_NBR string, SEASON string, DIV int, CARTON_SIZE int, CXL int, CUST_NBR string", *rows)


def detail(spark):
    return table(spark, "HFC_DETAIL", "HFC_NBR string, STYLE string, COLOR_CODE string, TTL_QTY int, CXL int", ("000001", "S", "001", 10, 0))


def test_cartons_need_one_header_and_one_difference(spark):
    short = spark.createDataFrame([("000001", "S", "001", 1)], "HFC string, STYLE string, COLOR string, DIFF int")
    boxes = spark.createDataFrame([("000001", 1)], "HFC_NBR string, CARTON_CTN int")
    make = lambda h, s: purchase_orders.cartons_to_come(detail(spark), h, s, boxes, seasons=["SP-20"])
    assert make(header(spark, "000001"), short).count() == 1
    stops(make(header(spark, "000001", "000001"), short))
    stops(make(header(spark, "000001"), short.unionByName(short)))


def test_scales_are_unique(spark):
    scales = spark.createDataFrame([("01", 12), ("01", 6)], "SIZE_SCALE_CODE string, TTL_QTY int")
    heads = spark.createDataFrame([("000001", "01", 12)], "HFC_NBR string, HFC_SIZE_SCALE string, CARTON_SIZE int")
    stops(prepack_mismatch(heads, scales))
    stops(purchase_orders.mark_mixed_scales(heads, scales))
    assert purchase_orders.mark_mixed_scales(heads, scales.limit(1)).count() == 1


def test_piece_check_needs_one_header(spark):
    lines = spark.createDataFrame([("I", "000001", 10)], "INVOICE_NBR string, HFC string, PCS int")
    boxes = spark.createDataFrame([("I", "000001", 1)], "INVOICE_NBR string, HFC_NBR string, CARTON_CTN int")
    stops(invoices.piece_differences(lines, header(spark, "000001", "000001"), boxes))


def test_offprice_needs_one_style(spark):
    state = table(spark, "CUST_ORDER", "STYLE string, CUST_NBR string, SEASON string, CXL int, COMMENT string", ("S", "61050", "SP-20", 0, "PLAIN"))
    styles = spark.createDataFrame([("S", "SP-20"), ("S", "FA-20")], "STYLE string, SEASON string")
    stops(orders.mark_offprice_by_season(state, styles, detail(spark), header(spark, "000001")))
