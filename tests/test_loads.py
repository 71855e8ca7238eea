"""Whole loads on hand-made feeds, with the results worked out by hand."""

import datetime as dt
import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.amounts import buckets
from tallyloom.operators.checks import CheckFailed, count_by_check
from tallyloom.plans import Load, commit, conform, dimensions, empty_table, forms, invoices, movements, orders, purchase_orders, quarantined, run_load, write_exceptions
from tallyloom.session import shared_dir, stage, staging
from tallyloom.sources.delimited import read_feed_family, read_positional
from tallyloom.sources.warehouse import Warehouse

KEY = ["GREEN_BAR", "STYLE", "COLOR"]


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def table(spark, name, ddl=None, *rows):
    return conform(frame(spark, ddl, *rows), schemas.TABLES[name]) if rows else empty_table(spark, schemas.TABLES[name])


def order_line(po, order, style, cust="61050", ordered=10, shipped=0, ship_on="", pick=0, mark="", cxl="7/1/2020", season="spring 20"):
    cells = [""] * 23
    for i, v in {0: 1, 2: cust, 4: po, 5: order, 6: "1/2/2020", 7: "6/1/2020", 8: cxl, 10: season, 11: style, 13: "7", 14: 9.5, 16: ordered, 18: shipped, 19: ship_on, 21: pick, 22: mark}.items():
        cells[i] = str(v)
    return ",".join(cells)


def open_line(order, style, shipped, bal, first):
    cells = [""] * 27
    for i, v in {4: order, 10: style, 12: "7", 16: shipped, 17: bal, 19: first, **{i: 0 for i in range(20, 27)}}.items():
        cells[i] = str(v)
    return ",".join(cells)


@pytest.fixture()
def order_feeds(tmp_path):
    (tmp_path / "SP-20 ALL.csv").write_text(
        "\n".join(
            [
                "header",
                order_line("77", "G1", "100", shipped=10, ship_on="6/5/2020"),
                order_line("77", "G2", "101"),
                order_line("77", "G3", "102", pick=3, mark="*"),
                order_line("78", "G4", "103", shipped=4, ship_on="6/9/2020"),
                order_line("79", "G5", "104"),
                order_line("80", "G6", "105", cust="87376", shipped=5, ordered=5, ship_on="6/7/2020"),
                order_line("80", "G7", "106", cust="87376"),
                order_line("81", "G6", "107", cust="87376"),
            ]
        )
    )
    (tmp_path / "OO.csv").write_text(
        "\n".join(["header", open_line("G4", "103", 4, 6, 6), open_line("G5", "104", 0, 10, 10), open_line("G3", "102", 0, 7, 7)])
    )
    return str(tmp_path)


def run_orders(spark, folder, state, generation=3):
    raw = read_feed_family(spark, folder, "*ALL*", schemas.CUSTOMER_ORDER)
    cleaned = orders.clean_orders(raw, generation)
    dated = orders.impute_ship_date(cleaned, "2020-07-01")
    oo = orders.clean_open_orders(read_positional(spark, f"{folder}/OO.csv", schemas.OPEN_ORDERS))
    return orders.load_orders(state, dated, oo, generation), dated, oo


def test_load_orders(spark, rows, order_feeds, tmp_path):
    state = table(
        spark, "CUST_ORDER", "GREEN_BAR string, STYLE string, COLOR string, SEASON string, COMMENT string, BAL_UNITS long, BAL_S1 long, CXL int",
        ("G1", "000100", "007", "SP-20", "ACTIVE", 9, 9, 1),
        ("GX", "000900", "007", "SP-20", "ACTIVE", 9, 9, 0),
        ("GY", "000901", "007", "FA-19", "ACTIVE", 9, 9, 0),
        ("GZ", "000902", "007", "FA-18", "COMPLETE", 9, 9, 0),
    )
    new, dated, oo = run_orders(spark, order_feeds, state)
    got = {r[0] + r[1]: tuple(r)[2:] for r in rows(new, "GREEN_BAR", "STYLE", "COMMENT", "SHIP_ON_DATE", "BAL_UNITS", "BAL_S1", "ORDERED_S1", "CXL")}
    day = lambda d: dt.date(2020, 6, d)
    assert got == {
        "G1000100": ("COMPLETE", day(5), 0, 0, None, 0),
        "G2000101": ("DEACTIVE", day(5), 0, 0, None, 0),
        "G3000102": ("UNCONFIRMED", None, 7, 7, 7, 0),
        "G4000103": ("PARTIAL", day(9), 6, 6, None, 0),
        "G5000104": ("ACTIVE", None, 10, 10, 10, 0),
        "G6000105": ("COMPLETE", day(7), 0, 0, None, 0),
        "G7000106": ("ACTIVE", None, 0, None, None, 0),
        "G6000107": ("DEACTIVE", day(7), 0, 0, None, 0),
        "GX000900": ("ACTIVE", None, 0, 0, None, 1),
        "GY000901": ("ACTIVE", None, 9, 9, None, 0),
        "GZ000902": ("COMPLETE", None, 9, 0, None, 0),
    }
    seasons = [r[0] for r in rows(orders.touched_seasons(state, dated, oo))]
    assert seasons == ["FA-18", "SP-20"]
    # only the touched seasons are read and rewritten
    store = Warehouse(spark, str(tmp_path / "store"))
    commit(store, Load({"CUST_ORDER": state}))
    part, _, _ = run_orders(spark, order_feeds, store.read("CUST_ORDER", seasons))
    commit(store, Load({"CUST_ORDER": part}, parts={"CUST_ORDER": seasons}))
    assert rows(store.read("CUST_ORDER")) == rows(new)


def test_generation_one_only_flags(spark, rows, order_feeds):
    state = table(spark, "CUST_ORDER", "GREEN_BAR string, STYLE string, COLOR string, SEASON string, COMMENT string, BAL_UNITS long, CXL int", ("GX", "000900", "007", "SP-20", "ACTIVE", 9, 0))
    new, _, _ = run_orders(spark, order_feeds, state, generation=1)
    assert ("GX", 9, 1, "ACTIVE") in rows(new, "GREEN_BAR", "BAL_UNITS", "CXL", "COMMENT")
    assert ("G3", 7, 0, "ACTIVE") in rows(new, "GREEN_BAR", "BAL_UNITS", "CXL", "COMMENT")


def row_loop_verdict(pairs, bought):
    """Per order: every style matches, by listing all customers of each style."""
    out = {}
    for po in {p for p, _, _ in pairs}:
        good = True
        for style in {s for p, s, _ in pairs if p == po}:
            wanted = {c for p, s, c in pairs if p == po and s == style}
            good &= any(c in bought.get(style, set()) for c in wanted)
        out[po] = "UPFRONT" if good else "OFFPRICE"
    return out


@pytest.mark.parametrize("seed", range(2))
def test_upfront_against_brute_force(spark, rows, seed):
    rnd = random.Random(seed)
    customers = frame(spark, "CUST_NBR string, CUST_NAME string", ("1", "A"), ("2", "B"), ("3", "A2"), ("61050", "C"))
    aliases = {"A2": "A"}
    name = {"1": "A", "2": "B", "3": "A", "61050": "C"}
    lines = [(f"g{i}", f"s{rnd.randint(0, 5)}", str(i), rnd.choice(list(name) + ["9"]), rnd.choice(["P1234567", "P1234568", "P2", "P3", "P4"])) for i in range(40)]
    ol = frame(spark, "GREEN_BAR string, STYLE string, COLOR string, CUST_NBR string, CUST_PO string", *lines)
    ol = ol.withColumns({"SEASON": F.lit("SP-20"), "COMMENT": F.lit("ACTIVE"), "COMMENT_2": F.lit("old"), "CXL": F.lit(0)})
    headers = [(f"h{i}", rnd.choice(list(name)), rnd.choice([1, 8])) for i in range(8)]
    details = [(f"h{rnd.randint(0, 7)}", f"s{rnd.randint(0, 4)}", rnd.randint(0, 1)) for _ in range(20)]
    d = frame(spark, "HFC_NBR string, STYLE string, CXL int", *details)
    h = frame(spark, "HFC_NBR string, CUST_NBR string, DIV int", *headers)
    marked = orders.mark_upfront(ol, d, h, customers, seasons=["SP-20"], prefix_lengths={"61050": 7}, aliases=aliases)
    live_headers = {n: c for n, c, div in headers if div != 8}
    bought = {}
    for hfc, style, cxl in details:
        if cxl == 0 and hfc in live_headers:
            bought.setdefault(style, set()).add(name[live_headers[hfc]])
    po = lambda r: r[4][:7] if r[3] == "61050" else r[4]
    verdict = row_loop_verdict({(po(r), r[1], name[r[3]]) for r in lines if r[3] in name}, bought)
    expected = sorted((r[0], str(verdict.get(po(r)))) for r in lines)
    assert sorted((r[0], str(r[1])) for r in rows(marked, "GREEN_BAR", "COMMENT_2")) == expected
    other = orders.mark_upfront(ol, d, h, customers, seasons=["FA-20"])
    assert {r[0] for r in rows(other, "COMMENT_2")} == {"old"}


def test_assoc_generations(spark, rows, tmp_path):
    (tmp_path / "SP-20 ASSOC.csv").write_text("h\nq,G1,x,12,5,123-A\nq,G2,x,13,5,\n")
    links = movements.read_assoc(spark, str(tmp_path))
    assert rows(links) == [("G1", "000012", "005", "000123", "SP-20"), ("G2", "000013", "005", "000000", "SP-20")]
    state = table(spark, "HFC_ASSOC", "GREEN_BAR string, STYLE string, COLOR string, HFC string, SEASON string, CXL int", ("G8", "1", "1", "9", "SP-20", 0), ("G9", "1", "1", "9", "FA-19", 0))
    scoped = movements.load_assoc(state, links, corrections=[({"GREEN_BAR": "G1"}, {"HFC": "000777"})]).states["HFC_ASSOC"]
    assert [(r[0], r[1], r[2]) for r in rows(scoped, "GREEN_BAR", "HFC", "CXL")] == [("G1", "000777", 0), ("G2", "000000", 0), ("G8", "9", 1), ("G9", "9", 0)]
    everywhere = movements.load_assoc(state, links, generation=1).states["HFC_ASSOC"]
    assert dict(rows(everywhere, "GREEN_BAR", "CXL")) == {"G1": 0, "G2": 0, "G8": 1, "G9": 1}


def test_inventory_clamps_and_reports(spark, rows, tmp_path):
    inv = frame(spark, "STYLE string, COLOR_CODE string, COLOR_DESC string, OH int, " + ", ".join(f"{b} long" for b in buckets()), ("12", "5", "NAVY", 3, -4, 3, *[0] * 6), ("13", "5", "RED", 1, 0, 0, *[0] * 6))
    ords = table(spark, "CUST_ORDER", "STYLE string, COLOR string, BAL_S1 long, CXL int", ("000012", "005", 1, 0), ("000012", "005", 100, 1))
    state = table(spark, "INV", "STYLE string, COLOR_CODE string, OH long, OH_S1 long, CXL int", ("000099", "001", 5, 5, 0))
    load = movements.load_inventory(state, inv, ords)
    assert rows(load.states["INV"], "STYLE", "OH", "OH_S1", "OH_S2", "CXL") == [("000012", 3, 0, 3, 0), ("000013", 1, 0, 0, 0), ("000099", 0, 0, 0, 1)]
    assert rows(load.exceptions, "key", "expected", "actual") == [("000013|005", "1", "0")]
    store = Warehouse(spark, str(tmp_path / "store"))
    with pytest.raises(CheckFailed):
        commit(store, load)
    assert not store.exists("INV")
    assert commit(store, load, accepted=["inventory_sizes"]) == {"inventory_sizes": 1}
    assert rows(store.read("INV"), "STYLE") == [("000012",), ("000013",), ("000099",)]
    commit(store, load, "quarantine")
    assert rows(store.read("INV"), "STYLE") == [("000012",), ("000099",)]
    commit(store, load, "quarantine", accepted=["inventory_sizes"])
    assert store.read("INV").count() == 3
    commit(store, load, "proceed")
    assert store.read("INV").count() == 3
    with pytest.raises(CheckFailed):
        commit(store, Load(load.states, load.exceptions), "quarantine")
    write_exceptions(load.exceptions, str(tmp_path / "reports"), "inventory")
    assert spark.read.parquet(str(tmp_path / "reports" / "inventory")).count() == 1


def test_styles(spark, rows):
    feed = frame(spark, "STYLE string, STYLE_DESC string, OPEN_SSN string, OPEN_YR string", ("12", "POLO KS X", "s", "2020"), ("13", None, "f", "2019"))
    feed = feed.select("*", *[F.lit(None).cast(k).alias(n) for n, k in [("PROTO", "string"), ("SIZE_RANGE", "string"), ("DIV", "int"), ("LABEL", "string"), ("SP", "double"), ("ELC", "double"), ("ILC", "double"), ("BRAND_NAME", "string"), ("FABRIC", "string"), ("RESERVE", "double"), ("ROYALTY", "double"), ("PPK", "string")]])
    manual = frame(spark, "STYLE string, CAT_2 string, SLV_2 string, INV_GROUP string, BUY_GROUP_MAIN string, BUY_GROUP_SUB string, SIZE string", ("12", "W", None, None, None, None, "REG"))
    state = table(spark, "STYLE_MASTER", "STYLE string, CXL int", ("000099", 0))
    details = frame(spark, "HFC_NBR string, STYLE string", ("h", "000012"), ("h", "000050"))
    headers = frame(spark, "HFC_NBR string, SEASON string", ("h", "SP-20"))
    load = dimensions.load_styles(state, feed, manual, details, headers)
    assert rows(load.states["STYLE_MASTER"], "STYLE", "CAT", "SLV", "RM_GROUP", "SEASON", "REG_BT", "CXL") == [
        ("000012", "W", "S/S", "OTHER WOVEN", "SP-20", "REG", 0),
        ("000013", "", "", "", "FA-19", None, 0),
        ("000099", None, None, None, None, None, 1),
    ]
    assert count_by_check(load.exceptions) == {"style_cat": 1, "style_season": 1}


def test_purchase_orders(spark, rows):
    raw = frame(
        spark, "DIV int, CUST_NBR string, SSN string, HFC string, X_ORIENT string, X_SHIP string, CAT string, AGENT string, COO string, CARTON_SIZE int, HFC_SIZE_SCALE string, pos int",
        (1, "7", "SP-20", "11", "1/2/2020", "", "K", "a", "c", 12, "1", 1), (1, "7", "SP-20", "11", "1/2/2020", "", "K", "a", "c", 99, "1", 2),
        (1, "7", "SP-20", "12", "", "", "K", "a", "c", 5, "1", 3), (1, "7", "SP-20", "13", "", "", "K", "a", "c", 5, "00", 4), (1, "7", "SP-20", "14", "", "", "K", "a", "c", 5, None, 5),
    )
    headers = purchase_orders.clean_headers(raw, ["pos"])
    scales = frame(spark, "SIZE_SCALE_CODE string, TTL_QTY int", ("01", 12))
    state = table(spark, "HFC_HEADER", "HFC_NBR string, SEASON string, CXL int", ("000001", "SP-20", 0), ("000002", "FA-19", 0))
    maker = frame(spark, "HFC string, MAKER string, ECOM int", ("11", "M", None))
    load = purchase_orders.load_po_headers(state, headers, scales, maker)
    got = {r[0]: tuple(r)[1:] for r in rows(load.states["HFC_HEADER"], "HFC_NBR", "HFC_SIZE_SCALE_CODE", "CXL", "MAKER", "IS_ECOM")}
    assert got["000011"] == ("01", 0, "M", 0) and got["000012"][0] == "Z9" and got["000013"][0] == "00" and got["000014"][0] == "Z9"
    assert got["000001"][1] == 1 and got["000002"][1] == 0
    assert [r[0] for r in rows(load.exceptions, "key")] == ["000012"]


def test_what_refers_to_held_rows_stays_as_stored(spark, rows, tmp_path):
    store = Warehouse(spark, str(tmp_path / "store"))
    old = table(spark, "SIZE_SCALE", "SIZE_SCALE_CODE string, S1_QTY int", ("02", 9))
    scales = dimensions.load_size_scales(old, frame(spark, "SCALE string, DESC string", ("1", "4/S 8/M"), ("2", "x/S")))
    with pytest.raises(CheckFailed):
        commit(store, scales)
    commit(store, scales, "quarantine")
    assert rows(quarantined(scales)) == [("02",)] and quarantined(scales, ["size_scale_text"]) is None
    totals = dimensions.scale_totals(store.read("SIZE_SCALE"))
    feed = frame(spark, "HFC string, SSN string, CARTON_SIZE int, HFC_SIZE_SCALE string", ("a", "SP-20", 12, "01"), ("b", "SP-20", 9, "02"), ("c", "SP-20", 7, "01"), ("d", "SP-20", 1, "00"))
    feed = feed.select("*", *[F.lit(None).cast(k).alias(n) for n, k in [("X_SHIP", "date"), ("X_ORIENT", "date"), ("DIV", "int"), ("CUST_NBR", "string"), ("AGENT", "string"), ("COO", "string"), ("CAT", "string")]])
    stored = table(spark, "HFC_HEADER", "HFC_NBR string, SEASON string, CARTON_SIZE int, CXL int", ("b", "SP-20", 5, 0), ("e", "SP-20", 5, 0))
    headers = purchase_orders.load_po_headers(stored, feed, totals, held_scales=quarantined(scales))
    assert count_by_check(headers.exceptions) == {"prepack_carton": 2, "scale_held": 1}
    commit(store, headers, "quarantine")
    assert rows(store.read("HFC_HEADER"), "HFC_NBR", "CARTON_SIZE", "CXL") == [("a", 12, 0), ("b", 5, 0), ("d", 1, 0), ("e", 5, 1)]
    held = quarantined(headers)
    assert rows(held) == [("b",), ("c",)]
    lines = frame(spark, "HFC string, SSN string, STYLE string, COLOR string, UNITS int", *[(k, "SP-20", "1", "1", 6) for k in "abc"])
    lines = lines.select("*", *[F.lit(None).cast("string").alias(c) for c in ("COLOR_DESC", "HFC_LINE_SIZE_SCALE", "ASST")], *[F.lit(1.0).alias(c) for c in ("FOB", "ELC", "SP", "MSRP")])
    detail = table(spark, "HFC_DETAIL", "HFC_NBR string, STYLE string, COLOR_CODE string, TTL_QTY long, CXL int", ("a", "2", "1", 3, 0), ("b", "1", "1", 3, 0), ("b", "2", "1", 3, 0))
    load = purchase_orders.load_po_lines(detail, lines, store.read("HFC_HEADER"), held=held)
    assert rows(load.exceptions, "check_id", "key") == [("held_back", "b|1|1"), ("held_back", "c|1|1")]
    commit(store, load, "quarantine")
    assert rows(store.read("HFC_DETAIL"), "HFC_NBR", "STYLE", "TTL_QTY", "CXL") == [("a", "1", 6, 0), ("a", "2", 3, 1), ("b", "1", 3, 0), ("b", "2", 3, 0)]
    breaks = frame(spark, "HFC string, STYLE string, COLOR string, " + ", ".join(f"{b} long" for b in buckets()), ("a", "1", "1", *[2] * 8), ("b", "1", "1", *[2] * 8))
    split = purchase_orders.load_size_breaks(store.read("HFC_DETAIL"), breaks, held=held)
    assert dict(rows(split.states["HFC_DETAIL"].filter("STYLE = '1'"), "HFC_NBR", "S1_QTY")) == {"a": 2, "b": None}
    links = frame(spark, "GREEN_BAR string, STYLE string, COLOR string, HFC string, SEASON string", ("g", "1", "1", "a", "SP-20"), ("h", "1", "1", "b", "SP-20"))
    assoc = table(spark, "HFC_ASSOC", "GREEN_BAR string, STYLE string, COLOR string, HFC string, SEASON string, CXL int", ("h", "1", "1", "old", "SP-20", 0), ("i", "1", "1", "old", "SP-20", 0))
    tied = movements.load_assoc(assoc, links, corrections=[], held=held)
    assert rows(tied.states["HFC_ASSOC"], "GREEN_BAR", "HFC", "CXL") == [("g", "a", 0), ("h", "old", 0), ("i", "old", 1)]
    assert rows(tied.exceptions, "key") == [("h|1|1|b",)]


def test_cartons_to_come(spark, rows):
    details = frame(spark, "HFC_NBR string, STYLE string, COLOR_CODE string, TTL_QTY long, CXL int", ("a", "1", "1", 25, 0), ("a", "2", "1", 10, 0), ("a", "3", "1", 99, 1), ("b", "1", "1", 5, 0), ("z", "1", "1", 5, 0))
    headers = frame(spark, "HFC_NBR string, SEASON string, DIV int, CARTON_SIZE int", ("a", "SP-20", 1, 10), ("b", "SP-20", 8, 10), ("z", "SP-20", 1, 0))
    short = frame(spark, "HFC string, STYLE string, COLOR string, DIFF int", ("a", "1", "1", -6))
    boxes = frame(spark, "HFC_NBR string, CARTON_CTN int, CTN_TO_COME long", ("a", 1, 7), ("a", 2, 7), ("b", 1, 7))
    to_come = purchase_orders.cartons_to_come(details, headers, short, boxes)
    assert rows(to_come) == [("a", -1), ("z", None)]
    assert rows(purchase_orders.with_cartons_to_come(boxes, to_come)) == [("a", 1, -1), ("a", 2, -1), ("b", 1, 7)]


def container_inputs(spark, hfc2="12"):
    sheet = frame(
        spark, "SHIPMENT_NBR string, ETA string, CONTAINER_NBR string, HFC_NBR string, CARTON_CTN int, _file string, _block long, _row long",
        ("S1", "2020-05-01", "abcd 1234567", "11", 5, "f", 0, 1), (None, None, None, hfc2, 6, "f", 0, 2), (None, "2020-05-02", "AIR", "11", 1, "f", 4, 9),
    )
    receiving = frame(spark, "CTRL_NBR string, HFC string, STYLE string, COLOR string, CONTAINER_NBR string, REC_DATE string, INVOICE_NBR string", ("9", "11", "1", "1", "ABCD1234567", "2020-05-03", "I0"), (None, "12", "1", "1", " ABCD1234567", "2020-05-03", "I1"))
    whse = frame(spark, "CONTAINER_NBR string, WHSE_REC_DATE string", ("ABCD1234567", "2020-05-05"))
    headers = frame(spark, "HFC_NBR string, SEASON string, DIV int, CARTON_SIZE int", ("000011", "SP-20", 1, 2), ("000012", "SP-20", 1, 2))
    details = frame(spark, "HFC_NBR string, STYLE string, COLOR_CODE string, TTL_QTY long, CXL int", ("000011", "1", "1", 20, 0))
    short = frame(spark, "HFC string, STYLE string, COLOR string, DIFF int", ("000011", "1", "1", 2))
    return movements.clean_containers(sheet), receiving, whse, headers, details, short


def test_containers(spark, rows):
    state = table(spark, "HFC_CONTAINER", "HFC_NBR string, CONTAINER_NBR string, CARTON_CTN int, ETA date, RECVD int", ("000099", "OLDD1234567", 3, dt.date(2020, 1, 1), 1))
    load = movements.load_containers(state, *container_inputs(spark))
    got = rows(load.states["HFC_CONTAINER"], "HFC_NBR", "CONTAINER_NBR", "CARTON_CTN", "SHIPMENT_NBR", "RECVD", "CTN_TO_COME", "INVOICE_NBR", "WHSE_REC_DATE")
    day = dt.date(2020, 5, 5)
    assert got == [
        ("000011", "ABCD1234567", 5, "S1", 1, 5, None, day),
        ("000011", "AIR", 1, "S1", 0, 5, None, None),
        ("000012", "ABCD1234567", 6, "S1", 0, None, "I1", day),
        ("000099", "OLDD1234567", 3, None, 1, None, None, None),
    ]
    assert load.exceptions.count() == 0
    blank = movements.load_containers(state, *container_inputs(spark, hfc2=None))
    assert count_by_check(blank.exceptions) == {"container_order_blank": 1, "container_control_total": 1, "invoice_pair_unknown": 1}
    strange = movements.load_containers(state, *container_inputs(spark, hfc2="13"))
    assert count_by_check(strange.exceptions) == {"container_order_unknown": 1, "invoice_pair_unknown": 1}
    kept = strange.without({"container_order_unknown"})["HFC_CONTAINER"]
    assert rows(kept, "HFC_NBR", "CONTAINER_NBR") == [("000011", "ABCD1234567"), ("000011", "AIR"), ("000099", "OLDD1234567")]


def test_invoices(spark, rows):
    header = frame(
        spark, "INVOICE_NBR string, LC_NBR string, DN_NBR string, DN_AMT double, OBL_AWB string, FIRST_SALE_AMT double, LC_AMT double, QTY long, CTNS long",
        ("i 1", "l", None, None, "ob 1", 0.0, 20.0, 10, 5), ("i2", "l", None, None, "OB9", 0.0, 20.011, 10, 0), ("i3", "l", None, None, None, 0.0, 9.0, 9, 9), ("i4", "l", None, None, "OB1", 1.0, 1.0, 1, 0),
    )
    detail = frame(
        spark, "INVOICE_NBR string, HFC string, STYLE string, PCS long, PRICE double, HANGER_COST double, DUTY_FREE_PRICE double",
        ("I1", "11", "1", 10, 1.5, 0.5, None), ("I2", "11", "9", 10, 1.5, 0.5, None),
    )
    paid = frame(
        spark, "INVOICE_NBR string, PAID_DATE string, COMMISSION_PAID_DATE string, ACH_PAID_DATE string, ACH_AMOUNT double, FILE_NBR string, CARTON_COUNT long",
        ("I1", "2020-01-01", None, "2020-01-02", 5.0, "f", 1), ("I2", "2020-01-01", None, None, None, "f", 1), ("I9", "2020-01-01", None, None, None, None, 1),
    )
    packing = frame(spark, "INVOICE_NBR string, CONTAINER_NBR string, HFC string", ("i1", "c 1", "11"), ("i2", "c2", "11"))
    boxes = table(spark, "HFC_CONTAINER", "CONTAINER_NBR string, HFC_NBR string, OBL_AWB string, CARTON_CTN int", ("C1", "000011", "OB1", 5), ("C2", "000011", None, 5))
    load = invoices.reconcile_invoices(
        invoices.clean_invoice_headers(header), invoices.clean_invoice_details(detail), invoices.clean_payments(paid), invoices.clean_invoice_containers(packing),
        boxes, frame(spark, "HFC_NBR string, CARTON_SIZE int, CXL int", ("000011", 2, 0)), frame(spark, "HFC_NBR string, STYLE string, CXL int", ("000011", "000001", 0)),
        table(spark, "INVOICE_HEADER"), table(spark, "INVOICE_DETAIL"),
    )
    assert rows(load.exceptions, "check_id", "key") == [
        ("bill_of_lading_unknown", "I2|OB9"),
        ("invoice_container_unknown", "I2|C2|000011"),
        ("invoice_line_unknown", "I2|000011|000009"),
        ("invoice_totals", "I2"),
        ("invoice_unbilled", "I9"),
    ]
    assert rows(load.states["INVOICE_HEADER"], "INVOICE_NBR", "ACH_AMT") == [("I1", 5.0), ("I2", 5.0), ("I3", None), ("I4", None), ("I9", None)]
    assert rows(load.states["HFC_CONTAINER"], "CONTAINER_NBR", "INVOICE_NBR") == [("C1", "I1"), ("C2", None)]
    kept = load.without({"invoice_totals", "invoice_unbilled"})
    assert rows(kept["INVOICE_HEADER"], "INVOICE_NBR") == [("I1",), ("I3",), ("I4",)]
    assert rows(kept["INVOICE_DETAIL"], "INVOICE_NBR") == [("I1",)]
    assert rows(kept["HFC_CONTAINER"], "CONTAINER_NBR", "INVOICE_NBR") == [("C1", "I1"), ("C2", None)]
    assert load.without({"another check"}) == {}
    twice = paid.unionByName(paid.filter("INVOICE_NBR = 'I1'"))
    with pytest.raises(Exception, match="repeated key in bank transfers"):
        invoices.clean_payments(twice).collect()


def test_receiving_and_short_over(spark, rows):
    raw = frame(spark, "CTRL_NBR string, REC_NBR string, REC_DATE string, HFC string, STYLE string, COLOR string, REC_UNITS long", ("1", "5", "1/2/2020", "11", "1", "1", 6))
    state = table(spark, "RECEIVING", "CTRL_NBR string, HFC_NBR string, STYLE string, COLOR string, REC_UNITS long", ("1", "000011", "000001", "001", 1), ("2", "000011", "000001", "001", 2))
    new = movements.load_receiving(state, movements.clean_receiving(raw, 1), 1).states["RECEIVING"]
    assert rows(new, "CTRL_NBR", "REC_NBR", "REC_UNITS") == [("1", "000005", 6), ("2", None, 2)]
    short = frame(spark, "PO string, STYLE string, COLOR string, DIFF int", ("11", "1", "1", -3))
    old = table(spark, "SHORT_OVER", "HFC string, STYLE string, COLOR string, DIFF int", ("000011", "000001", "001", 9), ("000012", "000001", "001", 8))
    assert rows(purchase_orders.load_short_over(old, short).states["SHORT_OVER"], "HFC", "DIFF") == [("000011", -3), ("000012", 8)]


def form(file, kind, lines, end=True, scale="00/BULK"):
    head = {(2, 2): "123", (2, 7): "SEASON: sp 2020", (2, 10): "61050: X E-COM", (3, 7): scale, (3, 10): kind, (6, 2): "7", (8, 11): "CTN: 24X", (8, 16): "( X )", (10, 2): "2020-01-02", (12, 2): "2020-03-04"}
    cells = [(file, r, c, v) for (r, c), v in head.items()]
    for i, values in enumerate(lines):
        cells += [(file, 22 + i, c, v) for c, v in values.items()]
    return cells + ([(file, 40, 5, "TOTAL")] if end else [])


def test_forms(spark, rows):
    cells = list(
        itertools.chain(
            form("bulk", "BULK", [{0: "100", 3: "polo", 8: "5", 9: "30", 10: "10/s-20/M"}, {0: "100", 9: "31", 10: "10/S-20/M"}, {0: "999", 9: "1", 10: ""}]),
            form("pack", "PPK", [{0: "100", 3: "polo", 9: "6"}, {0: "100", 3: "polo", 9: "7"}], scale="A1/x"),
            form("mixed", "PPK", [{0: "100", 3: "polo @ B2", 9: "8"}], scale="A1/x"),
            form("odd", "PPK", [{0: "100", 9: "1"}]),
            form("endless", "BULK", [{0: "100", 9: "1", 10: "1/S"}], end=False),
        )
    )
    df = frame(spark, "file string, row int, col int, value string", *cells)
    labels = frame(spark, "STYLE string, labels array<string>", ("100", ["S", "M", "L"]))
    scales = frame(spark, "SIZE_SCALE_CODE string, SIZE_SCALE_DESC string", ("A1", "1/S 2/M"), ("B2", "4/L"))
    headers, lines, found = forms.read_forms(df, labels, scales)
    assert ("bulk", "000123", "K", "61050", 1, "sp-20", 24, "00", "BULK") in rows(headers, "file", "hfc_nbr", "cat", "cust_nbr", "is_ecom", "ssn", "carton_size", "hfc_size_scale_code", "kind")
    assert rows(lines, "file", "ttl_qty", "s1", "s2", "s3", "s8", "adds_up") == [("bulk", 30, 10, 20, 0, 0, 1), ("bulk", 31, 10, 20, 0, 0, 0), ("mixed", 8, 0, 0, 8, 0, 1), ("pack", 6, 2, 4, 0, 0, 1)]
    assert count_by_check(found) == {"form_kind": 1, "form_body": 1, "form_line": 2, "form_line_total": 1}


def staged_folders(spark):
    folder = Path(f"{shared_dir(spark).removeprefix('file:')}/stage")
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_a_load_leaves_no_staged_frames(spark, tmp_path):
    store, before = Warehouse(spark, str(tmp_path / "w")), staged_folders(spark)
    state = frame(spark, "CUST string, CXL int", ("1", 0), ("2", 1))

    def build(bad=False):
        kept = stage(stage(state).filter("CXL = 0"))
        assert staged_folders(spark) - before
        found = kept.selectExpr("'c' check_id", "CUST key", "'' expected", "'' actual", "'r' reason")
        return Load({"T": kept}, found if bad else None)

    assert run_load(store, build) == {} and store.read("T").count() == 1
    assert staged_folders(spark) == before
    with pytest.raises(CheckFailed):
        run_load(store, lambda: build(bad=True))
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(state)
        1 / 0
    assert staged_folders(spark) == before


def test_scopes_own_what_they_stage(spark):
    before, state = staged_folders(spark), frame(spark, "a int", (1,))
    with staging(spark):
        outer = stage(state)
        with staging(spark):
            assert stage(outer) is outer
            inner = stage(state)
        assert outer.count() == 1
        again = stage(inner.limit(0).union(outer.limit(0)).union(state))
        assert stage(again) is again
    assert staged_folders(spark) == before
    with pytest.raises(Exception, match="(?i)path|file"):
        outer.collect()
