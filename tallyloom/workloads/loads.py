"""Whole loads over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..functions.amounts import buckets
from ..session import stage
from ..operators.mutate import scope_values
from ..plans import commit, conform, dimensions, movements, orders, purchase_orders, quarantined, write_exceptions
from ..sources.warehouse import Warehouse
from . import ORACLES, case
from .adapters import (
    AS_OF,
    CUSTOMER_NAMES,
    FEED_ORDERS,
    OPEN_ORDERS,
    ORDER_LINES,
    PO_DETAILS,
    PO_HEADERS,
    STORED_ORDERS,
    as_text,
    customer_names,
    digits,
    feed_orders,
    open_orders,
    order_lines,
    po_details,
    po_headers,
    season_of,
    season_sql,
    shared_lines,
    stored_orders,
    table,
    with_clause,
    z,
)
from .shape import scratch

KEY = "GREEN_BAR, STYLE, COLOR"
EIGHT = range(1, 9)
BY_ORDER = ("00007", "00011", "00400")


def _listed(pattern: str) -> str:
    return ", ".join(pattern.replace("#", str(i)) for i in EIGHT)


def _imputed(source: str, name: str = "im") -> str:
    """SQL of the ship-date imputation, by season."""
    by = "SELECT SEASON, {k}, max(SHIP_ON_DATE) AS d FROM {s} WHERE SHIPPED_UNITS > 0 GROUP BY SEASON, {k}"
    customers = ", ".join(f"'{c}'" for c in BY_ORDER)
    return f"""
    {name} AS (SELECT x.* EXCLUDE (SHIP_ON_DATE), CASE WHEN x.SHIP_ON_DATE IS NULL AND x.PICK_UNITS = 0
        AND x.CXL_SHIP - DATE '{AS_OF}' <= 5 THEN CASE WHEN x.CUST_NBR IN ({customers}) THEN g.d ELSE p.d END
        ELSE x.SHIP_ON_DATE END AS SHIP_ON_DATE
      FROM {source} x
      LEFT JOIN ({by.format(k='CUST_PO', s=source)}) p ON p.SEASON = x.SEASON AND p.CUST_PO = x.CUST_PO
      LEFT JOIN ({by.format(k='GREEN_BAR', s=source)}) g ON g.SEASON = x.SEASON AND g.GREEN_BAR = x.GREEN_BAR)"""


@case(
    "q_impute_ship_date",
    f"""{with_clause(ORDER_LINES, _imputed('ol'))} SELECT {KEY}, SEASON, SHIP_ON_DATE FROM im""",
)
def impute_ship_date(spark, folder):
    lines = orders.impute_ship_date(
        shared_lines(spark, folder), AS_OF, group="SEASON", green_bar_customers=BY_ORDER
    )
    return lines.select("GREEN_BAR", "STYLE", "COLOR", "SEASON", "SHIP_ON_DATE")


@case(
    "q_impute_by_order",
    f"""{with_clause(ORDER_LINES)} SELECT {KEY}, max(SHIP_ON_DATE) OVER (PARTITION BY SEASON, GREEN_BAR) AS SHIP_ON_DATE FROM ol""",
)
def impute_by_order(spark, folder):
    lines = orders.impute_ship_date_by_order(shared_lines(spark, folder), group="SEASON")
    return lines.select("GREEN_BAR", "STYLE", "COLOR", "SHIP_ON_DATE")


def _status_sql(generation: int) -> str:
    unconfirmed = "WHEN UNCONFIRMED = '*' THEN 'UNCONFIRMED'" if generation > 1 else ""
    return f"""CASE WHEN SHIPPED_UNITS = 0 AND SHIP_ON_DATE IS NOT NULL AND bal0 = 0 THEN 'DEACTIVE'
        WHEN SHIPPED_UNITS >= ORDERED_UNITS AND SHIP_ON_DATE IS NOT NULL THEN 'COMPLETE'
        WHEN bal0 > 0 AND SHIP_ON_DATE IS NOT NULL THEN 'PARTIAL' {unconfirmed} ELSE 'ACTIVE' END"""


_BY_ORDER_NUMBER = """im AS (SELECT * REPLACE (max(SHIP_ON_DATE) OVER (PARTITION BY SEASON, GREEN_BAR) AS SHIP_ON_DATE) FROM fd)"""


def _load_sql(generation: int) -> str:
    """SQL of the order load as the sequence of statements it stands for."""
    copied = [
        "DIV", "CUST_NBR", "ORDER_DATE", "START_SHIP", "CXL_SHIP", "CUST_PO", "SEASON", "SP", "ORDERED_UNITS",
        "SHIPPED_UNITS", "PICK_UNITS", "SHIP_ON_DATE", "UNCONFIRMED", "COMMENT",
    ]
    mark = "UNCONFIRMED = '*'" if generation > 1 else "UNCONFIRMED <> ''"
    lost = "s.GREEN_BAR IS NULL AND t.SEASON IN (SELECT SEASON FROM src)"
    zero = lost if generation > 1 else "FALSE"
    closed = "('COMPLETE', 'DEACTIVE')" if generation > 1 else "('COMPLETE')"
    imputed = _BY_ORDER_NUMBER if generation == 2 else _imputed("fd")
    return f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS, OPEN_ORDERS, imputed)},
    b AS (SELECT im.* EXCLUDE (BAL, UNCONFIRMED), im.UNCONFIRMED, coalesce(oo.BAL, 0) AS bal0 FROM im
      LEFT JOIN oo ON im.GREEN_BAR = oo.GREEN_BAR AND im.STYLE = oo.STYLE AND im.COLOR = oo.COLOR),
    src AS (SELECT * EXCLUDE (UNCONFIRMED), CASE WHEN {mark} THEN 1 ELSE 0 END AS UNCONFIRMED, {_status_sql(generation)} AS COMMENT FROM b),
    m AS (SELECT coalesce(t.GREEN_BAR, s.GREEN_BAR) AS GREEN_BAR, coalesce(t.STYLE, s.STYLE) AS STYLE, coalesce(t.COLOR, s.COLOR) AS COLOR,
      {', '.join(f'CASE WHEN s.GREEN_BAR IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in copied)},
      CASE WHEN s.GREEN_BAR IS NOT NULL THEN s.bal0 WHEN {zero} THEN 0 ELSE t.BAL_UNITS END AS BAL_UNITS, t.COMMENT_2,
      {_listed('t.ORDERED_S#')}, {_listed(f'CASE WHEN {zero} THEN 0 ELSE t.BAL_S# END AS BAL_S#')},
      CASE WHEN s.GREEN_BAR IS NOT NULL THEN 0 WHEN {lost} THEN 1 ELSE t.CXL END AS CXL
      FROM st t FULL OUTER JOIN src s ON t.GREEN_BAR = s.GREEN_BAR AND t.STYLE = s.STYLE AND t.COLOR = s.COLOR)
    SELECT m.GREEN_BAR, m.STYLE, m.COLOR, {', '.join(copied)}, BAL_UNITS, COMMENT_2, CXL,
      {_listed('CASE WHEN oo.SHIPPED = 0 AND oo.BAL > 0 THEN oo.S# ELSE ORDERED_S# END AS ORDERED_S#')},
      {_listed(f'CASE WHEN COMMENT IN {closed} THEN 0 WHEN oo.BAL > 0 THEN oo.S# ELSE BAL_S# END AS BAL_S#')}
    FROM m LEFT JOIN oo ON m.GREEN_BAR = oo.GREEN_BAR AND m.STYLE = oo.STYLE AND m.COLOR = oo.COLOR"""


def _load_orders(spark, folder, generation):
    lines = shared_lines(spark, folder)
    feed = as_text(feed_orders(lines), "yyyy-MM-dd HH:mm:ss" if generation == 2 else "M/d/yyyy")
    cleaned = stage(orders.clean_orders(feed.withColumn("FILE", F.col("SEASON")), generation))
    if generation == 2:
        dated = orders.impute_ship_date_by_order(cleaned)
    else:
        dated = orders.impute_ship_date(cleaned, AS_OF, green_bar_customers=BY_ORDER)
    return orders.load_orders(
        stored_orders(lines),
        dated,
        orders.clean_open_orders(open_orders(lines)),
        generation,
        # a few rows, written first: Spark sees that and does not shuffle the table by season
        seasons=stage(scope_values(cleaned, "SEASON")),
    )


@case("q_load_orders", _load_sql(3))
def load_orders(spark, folder):
    return _load_orders(spark, folder, 3)


@case("q_load_orders_gen1", _load_sql(1))
def load_orders_gen1(spark, folder):
    return _load_orders(spark, folder, 1)


@case("q_load_orders_gen2", _load_sql(2))
def load_orders_gen2(spark, folder):
    return _load_orders(spark, folder, 2)


@case(
    "q_touched_seasons",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS, OPEN_ORDERS)},
    k AS (SELECT {KEY} FROM fd UNION SELECT {KEY} FROM oo)
    SELECT SEASON FROM fd UNION SELECT st.SEASON FROM st JOIN k USING ({KEY})
    UNION SELECT SEASON FROM st WHERE COMMENT IN ('COMPLETE', 'DEACTIVE')""",
)
def touched_seasons(spark, folder):
    lines = shared_lines(spark, folder)
    return orders.touched_seasons(stored_orders(lines), feed_orders(lines), open_orders(lines))


def _named_orders(lines):
    return stored_orders(lines).withColumn("CUST_PO", F.col("GREEN_BAR"))


_ALIASES = {"NATION_1": "NATION_2", "NATION_3": "NATION_2"}
_NAMES = """na AS (SELECT CUST_NBR, CASE WHEN CUST_NAME IN ('NATION_1', 'NATION_3') THEN 'NATION_2' ELSE CUST_NAME END AS nm FROM cn)"""


@case(
    "q_upfront_offprice",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, PO_DETAILS, PO_HEADERS, CUSTOMER_NAMES, _NAMES)},
    o AS (SELECT *, CASE WHEN CUST_NBR = '00007' THEN left(GREEN_BAR, 4) ELSE GREEN_BAR END AS po FROM st
      WHERE CXL = 0 AND COMMENT <> 'DEACTIVE'),
    t1 AS (SELECT DISTINCT STYLE, po, nm FROM o JOIN na ON na.CUST_NBR = o.CUST_NBR),
    t2 AS (SELECT DISTINCT STYLE, nm AS nm2 FROM pd JOIN ph ON pd.HFC_NBR = ph.HFC_NBR JOIN na ON na.CUST_NBR = ph.CUST_NBR
      WHERE pd.CXL = 0 AND ph.DIV <> 2),
    g AS (SELECT po, t1.STYLE, max(CASE WHEN nm = nm2 THEN 1 ELSE 0 END) AS hit FROM t1 LEFT JOIN t2 ON t1.STYLE = t2.STYLE GROUP BY 1, 2),
    v AS (SELECT po, CASE WHEN min(hit) = 1 THEN 'UPFRONT' ELSE 'OFFPRICE' END AS c2 FROM g GROUP BY po)
    SELECT {KEY}, CASE WHEN st.CXL = 0 AND st.COMMENT <> 'DEACTIVE' THEN v.c2 ELSE st.COMMENT_2 END AS COMMENT_2
    FROM st LEFT JOIN v ON v.po = CASE WHEN st.CUST_NBR = '00007' THEN left(st.GREEN_BAR, 4) ELSE st.GREEN_BAR END""",
)
def upfront_offprice(spark, folder):
    lines = shared_lines(spark, folder)
    marked = orders.mark_upfront(
        _named_orders(lines),
        po_details(lines),
        po_headers(spark, folder),
        customer_names(spark, folder),
        seasons=None,
        prefix_lengths={"00007": 4},
        aliases=_ALIASES,
        excluded_div=2,
    )
    return marked.select("GREEN_BAR", "STYLE", "COLOR", "COMMENT_2")


@case(
    "q_offprice_by_season",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, PO_DETAILS, PO_HEADERS)},
    sm AS (SELECT STYLE, max(SEASON) AS style_ssn FROM ol WHERE STATUS = 'F' GROUP BY STYLE),
    hb AS (SELECT DISTINCT STYLE, CUST_NBR FROM pd JOIN ph ON pd.HFC_NBR = ph.HFC_NBR WHERE pd.CXL = 0)
    SELECT {KEY}, CASE WHEN CUST_PO = '000010' THEN 'UPFRONT' WHEN st.CXL = 1 OR COMMENT = 'DEACTIVE' THEN COMMENT_2
      WHEN style_ssn IS NULL OR SEASON <> style_ssn THEN 'OFFPRICE'
      WHEN hb.STYLE IS NULL AND st.CUST_NBR NOT IN ('00007', '00011') THEN 'OFFPRICE' ELSE 'UPFRONT' END AS COMMENT_2
    FROM st LEFT JOIN sm USING (STYLE) LEFT JOIN hb ON hb.STYLE = st.STYLE AND hb.CUST_NBR = st.CUST_NBR""",
)
def offprice_by_season(spark, folder):
    lines = shared_lines(spark, folder)
    styles = lines.filter("STATUS = 'F'").groupBy("STYLE").agg(F.max("SEASON").alias("SEASON"))
    marked = orders.mark_offprice_by_season(
        stored_orders(lines),
        styles,
        po_details(lines),
        po_headers(spark, folder),
        exempt=("00007", "00011"),
        corrections=[({"CUST_PO": "000010"}, {"COMMENT_2": "UPFRONT"})],
    )
    return marked.select("GREEN_BAR", "STYLE", "COLOR", "COMMENT_2")


_SHORT = f"""so AS (SELECT {z('l_orderkey', 6)} AS HFC, {z('l_partkey', 6)} AS STYLE, {z('l_suppkey', 3)} AS COLOR,
    CAST(-sum(l_quantity) AS INTEGER) AS DIFF FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_partkey, l_suppkey)"""
_BOXES = f"""bx AS (SELECT {z('l_orderkey', 6)} AS HFC_NBR, {z('l_suppkey', 3)} AS CONTAINER_NBR, CAST(count(*) AS INTEGER) AS CARTON_CTN,
    CAST(NULL AS BIGINT) AS CTN_TO_COME FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_suppkey)"""


def _short_over(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R'")
        .groupBy("l_orderkey", "l_partkey", "l_suppkey")
        .agg((-F.sum(F.col("l_quantity").cast("long"))).cast("int").alias("DIFF"))
        .select(
            text.zfill(digits("l_orderkey"), 6).alias("HFC"),
            text.zfill(digits("l_partkey"), 6).alias("STYLE"),
            text.zfill(digits("l_suppkey"), 3).alias("COLOR"),
            "DIFF",
        )
    )


def _boxes(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .filter("l_linestatus = 'F'")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(F.count("*").cast("int").alias("CARTON_CTN"))
        .select(
            text.zfill(digits("l_orderkey"), 6).alias("HFC_NBR"),
            text.zfill(digits("l_suppkey"), 3).alias("CONTAINER_NBR"),
            "CARTON_CTN",
            F.lit(None).cast("long").alias("CTN_TO_COME"),
        )
    )


@case(
    "q_cartons_to_come",
    f"""{with_clause(ORDER_LINES, PO_DETAILS, PO_HEADERS, _SHORT, _BOXES)},
    c AS (SELECT pd.HFC_NBR, CAST(sum(pd.TTL_QTY + coalesce(so.DIFF, 0)) AS BIGINT) AS pieces FROM pd
      LEFT JOIN so ON so.HFC = pd.HFC_NBR AND so.STYLE = pd.STYLE AND so.COLOR = pd.COLOR_CODE WHERE pd.CXL = 0 GROUP BY pd.HFC_NBR),
    d AS (SELECT HFC_NBR, CAST(sum(CARTON_CTN) AS BIGINT) AS boxes FROM bx GROUP BY HFC_NBR),
    r AS (SELECT c.HFC_NBR, CAST(trunc(CAST(pieces AS DOUBLE) / CARTON_SIZE) AS BIGINT) - coalesce(boxes, 0) AS v FROM c JOIN ph ON ph.HFC_NBR = c.HFC_NBR
      LEFT JOIN d ON d.HFC_NBR = c.HFC_NBR WHERE SEASON IN ('SP-96', 'FA-96', 'SP-97', 'FA-97', 'SP-99', 'FA-00') AND DIV <> 3)
    SELECT bx.HFC_NBR, CONTAINER_NBR, CARTON_CTN, v AS CTN_TO_COME FROM bx LEFT JOIN r ON r.HFC_NBR = bx.HFC_NBR""",
)
def cartons_to_come(spark, folder):
    lines = order_lines(spark, folder)
    boxes = _boxes(spark, folder)
    cartons = purchase_orders.cartons_to_come(
        po_details(lines),
        po_headers(spark, folder),
        _short_over(spark, folder),
        boxes,
        seasons=("SP-96", "FA-96", "SP-97", "FA-97", "SP-99", "FA-00"),
        excluded_div=3,
    )
    return purchase_orders.with_cartons_to_come(boxes, cartons)


def _counts(spark, folder):
    """Inventory extract: shipped less twice the returned pieces by size."""
    qty = F.col("l_quantity").cast("long")
    signed = F.when(F.col("l_returnflag") == "R", -2 * qty).when(F.col("l_linestatus") == "F", qty).otherwise(0)
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum(qty).cast("int").alias("OH"),
            *[F.sum(F.when(F.col("l_linenumber") == i, signed).otherwise(0)).alias(f"S{i}") for i in EIGHT],
        )
        .select(
            digits("l_partkey").alias("STYLE"),
            F.concat(F.lit("C"), digits("l_suppkey")).alias("COLOR_DESC"),
            digits("l_suppkey").alias("COLOR_CODE"),
            "OH",
            *buckets(),
        )
    )


_COUNTS = f"""iv AS (SELECT {z('l_partkey', 6)} AS STYLE, {z('l_suppkey', 3)} AS COLOR_CODE, 'C' || l_suppkey AS COLOR_DESC,
    CAST(sum(l_quantity) AS BIGINT) AS OH,
    {_listed("CAST(sum(CASE WHEN l_linenumber <> # THEN 0 WHEN l_returnflag = 'R' THEN -2 * l_quantity WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS S#")}
  FROM lineitem GROUP BY l_partkey, l_suppkey),
  bl AS (SELECT STYLE, COLOR, {_listed('CAST(sum(BAL_S#) AS BIGINT) AS O#')} FROM st WHERE CXL = 0 GROUP BY STYLE, COLOR),
  oh AS (SELECT iv.STYLE, COLOR_CODE, COLOR_DESC, OH, {_listed('greatest(0, S# + coalesce(O#, 0)) AS OH_S#')}
    FROM iv LEFT JOIN bl ON bl.STYLE = iv.STYLE AND bl.COLOR = iv.COLOR_CODE)"""
_OLD_INV = f"""old AS (SELECT STYLE, COLOR AS COLOR_CODE, 'OLD' AS COLOR_DESC, CAST(sum(ORDERED_UNITS) AS BIGINT) AS OH,
    {_listed('CAST(sum(S#) AS BIGINT) AS OH_S#')}, 1 AS CXL FROM (SELECT * FROM ol UNION ALL
    SELECT * REPLACE ('999' AS COLOR) FROM ol) WHERE STATUS = 'F' GROUP BY STYLE, COLOR)"""


def _old_inventory(lines):
    """Stored inventory; the same styles also in a color no longer counted."""
    older = lines.filter("STATUS = 'F'")
    both = older.unionByName(older.withColumn("COLOR", F.lit("999")))
    return both.groupBy("STYLE", F.col("COLOR").alias("COLOR_CODE")).agg(
        F.first(F.lit("OLD")).alias("COLOR_DESC"),
        F.sum("ORDERED_UNITS").alias("OH"),
        *[F.sum(f"S{i}").alias(f"OH_S{i}") for i in EIGHT],
        F.first(F.lit(1)).alias("CXL"),
    )


@case(
    "q_inventory",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, _COUNTS, _OLD_INV)}
    SELECT coalesce(o.STYLE, n.STYLE) AS STYLE, coalesce(o.COLOR_CODE, n.COLOR_CODE) AS COLOR_CODE,
      coalesce(o.COLOR_DESC, n.COLOR_DESC) AS COLOR_DESC, coalesce(n.OH, 0) AS OH, {_listed('coalesce(n.OH_S#, 0) AS OH_S#')},
      CASE WHEN n.STYLE IS NULL THEN 1 ELSE 0 END AS CXL
    FROM old o FULL OUTER JOIN oh n ON n.STYLE = o.STYLE AND n.COLOR_CODE = o.COLOR_CODE""",
)
def inventory(spark, folder):
    lines = shared_lines(spark, folder)
    load = movements.load_inventory(
        _old_inventory(lines), _counts(spark, folder), stored_orders(lines)
    )
    return load.states["INV"]


@case(
    "q_inventory_check",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, _COUNTS)} SELECT 'inventory_sizes' AS check_id, STYLE || '|' || COLOR_CODE AS key,
      CAST(OH AS VARCHAR) AS expected, CAST({' + '.join(f'OH_S{i}' for i in EIGHT)} AS VARCHAR) AS actual,
      'sizes do not add up to on hand' AS reason FROM oh WHERE OH <> {' + '.join(f'OH_S{i}' for i in EIGHT)}""",
)
def inventory_check(spark, folder):
    lines = shared_lines(spark, folder)
    load = movements.load_inventory(
        _old_inventory(lines), _counts(spark, folder), stored_orders(lines)
    )
    return load.exceptions


@case("q_exception_report", ORACLES["q_inventory_check"])
def exception_report(spark, folder):
    """The exceptions of a load, written as a report and read back."""
    reports = scratch(spark, "reports")
    write_exceptions(inventory_check(spark, folder), reports, "inventory_sizes")
    return spark.read.parquet(f"{reports}/inventory_sizes")


@case(
    "q_load_assoc",
    f"""{with_clause(ORDER_LINES)},
    t AS (SELECT {KEY}, '0000AA' AS HFC, {season_sql('START_SHIP')} AS SEASON, 0 AS CXL FROM ol WHERE STATUS <> 'O'),
    s AS (SELECT {KEY}, CASE WHEN STATUS = 'P' THEN CUST_PO ELSE '' END AS HFC, SEASON FROM ol WHERE STATUS <> 'F' AND SEASON IN ('SP-99', 'FA-99')),
    m AS (SELECT coalesce(t.GREEN_BAR, s.GREEN_BAR) AS GREEN_BAR, coalesce(t.STYLE, s.STYLE) AS STYLE, coalesce(t.COLOR, s.COLOR) AS COLOR,
      coalesce(s.HFC, t.HFC) AS HFC, coalesce(s.SEASON, t.SEASON) AS SEASON,
      CASE WHEN s.HFC IS NULL AND t.SEASON IN ('SP-99', 'FA-99') THEN 1 ELSE 0 END AS CXL
      FROM t FULL OUTER JOIN s ON t.GREEN_BAR = s.GREEN_BAR AND t.STYLE = s.STYLE AND t.COLOR = s.COLOR)
    SELECT {KEY}, CASE WHEN COLOR = '003' THEN '197218' ELSE HFC END AS HFC, SEASON, CASE WHEN COLOR = '004' THEN 0 ELSE CXL END AS CXL FROM m""",
)
def load_assoc(spark, folder):
    fixes = [({"COLOR": "003"}, {"HFC": "197218"}), ({"COLOR": "004"}, {"CXL": 0})]
    return _load_assoc(spark, folder, F.concat(F.lower("SEASON"), F.lit(" ASSOC.csv")), 3, fixes)


def _load_assoc(spark, folder, file, generation, fixes=()):
    lines = shared_lines(spark, folder)
    state = lines.filter("STATUS <> 'O'").select(
        "GREEN_BAR", "STYLE", "COLOR", F.lit("0000AA").alias("HFC"),
        season_of(F.col("START_SHIP")).alias("SEASON"), F.lit(0).alias("CXL"),
    )
    ref = F.when(F.col("STATUS") == "P", F.concat(F.col("CUST_PO"), F.lit("-1"))).otherwise("longer than six-2")
    feed = lines.filter("STATUS <> 'F' AND SEASON IN ('SP-99', 'FA-99')").select(
        "GREEN_BAR", "STYLE", "COLOR", ref.alias("HFC"), file.alias("FILE")
    )
    links = movements.clean_assoc(feed, generation)
    return movements.load_assoc(state, links, generation, corrections=fixes).states["HFC_ASSOC"]


_OLDER_ASSOC = f"""{with_clause(ORDER_LINES)},
    t AS (SELECT {KEY}, '0000AA' AS HFC, {season_sql('START_SHIP')} AS SEASON FROM ol WHERE STATUS <> 'O'),
    s AS (SELECT {KEY}, CASE WHEN STATUS = 'P' THEN CUST_PO ELSE 'longer than six' END AS HFC, SEASON FROM ol
      WHERE STATUS <> 'F' AND SEASON IN ('SP-99', 'FA-99'))
    SELECT coalesce(t.GREEN_BAR, s.GREEN_BAR) AS GREEN_BAR, coalesce(t.STYLE, s.STYLE) AS STYLE, coalesce(t.COLOR, s.COLOR) AS COLOR,
      coalesce(s.HFC, t.HFC) AS HFC, coalesce(s.SEASON, t.SEASON) AS SEASON, CASE WHEN s.HFC IS NULL THEN 1 ELSE 0 END AS CXL
    FROM t FULL OUTER JOIN s ON t.GREEN_BAR = s.GREEN_BAR AND t.STYLE = s.STYLE AND t.COLOR = s.COLOR"""


@case("q_load_assoc_gen1", _OLDER_ASSOC)
def load_assoc_gen1(spark, folder):
    name = F.concat(F.lit("SOURCE_HFC_ASSOC_"), F.col("SEASON"), F.lit(".csv"))
    return _load_assoc(spark, folder, name, 1)


@case("q_load_assoc_gen2", _OLDER_ASSOC)
def load_assoc_gen2(spark, folder):
    return _load_assoc(spark, folder, F.concat(F.lower("SEASON"), F.lit(" ASSOC.csv")), 2)


_STYLE_FEED = """f AS (
    SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS STYLE, upper(p_name) || ' ' || (CASE p_size % 4 WHEN 0 THEN 'KS' WHEN 1 THEN 'KL'
        WHEN 2 THEN 'WS' ELSE 'XX' END) || ' ' || p_type AS descr, p_size,
      CASE WHEN p_size % 2 = 0 THEN 'SP-' ELSE 'FA-' END || lpad(CAST(p_size AS VARCHAR), 2, '0') AS SEASON, p_retailprice AS SP, p_brand,
      CASE p_brand WHEN 'Brand#1' THEN 'K' WHEN 'Brand#2' THEN 'W' ELSE '' END AS cat2,
      CASE p_brand WHEN 'Brand#3' THEN 'L/S' ELSE '' END AS slv2, CASE p_type WHEN 'ECONOMY' THEN 'MICROFIBER' ELSE '' END AS grp
    FROM part),
  c AS (SELECT *, CASE WHEN contains(descr, ' KS ') OR contains(descr, ' KL ') THEN 'K' WHEN contains(descr, ' WS ') THEN 'W' ELSE '' END AS cat1,
      CASE WHEN contains(descr, ' KL ') THEN 'L/S' WHEN contains(descr, ' WS ') OR contains(descr, ' KS ') THEN 'S/S' ELSE '' END AS slv1 FROM f),
  g AS (SELECT *, CASE WHEN cat2 <> '' THEN cat2 ELSE cat1 END AS CAT, CASE WHEN slv2 <> '' THEN slv2 ELSE slv1 END AS SLV FROM c)"""


def _styles(spark, folder):
    parts = table(spark, folder, "part")
    mark = F.element_at(F.array(*[F.lit(m) for m in ("KS", "KL", "WS", "XX")]), F.col("p_size") % 4 + 1)
    feed = parts.select(
        digits("p_partkey").alias("STYLE"),
        F.concat_ws(" ", F.upper("p_name"), mark, "p_type").alias("STYLE_DESC"),
        F.lit(None).cast("string").alias("PROTO"),
        F.lit("R1").alias("SIZE_RANGE"),
        F.when(F.col("p_size") % 2 == 0, "s").otherwise("F").alias("OPEN_SSN"),
        F.concat(F.lit("20"), F.lpad(digits("p_size"), 2, "0")).alias("OPEN_YR"),
        F.lit(1).alias("DIV"),
        F.lit("L").alias("LABEL"),
        F.col("p_retailprice").alias("SP"),
        F.lit(1.0).alias("ELC"),
        F.lit(1.0).alias("ILC"),
        F.col("p_brand").alias("BRAND_NAME"),
        F.col("p_type").alias("FABRIC"),
        F.lit(0.0).alias("RESERVE"),
        F.lit(0.0).alias("ROYALTY"),
        F.lit("N").alias("PPK"),
    )
    brand = F.col("p_brand")
    manual = parts.filter(brand.isin("Brand#1", "Brand#2", "Brand#3") | (F.col("p_type") == "ECONOMY")).select(
        digits("p_partkey").alias("STYLE"),
        F.when(brand == "Brand#1", "K").when(brand == "Brand#2", "W").alias("CAT_2"),
        F.when(brand == "Brand#3", "L/S").alias("SLV_2"),
        F.when(F.col("p_type") == "ECONOMY", "MICROFIBER").alias("INV_GROUP"),
        F.lit("BM").alias("BUY_GROUP_MAIN"),
        F.lit(None).cast("string").alias("BUY_GROUP_SUB"),
        F.lit("REG").alias("SIZE"),
    )
    # the stored styles: suppliers' numbers, most of which are styles too
    old = table(spark, folder, "customer").select(
        text.zfill(digits(F.col("c_custkey") * 2), 6).alias("STYLE"), F.lit("old").alias("STYLE_DESC"), F.lit(0).alias("CXL")
    )
    return conform(old, schemas.TABLES["STYLE_MASTER"]), feed, manual


@case(
    "q_load_styles",
    f"""WITH {_STYLE_FEED}, o AS (SELECT lpad(CAST(c_custkey * 2 AS VARCHAR), 6, '0') AS STYLE FROM customer)
    SELECT coalesce(o.STYLE, g.STYLE) AS STYLE, coalesce(descr, 'old') AS STYLE_DESC, CAT, SLV, SEASON, SP, grp AS INV_GROUP,
      CASE WHEN g.STYLE IS NULL THEN NULL WHEN grp = 'MICROFIBER' THEN 'MICROFIBER' WHEN CAT = 'K' THEN 'OTHER KNITS' WHEN CAT = 'W' THEN 'OTHER WOVEN' ELSE '' END AS RM_GROUP,
      CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') OR grp <> '' THEN 'REG' END AS REG_BT,
      CASE WHEN g.STYLE IS NULL THEN 1 ELSE 0 END AS CXL FROM o FULL OUTER JOIN g ON o.STYLE = g.STYLE""",
)
def load_styles(spark, folder):
    new = dimensions.load_styles(*_styles(spark, folder)).states["STYLE_MASTER"]
    return new.select(
        "STYLE", "STYLE_DESC", "CAT", "SLV", "SEASON", "SP", "INV_GROUP", "RM_GROUP", "REG_BT", "CXL"
    )


@case(
    "q_style_conflicts",
    f"""WITH {_STYLE_FEED} SELECT 'style_cat' AS check_id, STYLE AS key, cat2 AS expected, cat1 AS actual,
      'manual list and description disagree' AS reason FROM c WHERE cat1 <> '' AND cat2 <> '' AND cat1 <> cat2
    UNION ALL SELECT 'style_slv', STYLE, slv2, slv1, 'manual list and description disagree' FROM c WHERE slv1 <> '' AND slv2 <> '' AND slv1 <> slv2""",
)
def style_conflicts(spark, folder):
    return dimensions.load_styles(*_styles(spark, folder)).exceptions


@case(
    "q_load_po_headers",
    f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem),
    s AS (SELECT {z('l_orderkey', 6)} AS HFC, {season_sql('o_orderdate')} AS SSN, CAST(o_orderdate AS DATE) AS d, {z('o_custkey', 5)} AS cust,
      CAST(l_quantity AS INTEGER) AS cs, {z('l_linenumber', 2)} AS sc, o_orderstatus AS st FROM f JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1),
    sc AS (SELECT {z('p_size', 2)} AS code, p_size AS ttl FROM part GROUP BY p_size),
    src AS (SELECT HFC, SSN, d, cust, cs, CASE WHEN sc <> '00' AND (ttl IS NULL OR cs <> ttl) THEN 'Z9' ELSE sc END AS sc FROM s LEFT JOIN sc ON sc = code
      WHERE st <> 'F' AND d >= DATE '1998-01-01'),
    t AS (SELECT {z('o_orderkey', 6)} AS HFC_NBR, {season_sql('o_orderdate')} AS SEASON, {z('o_custkey', 5)} AS CUST_NBR FROM orders WHERE o_orderstatus <> 'O'),
    mk AS (SELECT {z('o_orderkey', 6)} AS h, 'M' || o_custkey AS mk, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS ec FROM orders WHERE o_orderpriority = '1-URGENT'),
    m AS (SELECT coalesce(HFC_NBR, HFC) AS HFC_NBR, d AS SHIP_DATE, coalesce(SSN, SEASON) AS SEASON, coalesce(cust, CUST_NBR) AS CUST_NBR, cs AS CARTON_SIZE,
      sc AS HFC_SIZE_SCALE_CODE, CASE WHEN HFC IS NULL AND SEASON IN (SELECT SSN FROM src) THEN 1 ELSE 0 END AS CXL FROM t FULL OUTER JOIN src ON HFC_NBR = HFC)
    SELECT m.*, mk AS MAKER, ec AS IS_ECOM FROM m LEFT JOIN mk ON h = HFC_NBR""",
)
def load_po_headers(spark, folder):
    """Lines as buy-summary rows: several per order, the first one counts."""
    od = table(spark, folder, "orders")
    us = F.date_format("o_orderdate", "M/d/yyyy")
    raw = (
        table(spark, folder, "lineitem")
        .join(od.filter(F.to_date("o_orderdate") >= "1998-01-01"), F.col("l_orderkey") == F.col("o_orderkey"))
        .filter("o_orderstatus <> 'F'")
        .select(
            F.lit(1).alias("DIV"),
            digits("o_custkey").alias("CUST_NBR"),
            season_of(F.to_date("o_orderdate")).alias("SSN"),
            digits("o_orderkey").alias("HFC"),
            us.alias("X_ORIENT"),
            us.alias("X_SHIP"),
            F.lit("K").alias("CAT"),
            F.lit("A").alias("AGENT"),
            F.lit("CN").alias("COO"),
            F.col("l_quantity").cast("int").alias("CARTON_SIZE"),
            digits("l_linenumber").alias("HFC_SIZE_SCALE"),
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        )
    )
    headers = purchase_orders.clean_headers(raw, ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    scales = table(spark, folder, "part").groupBy("p_size").agg(F.max("p_size").alias("TTL_QTY")).select(
        text.zfill(digits("p_size"), 2).alias("SIZE_SCALE_CODE"), "TTL_QTY"
    )
    state = od.filter("o_orderstatus <> 'O'").select(
        text.zfill(digits("o_orderkey"), 6).alias("HFC_NBR"),
        season_of(F.to_date("o_orderdate")).alias("SEASON"),
        text.zfill(digits("o_custkey"), 5).alias("CUST_NBR"),
        F.lit(0).alias("CXL"),
    )
    maker = od.filter("o_orderpriority = '1-URGENT'").select(
        digits("o_orderkey").alias("HFC"),
        F.concat(F.lit("M"), digits("o_custkey")).alias("MAKER"),
        F.when(F.col("o_orderstatus") != "P", 1).alias("ECOM"),
    )
    new = purchase_orders.load_po_headers(
        conform(state, schemas.TABLES["HFC_HEADER"]), headers, scales, maker
    ).states["HFC_HEADER"]
    return new.select(
        "HFC_NBR", "SHIP_DATE", "SEASON", "CUST_NBR", "CARTON_SIZE", "HFC_SIZE_SCALE_CODE", "CXL", "MAKER", "IS_ECOM"
    )


_PO_COLUMNS = ["GREEN_BAR", "STYLE", "COLOR", "DIV", "ORDER_DATE", "SEASON", "ORDERED_UNITS", "PICK_UNITS", "BAL", *buckets(), "STATUS", "STORED"]


@case(
    "q_load_po_lines",
    f"""{with_clause(ORDER_LINES, PO_DETAILS, PO_HEADERS)},
    t AS (SELECT pd.* FROM pd JOIN ol ON HFC_NBR = GREEN_BAR AND pd.STYLE = ol.STYLE AND COLOR_CODE = COLOR WHERE STATUS <> 'O'),
    s AS (SELECT GREEN_BAR, STYLE, COLOR, 'NAVY ' || COLOR AS d, ORDERED_UNITS AS u, SEASON FROM ol WHERE STATUS <> 'F' AND ORDER_DATE >= DATE '1998-01-01'),
    m AS (SELECT coalesce(t.HFC_NBR, GREEN_BAR) AS HFC_NBR, coalesce(t.STYLE, s.STYLE) AS STYLE, coalesce(COLOR_CODE, COLOR) AS COLOR_CODE, d AS COLOR_DESC,
      coalesce(u, TTL_QTY) AS TTL_QTY, CASE WHEN u IS NOT NULL THEN 0 WHEN h.SEASON IN (SELECT SEASON FROM s) THEN 1 ELSE t.CXL END AS CXL, {_listed('S#_QTY')}
      FROM t LEFT JOIN ph h ON h.HFC_NBR = t.HFC_NBR FULL OUTER JOIN s ON t.HFC_NBR = GREEN_BAR AND t.STYLE = s.STYLE AND COLOR_CODE = COLOR)
    SELECT m.HFC_NBR, m.STYLE, COLOR_CODE, COLOR_DESC, TTL_QTY, m.CXL, {_listed('CASE WHEN b.GREEN_BAR IS NOT NULL THEN b.S# + 1 ELSE S#_QTY END AS S#_QTY')}
    FROM m LEFT JOIN ol b ON b.DIV = 2 AND b.GREEN_BAR = HFC_NBR AND b.STYLE = m.STYLE AND b.COLOR = COLOR_CODE""",
)
def load_po_lines(spark, folder):
    lines = shared_lines(spark, folder, *_PO_COLUMNS)
    state = po_details(lines.filter("STORED").na.drop(subset=["STYLE", "COLOR"]))
    raw = feed_orders(lines).select(
        F.col("SEASON").alias("SSN"),
        F.col("GREEN_BAR").alias("HFC"),
        digits(F.col("STYLE").cast("long")).alias("STYLE"),
        F.lit(None).cast("string").alias("ASST"),
        F.concat_ws("-", digits(F.col("COLOR").cast("long")), F.concat(F.lit("NAVY "), "COLOR"), F.lit("X")).alias("COLOR"),
        *[F.lit(1.0).alias(c) for c in ("FOB", "ELC", "SP", "MSRP")],
        F.col("ORDERED_UNITS").alias("UNITS"),
        F.lit("1").alias("HFC_LINE_SIZE_SCALE"),
    )
    feed = purchase_orders.clean_lines(raw)
    loaded = purchase_orders.load_po_lines(
        conform(state, schemas.TABLES["HFC_DETAIL"]), feed, po_headers(spark, folder), seasons=stage(scope_values(feed, "SSN"))
    ).states["HFC_DETAIL"]
    breaks = lines.select(
        F.concat(F.when(F.col("DIV") == 2, "HFC").otherwise("ORD"), F.col("GREEN_BAR")).alias("HFC"),
        F.col("STYLE"),
        "COLOR",
        *[(F.col(b) + 1).alias(b) for b in buckets()],
    )
    new = purchase_orders.load_size_breaks(loaded, purchase_orders.clean_size_breaks(breaks)).states["HFC_DETAIL"]
    return new.select("HFC_NBR", "STYLE", "COLOR_CODE", "COLOR_DESC", "TTL_QTY", "CXL", *buckets("S", "_QTY"))


@case(
    "q_load_short_over",
    f"""WITH {_SHORT}, t AS (SELECT HFC, STYLE, COLOR, 0 AS DIFF FROM (SELECT DISTINCT {z('l_orderkey', 6)} AS HFC, {z('l_partkey', 6)} AS STYLE,
      {z('l_suppkey', 3)} AS COLOR FROM lineitem WHERE l_linestatus = 'F'))
    SELECT coalesce(t.HFC, so.HFC) AS HFC, coalesce(t.STYLE, so.STYLE) AS STYLE, coalesce(t.COLOR, so.COLOR) AS COLOR, coalesce(so.DIFF, t.DIFF) AS DIFF
    FROM t FULL OUTER JOIN so ON t.HFC = so.HFC AND t.STYLE = so.STYLE AND t.COLOR = so.COLOR""",
)
def load_short_over(spark, folder):
    state = (
        table(spark, folder, "lineitem")
        .filter("l_linestatus = 'F'")
        .select(
            text.zfill(digits("l_orderkey"), 6).alias("HFC"),
            text.zfill(digits("l_partkey"), 6).alias("STYLE"),
            text.zfill(digits("l_suppkey"), 3).alias("COLOR"),
            F.lit(0).alias("DIFF"),
        )
        .distinct()
    )
    feed = _short_over(spark, folder).select(
        digits(F.col("HFC").cast("long")).alias("PO"), digits(F.col("STYLE").cast("long")).alias("STYLE"), "COLOR", "DIFF"
    )
    return purchase_orders.load_short_over(state, feed).states["SHORT_OVER"]


_RECEIPTS = f"""rc AS (SELECT {z('l_orderkey', 6)} AS HFC, {z('l_partkey', 6)} AS STYLE, {z('l_suppkey', 3)} AS COLOR,
    CAST(sum(l_quantity) AS BIGINT) AS u, CAST(max(l_shipdate) AS DATE) AS d, max(l_returnflag) AS fl FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey)"""


@case(
    "q_load_receiving",
    f"""WITH {_RECEIPTS} SELECT HFC AS CTRL_NBR, HFC AS HFC_NBR, STYLE, COLOR, 'BOX' AS CONTAINER_NBR,
      CASE WHEN fl = 'R' THEN DATE '1990-01-01' ELSE d END AS REC_DATE, CASE WHEN fl = 'R' THEN 0 ELSE u END AS REC_UNITS,
      CASE WHEN fl <> 'R' THEN u END AS REC_S1, CASE WHEN fl <> 'R' THEN 'I' || HFC END AS INVOICE_NBR FROM rc WHERE fl <> 'N'
    UNION ALL SELECT HFC, HFC, STYLE, COLOR, 'BOX', d, u, u, 'I' || HFC FROM rc WHERE fl = 'N'""",
)
def load_receiving(spark, folder):
    """Stored receipts of marked lines; the feed lacks the returned ones' number."""
    state, receipts = _receipts(spark, folder)
    order = text.zfill(digits("l_orderkey"), 6)
    raw = receipts.select(
        F.when(F.col("fl") != "R", order).alias("CTRL_NBR"),
        digits("l_orderkey").alias("HFC"), digits("l_partkey").alias("STYLE"), digits("l_suppkey").alias("COLOR"),
        F.col("u").alias("REC_UNITS"), *[F.col("u").alias(b) for b in buckets()],
        F.lit("BOX").alias("CONTAINER_NBR"), F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("REC_DATE"),
        F.concat(F.lit("I"), order).alias("INVOICE_NBR"),
    )
    new = movements.load_receiving(state, movements.clean_receiving(raw)).states["RECEIVING"]
    return new.select(
        "CTRL_NBR", "HFC_NBR", "STYLE", "COLOR", "CONTAINER_NBR", "REC_DATE", "REC_UNITS", "REC_S1", "INVOICE_NBR"
    )


def _receipts(spark, folder):
    """(stored receipts, lines as receipts)"""
    receipts = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_partkey", "l_suppkey")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("u"),
            F.max("l_shipdate").alias("d"),
            F.max("l_returnflag").alias("fl"),
        )
    )
    order = text.zfill(digits("l_orderkey"), 6)
    state = receipts.filter("fl <> 'N'").select(
        order.alias("CTRL_NBR"), order.alias("HFC_NBR"),
        text.zfill(digits("l_partkey"), 6).alias("STYLE"), text.zfill(digits("l_suppkey"), 3).alias("COLOR"),
        F.lit("BOX").alias("CONTAINER_NBR"), F.lit("1990-01-01").cast("date").alias("REC_DATE"), F.lit(0).alias("REC_UNITS"),
    )
    return conform(state, schemas.TABLES["RECEIVING"]), receipts


@case(
    "q_load_receiving_gen1",
    f"""WITH {_RECEIPTS} SELECT HFC AS CTRL_NBR, HFC AS HFC_NBR, STYLE, COLOR, CASE WHEN fl <> 'N' THEN 'BOX' END AS CONTAINER_NBR,
      CASE WHEN fl <> 'R' THEN STYLE END AS REC_NBR, CASE WHEN fl = 'R' THEN DATE '1990-01-01' ELSE d END AS REC_DATE,
      CASE WHEN fl = 'R' THEN 0 ELSE u END AS REC_UNITS FROM rc""",
)
def load_receiving_gen1(spark, folder):
    """The older feed names no container; returned lines are not in it."""
    state, receipts = _receipts(spark, folder)
    style = digits("l_partkey")
    raw = receipts.filter("fl <> 'R'").select(
        text.zfill(digits("l_orderkey"), 6).alias("CTRL_NBR"), style.alias("REC_NBR"),
        F.date_format("d", "M/d/yyyy").alias("REC_DATE"), digits("l_orderkey").alias("HFC"),
        style.alias("STYLE"), digits("l_suppkey").alias("COLOR"), F.col("u").alias("REC_UNITS"),
    )
    new = movements.load_receiving(state, movements.clean_receiving(raw, 1), 1).states["RECEIVING"]
    return new.select(
        "CTRL_NBR", "HFC_NBR", "STYLE", "COLOR", "CONTAINER_NBR", "REC_NBR", "REC_DATE", "REC_UNITS"
    )


@case(
    "q_load_customers",
    f"""WITH t AS (SELECT {z('o_custkey', 5)} AS CUST_NBR, 'old' AS CUST_NAME FROM orders GROUP BY o_custkey),
    s AS (SELECT {z('c_custkey', 5)} AS n, c_name, c_acctbal FROM customer)
    SELECT coalesce(CUST_NBR, n) AS CUST_NBR, coalesce(c_name, CUST_NAME) AS CUST_NAME, c_acctbal AS AD_PCT, CAST(NULL AS DOUBLE) AS LOAD_PCT
    FROM t FULL OUTER JOIN s ON CUST_NBR = n""",
)
def load_customers(spark, folder):
    old = table(spark, folder, "orders").select(text.zfill(digits("o_custkey"), 5).alias("CUST_NBR")).distinct()
    feed = table(spark, folder, "customer").select(
        digits("c_custkey").alias("CUST_NBR"), F.col("c_name").alias("CUST_NAME"), F.col("c_acctbal").alias("AD"), F.lit(None).cast("double").alias("LOAD")
    )
    state = conform(old.withColumn("CUST_NAME", F.lit("old")), schemas.TABLES["CUSTOMER"])
    return dimensions.load_customers(state, feed).states["CUSTOMER"]


@case(
    "q_load_size_ranges",
    """SELECT p_brand AS SIZE_RANGE_CODE, max(CASE WHEN p_size > 25 THEN p_type ELSE '' END) AS S1, max(p_type) AS S2, min(p_name) AS S3,
      '' AS S4, '' AS S5, '' AS S6, '' AS S7, '' AS S8 FROM part GROUP BY p_brand""",
)
def load_size_ranges(spark, folder):
    parts = table(spark, folder, "part")
    blank = [F.first(F.lit(None).cast("string")).alias(f"s{i}") for i in range(4, 9)]
    feed = parts.groupBy("p_brand").agg(
        F.max(F.when(F.col("p_size") > 25, F.col("p_type"))).alias("a"), F.max("p_type").alias("b"), F.min("p_name").alias("c"), *blank
    )
    old = parts.filter("p_type = 'SMALL'").select(F.col("p_brand").alias("SIZE_RANGE_CODE"), F.lit("x").alias("S1")).distinct()
    return dimensions.load_size_ranges(conform(old, schemas.TABLES["SIZE_RANGE"]), feed).states["SIZE_RANGE"]


@case(
    "q_load_size_scales",
    """WITH s AS (SELECT lpad(CAST(p_partkey AS VARCHAR), greatest(2, length(CAST(p_partkey AS VARCHAR)))::INTEGER, '0') AS code,
      p_size || '/S 2/M' AS descr, p_size FROM part)
    SELECT code AS SIZE_SCALE_CODE, descr AS SIZE_SCALE_DESC, 'S' AS S1_SIZE, 'M' AS S2_SIZE, 'NONE' AS S3_SIZE, p_size AS S1_QTY, 2 AS S2_QTY, 0 AS S8_QTY FROM s
    UNION ALL SELECT 'B' || code, '2/' || code, code, 'NONE', 'NONE', 2, 0, 0 FROM s WHERE p_size <> 9""",
)
def load_size_scales(spark, folder):
    parts = table(spark, folder, "part")
    key = digits("p_partkey")
    sheet = parts.select(
        F.concat(key, F.lit(".0")).alias("SCALE"),
        F.concat(digits("p_size"), F.lit("/S 2/M")).alias("DESC"),
        F.concat(F.lit("B"), text.zfill(key, 2)).alias("SCALE 2"),
        F.when(F.col("p_size") == 9, F.lit("two/S")).otherwise(F.concat(F.lit("2/"), text.zfill(key, 2))).alias("DESC 2"),
    )
    old = parts.filter("p_type = 'SMALL'").select(text.zfill(key, 2).alias("SIZE_SCALE_CODE"))
    new = dimensions.load_size_scales(conform(old, schemas.TABLES["SIZE_SCALE"]), sheet).states["SIZE_SCALE"]
    return new.select(
        "SIZE_SCALE_CODE", "SIZE_SCALE_DESC", "S1_SIZE", "S2_SIZE", "S3_SIZE", "S1_QTY", "S2_QTY", "S8_QTY"
    )


# --- quarantine along references: part sizes as size scales, orders as purchase orders, their lines

_HELD_CHAIN = f"""sc AS (SELECT k, CASE WHEN k % 7 <> 0 THEN k WHEN k <= 20 THEN 99 END AS ttl FROM (SELECT DISTINCT p_size AS k FROM part)),
    fo AS (SELECT o_orderkey AS ok, {z('o_orderkey', 6)} AS HFC, {season_sql('o_orderdate')} AS SSN, o_orderstatus AS st, o_custkey % 50 + 1 AS k,
      o_custkey % 50 + 1 + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS cs FROM orders),
    hd AS (SELECT HFC, fo.k % 7 = 0 AS by_scale, ttl IS NULL OR cs <> ttl AS by_carton FROM fo LEFT JOIN sc ON sc.k = fo.k
      WHERE st <> 'F' AND (fo.k % 7 = 0 OR ttl IS NULL OR cs <> ttl)),
    ss AS (SELECT DISTINCT SSN FROM fo WHERE st <> 'F')"""


def _scale_sheet(spark, folder):
    """(stored scales, sheet): every seventh description cannot be read."""
    sizes = table(spark, folder, "part").select("p_size").distinct()
    unreadable = F.col("p_size") % 7 == 0
    sheet = sizes.select(
        digits("p_size").alias("SCALE"), F.when(unreadable, "some/S").otherwise(F.concat(digits("p_size"), F.lit("/S"))).alias("DESC")
    )
    stored = sizes.filter("p_size <= 20").select(
        text.zfill(digits("p_size"), 2).alias("SIZE_SCALE_CODE"), F.lit("99/S").alias("SIZE_SCALE_DESC"), F.lit(99).alias("S1_QTY")
    )
    return conform(stored, schemas.TABLES["SIZE_SCALE"]), sheet


def _buy_orders(spark, folder):
    """(stored headers, headers of the feed)"""
    od = table(spark, folder, "orders").withColumns(
        {
            "HFC": text.zfill(digits("o_orderkey"), 6),
            "SSN": season_of(F.to_date("o_orderdate")),
            "HFC_SIZE_SCALE": text.zfill(digits(F.col("o_custkey") % 50 + 1), 2),
            "CARTON_SIZE": (F.col("o_custkey") % 50 + 1 + F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).cast("int"),
        }
    )
    feed = od.filter("o_orderstatus <> 'F'").select(
        "HFC", "SSN", "HFC_SIZE_SCALE", "CARTON_SIZE", F.lit(1).alias("DIV"), F.lit("00001").alias("CUST_NBR"),
        *[F.lit(None).cast("date").alias(c) for c in ("X_SHIP", "X_ORIENT")], *[F.lit("x").alias(c) for c in ("AGENT", "COO", "CAT")],
    )
    stored = od.filter("o_orderstatus <> 'O'").select(
        F.col("HFC").alias("HFC_NBR"), F.col("SSN").alias("SEASON"), F.lit(0).alias("CARTON_SIZE"), F.lit("OL").alias("HFC_SIZE_SCALE_CODE"), F.lit(0).alias("CXL")
    )
    return conform(stored, schemas.TABLES["HFC_HEADER"]), feed


def _buy_lines(spark, folder):
    """(stored lines, lines of the feed)"""
    units = F.sum(F.col("l_quantity").cast("long")).alias("UNITS")
    sums = table(spark, folder, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(units)
    # stored lines, feed, seasons and held lines read this: written once
    lines = stage(sums.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        text.zfill(digits("l_orderkey"), 6).alias("HFC"), text.zfill(digits("l_partkey"), 6).alias("STYLE"), digits("l_suppkey").alias("COLOR"),
        "UNITS", season_of(F.to_date("o_orderdate")).alias("SSN"), "o_orderstatus",
    ))
    feed = lines.filter("o_orderstatus <> 'F'").select(
        "HFC", "STYLE", "COLOR", "UNITS", "SSN", *[F.lit("x").alias(c) for c in ("COLOR_DESC", "HFC_LINE_SIZE_SCALE", "ASST")],
        *[F.lit(1.0).alias(c) for c in ("FOB", "ELC", "SP", "MSRP")],
    )
    stored = lines.filter("o_orderstatus <> 'O'").select(
        F.col("HFC").alias("HFC_NBR"), "STYLE", F.col("COLOR").alias("COLOR_CODE"), F.lit(0).alias("TTL_QTY"), F.lit(0).alias("CXL")
    )
    return conform(stored, schemas.TABLES["HFC_DETAIL"]), feed


def _held_headers(spark, folder, store):
    """Publish scales, then headers, under quarantine; the load of the headers."""
    scales = dimensions.load_size_scales(*_scale_sheet(spark, folder))
    commit(store, scales, "quarantine")
    totals = dimensions.scale_totals(store.read("SIZE_SCALE"))
    headers = purchase_orders.load_po_headers(*_buy_orders(spark, folder), totals, held_scales=quarantined(scales))
    commit(store, headers, "quarantine")
    return headers


@case(
    "q_header_quarantine",
    f"""WITH {_HELD_CHAIN}, t AS (SELECT HFC, SSN FROM fo WHERE st <> 'O'), n AS (SELECT * FROM fo WHERE st <> 'F' AND HFC NOT IN (SELECT HFC FROM hd))
    SELECT coalesce(t.HFC, n.HFC) AS HFC_NBR, coalesce(n.SSN, t.SSN) AS SEASON, coalesce(cs, 0) AS CARTON_SIZE,
      coalesce(lpad(CAST(k AS VARCHAR), 2, '0'), 'OL') AS HFC_SIZE_SCALE_CODE,
      CASE WHEN n.HFC IS NULL AND t.SSN IN (SELECT SSN FROM ss) AND t.HFC NOT IN (SELECT HFC FROM hd) THEN 1 ELSE 0 END AS CXL
    FROM t FULL OUTER JOIN n ON t.HFC = n.HFC""",
)
def header_quarantine(spark, folder):
    """Orders published without those whose carton or scale is reported; these stay as stored."""
    store = Warehouse(spark, scratch(spark, "store"))
    _held_headers(spark, folder, store)
    return store.read("HFC_HEADER").select("HFC_NBR", "SEASON", "CARTON_SIZE", "HFC_SIZE_SCALE_CODE", "CXL")


@case(
    "q_line_quarantine",
    f"""WITH {_HELD_CHAIN}, ln AS (SELECT HFC, SSN, st, {z('l_partkey', 6)} AS STYLE, CAST(l_suppkey AS VARCHAR) AS COLOR, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS u
      FROM lineitem JOIN fo ON ok = l_orderkey GROUP BY HFC, SSN, st, l_partkey, l_suppkey),
    t AS (SELECT * FROM ln WHERE st <> 'O'), n AS (SELECT * FROM ln WHERE st <> 'F' AND HFC NOT IN (SELECT HFC FROM hd)),
    ls AS (SELECT DISTINCT SSN FROM ln WHERE st <> 'F')
    SELECT coalesce(t.HFC, n.HFC) AS HFC_NBR, coalesce(t.STYLE, n.STYLE) AS STYLE, coalesce(t.COLOR, n.COLOR) AS COLOR_CODE, coalesce(n.u, 0) AS TTL_QTY,
      CASE WHEN n.u IS NULL AND t.SSN IN (SELECT SSN FROM ls) AND t.HFC NOT IN (SELECT HFC FROM hd) THEN 1 ELSE 0 END AS CXL
    FROM t FULL OUTER JOIN n ON t.HFC = n.HFC AND t.STYLE = n.STYLE AND t.COLOR = n.COLOR""",
)
def line_quarantine(spark, folder):
    """Lines published without those of orders that are held back themselves."""
    store = Warehouse(spark, scratch(spark, "store"))
    headers = _held_headers(spark, folder, store)
    seasons = store.read("HFC_HEADER").select("HFC_NBR", "SEASON")
    stored, feed = _buy_lines(spark, folder)
    lines = purchase_orders.load_po_lines(stored, feed, seasons, held=quarantined(headers), seasons=stage(scope_values(feed, "SSN")))
    commit(store, lines, "quarantine")
    return store.read("HFC_DETAIL").select("HFC_NBR", "STYLE", "COLOR_CODE", "TTL_QTY", "CXL")


@case(
    "q_held_reports",
    f"""WITH {_HELD_CHAIN} SELECT check_id, count(*) AS n FROM (
      SELECT 'size_scale_text' AS check_id FROM sc WHERE k % 7 = 0
      UNION ALL SELECT 'prepack_carton' FROM hd WHERE by_carton UNION ALL SELECT 'scale_held' FROM hd JOIN fo ON fo.HFC = hd.HFC JOIN sc ON sc.k = fo.k WHERE by_scale
      UNION ALL SELECT 'held_back' FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem) JOIN fo ON ok = l_orderkey WHERE HFC IN (SELECT HFC FROM hd)) GROUP BY check_id""",
)
def held_reports(spark, folder):
    """What the loads along the references report."""
    scales = dimensions.load_size_scales(*_scale_sheet(spark, folder))
    totals = dimensions.scale_totals(scales.states["SIZE_SCALE"])
    headers = purchase_orders.load_po_headers(*_buy_orders(spark, folder), totals, held_scales=quarantined(scales))
    seasons = headers.states["HFC_HEADER"].select("HFC_NBR", "SEASON")
    stored, feed = _buy_lines(spark, folder)
    lines = purchase_orders.load_po_lines(stored, feed, seasons, held=quarantined(headers), seasons=stage(scope_values(feed, "SSN")))
    found = scales.exceptions.unionByName(headers.exceptions).unionByName(lines.exceptions)
    return found.groupBy("check_id").agg(F.count("*").alias("n"))
