"""Data-quality checks and control totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.amounts import money_sum, sum0
from ..operators import checks as qc
from ..operators import mutate
from ..operators.checks import all_exceptions, exception_rows
from ..operators.compare import ne_or_null
from ..plans.dimensions import season_conflicts
from ..plans.invoices import carton_differences, piece_differences
from ..plans.movements import carton_grand_total
from ..plans.purchase_orders import mark_mixed_scales, size_break_review
from . import case
from .adapters import (
    FEED_ORDERS,
    ORDER_LINES,
    PO_DETAILS,
    PO_HEADERS,
    STORED_ORDERS,
    feed_orders,
    order_lines,
    po_details,
    po_headers,
    season_of,
    season_sql,
    shared_lines,
    stored_orders,
    table,
    with_clause,
)


@case(
    "q_bad_format",
    """SELECT p_partkey, p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]{2}$')""",
)
def bad_format(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return qc.bad_format(parts, F.col("p_brand").rlike("^Brand#[0-9]{2}$"))


def _packs(spark, folder):
    """Parts as prepack orders, suppliers' brands as scales with a total."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("HFC"),
        F.when(F.col("p_type") == "SMALL", "00").otherwise(F.col("p_brand")).alias("HFC_SIZE_SCALE"),
        F.col("p_size").alias("CARTON_SIZE"),
    )
    scales = (
        table(spark, folder, "part")
        .filter("p_brand <> 'Brand#3'")
        .groupBy(F.col("p_brand").alias("SIZE_SCALE_CODE"))
        .agg(F.max("p_size").alias("TTL_QTY"))
    )
    return parts, scales


_PACKS = """p AS (SELECT p_partkey AS HFC, CASE WHEN p_type = 'SMALL' THEN '00' ELSE p_brand END AS sc, p_size FROM part),
  s AS (SELECT p_brand AS code, max(p_size) AS ttl FROM part WHERE p_brand <> 'Brand#3' GROUP BY p_brand)"""


@case(
    "q_prepack_check",
    f"""WITH {_PACKS} SELECT HFC, sc AS "HFC_SIZE_SCALE", p_size AS "CARTON_SIZE", ttl AS "TTL_QTY", p_size - ttl AS "PPK_DIFF"
    FROM p LEFT JOIN s ON sc = code WHERE sc <> '00' AND (ttl IS NULL OR p_size <> ttl)""",
)
def prepack_check(spark, folder):
    return qc.prepack_mismatch(*_packs(spark, folder))


@case(
    "q_mixed_scale",
    f"""WITH {_PACKS} SELECT HFC, CASE WHEN sc <> '00' AND (ttl IS NULL OR p_size <> ttl) THEN 'Z9' ELSE sc END AS "HFC_SIZE_SCALE",
      p_size AS "CARTON_SIZE" FROM p LEFT JOIN s ON sc = code""",
)
def mixed_scale(spark, folder):
    return mark_mixed_scales(*_packs(spark, folder))


@case(
    "q_size_break_review",
    f"""{with_clause(ORDER_LINES, PO_DETAILS, PO_HEADERS)}, a AS (
      SELECT HFC_NBR, STYLE, COLOR_CODE, TTL_QTY + CASE WHEN STYLE LIKE '%7' THEN 1 ELSE 0 END AS TTL_QTY, CXL,
        {', '.join(f'S{i}_QTY' for i in range(1, 9))} FROM pd)
    SELECT SEASON, a.HFC_NBR, STYLE, COLOR_CODE, TTL_QTY,
      CAST({' + '.join(f'sum(S{i}_QTY)' for i in range(1, 9))} AS BIGINT) AS TTL_SIZE_BREAK
    FROM a JOIN ph ON a.HFC_NBR = ph.HFC_NBR WHERE DIV <> 5 AND CUST_NBR <> '00007' AND a.CXL = 0
    GROUP BY SEASON, a.HFC_NBR, STYLE, COLOR_CODE, TTL_QTY
    HAVING TTL_QTY <> {' + '.join(f'sum(S{i}_QTY)' for i in range(1, 9))}""",
)
def size_break(spark, folder):
    lines = order_lines(spark, folder)
    wrong = F.when(F.col("STYLE").endswith("7"), 1).otherwise(0)
    details = po_details(lines).withColumn("TTL_QTY", F.col("TTL_QTY") + wrong)
    return size_break_review(details, po_headers(spark, folder), excluded_div=5, excluded_customer="00007")


@case(
    "q_season_conflict",
    f"""{with_clause(ORDER_LINES, PO_HEADERS)},
    opened AS (SELECT STYLE, max(SEASON) AS STYLE_SSN FROM ol WHERE STATUS <> 'O' GROUP BY STYLE),
    bought AS (SELECT DISTINCT STYLE, ph.SEASON AS HFC_SSN FROM ol JOIN ph ON GREEN_BAR = HFC_NBR)
    SELECT b.STYLE, HFC_SSN, STYLE_SSN FROM bought b LEFT JOIN opened o ON b.STYLE = o.STYLE
    WHERE STYLE_SSN IS NULL OR HFC_SSN <> STYLE_SSN""",
)
def season_conflict(spark, folder):
    lines = shared_lines(spark, folder)
    styles = lines.filter("STATUS <> 'O'").groupBy("STYLE").agg(F.max("SEASON").alias("SEASON"))
    return season_conflicts(styles, po_details(lines), po_headers(spark, folder))


@case(
    "q_totals_tolerance",
    """WITH t AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(24,6))) AS total, CAST(sum(l_quantity) AS BIGINT) AS pieces
      FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT o_orderkey, o_totalprice, total, pieces FROM orders LEFT JOIN t ON o_orderkey = l_orderkey)
    SELECT o_orderkey, o_totalprice, CAST(total AS DOUBLE) AS total, pieces FROM j
    WHERE abs(total - CAST(o_totalprice AS DECIMAL(24,6))) >= 0.01 OR abs(pieces - 100) >= 0.000001""",
)
def totals_tolerance(spark, folder):
    totals = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        money_sum("l_extendedprice").alias("total"), sum0(F.col("l_quantity").cast("long")).alias("pieces")
    )
    summary = table(spark, folder, "orders").select("o_orderkey", "o_totalprice").join(totals, "o_orderkey", "left")
    found = qc.totals_mismatch(
        summary.withColumn("hundred", F.lit(100)),
        [("total", "o_totalprice", "0.01"), ("pieces", "hundred", "0.000001")],
    )
    return found.select("o_orderkey", "o_totalprice", F.col("total").cast("double").alias("total"), "pieces")


def _shipped(spark, folder):
    """Lines as cartons of an (order, part) pair, at least one each."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("INVOICE_NBR"), F.col("l_partkey").alias("HFC_NBR"), F.lit(1).alias("CARTON_CTN")
    )


@case(
    "q_carton_checks",
    """WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS "INVOICE_NBR", CAST(left(o_orderpriority, 1) AS BIGINT) AS "CTNS", CAST(coalesce(n, 0) AS BIGINT) AS "CTN_SUM"
    FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE coalesce(n, 0) <> CAST(left(o_orderpriority, 1) AS BIGINT)""",
)
def carton_checks(spark, folder):
    summary = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("INVOICE_NBR"), F.left("o_orderpriority", F.lit(1)).cast("long").alias("CTNS")
    )
    return carton_differences(summary, _shipped(spark, folder))


@case(
    "q_piece_checks",
    """WITH d AS (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS pcs, count(*) AS ctn FROM lineitem GROUP BY 1, 2)
    SELECT l_partkey AS "HFC", l_orderkey AS "INVOICE_NBR", pcs AS "PCS", ctn AS "CTN_SUM", p_size AS "CARTON_SIZE",
      CAST(pcs AS DOUBLE) / p_size AS "CARTONS" FROM d LEFT JOIN part ON p_partkey = l_partkey AND p_type <> 'SMALL'
    WHERE p_size IS NULL OR CAST(pcs AS DOUBLE) / p_size <> ctn""",
)
def piece_checks(spark, folder):
    details = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("INVOICE_NBR"),
        F.col("l_partkey").alias("HFC"),
        F.col("l_quantity").cast("long").alias("PCS"),
    )
    headers = table(spark, folder, "part").select(
        F.col("p_partkey").alias("HFC_NBR"),
        F.col("p_size").alias("CARTON_SIZE"),
        F.when(F.col("p_type") == "SMALL", 1).otherwise(0).alias("CXL"),
    )
    return piece_differences(details, headers, _shipped(spark, folder))


@case(
    "q_control_totals",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS)},
    new AS (SELECT s.SEASON, s.CUST_NBR, s.BAL AS bal FROM fd s UNION ALL
      SELECT SEASON, CUST_NBR, BAL_UNITS FROM st t WHERE NOT EXISTS (SELECT 1 FROM fd s
        WHERE t.GREEN_BAR = s.GREEN_BAR AND t.STYLE = s.STYLE AND t.COLOR = s.COLOR)),
    a AS (SELECT SEASON, CUST_NBR, CAST(sum(BAL) AS BIGINT) AS "TTL_SENT" FROM fd GROUP BY 1, 2),
    b AS (SELECT SEASON, CUST_NBR, CAST(sum(bal) AS BIGINT) AS "TTL_STORED" FROM new GROUP BY 1, 2)
    SELECT a.SEASON, a.CUST_NBR, "TTL_SENT", "TTL_STORED" FROM a LEFT JOIN b ON a.SEASON = b.SEASON AND a.CUST_NBR = b.CUST_NBR
    WHERE "TTL_STORED" IS NULL OR "TTL_SENT" <> "TTL_STORED\"""",
)
def control_totals(spark, folder):
    lines = shared_lines(spark, folder)
    keys = ["GREEN_BAR", "STYLE", "COLOR"]
    feed = feed_orders(lines).select(*keys, "SEASON", "CUST_NBR", "BAL")
    state = stored_orders(lines).select(*keys, "SEASON", "CUST_NBR", F.col("BAL_UNITS").alias("BAL"))
    new = mutate.upsert(state, feed, keys, {c: c for c in ("SEASON", "CUST_NBR", "BAL")})
    return qc.control_totals(feed, new, ["SEASON", "CUST_NBR"], "BAL")


@case(
    "q_grand_total",
    "SELECT CAST(sum(l_quantity) AS BIGINT) AS CTN FROM lineitem",
)
def grand_total(spark, folder):
    cartons = table(spark, folder, "lineitem").select(F.col("l_quantity").cast("long").alias("CARTON_CTN"))
    return carton_grand_total(cartons)


@case(
    "q_exception_counts",
    """SELECT 'brand' AS check_id, count(*) AS n FROM part WHERE p_brand = 'Brand#1'
    UNION ALL SELECT 'size', count(*) FROM part WHERE p_size <> 10
    UNION ALL SELECT 'supplier', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = l_partkey)""",
)
def exception_counts(spark, folder):
    parts = table(spark, folder, "part")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("l_partkey"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    found = all_exceptions(
        [
            exception_rows(parts.filter("p_brand = 'Brand#1'"), "brand", ["p_partkey"], "brand is not sold"),
            exception_rows(
                parts.filter(ne_or_null("p_size", F.lit(10))), "size", ["p_partkey"], "size differs", F.lit(10), "p_size"
            ),
            exception_rows(
                qc.missing_reference(lines, customers, ["l_partkey"]), "supplier", ["l_orderkey", "l_partkey"], "unknown"
            ),
        ]
    )
    return found.groupBy("check_id").agg(F.count("*").alias("n"))


@case(
    "q_exception_report",
    f"""SELECT 'order_season' AS check_id, CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus AS key,
      {season_sql('o_orderdate')} AS expected, o_orderpriority AS actual, 'not in season' AS reason
    FROM orders WHERE month(o_orderdate) <= 6""",
)
def exception_report(spark, folder):
    day = F.to_date("o_orderdate")
    orders = table(spark, folder, "orders").filter(F.month("o_orderdate") <= 6)
    return exception_rows(
        orders.withColumn("season", season_of(day)),
        "order_season",
        ["o_orderkey", "o_orderstatus"],
        "not in season",
        expected="season",
        actual="o_orderpriority",
    )
