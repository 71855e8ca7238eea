"""Row shaping, joins, aggregates and readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..functions.amounts import bucket_sum, buckets, sum0
from ..operators import checks as qc
from ..operators import shape
from ..operators.compare import active_orders, in_seasons, open_kind
from ..sources import delimited, forms
from ..plans.forms import form_headers
from ..session import shared_dir
from . import case
from .adapters import (
    CUSTOMER_NAMES,
    ORDER_LINES,
    STORED_ORDERS,
    customer_names,
    digits,
    order_lines,
    season_of,
    season_sql,
    stored_orders,
    table,
    with_clause,
    z,
)


def scratch(spark, what: str) -> str:
    """A new folder in the shared folder, for feeds derived from the tables."""
    return f"{shared_dir(spark)}/feeds/{what}-{uuid.uuid4().hex}"


@case(
    "q_first_by",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def first_by(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return shape.first_by(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    )


@case(
    "q_repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS COPIES FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def repeated_keys(spark, folder):
    return qc.repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@case(
    "q_ffill",
    """SELECT user_id, event_id, last_value(v IGNORE NULLS) OVER
      (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
    FROM (SELECT *, CASE WHEN event_type IN ('error', 'view', 'signup') THEN NULL ELSE value END AS v,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back > 1""",
)
def ffill(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id",
        "event_id",
        "ts",
        F.when(~F.col("event_type").isin("error", "view", "signup"), F.col("value")).alias("carried"),
    )
    kept = shape.drop_last(events, ["user_id"], ["ts", "event_id"])
    filled = shape.carry_forward(kept, ["carried"], ["user_id"], ["ts", "event_id"], F.to_date("ts"))
    return filled.select("user_id", "event_id", "carried")


@case(
    "q_union_tagged",
    """SELECT p_partkey, p_name, 'CAT' AS "TYPE" FROM part WHERE p_type <> '' AND left(p_name, 1) <> '' AND p_type <> left(p_name, 1)
    UNION ALL SELECT p_partkey, p_name, 'SLV' FROM part WHERE p_brand = 'Brand#7' AND p_size <> 7""",
)
def union_tagged(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        "p_type",
        F.left("p_name", F.lit(1)).alias("letter"),
        F.when(F.col("p_brand") == "Brand#7", "7").otherwise("").alias("brand"),
        digits("p_size").alias("size"),
    )
    found = {
        "CAT": qc.attribute_conflict(parts, "p_type", "letter"),
        "SLV": qc.attribute_conflict(parts, "brand", "size"),
    }
    return shape.tagged_union(found).select("p_partkey", "p_name", "TYPE")


@case(
    "q_unpivot_pairs",
    """SELECT p_brand AS "SIZE_SCALE_CODE", p_type AS "DESCRIPTION" FROM part WHERE p_size > 5
    UNION ALL SELECT p_name, CAST(p_size AS VARCHAR) FROM part""",
)
def unpivot_pairs(spark, folder):
    sheet = table(spark, folder, "part").select(
        F.col("p_brand").alias("SCALE"),
        F.when(F.col("p_size") > 5, F.col("p_type")).alias("DESC"),
        F.col("p_name").alias("SCALE.1"),
        F.col("p_size").alias("DESC.1"),
    )
    return shape.unpivot_pairs(sheet)


@case(
    "q_complete_rows",
    """SELECT 'complete' AS kind, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N'
    UNION ALL SELECT 'keyless', count(*) FROM lineitem WHERE l_returnflag = 'N'""",
)
def complete_rows(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("key"), "l_quantity"
    )
    parts = {"complete": shape.require_complete(rows, ["key"]), "keyless": qc.null_key(rows, ["key"])}
    return shape.tagged_union(parts, "kind").groupBy("kind").agg(F.count("*").alias("n"))


@case(
    "q_left_enrich",
    f"""{with_clause(CUSTOMER_NAMES)} SELECT o_orderkey, CUST_NAME, CAST(coalesce(n, 0) AS BIGINT) AS n,
      CAST(coalesce(qty, 0) AS BIGINT) AS qty
    FROM orders LEFT JOIN cn ON CUST_NBR = {z('o_custkey', 5)}
    LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def left_enrich(spark, folder):
    totals = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n"), sum0(F.col("l_quantity").cast("long")).alias("qty"))
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", text.zfill(digits("o_custkey"), 5).alias("CUST_NBR")
    )
    return (
        orders.join(customer_names(spark, folder), "CUST_NBR", "left")
        .join(totals, "o_orderkey", "left")
        .select(
            "o_orderkey", "CUST_NAME", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("qty", F.lit(0)).alias("qty")
        )
    )


@case(
    "q_outer_payments",
    """WITH paid AS (SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS paid_on
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, o_orderkey, paid_on FROM customer
      FULL OUTER JOIN (SELECT o_orderkey, o.o_custkey, paid_on FROM orders o JOIN paid p ON o.o_custkey = p.o_custkey)
      ON c_custkey = o_custkey""",
)
def outer_payments(spark, folder):
    # one date per customer, copied to all of the customer's orders
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderdate")
    paid = orders.groupBy("c_custkey").agg(
        F.to_date(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))).alias("paid_on")
    )
    payments = orders.select("c_custkey", "o_orderkey").join(paid, "c_custkey", "left")
    customers = table(spark, folder, "customer").select("c_custkey")
    return customers.join(payments, "c_custkey", "full_outer").select("c_custkey", "o_orderkey", "paid_on")


@case(
    "q_semi_anti",
    """SELECT o_orderkey, 'with lines' AS kind FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL SELECT o_orderkey, 'no lines' FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL SELECT o_orderkey, 'no such pair' FROM orders WHERE NOT EXISTS
      (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey = o_custkey)""",
)
def semi_anti(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("l_suppkey"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    found = {
        "with lines": qc.with_reference(orders, lines, ["l_orderkey"]),
        "no lines": qc.missing_reference(orders, lines, ["l_orderkey"]),
        "no such pair": qc.missing_reference(orders, lines, ["l_orderkey", "l_suppkey"]),
    }
    return shape.tagged_union(found, "kind").select("o_orderkey", "kind")


@case(
    "q_open_split",
    f"""{with_clause(ORDER_LINES)}, k AS (SELECT *, CASE WHEN BAL > 0 AND SHIPPED_UNITS = 0 THEN 'full'
      WHEN BAL > 0 AND SHIPPED_UNITS > 0 THEN 'partial' END AS kind FROM ol)
    SELECT SEASON, kind, count(*) AS lines, CAST(sum(BAL) AS BIGINT) AS bal,
      {', '.join(f'CAST(sum(S{i}) AS BIGINT) AS S{i}' for i in range(1, 9))} FROM k WHERE kind IS NOT NULL GROUP BY SEASON, kind""",
)
def open_split(spark, folder):
    lines = order_lines(spark, folder).withColumn("kind", open_kind("SHIPPED_UNITS", "BAL"))
    return (
        lines.filter(F.col("kind").isNotNull())
        .groupBy("SEASON", "kind")
        .agg(F.count("*").alias("lines"), sum0("BAL").alias("bal"), *[sum0(b).alias(b) for b in buckets()])
    )


@case(
    "q_agg_basics",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS)}, live AS (SELECT * FROM st WHERE CXL = 0 AND COMMENT <> 'DEACTIVE' AND DIV <> 4)
    SELECT SEASON, STYLE, CAST(sum(ORDERED_UNITS) AS BIGINT) AS ordered, max(SHIP_ON_DATE) AS last_ship, count(*) AS lines,
      count(DISTINCT CUST_NBR) AS customers, CAST(sum({' + '.join(f'BAL_S{i}' for i in range(1, 9))}) AS BIGINT) AS bal
    FROM live WHERE SEASON IN ('SP-98', 'FA-98', 'SP-99') GROUP BY SEASON, STYLE
    UNION ALL SELECT 'ALL', 'ALL', CAST(sum(ORDERED_UNITS) AS BIGINT), max(SHIP_ON_DATE), count(*), count(DISTINCT CUST_NBR),
      CAST(sum({' + '.join(f'BAL_S{i}' for i in range(1, 9))}) AS BIGINT) FROM live""",
)
def agg_basics(spark, folder):
    lines = order_lines(spark, folder)
    live = active_orders(stored_orders(lines)).filter(F.col("DIV") != 4)
    aggs = [
        sum0("ORDERED_UNITS").alias("ordered"),
        F.max("SHIP_ON_DATE").alias("last_ship"),
        F.count("*").alias("lines"),
        F.countDistinct("CUST_NBR").alias("customers"),
        bucket_sum([F.sum(b) for b in buckets("BAL_S")]).alias("bal"),
    ]
    by_style = in_seasons(live, ["SP-98", "FA-98", "SP-99"]).groupBy("SEASON", "STYLE").agg(*aggs)
    overall = live.agg(*aggs).withColumns({"SEASON": F.lit("ALL"), "STYLE": F.lit("ALL")})
    return by_style.unionByName(overall)


_FEED = {
    1: ("ORDER", "string"),
    2: ("DAY", "string"),
    4: ("PRICE", "double"),
    5: ("NOTE", "string"),
    6: ("STATUS", "nullable string"),
}


def _order_feed(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(
        F.lit("x").alias("a"),
        digits("o_orderkey").alias("b"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("c"),
        F.lit("unused").alias("d"),
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("e"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("f"),
        F.lit("z").alias("g"),
    )


_FEED_SQL = f"""SELECT {z('o_orderkey', 6)} AS order_id,
  CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS note,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status FROM orders"""


def _read_back(rows):
    from ..functions.dates import us_date

    return rows.select(
        text.zfill("ORDER", 6).alias("order_id"),
        us_date("DAY").alias("day"),
        F.col("PRICE").alias("price"),
        F.col("NOTE").alias("note"),
        F.col("STATUS").alias("status"),
    )


@case("q_positional_feed", _FEED_SQL)
def positional_feed(spark, folder):
    path = scratch(spark, "positional")
    _order_feed(spark, folder).write.option("header", True).csv(path)
    return _read_back(delimited.read_positional(spark, path, _FEED, skip=1))


@case("q_headered_feed", _FEED_SQL)
def headered_feed(spark, folder):
    path = scratch(spark, "headered")
    names = {"b": "string", "c": "string", "o_totalprice": "double", "e": "string", "f": "nullable string"}
    _order_feed(spark, folder).write.option("header", True).csv(path)
    rows = delimited.read_headered(spark, path, names)
    return _read_back(shape.renamed(rows, {"b": "ORDER", "c": "DAY", "o_totalprice": "PRICE", "e": "NOTE", "f": "STATUS"}))


@case(
    "q_feed_family",
    f"""SELECT {season_sql('o_orderdate')} AS season, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys, 'RETURNS' AS missing
    FROM orders GROUP BY 1""",
)
def feed_family(spark, folder):
    """One feed per season, the season in its name; another feed did not arrive."""
    path = scratch(spark, "family")
    orders = table(spark, folder, "orders")
    name = F.concat(F.lit("ORDERS_"), season_of(F.to_date("o_orderdate")), F.lit(".csv"))
    (
        orders.select(digits("o_orderkey"), "o_orderstatus", name.alias("feed"))
        .write.partitionBy("feed")
        .option("header", True)
        .csv(path)
    )
    delimited.require_feed(spark, f"{path}/feed=ORDERS*")
    missing = None
    try:
        delimited.require_feed(spark, f"{path}/feed=RETURNS*")
    except delimited.MissingFeed:
        missing = "RETURNS"
    rows = delimited.read_feed_family(spark, path, "feed=ORDERS*", {0: ("KEY", "long")})
    return (
        rows.groupBy(delimited.season_last(F.col("FILE")).alias("season"))
        .agg(F.count("*").alias("orders"), F.sum("KEY").alias("keys"))
        .withColumn("missing", F.lit(missing))
    )


@case(
    "q_sheet_family",
    f"""SELECT {season_sql('o_orderdate')} AS season, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM orders GROUP BY 1""",
)
def sheet_family(spark, folder):
    path = scratch(spark, "sheets")
    day = F.to_date("o_orderdate")
    half = F.when(F.month(day) <= 6, "sp-").otherwise("fa-")
    tab = F.concat(half, F.date_format(day, "yy"), F.lit(" ALL"))
    (
        table(spark, folder, "orders")
        .select(digits("o_orderkey"), "o_orderstatus", tab.alias("sheet"))
        .write.partitionBy("sheet")
        .option("header", True)
        .csv(path)
    )
    rows = delimited.read_sheet_family(spark, path, "ALL", {0: ("KEY", "long")})
    return (
        rows.groupBy(delimited.season_first(F.col("SHEET")).alias("season"))
        .agg(F.count("*").alias("orders"), F.sum("KEY").alias("keys"))
    )


@case(
    "q_numbered_preamble",
    """SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
)
def numbered_preamble(spark, folder):
    """Three preamble rows (one of them blank) and a totals row in every file."""

    # defined here so that it travels with the job: workers need not have this package
    def framed(batches):
        import pandas as pd

        yield pd.DataFrame({"value": ["title", "", "a,b,c"]})
        yield from batches
        yield pd.DataFrame({"value": ["total,,"]})

    path = scratch(spark, "preamble")
    line = F.concat_ws(",", F.lit("x"), digits("o_orderkey"), "o_orderstatus")
    table(spark, folder, "orders").select(line.alias("value")).mapInPandas(framed, "value string").write.text(path)
    rows = delimited.read_positional(
        spark, path, {1: ("KEY", "long"), 2: ("STATUS", "string")}, skip=3, with_position=True
    )
    return (
        delimited.trim_footer(rows)
        .groupBy(F.col("STATUS").alias("status"))
        .agg(F.count("*").alias("n"), F.sum("KEY").alias("keys"))
    )


@case(
    "q_last_or_match",
    """WITH r AS (SELECT l_suppkey AS s, l_orderkey % 3 AS run, l_partkey % 4 = 0 AS hit, l_orderkey AS o, l_partkey AS p, sum(l_linenumber) AS n
      FROM lineitem GROUP BY l_suppkey, l_orderkey, l_partkey),
    w AS (SELECT *, lead(run) OVER (PARTITION BY s ORDER BY o, p) AS next, last_value(CASE WHEN hit THEN run END IGNORE NULLS)
      OVER (PARTITION BY s ORDER BY o, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS found FROM r)
    SELECT s AS supplier, o AS order_id, p AS part, CAST(n AS BIGINT) AS n FROM w WHERE hit OR ((next IS NULL OR next <> run) AND (found IS NULL OR found <> run))""",
)
def last_or_match(spark, folder):
    """Per supplier, parts of runs of orders: those of a kind, or the last one of a run without any."""
    lines = table(spark, folder, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_partkey").agg(F.sum("l_linenumber").alias("n"))
    lines = lines.withColumn("run", F.col("l_orderkey") % 3)
    kept = shape.last_or_match(
        lines, ["run"], F.col("l_partkey") % 4 == 0, ["l_suppkey"], ["l_orderkey", "l_partkey"], F.floor(F.col("l_orderkey") / 5000)
    )
    return kept.select(F.col("l_suppkey").alias("supplier"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part"), "n")


_FORM_ROWS = """
cells AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS file, l_linenumber + 21 AS rw, CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS qty,
    CAST(max(l_partkey) AS VARCHAR) AS style
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
last AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file, greatest(coalesce(max(rw), 17), CASE WHEN o_orderstatus = 'O' THEN 17 ELSE 30 END) AS last_row
  FROM orders LEFT JOIN cells ON file = CAST(o_orderkey AS VARCHAR) GROUP BY o_orderkey, o_orderstatus
),
ends AS (
  SELECT file, last_row, min(r) AS end_row FROM (
    SELECT last.file, last_row, g.r FROM last, (SELECT unnest(range(22, 30)) AS r) g
      LEFT JOIN cells ON cells.file = last.file AND cells.rw = g.r WHERE cells.rw IS NULL)
  GROUP BY file, last_row
)"""


def form_cells(spark, folder, mixed=False):
    """Orders laid out as purchase-order forms, one per order.

    ``mixed``: prepack forms name one of three scales, and those with an even
    number name scales line by line, though not on every line.
    """
    from ..sources.forms import BODY_COLUMNS, HEADER_CELLS

    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    priority = F.left("o_orderpriority", F.lit(1))
    values = {
        "hfc_nbr": digits("o_orderkey"),
        "season_text": F.concat(F.lit("SEASON: SP "), F.year("o_orderdate").cast("string")),
        "customer_text": F.concat(digits("o_custkey"), F.when(status == "P", ": SHOP E-COM").otherwise(": STORE")),
        "scale_text": F.when(
            status == "F", F.concat(F.lit("A"), digits(F.col("o_custkey") % 3 + 1), F.lit("/pack")) if mixed else F.lit("A1/pack")
        ).otherwise("00"),
        "kind_text": F.when((status == "F") | (priority == "5"), "PREPACK").otherwise("BULK ORDER"),
        "div": priority,
        "carton_text": F.concat(F.lit("CARTON: "), F.dayofmonth("o_orderdate").cast("string"), F.lit("X")),
        "knit_box": F.when(priority == "1", "( X )"),
        "woven_box": F.when(priority == "2", "( X )"),
        "x_orient": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "agent": F.col("o_orderpriority"),
        "ship_date": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "maker": F.concat(F.lit("M"), priority),
        "coo": F.lit("CN"),
    }
    fixed = [(r, c, values[n]) for n, (r, c) in HEADER_CELLS.items()]
    fixed.append((30, 5, F.when(status != "O", "TOTAL")))
    head = orders.select(
        digits("o_orderkey").alias("file"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), v.cast("string").alias("value"))
                    for r, c, v in fixed
                ]
            )
        ),
    )
    line = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("q"), F.max("l_partkey").alias("p"))
    )
    half = F.call_function("div", F.col("q"), F.lit(2))
    curve = F.concat(digits(half), F.lit("/s-"), digits(F.col("q") - half), F.lit("/M"))
    body_values = {
        "style": digits("p"),
        "style_desc": F.concat_ws(
            " @ ",
            F.concat(F.lit("STYLE "), digits("p")),
            F.when(F.lit(mixed) & (F.col("l_orderkey") % 2 == 0) & (F.col("p") % 5 != 0), F.concat(F.lit("A"), digits(F.col("p") % 4 + 1))),
        ),
        "color_code": F.lpad(digits("l_linenumber"), 3, "0"),
        "ttl_qty": digits("q"),
        "size_curve": curve,
    }
    body = line.select(
        digits("l_orderkey").alias("file"),
        (F.col("l_linenumber") + 21).alias("row"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(BODY_COLUMNS[n]).alias("col"), v.alias("value"))
                    for n, v in body_values.items()
                ]
            )
        ),
    )
    return head.filter(F.col("value").isNotNull()).unionByName(body)


@case(
    "q_form_headers",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS file, {z('o_orderkey', 6)} AS hfc_nbr, CAST(left(o_orderpriority, 1) AS INTEGER) AS div,
      CAST(o_orderdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS x_orient,
      CASE left(o_orderpriority, 1) WHEN '1' THEN 'K' WHEN '2' THEN 'W' END AS cat, CAST(o_custkey AS VARCHAR) AS cust_nbr,
      CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_ecom, o_orderpriority AS agent, 'M' || left(o_orderpriority, 1) AS maker,
      'CN' AS coo, 'SP-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS ssn, CAST(day(o_orderdate) AS INTEGER) AS carton_size,
      CASE WHEN o_orderstatus = 'F' THEN 'A1' ELSE '00' END AS hfc_size_scale_code,
      CASE WHEN o_orderstatus = 'F' THEN 'PPK' WHEN left(o_orderpriority, 1) <> '5' THEN 'BULK' END AS kind FROM orders""",
)
def form_headers_case(spark, folder):
    return form_headers(form_cells(spark, folder))


@case(
    "q_form_extract",
    f"""{with_clause(_FORM_ROWS)} SELECT cells.file, CAST(rw AS INTEGER) AS row, style, qty FROM cells JOIN ends ON ends.file = cells.file
    WHERE rw < end_row AND end_row <= last_row""",
)
def form_extract(spark, folder):
    lines = forms.body_lines(form_cells(spark, folder))
    return lines.select("file", "row", "style", F.col("ttl_qty").alias("qty"))


@case(
    "q_form_names",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'po ' || o_orderkey || '.xls' ELSE 'po CANCELED ' || o_orderkey || '.xls' END AS name
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def form_names(spark, folder):
    key, status = digits("o_orderkey"), F.col("o_orderstatus")
    name = (
        F.when(status == "F", F.concat(F.lit("po "), key, F.lit(".xls")))
        .when((status == "P") & (F.length(key) > 2), F.concat(F.lit("po "), key, F.lit(" Cancel.xls")))
        .when(status == "P", F.concat(F.lit("po "), key, F.lit(".xlsx")))
        .otherwise(F.concat(F.lit("po CANCELED "), key, F.lit(".xls")))
    )
    named = table(spark, folder, "orders").select("o_orderkey", name.alias("name"))
    return delimited.not_cancelled(named, F.col("name"))
