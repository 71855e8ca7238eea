"""The tables seen as order lines, open orders, purchase orders and forms.

Every adapter reads its tables whole. Each comes with the SQL text of the
same relation for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.amounts import buckets
from ..session import stage

AS_OF = "2001-01-01"
FEED_FROM = "1998-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def digits(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def season_of(day: Column) -> Column:
    half = F.when(F.month(day) <= 6, "SP-").otherwise("FA-")
    return F.concat(half, F.lpad((F.year(day) % 100).cast("string"), 2, "0"))


def z(expr: str, width: int) -> str:
    """Zero padding in SQL."""
    e = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({e}) >= {width} THEN {e} ELSE lpad({e}, {width}, '0') END)"


def season_sql(day: str) -> str:
    return f"((CASE WHEN month({day}) <= 6 THEN 'SP-' ELSE 'FA-' END) || right(CAST(year({day}) AS VARCHAR), 2))"


def order_lines(spark: SparkSession, folder: str, stored: bool = False) -> DataFrame:
    """Lines summed per (order, part, supplier) before they meet their order.

    Rows are dealt by order as they are read: hardly any two have the same
    key, so sums made before the shuffle would only be wider than the rows.
    The sums and the join with the orders use that one shuffle.

    With ``stored`` comes STORED: a line of the same key is that of an order
    which is not new, as where an order is there twice.
    """
    qty, day, shipped, waiting, picked = (F.col(c) for c in ("_qty", "_day", "_shipped", "_waiting", "_picked"))
    unshipped = F.col("l_linestatus") == "O"

    def units(cond: Column) -> Column:
        return F.sum(F.when(cond, qty).otherwise(0))

    lines = (
        table(spark, folder, "lineitem")
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            F.col("l_linenumber").alias("_nbr"),
            F.col("l_quantity").cast("long").alias("_qty"),
            "l_extendedprice",
            F.to_date("l_shipdate").alias("_day"),
            (F.col("l_linestatus") == "F").alias("_shipped"),
            (unshipped & (F.col("l_returnflag") != "R")).alias("_waiting"),
            (unshipped & (F.col("l_returnflag") == "A")).alias("_picked"),
        )
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_partkey", "l_suppkey")
        .agg(
            F.min(day).alias("START_SHIP"),
            F.max(day).alias("CXL_SHIP"),
            F.max("l_extendedprice").alias("SP"),
            F.sum(qty).alias("ORDERED_UNITS"),
            units(shipped).alias("SHIPPED_UNITS"),
            F.max(F.when(shipped, day)).alias("SHIP_ON_DATE"),
            units(picked).alias("PICK_UNITS"),
            units(waiting).alias("BAL"),
            *[units(waiting & (F.col("_nbr") == i)).alias(f"S{i}") for i in range(1, 9)],
        )
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.col("o_orderstatus").alias("STATUS"),
        F.to_date("o_orderdate").alias("ORDER_DATE"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("DIV"),
    )
    if stored:
        older = F.max(F.col("STATUS") != "O").over(Window.partitionBy("l_orderkey"))
        orders = orders.withColumn("STORED", F.coalesce(older, F.lit(False)))
    return lines.join(orders, "l_orderkey").select(
        text.zfill(digits("l_orderkey"), 6).alias("GREEN_BAR"),
        text.zfill(digits("l_partkey"), 6).alias("STYLE"),
        text.zfill(digits("l_suppkey"), 3).alias("COLOR"),
        "DIV",
        text.zfill(digits("o_custkey"), 5).alias("CUST_NBR"),
        text.zfill(digits("o_custkey"), 6).alias("CUST_PO"),
        "ORDER_DATE",
        "START_SHIP",
        "CXL_SHIP",
        season_of(F.col("ORDER_DATE")).alias("SEASON"),
        "SP",
        "ORDERED_UNITS",
        "SHIPPED_UNITS",
        "SHIP_ON_DATE",
        "PICK_UNITS",
        F.when(F.col("STATUS") == "P", "*").otherwise("").alias("UNCONFIRMED"),
        "BAL",
        *buckets(),
        "STATUS",
        *["STORED"] * stored,
    )


def shared_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines for queries that use them several times: written once, with all or the named columns."""
    lines = order_lines(spark, folder, "STORED" in columns)
    return stage(lines.select(*columns) if columns else lines)


def _units_sql(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN l_quantity ELSE 0 END) AS BIGINT)"


_WAITING = "l_linestatus = 'O' AND l_returnflag <> 'R'"
ORDER_LINES = f"""
ol AS (
  SELECT {z('l_orderkey', 6)} AS GREEN_BAR, {z('l_partkey', 6)} AS STYLE, {z('l_suppkey', 3)} AS COLOR,
    CAST(left(o_orderpriority, 1) AS INTEGER) AS DIV, {z('o_custkey', 5)} AS CUST_NBR,
    {z('o_custkey', 6)} AS CUST_PO, CAST(o_orderdate AS DATE) AS ORDER_DATE, START_SHIP, CXL_SHIP,
    {season_sql('o_orderdate')} AS SEASON, SP, ORDERED_UNITS, SHIPPED_UNITS, SHIP_ON_DATE, PICK_UNITS,
    CASE WHEN o_orderstatus = 'P' THEN '*' ELSE '' END AS UNCONFIRMED, BAL,
    {', '.join(buckets())}, o_orderstatus AS STATUS
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(min(l_shipdate) AS DATE) AS START_SHIP,
      CAST(max(l_shipdate) AS DATE) AS CXL_SHIP, max(l_extendedprice) AS SP,
      CAST(sum(l_quantity) AS BIGINT) AS ORDERED_UNITS,
      {_units_sql("l_linestatus = 'F'")} AS SHIPPED_UNITS,
      CAST(max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS DATE) AS SHIP_ON_DATE,
      {_units_sql("l_linestatus = 'O' AND l_returnflag = 'A'")} AS PICK_UNITS,
      {_units_sql(_WAITING)} AS BAL,
      {', '.join(f"{_units_sql(f'{_WAITING} AND l_linenumber = {i}')} AS S{i}" for i in range(1, 9))}
    FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey
  ) l JOIN orders o ON l_orderkey = o_orderkey
)"""


def stored_orders(lines: DataFrame) -> DataFrame:
    """The order table before a load: every order that is not new.

    Its seasons follow the ship date, so matched lines change season; lines
    of the last priority were cancelled before.
    """
    return lines.filter("STATUS <> 'O'").select(
        "GREEN_BAR", "STYLE", "COLOR", "DIV", "CUST_NBR", "ORDER_DATE", "START_SHIP", "CXL_SHIP", "CUST_PO",
        season_of(F.col("START_SHIP")).alias("SEASON"),
        "SP", "ORDERED_UNITS", "SHIPPED_UNITS", F.col("BAL").alias("BAL_UNITS"), "PICK_UNITS", "SHIP_ON_DATE",
        F.lit(0).alias("UNCONFIRMED"),
        F.when(F.col("SHIPPED_UNITS") >= F.col("ORDERED_UNITS"), "COMPLETE").otherwise("ACTIVE").alias("COMMENT"),
        F.lit("").alias("COMMENT_2"),
        *[F.col(f"S{i}").alias(f"ORDERED_S{i}") for i in range(1, 9)],
        *[(F.col(f"S{i}") + 1).alias(f"BAL_S{i}") for i in range(1, 9)],
        F.when(F.col("DIV") == 5, 1).otherwise(0).alias("CXL"),
    )


STORED_ORDERS = f"""
st AS (
  SELECT GREEN_BAR, STYLE, COLOR, DIV, CUST_NBR, ORDER_DATE, START_SHIP, CXL_SHIP, CUST_PO,
    {season_sql('START_SHIP')} AS SEASON, SP, ORDERED_UNITS, SHIPPED_UNITS, BAL AS BAL_UNITS, PICK_UNITS,
    SHIP_ON_DATE, 0 AS UNCONFIRMED,
    CASE WHEN SHIPPED_UNITS >= ORDERED_UNITS THEN 'COMPLETE' ELSE 'ACTIVE' END AS COMMENT, '' AS COMMENT_2,
    {', '.join(f'S{i} AS ORDERED_S{i}' for i in range(1, 9))},
    {', '.join(f'S{i} + 1 AS BAL_S{i}' for i in range(1, 9))},
    CASE WHEN DIV = 5 THEN 1 ELSE 0 END AS CXL
  FROM ol WHERE STATUS <> 'O'
)"""


def feed_orders(lines: DataFrame) -> DataFrame:
    """Today's order extract: open orders of the current seasons."""
    return lines.filter((F.col("STATUS") != "F") & (F.col("ORDER_DATE") >= FEED_FROM))


FEED_ORDERS = f"fd AS (SELECT * FROM ol WHERE STATUS <> 'F' AND ORDER_DATE >= DATE '{FEED_FROM}')"


def as_text(lines: DataFrame, dates: str = "M/d/yyyy") -> DataFrame:
    """Order lines as the extract spells them: dates in a pattern, short codes."""
    us = lambda c: F.date_format(c, dates)
    bare = lambda c: F.concat(F.ltrim(F.left(c, F.length(c) - 1), F.lit("0")), F.right(c, F.lit(1)))
    return lines.withColumns(
        {
            "CUST_NBR": bare("CUST_NBR"),
            "CUST_PO": bare("CUST_PO"),
            "STYLE": bare("STYLE"),
            "COLOR": bare("COLOR"),
            "ORDER_DATE": us("ORDER_DATE"),
            "START_SHIP": us("START_SHIP"),
            "CXL_SHIP": us("CXL_SHIP"),
            "SHIP_ON_DATE": F.coalesce(us("SHIP_ON_DATE"), F.lit("")),
            "SEASON": F.concat(F.lower(F.left("SEASON", F.lit(2))), F.lit(" 20"), F.right("SEASON", F.lit(2))),
        }
    )


def open_orders(lines: DataFrame) -> DataFrame:
    """Open-order extract: every line with a balance."""
    return (
        lines.filter("BAL > 0")
        .select("GREEN_BAR", "STYLE", "COLOR", F.col("SHIPPED_UNITS").alias("SHIPPED"), "BAL", *buckets())
    )


OPEN_ORDERS = f"oo AS (SELECT GREEN_BAR, STYLE, COLOR, SHIPPED_UNITS AS SHIPPED, BAL, {', '.join(buckets())} FROM ol WHERE BAL > 0)"


def po_details(lines: DataFrame) -> DataFrame:
    """Order lines as purchase-order lines: HFC = order, size buckets = balance."""
    return lines.select(
        F.col("GREEN_BAR").alias("HFC_NBR"),
        "STYLE",
        F.col("COLOR").alias("COLOR_CODE"),
        F.col("BAL").alias("TTL_QTY"),
        *[F.col(f"S{i}").alias(f"S{i}_QTY") for i in range(1, 9)],
        F.when(F.col("PICK_UNITS") > 40, 1).otherwise(0).alias("CXL"),
    )


PO_DETAILS = f"""
pd AS (
  SELECT GREEN_BAR AS HFC_NBR, STYLE, COLOR AS COLOR_CODE, BAL AS TTL_QTY,
    {', '.join(f'S{i} AS S{i}_QTY' for i in range(1, 9))}, CASE WHEN PICK_UNITS > 40 THEN 1 ELSE 0 END AS CXL
  FROM ol
)"""


def po_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as purchase-order headers."""
    orders = table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    return orders.select(
        text.zfill(digits("o_orderkey"), 6).alias("HFC_NBR"),
        season_of(day).alias("SEASON"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("DIV"),
        text.zfill(digits("o_custkey"), 5).alias("CUST_NBR"),
        F.dayofmonth(day).alias("CARTON_SIZE"),
        day.alias("SHIP_DATE"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("CXL"),
    )


PO_HEADERS = f"""
ph AS (
  SELECT {z('o_orderkey', 6)} AS HFC_NBR, {season_sql('o_orderdate')} AS SEASON,
    CAST(left(o_orderpriority, 1) AS INTEGER) AS DIV, {z('o_custkey', 5)} AS CUST_NBR,
    CAST(day(o_orderdate) AS INTEGER) AS CARTON_SIZE, CAST(o_orderdate AS DATE) AS SHIP_DATE,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS CXL
  FROM orders
)"""


def customer_names(spark: SparkSession, folder: str) -> DataFrame:
    """Customers named by their nation, so that several share a name."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customers.join(nations, "c_nationkey").select(
        text.zfill(digits("c_custkey"), 5).alias("CUST_NBR"), F.col("n_name").alias("CUST_NAME")
    )


CUSTOMER_NAMES = f"""
cn AS (SELECT {z('c_custkey', 5)} AS CUST_NBR, n_name AS CUST_NAME
       FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def with_clause(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts)
