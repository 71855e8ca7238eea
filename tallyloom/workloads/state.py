"""Upserts, soft deletes and updates of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.amounts import buckets, sum0
from ..operators import mutate
from ..operators.mutate import Scope
from ..sources.warehouse import Split, Warehouse
from . import case
from .adapters import (
    FEED_ORDERS,
    ORDER_LINES,
    STORED_ORDERS,
    feed_orders,
    order_lines,
    shared_lines,
    stored_orders,
    table,
    with_clause,
)
from .shape import scratch

KEY = ["GREEN_BAR", "STYLE", "COLOR"]
_PAIR = """t AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, CAST(NULL AS BIGINT) AS qty,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS CXL FROM orders WHERE o_orderstatus <> 'O'),
  s AS (SELECT l_orderkey AS k2, CAST(sum(l_quantity) AS BIGINT) AS q, max(l_extendedprice) AS p FROM lineitem GROUP BY l_orderkey)"""


def _pair(spark, folder):
    """Order totals of older orders, and line totals of all orders."""
    target = table(spark, folder, "orders").filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.lit(None).cast("long").alias("qty"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("CXL"),
    )
    source = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("k2")).agg(
        sum0(F.col("l_quantity").cast("long")).alias("q"), F.max("l_extendedprice").alias("p")
    )
    return target, source


@case(
    "q_upsert",
    f"""WITH {_PAIR} SELECT coalesce(k, k2) AS k, CASE WHEN k IS NULL THEN 'NEW' ELSE status END AS status,
      CASE WHEN k2 IS NOT NULL THEN p ELSE price END AS price, CASE WHEN k2 IS NOT NULL THEN q ELSE qty END AS qty,
      coalesce(CXL, 0) AS CXL FROM t FULL OUTER JOIN s ON k = k2""",
)
def upsert(spark, folder):
    target, source = _pair(spark, folder)
    values = {"price": "p", "qty": "q"}
    return mutate.upsert(target, source, {"k": "k2"}, values, {**values, "status": F.lit("NEW")})


@case(
    "q_upsert_soft_delete",
    f"""WITH {_PAIR} SELECT coalesce(k, k2) AS k, status, CASE WHEN k2 IS NOT NULL THEN p ELSE price END AS price,
      CASE WHEN k2 IS NOT NULL THEN q ELSE qty END AS qty, CASE WHEN k2 IS NULL THEN 1 ELSE 0 END AS CXL
    FROM t FULL OUTER JOIN s ON k = k2""",
)
def upsert_soft_delete(spark, folder):
    target, source = _pair(spark, folder)
    return mutate.upsert_soft_delete(target, source, {"k": "k2"}, {"price": "p", "qty": "q"})


_KEY_JOIN = "t.GREEN_BAR = s.GREEN_BAR AND t.STYLE = s.STYLE AND t.COLOR = s.COLOR"
_SMALL_STATE = """t AS (SELECT GREEN_BAR, STYLE, COLOR, SEASON, ORDERED_UNITS, BAL_UNITS, BAL_S1, BAL_S2, CXL FROM st)"""


def _small_state(lines):
    return stored_orders(lines).select(
        *KEY, "SEASON", "ORDERED_UNITS", "BAL_UNITS", "BAL_S1", "BAL_S2", "CXL"
    )


_VALUES = {"SEASON": "SEASON", "ORDERED_UNITS": "ORDERED_UNITS", "BAL_UNITS": "BAL"}


@case(
    "q_upsert_scoped",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS, _SMALL_STATE)}
    SELECT coalesce(t.GREEN_BAR, s.GREEN_BAR) AS GREEN_BAR, coalesce(t.STYLE, s.STYLE) AS STYLE, coalesce(t.COLOR, s.COLOR) AS COLOR,
      coalesce(s.SEASON, t.SEASON) AS SEASON, coalesce(s.ORDERED_UNITS, t.ORDERED_UNITS) AS ORDERED_UNITS,
      coalesce(s.BAL, t.BAL_UNITS) AS BAL_UNITS, t.BAL_S1, t.BAL_S2,
      CASE WHEN s.GREEN_BAR IS NOT NULL THEN 0 WHEN t.SEASON IN (SELECT SEASON FROM fd) THEN 1 ELSE t.CXL END AS CXL
    FROM t FULL OUTER JOIN fd s ON {_KEY_JOIN}""",
)
def upsert_scoped(spark, folder):
    lines = shared_lines(spark, folder)
    source = feed_orders(lines)
    return mutate.upsert_soft_delete(
        _small_state(lines), source, KEY, _VALUES, scope=Scope("SEASON", source, "SEASON")
    )


@case(
    "q_upsert_zeroing",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS, _SMALL_STATE)},
    matched AS (SELECT t.GREEN_BAR, t.STYLE, t.COLOR, s.SEASON, s.ORDERED_UNITS, s.BAL AS BAL_UNITS, t.BAL_S1, t.BAL_S2, 0 AS CXL
      FROM t JOIN fd s ON {_KEY_JOIN}),
    added AS (SELECT GREEN_BAR, STYLE, COLOR, SEASON, ORDERED_UNITS, BAL AS BAL_UNITS, NULL AS BAL_S1, NULL AS BAL_S2, 0 AS CXL
      FROM fd s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_KEY_JOIN})),
    rest AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM fd s WHERE {_KEY_JOIN})),
    lost AS (SELECT GREEN_BAR, STYLE, COLOR, SEASON, ORDERED_UNITS, 0 AS BAL_UNITS, 0 AS BAL_S1, 0 AS BAL_S2, 1 AS CXL
      FROM rest WHERE SEASON IN (SELECT SEASON FROM fd)),
    kept AS (SELECT * FROM rest WHERE SEASON NOT IN (SELECT SEASON FROM fd))
    SELECT * FROM matched UNION ALL SELECT * FROM added UNION ALL SELECT * FROM lost UNION ALL SELECT * FROM kept""",
)
def upsert_zeroing(spark, folder):
    lines = shared_lines(spark, folder)
    source = feed_orders(lines)
    return mutate.upsert_soft_delete(
        _small_state(lines),
        source,
        KEY,
        _VALUES,
        zero=["BAL_UNITS", "BAL_S1", "BAL_S2"],
        scope=Scope("SEASON", source, "SEASON"),
    )


@case(
    "q_update_from",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, FEED_ORDERS, _SMALL_STATE)}
    SELECT t.GREEN_BAR, t.STYLE, t.COLOR, t.SEASON, t.ORDERED_UNITS, t.BAL_UNITS,
      CASE WHEN s.GREEN_BAR IS NOT NULL THEN s.S1 ELSE t.BAL_S1 END AS BAL_S1,
      CASE WHEN s.GREEN_BAR IS NOT NULL THEN s.S2 ELSE t.BAL_S2 END AS BAL_S2, t.CXL
    FROM t LEFT JOIN fd s ON {_KEY_JOIN}""",
)
def update_from(spark, folder):
    lines = shared_lines(spark, folder)
    return mutate.update_from(
        _small_state(lines), feed_orders(lines), KEY, {"BAL_S1": "S1", "BAL_S2": "S2"}
    )


@case(
    "q_update_where",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS)} SELECT GREEN_BAR, STYLE, COLOR, COMMENT,
      {', '.join(f"CASE WHEN COMMENT IN ('COMPLETE', 'DEACTIVE') THEN 0 ELSE BAL_S{i} END AS BAL_S{i}" for i in range(1, 9))} FROM st""",
)
def update_where(spark, folder):
    lines = order_lines(spark, folder)
    closed = F.col("COMMENT").isin("COMPLETE", "DEACTIVE")
    state = stored_orders(lines)
    return mutate.update_where(state, closed, {b: F.lit(0) for b in buckets("BAL_S")}).select(
        *KEY, "COMMENT", *buckets("BAL_S")
    )


@case(
    "q_corrections",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, _SMALL_STATE)} SELECT GREEN_BAR, STYLE, COLOR,
      CASE WHEN SEASON = 'SP-97' THEN 'FA-97' ELSE SEASON END AS SEASON,
      CASE WHEN (CASE WHEN SEASON = 'SP-97' THEN 'FA-97' ELSE SEASON END) = 'FA-97' AND COLOR = '001' THEN 0 ELSE ORDERED_UNITS END AS ORDERED_UNITS,
      BAL_UNITS, BAL_S1, BAL_S2, CASE WHEN COLOR = '007' THEN 0 ELSE CXL END AS CXL FROM t""",
)
def corrections(spark, folder):
    lines = order_lines(spark, folder)
    fixes = [
        ({"SEASON": "SP-97"}, {"SEASON": "FA-97"}),
        ({"SEASON": "FA-97", "COLOR": "001"}, {"ORDERED_UNITS": 0}),
        ({"COLOR": "007"}, {"CXL": 0}),
    ]
    return mutate.apply_corrections(_small_state(lines), fixes)


@case(
    "q_published_table",
    f"""{with_clause(ORDER_LINES, STORED_ORDERS, _SMALL_STATE)} SELECT GREEN_BAR, STYLE, COLOR, SEASON,
      CASE WHEN SEASON IN ('SP-98', 'FA-98') THEN 0 ELSE ORDERED_UNITS END AS ORDERED_UNITS, BAL_UNITS, BAL_S1, BAL_S2, CXL FROM t""",
)
def published_table(spark, folder):
    """Publish a table by season, replace two seasons, read it back."""
    lines = order_lines(spark, folder)
    store = Warehouse(spark, scratch(spark, "store"))
    store.publish({"ORDERS": _small_state(lines)}, {"ORDERS": Split("SEASON")})
    changed = ["SP-98", "FA-98"]
    new = store.read("ORDERS", changed).withColumn("ORDERED_UNITS", F.lit(0).cast("long"))
    store.publish({"ORDERS": new}, {"ORDERS": Split("SEASON", changed)})
    return store.read("ORDERS")
