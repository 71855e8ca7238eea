"""Codes, texts, dates, amounts and size texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, nested, rules, text
from ..functions.amounts import (
    buckets,
    duty_free_amount,
    fill,
    line_amount,
    override,
    pack_count,
    row_max,
)
from . import case
from .adapters import AS_OF, ORDER_LINES, digits, order_lines, table, with_clause, z


@case(
    "q_clean_ids",
    f"""SELECT o_orderkey, {z('o_orderkey', 6)} AS order_id, {z('o_custkey', 3)} AS cust_id,
      '-' || {z('o_custkey', 5)} AS signed_id,
      (CASE WHEN month(o_orderdate) <= 6 THEN 'SP-' ELSE 'FA-' END) || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS season
    FROM orders""",
)
def clean_ids(spark, folder):
    half = F.when(F.month("o_orderdate") <= 6, "spring ").otherwise("fall ")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.zfill("o_orderkey", 6).alias("order_id"),
        text.zfill("o_custkey", 3).alias("cust_id"),
        text.zfill(F.concat(F.lit("-"), digits("o_custkey")), 6).alias("signed_id"),
        text.season_code(F.concat(half, F.year("o_orderdate").cast("string"))).alias("season"),
    )


@case(
    "q_split_code_desc",
    """SELECT o_orderkey, lpad(split_part(o_orderpriority, '-', 1), 3, '0') AS code,
      split_part(o_orderpriority, '-', 2) AS descr, '' AS no_desc FROM orders""",
)
def split_code_desc(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.code_part("o_orderpriority").alias("code"),
        text.desc_part("o_orderpriority").alias("descr"),
        text.desc_part("o_orderstatus").alias("no_desc"),
    )


@case(
    "q_clean_text",
    f"""SELECT p_partkey,
      CASE WHEN length({z('p_partkey', 6)}) = 6 THEN {z('p_partkey', 6)} ELSE '' END AS po,
      '' AS po_missing, '000000' AS po_blank,
      upper(replace(p_name, ' ', '')) AS packed, upper(replace(p_name, ' ', '')) AS squeezed,
      CASE WHEN contains(p_name, 'red') OR contains(p_name, 'hot') THEN 1 ELSE 0 END AS flagged,
      replace(p_brand, 'Brand#', '') AS brand_nbr, p_size AS counted, p_brand AS scale, p_type AS lead
    FROM part""",
)
def clean_text(spark, folder):
    name, brand, size = F.col("p_name"), F.col("p_brand"), digits("p_size")
    return table(spark, folder, "part").select(
        "p_partkey",
        text.po_ref(F.concat(digits("p_partkey"), F.lit("-"), brand)).alias("po"),
        text.po_ref(F.nullif(name, name)).alias("po_missing"),
        text.po_ref(F.regexp_replace(name, ".", "")).alias("po_blank"),
        text.clean_id("p_name").alias("packed"),
        text.squeeze_id(F.concat(F.lit(" "), name, F.lit("\t"))).alias("squeezed"),
        text.contains_flag("p_name", ["red", "hot"]).alias("flagged"),
        text.drop_leading("p_brand", "Brand#").alias("brand_nbr"),
        text.count_after_colon(F.concat(F.col("p_type"), F.lit(": "), size, F.lit("X"))).alias("counted"),
        text.scale_after_at(F.concat(name, F.lit("@"), size, F.lit("@ "), brand, F.lit(" "))).alias("scale"),
        text.before(F.concat(F.col("p_type"), F.lit(":"), name), ":").alias("lead"),
    )


@case(
    "q_numeric_code",
    f"""SELECT p_partkey, {z('p_size', 4)} AS whole, {z('p_size', 2)} AS as_float, p_brand AS coded FROM part""",
)
def numeric_code(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        text.numeric_code(digits("p_size"), 4).alias("whole"),
        text.numeric_code(F.concat(digits("p_size"), F.lit(".0")), 2).alias("as_float"),
        text.numeric_code("p_brand", 4).alias("coded"),
    )


@case(
    "q_season_open",
    """SELECT o_orderkey, (CASE WHEN o_orderstatus = 'F' THEN 'SP-' ELSE 'FA-' END)
      || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS season,
      'sp-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS form_season FROM orders""",
)
def season_open(spark, folder):
    year = F.year("o_orderdate").cast("string")
    letter = F.when(F.col("o_orderstatus") == "F", "s").otherwise("f")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.season_from_open(letter, year).alias("season"),
        text.season_after_colon(F.concat(F.lit("A: SEASON: spring "), year, F.lit(" "))).alias("form_season"),
    )


@case(
    "q_po_prefix_alias",
    """SELECT c_custkey,
      CASE c_mktsegment WHEN 'BUILDING' THEN left(c_name, 8) WHEN 'MACHINERY' THEN left(c_name, 12) ELSE c_name END AS po,
      CASE c_mktsegment WHEN 'FURNITURE' THEN 'HOUSEHOLD' WHEN 'AUTOMOBILE' THEN 'MACHINERY' ELSE c_mktsegment END AS segment
    FROM customer""",
)
def po_prefix_alias(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        text.prefix_po("c_mktsegment", "c_name", {"BUILDING": 8, "MACHINERY": 12}).alias("po"),
        text.alias_name("c_mktsegment", {"FURNITURE": "HOUSEHOLD", "AUTOMOBILE": "MACHINERY"}).alias("segment"),
    )


@case(
    "q_dates",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed,
      CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS or_null,
      CAST(o_orderdate AS DATE) AS iso, CAST(o_orderdate AS DATE) AS as_day,
      CAST(CAST(o_orderdate AS DATE) - DATE '{AS_OF}' AS INTEGER) AS days_left FROM orders""",
)
def parse_dates(spark, folder):
    orders = table(spark, folder, "orders")
    us = F.date_format("o_orderdate", "M/d/yyyy")
    blanked = F.when(F.col("o_orderstatus") == "O", " ").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    iso = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return orders.select(
        "o_orderkey",
        dates.us_date(us).alias("parsed"),
        dates.us_date_or_null(blanked).alias("or_null"),
        dates.iso_date_prefix(iso).alias("iso"),
        dates.to_day("o_orderdate").alias("as_day"),
        dates.days_until(F.to_date("o_orderdate"), AS_OF).alias("days_left"),
    )


_DESC = """upper(p_name) || ' ' || (CASE p_size % 5 WHEN 0 THEN 'KS' WHEN 1 THEN 'KL' WHEN 2 THEN 'WS'
  WHEN 3 THEN 'WL' ELSE 'XX' END) || ' ' || p_type"""


@case(
    "q_category",
    f"""WITH d AS (
      SELECT p_partkey, {_DESC} AS descr,
        CASE p_brand WHEN 'Brand#1' THEN 'K' WHEN 'Brand#2' THEN 'W' ELSE '' END AS manual,
        CASE p_type WHEN 'ECONOMY' THEN 'MICROFIBER' WHEN 'SMALL' THEN 'POLY POLO' ELSE '' END AS grp
      FROM part),
    c AS (SELECT *, CASE WHEN contains(descr, ' KS ') OR contains(descr, ' KL ') THEN 'K'
        WHEN contains(descr, ' WS ') OR contains(descr, ' WL ') THEN 'W' ELSE '' END AS derived,
      CASE WHEN contains(descr, ' KL ') OR contains(descr, ' WL ') THEN 'L/S'
        WHEN contains(descr, ' WS ') OR contains(descr, ' KS ') THEN 'S/S' ELSE '' END AS slv FROM d),
    f AS (SELECT *, CASE WHEN manual <> '' THEN manual ELSE derived END AS cat FROM c)
    SELECT p_partkey, cat, slv, CASE WHEN grp = 'POLY POLO' THEN 'POLY KNITS' WHEN grp = 'MICROFIBER' THEN 'MICROFIBER'
      WHEN cat = 'K' THEN 'OTHER KNITS' WHEN cat = 'W' THEN 'OTHER WOVEN' ELSE '' END AS rm_group FROM f""",
)
def category(spark, folder):
    mark = F.element_at(F.array(*[F.lit(m) for m in ("KS", "KL", "WS", "WL", "XX")]), F.col("p_size") % 5 + 1)
    brand, kind = F.col("p_brand"), F.col("p_type")
    described = table(spark, folder, "part").select(
        "p_partkey",
        F.concat_ws(" ", F.upper("p_name"), mark, "p_type").alias("descr"),
        F.when(brand == "Brand#1", "K").when(brand == "Brand#2", "W").otherwise("").alias("manual"),
        F.when(kind == "ECONOMY", "MICROFIBER").when(kind == "SMALL", "POLY POLO").otherwise("").alias("grp"),
    )
    return described.select(
        "p_partkey",
        override(rules.category("descr"), "manual").alias("cat"),
        rules.sleeve("descr").alias("slv"),
        "grp",
    ).select("p_partkey", "cat", "slv", rules.rm_group("grp", "cat").alias("rm_group"))


_STATUS = """CASE WHEN SHIPPED_UNITS = 0 AND SHIP_ON_DATE IS NOT NULL AND BAL = 0 THEN 'DEACTIVE'
  WHEN SHIPPED_UNITS >= ORDERED_UNITS AND SHIP_ON_DATE IS NOT NULL THEN 'COMPLETE'
  WHEN BAL > 0 AND SHIP_ON_DATE IS NOT NULL THEN 'PARTIAL'"""


@case(
    "q_order_status",
    f"""{with_clause(ORDER_LINES)} SELECT GREEN_BAR, STYLE, COLOR,
      CASE WHEN UNCONFIRMED = '*' THEN 1 ELSE 0 END AS unconfirmed,
      {_STATUS} WHEN UNCONFIRMED = '*' THEN 'UNCONFIRMED' ELSE 'ACTIVE' END AS status,
      {_STATUS} ELSE 'ACTIVE' END AS status_gen1 FROM ol""",
)
def order_status(spark, folder):
    lines = order_lines(spark, folder)
    flagged = lines.withColumn("UNCONFIRMED", rules.unconfirmed_flag("UNCONFIRMED"))
    return flagged.select(
        "GREEN_BAR",
        "STYLE",
        "COLOR",
        F.col("UNCONFIRMED").alias("unconfirmed"),
        rules.order_status().alias("status"),
        rules.order_status(generation=1).alias("status_gen1"),
    )


@case(
    "q_regex_valid",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' OR regexp_matches(p_brand, '^Brand#[0-9]{2}$') THEN 1 ELSE 0 END AS valid,
      CASE WHEN p_size < 10 THEN 0 ELSE 1 END AS container_ok FROM part""",
)
def regex_valid(spark, folder):
    number = F.concat(F.lit("ABCD"), F.lpad(digits("p_size"), 7, "0"))
    broken = F.when(F.col("p_size") < 10, F.lower(number)).when(F.col("p_size") > 40, "AIR").otherwise(number)
    return table(spark, folder, "part").select(
        "p_partkey",
        text.matches_or_exempt("p_brand", "^Brand#[0-9]{2}$", ["Brand#1"]).cast("int").alias("valid"),
        text.valid_container(broken).cast("int").alias("container_ok"),
    )


@case(
    "q_amounts",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, (l_extendedprice + l_tax) * l_quantity AS line_amt,
      CASE WHEN l_returnflag = 'N' THEN 0.0::DOUBLE ELSE (l_discount + l_tax) * l_quantity END AS free_amt,
      greatest(l_discount, l_tax) AS larger, CASE WHEN l_returnflag = 'N' THEN 0.0::DOUBLE ELSE l_discount END AS filled
    FROM lineitem""",
)
def amounts(spark, folder):
    free = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        line_amount("l_extendedprice", "l_tax", "l_quantity").alias("line_amt"),
        duty_free_amount(free, "l_tax", "l_quantity").alias("free_amt"),
        row_max("l_discount", "l_tax").alias("larger"),
        fill(free, 0.0).alias("filled"),
    )


_QTY = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
_LONG_QTY = f"CASE WHEN l_linenumber = 2 THEN '12345678' || lpad({_QTY}, 2, '0') ELSE {_QTY} END"
_SCALE_DESC = f"""(CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'x' ELSE {_LONG_QTY} END) || '/' || l_returnflag
  || ' junk ' || l_linenumber || '/' || l_linestatus || repeat(' 2/M', l_linenumber)"""


def _long_quantity():
    """Quantity of a line; second lines have ten digits."""
    q = digits(F.col("l_quantity").cast("int"))
    return F.when(F.col("l_linenumber") == 2, F.concat(F.lit("12345678"), F.lpad(q, 2, "0"))).otherwise(q)


def _scale_desc():
    first = F.when(
        (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R"), "x"
    ).otherwise(_long_quantity())
    return F.concat(
        first, F.lit("/"), F.col("l_returnflag"), F.lit("  junk "), digits("l_linenumber"), F.lit("/"),
        F.col("l_linestatus"), F.repeat(F.lit(" 2/M"), F.col("l_linenumber")),
    )


_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@case(
    "q_parse_scale",
    f"""WITH t AS (SELECT {_LINE}, {_SCALE_DESC} AS descr FROM lineitem),
    p AS (SELECT *, list_filter(string_split(descr, ' '), lambda x: contains(x, '/')) AS toks FROM t),
    q AS (SELECT *, CASE WHEN starts_with(descr, 'x') THEN 'quantity is not a whole number'
      WHEN len(toks) > 8 THEN 'more than eight sizes' END AS problem FROM p)
    SELECT {_LINE}, problem,
      {', '.join(f"CASE WHEN problem IS NULL THEN coalesce(split_part(toks[{i}], '/', 2), 'NONE') END AS S{i}_SIZE" for i in range(1, 9))},
      {', '.join(f"CASE WHEN problem IS NULL THEN coalesce(TRY_CAST(split_part(toks[{i}], '/', 1) AS BIGINT), 0) END AS S{i}_QTY" for i in range(1, 9))}
    FROM q""",
)
def parse_scale(spark, folder):
    parsed = table(spark, folder, "lineitem").select(*_LINE.split(", "), nested.parse_scale(_scale_desc()).alias("s"))
    return parsed.select(
        *_LINE.split(", "),
        F.col("s.error").alias("problem"),
        *nested.fold_to_columns("s.sizes", buckets("S", "_SIZE")),
        *nested.fold_to_columns("s.quantities", buckets("S", "_QTY")),
    )


@case(
    "q_align_curve",
    f"""WITH t AS (SELECT {_LINE}, CAST({_LONG_QTY} AS BIGINT) AS q, l_returnflag AS rf, l_linestatus AS ls FROM lineitem)
    SELECT {_LINE}, CAST(CASE WHEN rf = 'A' THEN l_linenumber ELSE 0 END AS BIGINT) AS s1, CASE WHEN rf = 'N' THEN q ELSE 0 END AS s2,
      CASE WHEN rf = 'R' THEN q ELSE 0 END AS s3, CAST(CASE WHEN ls = 'F' THEN l_linenumber ELSE 0 END AS BIGINT) AS s4,
      CAST(CASE WHEN ls = 'O' THEN l_linenumber ELSE 0 END AS BIGINT) AS s5, CAST(0 AS BIGINT) AS s6, CAST(0 AS BIGINT) AS s7, CAST(0 AS BIGINT) AS s8,
      CASE WHEN rf = 'A' THEN 0 ELSE 1 END AS adds_up
    FROM t""",
)
def align_curve(spark, folder):
    # the size of a returned line is named again: the later quantity counts
    q, ln = _long_quantity(), digits("l_linenumber")
    again = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("-"), ln, F.lit("/A"))).otherwise("")
    curve = F.concat(
        q, F.lit("/ "), F.lower("l_returnflag"), F.lit(" - "), ln, F.lit("/"), F.col("l_linestatus"), again
    )
    sizes = [F.lit(s) for s in ("A", "N", "R", "F", "O", "", "", "")]
    labels = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), nested.range_labels(sizes).alias("labels")
    )
    sizes = (
        table(spark, folder, "lineitem")
        .withColumn("curve", nested.curve_map(curve))
        .join(labels, "l_partkey")
        .withColumn("v", nested.align_curve("curve", "labels"))
    )
    wanted = _long_quantity().cast("long") + F.col("l_linenumber")
    same = F.col("l_returnflag") != "A"
    return sizes.select(
        *_LINE.split(", "),
        *nested.fold_to_columns("v", [b.lower() for b in buckets()]),
        (same & (nested.placed_total("v") == wanted)).cast("int").alias("adds_up"),
    )


@case(
    "q_prepack",
    """WITH t AS (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS ttl FROM lineitem GROUP BY l_partkey),
    p AS (SELECT p_partkey, coalesce(ttl, 0) AS ttl, p_size, p_size % 3 AS extra, p_size + p_size % 3 AS pack
      FROM part LEFT JOIN t ON p_partkey = l_partkey)
    SELECT p_partkey, ttl, CAST(pack AS BIGINT) AS pack, CASE WHEN ttl % pack = 0 THEN CAST(ttl // pack AS BIGINT) END AS packs,
      CASE WHEN ttl % pack = 0 THEN CAST(ttl // pack * p_size AS BIGINT) END AS s_qty,
      CASE WHEN ttl % pack = 0 THEN CAST(ttl // pack * extra AS BIGINT) END AS m_qty FROM p""",
)
def prepack(spark, folder):
    totals = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("ttl"))
    )
    text_of = F.concat(digits("p_size"), F.lit("/S "), digits(F.col("p_size") % 3), F.lit("/M"))
    packed = (
        table(spark, folder, "part")
        .join(totals, "p_partkey", "left")
        .withColumn("ttl", fill("ttl", 0))
        .withColumn("scale", nested.scale_map(text_of))
        .withColumn("pack", nested.pack_size("scale"))
        .withColumn("packs", pack_count("ttl", "pack"))
        .withColumn("curve", nested.explode_prepack("scale", "packs"))
    )
    return packed.select(
        "p_partkey", "ttl", "pack", "packs", F.col("curve")["S"].alias("s_qty"), F.col("curve")["M"].alias("m_qty")
    )
