"""Customer orders: clean, impute ship dates, classify, load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import dates, rules, text
from ..functions.amounts import buckets
from ..operators.compare import active_orders, live, ne_or_null, open_kind
from ..operators.mutate import (
    Scope,
    apply_corrections,
    require_keys,
    scope_values,
    update_where,
    upsert_soft_delete,
)

LINE_KEY = ["GREEN_BAR", "STYLE", "COLOR"]
_CARRIED = [
    "DIV", "CUST_NBR", "ORDER_DATE", "START_SHIP", "CXL_SHIP", "CUST_PO", "SEASON", "SP",
    "ORDERED_UNITS", "SHIPPED_UNITS", "PICK_UNITS", "SHIP_ON_DATE", "UNCONFIRMED", "COMMENT",
]
_KIND = "_kind"


def clean_orders(raw: DataFrame, generation: int = 3) -> DataFrame:
    """Normalise the order extract; ``FILE`` and other columns pass through.

    Generation 2 feeds carry ISO dates, the others month/day/year.
    """
    if generation == 2:
        due = shipped = dates.iso_date_prefix
        ship_date = shipped(F.nullif(F.col("SHIP_ON_DATE"), F.lit("")))
    else:
        due = dates.us_date
        ship_date = dates.us_date_or_null("SHIP_ON_DATE")
    return raw.withColumns(
        {
            "CUST_NBR": text.zfill("CUST_NBR", 5),
            "CUST_PO": text.zfill("CUST_PO", 6),
            "ORDER_DATE": due("ORDER_DATE"),
            "START_SHIP": due("START_SHIP"),
            "CXL_SHIP": due("CXL_SHIP"),
            "SHIP_ON_DATE": ship_date,
            "SEASON": text.season_code("SEASON"),
            "UNCONFIRMED": rules.unconfirmed_flag("UNCONFIRMED", generation),
            "STYLE": text.zfill("STYLE", 6),
            "COLOR": text.zfill("COLOR", 3),
        }
    )


def clean_open_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"STYLE": text.zfill("STYLE", 6), "COLOR": text.zfill("COLOR", 3)})


def impute_ship_date(
    lines: DataFrame,
    as_of: dt.date | str,
    group: str = "FILE",
    green_bar_customers: Sequence[str] = params.GREEN_BAR_CUSTOMERS,
    due_within: int = params.DUE_WITHIN_DAYS,
) -> DataFrame:
    """Give due, untouched lines the latest ship date of their purchase order.

    Some customers are looked up by order number instead. Both look-ups share
    one aggregation and one join: every line carries the kind of reference it
    uses, and shipped lines are summed up under both kinds. Dates are looked
    up per ``group`` (the input file). Lines that are not due keep their date
    and are not shuffled for the look-up.
    """
    shipped = (
        lines.filter((F.col("SHIPPED_UNITS") > 0) & F.col("SHIP_ON_DATE").isNotNull())
        .select(
            group,
            "SHIP_ON_DATE",
            F.explode(
                F.array(
                    F.struct(F.lit("PO").alias("kind"), F.col("CUST_PO").alias("ref")),
                    F.struct(F.lit("ORDER").alias("kind"), F.col("GREEN_BAR").alias("ref")),
                )
            ).alias("r"),
        )
        .groupBy(group, F.col("r.kind").alias("_kind"), F.col("r.ref").alias("_ref"))
        .agg(F.max("SHIP_ON_DATE").alias("_shipped_on"))
    )
    by_order = F.coalesce(F.col("CUST_NBR").isin(*green_bar_customers), F.lit(False))
    due = (
        (dates.days_until("CXL_SHIP", as_of) <= due_within)
        & (F.col("PICK_UNITS") == 0)
        & F.col("SHIP_ON_DATE").isNull()
    )
    due = F.coalesce(due, F.lit(False))
    referenced = lines.filter(due).withColumns(
        {
            "_kind": F.when(by_order, "ORDER").otherwise("PO"),
            "_ref": F.when(by_order, F.col("GREEN_BAR")).otherwise(F.col("CUST_PO")),
        }
    )
    filled = referenced.join(shipped, [group, "_kind", "_ref"], "left").withColumn("SHIP_ON_DATE", F.col("_shipped_on"))
    return lines.filter(~due).unionByName(filled.select(*lines.columns))


def impute_ship_date_by_order(lines: DataFrame, group: str = "FILE") -> DataFrame:
    """Generation 2: every line takes the latest ship date of its order number.

    The older feed repeated a line once per distinct date, which breaks the
    line key when an order has several; the latest date is used instead.
    """
    latest = lines.groupBy(group, "GREEN_BAR").agg(F.max("SHIP_ON_DATE").alias("_shipped_on"))
    return (
        lines.join(latest, [group, "GREEN_BAR"], "left")
        .withColumn("SHIP_ON_DATE", F.col("_shipped_on"))
        .select(*lines.columns)
    )


def open_balances(open_orders: DataFrame) -> DataFrame:
    """Open-order extract reduced to the key, balance, kind and size break."""
    return require_keys(open_orders, LINE_KEY, "open orders").select(
        *LINE_KEY,
        F.col("BAL").alias("_bal"),
        open_kind("SHIPPED", "BAL").alias(_KIND),
        *[F.col(b).alias(f"_{b}") for b in buckets()],
    )


def load_orders(
    state: DataFrame,
    orders: DataFrame,
    open_orders: DataFrame,
    generation: int = 3,
    seasons: DataFrame | None = None,
) -> DataFrame:
    """New order table after one snapshot of orders and open orders.

    Order of effects: upsert with season-scoped soft delete, size break of
    untouched lines to ordered and balance, of started lines to balance, and
    last the zero balance of closed lines. The open orders are joined to both
    sides on the line key before the upsert, so each input is shuffled once
    and the follow-up updates are expressions.

    ``seasons`` may name a cheaper frame that lists the seasons of the feed.
    """
    balances = open_balances(open_orders)
    sizes = [f"_{b}" for b in buckets()]
    status = rules.order_status(balance="_bal0", generation=generation)
    source = (
        orders.join(balances, LINE_KEY, "left")
        .withColumn("_bal0", F.coalesce("_bal", F.lit(0)))
        .withColumn("COMMENT", status)
    )
    current = state.join(balances.drop("_bal"), LINE_KEY, "left")
    helpers = {c: c for c in [_KIND, *sizes]}
    zero = [] if generation == 1 else ["BAL_UNITS", *buckets("BAL_S")]
    merged = upsert_soft_delete(
        current,
        source,
        LINE_KEY,
        {**{c: c for c in _CARRIED}, "BAL_UNITS": "_bal0", **helpers},
        zero=zero,
        scope=Scope("SEASON", orders if seasons is None else seasons, "SEASON"),
    )
    closed = ["COMPLETE"] if generation == 1 else ["COMPLETE", "DEACTIVE"]
    full = F.col(_KIND) == "full"
    opened = F.col(_KIND).isin("full", "partial")
    merged = update_where(merged, full, {o: F.col(s) for o, s in zip(buckets("ORDERED_S"), sizes)})
    merged = update_where(merged, opened, {b: F.col(s) for b, s in zip(buckets("BAL_S"), sizes)})
    merged = update_where(
        merged, F.col("COMMENT").isin(*closed), {b: F.lit(0) for b in buckets("BAL_S")}
    )
    return merged.select(*state.columns)


def touched_seasons(state: DataFrame, orders: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Seasons whose rows a load can change; the others need no rewrite.

    Seasons of the feed, old seasons of lines the feeds mention, and seasons
    holding closed lines whose balance is not zero yet; one row each.
    """
    mentioned = orders.select(*LINE_KEY).unionByName(open_orders.select(*LINE_KEY))
    moved = state.select("SEASON", *LINE_KEY).join(mentioned, LINE_KEY, "left_semi")
    balance = F.greatest(*[F.coalesce(F.abs(b), F.lit(1)) for b in buckets("BAL_S")])
    unsettled = state.filter(F.col("COMMENT").isin("COMPLETE", "DEACTIVE") & (balance > 0))
    named = (
        orders.select("SEASON")
        .unionByName(moved.select("SEASON"))
        .unionByName(unsettled.select("SEASON"))
    )
    return scope_values(named, "SEASON")


def upfront_offprice(
    orders: DataFrame,
    details: DataFrame,
    headers: DataFrame,
    customers: DataFrame,
    seasons: Sequence[str] | None = params.ORDER_SEASONS,
    prefix_lengths: Mapping[str, int] = params.PO_PREFIX_LENGTHS,
    aliases: Mapping[str, str] = params.CUSTOMER_ALIASES,
    excluded_div: int | None = params.EXCLUDED_DIV,
) -> DataFrame:
    """Verdict per purchase order: UPFRONT when every style on it was bought
    for the same customer, else OFFPRICE.

    A style on the order matches when (style, customer) is among the pairs of
    the purchase-order lines; asking for the pair, rather than listing all
    customers of a style, keeps one row per (order, style, customer).
    """
    po = text.prefix_po("CUST_NBR", "CUST_PO", prefix_lengths)
    named = customers.select("CUST_NBR", text.alias_name("CUST_NAME", aliases).alias("_name"))
    wanted = (
        active_orders(orders, seasons)
        .select("STYLE", "CUST_NBR", po.alias("CUST_PO"))
        .distinct()
        .join(named, "CUST_NBR")
        .select("CUST_PO", "STYLE", "_name")
        .distinct()
    )
    bought_for = headers if excluded_div is None else headers.filter(F.col("DIV") != excluded_div)
    bought = (
        live(details)
        .select("HFC_NBR", "STYLE")
        .join(bought_for.select("HFC_NBR", "CUST_NBR"), "HFC_NBR")
        .select("STYLE", "CUST_NBR")
        .distinct()
        .join(named, "CUST_NBR")
        .select("STYLE", "_name")
        .distinct()
        .withColumn("_match", F.lit(1))
    )
    return (
        wanted.join(bought, ["STYLE", "_name"], "left")
        .groupBy("CUST_PO", "STYLE")
        .agg(F.max(F.coalesce("_match", F.lit(0))).alias("_match"))
        .groupBy("CUST_PO")
        .agg(F.min("_match").alias("_match"))
        .select("CUST_PO", F.when(F.col("_match") == 1, "UPFRONT").otherwise("OFFPRICE").alias("COMMENT_2"))
    )


def mark_upfront(
    orders: DataFrame,
    details: DataFrame,
    headers: DataFrame,
    customers: DataFrame,
    seasons: Sequence[str] | None = params.ORDER_SEASONS,
    prefix_lengths: Mapping[str, int] = params.PO_PREFIX_LENGTHS,
    **kwargs,
) -> DataFrame:
    """Write the verdict to the active lines of the seasons; others keep theirs.

    The line's own attributes decide whether it is updated, so the verdict is
    joined by purchase order and the table needs no second join on its key.
    """
    verdict = upfront_offprice(orders, details, headers, customers, seasons, prefix_lengths, **kwargs)
    active = (F.col("CXL") == 0) & (F.col("COMMENT") != "DEACTIVE")
    if seasons is not None:
        active = active & F.col("SEASON").isin(*seasons)
    po = text.prefix_po("CUST_NBR", "CUST_PO", prefix_lengths)
    marked = orders.withColumn("_po", po)
    found = verdict.select(F.col("CUST_PO").alias("_po"), F.col("COMMENT_2").alias("_verdict"))
    return update_where(
        marked.join(found, "_po", "left"), active, {"COMMENT_2": F.col("_verdict")}
    ).select(*orders.columns)


def mark_offprice_by_season(
    orders: DataFrame,
    styles: DataFrame,
    details: DataFrame,
    headers: DataFrame,
    exempt: Sequence[str] = params.OFFPRICE_EXEMPT_CUSTOMERS,
    corrections: Sequence[tuple[Mapping, Mapping]] = params.OFFPRICE_CORRECTIONS,
) -> DataFrame:
    """Generation 2 rule: off-price when the order's season is not the style's
    season, or nothing was bought for the style and customer.

    A style without a known season is off-price. Manual fixes come last.
    """
    seasons = require_keys(styles.select("STYLE", F.col("SEASON").alias("_style_season")), ["STYLE"], "styles")
    bought = (
        live(details)
        .select("HFC_NBR", "STYLE")
        .join(headers.select("HFC_NBR", "CUST_NBR", "SEASON"), "HFC_NBR")
        .groupBy("STYLE", "CUST_NBR")
        .agg(F.min(F.col("SEASON").isNotNull().cast("int")).alias("_bought"))
    )
    marked = orders.join(seasons, "STYLE", "left").join(bought, ["STYLE", "CUST_NBR"], "left")
    offprice = ne_or_null("SEASON", "_style_season") | (
        (F.coalesce("_bought", F.lit(0)) == 0) & ~F.col("CUST_NBR").isin(*exempt)
    )
    active = (F.col("CXL") == 0) & (F.col("COMMENT") != "DEACTIVE")
    verdict = F.when(offprice, "OFFPRICE").otherwise("UPFRONT")
    done = update_where(marked, active, {"COMMENT_2": verdict}).select(*orders.columns)
    return apply_corrections(done, corrections)
