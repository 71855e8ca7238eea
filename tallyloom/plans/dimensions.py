"""Customers, size ranges, size scales and styles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nested, rules, text
from ..functions.amounts import bucket_sum, buckets, fill, override
from ..operators.checks import all_exceptions, attribute_conflict, exception_rows, hold_back
from ..operators.compare import ne_or_null
from ..operators.mutate import upsert, upsert_soft_delete
from ..operators.shape import unpivot_pairs
from ..schemas import KEYS
from . import Load, held_keys

_STYLE_SET = {
    **{
        c: c
        for c in (
            "STYLE_DESC", "DIV", "PROTO", "SLV", "SEASON", "CAT", "INV_GROUP", "BUY_GROUP_MAIN",
            "BUY_GROUP_SUB", "RM_GROUP", "SP", "ELC", "ILC", "BRAND_NAME", "FABRIC", "RESERVE",
            "ROYALTY", "PPK",
        )
    },
    "SIZE_RANGE_CODE": "SIZE_RANGE",
    "LABEL_CODE": "LABEL",
    "REG_BT": "SIZE",
}


def load_customers(state: DataFrame, feed: DataFrame) -> Load:
    source = feed.withColumn("CUST_NBR", text.zfill("CUST_NBR", 5))
    new = upsert(
        state, source, ["CUST_NBR"], {"CUST_NAME": "CUST_NAME", "AD_PCT": "AD", "LOAD_PCT": "LOAD"}
    )
    return Load({"CUSTOMER": new})


def load_size_ranges(state: DataFrame, feed: DataFrame) -> Load:
    """Columns are taken by position; blank labels become the empty text."""
    names = ["SIZE_RANGE_CODE", *buckets()]
    source = feed.toDF(*names).na.fill("")
    return Load({"SIZE_RANGE": upsert(state, source, names[:1], {b: b for b in names[1:]})})


def parse_size_scales(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sheet of repeated column pairs -> (parsed scales, unreadable scales)."""
    pairs = unpivot_pairs(sheet).withColumn(
        "SIZE_SCALE_CODE", text.numeric_code("SIZE_SCALE_CODE", 2)
    )
    parsed = pairs.withColumn("_scale", nested.parse_scale("DESCRIPTION"))
    good = parsed.filter(F.col("_scale.error").isNull()).select(
        "SIZE_SCALE_CODE",
        "DESCRIPTION",
        *nested.fold_to_columns("_scale.sizes", buckets("S", "_SIZE")),
        *nested.fold_to_columns("_scale.quantities", buckets("S", "_QTY")),
    )
    bad = parsed.filter(F.col("_scale.error").isNotNull()).select(
        "SIZE_SCALE_CODE", "DESCRIPTION", F.col("_scale.error").alias("ERROR")
    )
    return good, bad


def load_size_scales(state: DataFrame, sheet: DataFrame) -> Load:
    good, bad = parse_size_scales(sheet)
    new = upsert(
        state,
        good,
        ["SIZE_SCALE_CODE"],
        {
            "SIZE_SCALE_DESC": "DESCRIPTION",
            **{c: c for c in [*buckets("S", "_SIZE"), *buckets("S", "_QTY")]},
        },
    )
    reported = exception_rows(bad, "size_scale_text", ["SIZE_SCALE_CODE"], F.col("ERROR"), actual="DESCRIPTION")
    # unreadable scales never enter the new state, so quarantine has nothing to take out of it
    return Load(
        {"SIZE_SCALE": new}, reported, without=lambda checks: {}, held=lambda checks: bad.select("SIZE_SCALE_CODE").distinct()
    )


def classify_styles(feed: DataFrame, overrides: DataFrame) -> DataFrame:
    """Style extract with derived and manual attributes side by side."""
    derived = feed.withColumns(
        {
            "STYLE": text.zfill("STYLE", 6),
            "SEASON": text.season_from_open("OPEN_SSN", "OPEN_YR"),
            "CAT": rules.category("STYLE_DESC"),
            "SLV": rules.sleeve("STYLE_DESC"),
        }
    )
    manual = overrides.withColumn("STYLE", text.zfill("STYLE", 6))
    return derived.join(manual, "STYLE", "left").withColumns(
        {c: fill(c, "") for c in ("CAT_2", "SLV_2", "INV_GROUP", "BUY_GROUP_MAIN", "BUY_GROUP_SUB")}
    )


def finish_styles(classified: DataFrame) -> DataFrame:
    """Manual attributes win; the material group follows from the result."""
    final = classified.withColumns({"CAT": override("CAT", "CAT_2"), "SLV": override("SLV", "SLV_2")})
    return final.withColumn("RM_GROUP", rules.rm_group("INV_GROUP", "CAT"))


def season_conflicts(styles: DataFrame, details: DataFrame, headers: DataFrame) -> DataFrame:
    """Styles bought in another season than the one they are opened in."""
    bought = (
        details.select("HFC_NBR", "STYLE")
        .join(headers.select("HFC_NBR", F.col("SEASON").alias("HFC_SSN")), "HFC_NBR")
        .select("STYLE", "HFC_SSN")
        .distinct()
    )
    opened = styles.select("STYLE", F.col("SEASON").alias("STYLE_SSN"))
    return bought.join(opened, "STYLE", "left").filter(ne_or_null("HFC_SSN", "STYLE_SSN"))


def load_styles(
    state: DataFrame,
    feed: DataFrame,
    overrides: DataFrame,
    details: DataFrame | None = None,
    headers: DataFrame | None = None,
) -> Load:
    classified = classify_styles(feed, overrides)
    new = upsert_soft_delete(state, finish_styles(classified), ["STYLE"], _STYLE_SET)
    offending = {
        f"style_{name.lower()}": attribute_conflict(classified, name, f"{name}_2") for name in ("CAT", "SLV")
    }
    found = [
        exception_rows(
            offending[f"style_{name.lower()}"],
            f"style_{name.lower()}",
            ["STYLE"],
            "manual list and description disagree",
            expected=f"{name}_2",
            actual=name,
        )
        for name in ("CAT", "SLV")
    ]
    if details is not None and headers is not None:
        offending["style_season"] = season_conflicts(new, details, headers)
        found.append(
            exception_rows(
                offending["style_season"],
                "style_season",
                ["STYLE"],
                "bought in another season",
                expected="STYLE_SSN",
                actual="HFC_SSN",
            )
        )

    def without(checks):
        held = held_keys(offending, checks, KEYS["STYLE_MASTER"])
        return {} if held is None else {"STYLE_MASTER": hold_back(state, new, held, KEYS["STYLE_MASTER"])}

    return Load({"STYLE_MASTER": new}, all_exceptions(found), without=without)


def scale_totals(scales: DataFrame) -> DataFrame:
    """Pieces per carton of each scale."""
    return scales.select("SIZE_SCALE_CODE", bucket_sum(buckets("S", "_QTY")).alias("TTL_QTY"))


def style_labels(styles: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ordered size labels of each style."""
    labels = ranges.select("SIZE_RANGE_CODE", nested.range_labels(buckets()).alias("labels"))
    return styles.select("STYLE", "SIZE_RANGE_CODE").join(labels, "SIZE_RANGE_CODE").select("STYLE", "labels")
