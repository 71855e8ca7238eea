"""Purchase-order forms -> headers and lines with their size curve in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, nested, rules, text
from ..functions.amounts import buckets, pack_count
from ..operators.checks import Rule, all_exceptions, exception_rows, stacked_exceptions, with_reference
from ..session import stage
from ..sources.forms import body_end, header_cells, marked_lines, named_scales

# fixed values: texts that mark a web-shop order
ECOM_MARKS = ("E-COM", "ECOM", ".COM")


def form_headers(cells: DataFrame) -> DataFrame:
    """One header per form, with its kind (BULK, PPK, or NULL when unclear)."""
    raw = header_cells(cells)
    return raw.select(
        "file",
        text.zfill("hfc_nbr", 6).alias("hfc_nbr"),
        text.whole_number("div").alias("div"),
        dates.to_day("ship_date").alias("ship_date"),
        dates.to_day("x_orient").alias("x_orient"),
        rules.knit_or_woven("knit_box", "woven_box").alias("cat"),
        text.before("customer_text", ":").alias("cust_nbr"),
        text.contains_flag("customer_text", ECOM_MARKS).alias("is_ecom"),
        "agent",
        "maker",
        "coo",
        text.season_after_colon("season_text").alias("ssn"),
        text.count_after_colon("carton_text").alias("carton_size"),
        text.before("scale_text", "/").alias("hfc_size_scale_code"),
        rules.bulk_or_prepack("scale_text", "kind_text").alias("kind"),
    )


def _used_scales(cells: DataFrame, headers: DataFrame, scales: DataFrame) -> DataFrame:
    """Scales that forms can refer to, written once.

    Most forms share a few scales. Where these are few, Spark sees it from the
    written table and the lines need no shuffle by scale, which would send
    nearly all of them to one task.
    """
    codes = headers.select(F.col("hfc_size_scale_code").alias("scale_code")).distinct().unionByName(named_scales(cells))
    by_code = scales.select(F.col("SIZE_SCALE_CODE").alias("scale_code"), "SIZE_SCALE_DESC")
    used = with_reference(by_code, codes, ["scale_code"])
    return stage(used.select("scale_code", nested.scale_map("SIZE_SCALE_DESC").alias("_scale")))


def _placed_lines(cells: DataFrame, headers: DataFrame, labels: DataFrame, scales: DataFrame) -> DataFrame:
    """Lines of bulk and prepack forms, their quantities at the places of the style's sizes."""
    prepack = F.col("kind") == "PPK"
    code = F.when(F.col("mixed"), text.scale_after_at("style_desc")).otherwise(F.col("hfc_size_scale_code"))
    packs = pack_count("ttl_qty", nested.pack_size("_scale"))
    curve = F.when(prepack, nested.explode_prepack("_scale", "_packs")).otherwise(nested.curve_map("size_curve"))
    problem = (
        F.when(prepack & F.col("_packs").isNull(), "not a whole number of packs")
        .when(F.col("labels").isNull(), "style has no size range")
        .when(F.col("curve").isNull(), "size curve is unreadable")
        .when(F.col("sizes").isNull(), "more than eight sizes")
    )
    named = headers.filter(F.col("kind").isin("BULK", "PPK")).select("file", "hfc_nbr", "kind", "hfc_size_scale_code")
    return (
        marked_lines(cells)
        .join(named, "file")
        .withColumn("ttl_qty", text.whole_number("ttl_qty"))
        .withColumn("scale_code", F.when(prepack, code))
        .join(_used_scales(cells, headers, scales), "scale_code", "left")
        .withColumn("_packs", F.when(prepack, packs))
        .withColumn("curve", curve)
        .join(labels.withColumnRenamed("STYLE", "style"), "style", "left")
        .withColumn("sizes", nested.align_curve("curve", "labels"))
        .withColumn("problem", problem)
        .withColumn("adds_up", (nested.placed_total("sizes") == F.col("ttl_qty")).cast("int"))
    )


def form_lines(
    cells: DataFrame, headers: DataFrame, labels: DataFrame, scales: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Lines of bulk and prepack forms with S1..S8, and the lines set aside.

    ``labels`` has the ordered sizes per STYLE, ``scales`` the table of size
    scales. A line set aside carries the reason in ``problem``.
    """
    placed = _placed_lines(cells, headers, labels, scales)
    keep = [
        "file", "hfc_nbr", "kind", "row", "style", "asst", "style_desc", "proto", "color_code",
        "ttl_qty", "fob", "msrp", "elc", "sp",
    ]
    good = placed.filter("problem is null").select(
        *keep, *nested.fold_to_columns("sizes", [b.lower() for b in buckets()]), "adds_up"
    )
    bad = placed.filter("problem is not null").select(*keep, "problem")
    return good, bad


def read_forms(
    cells: DataFrame, labels: DataFrame, scales: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, lines, exceptions) of all forms; unclear forms are set aside."""
    headers = form_headers(cells)
    good, _ = form_lines(cells, headers, labels, scales)
    place, line = ["file", "hfc_nbr"], ["file", "style", "color_code"]
    of_form = [
        Rule("form_kind", F.col("kind").isNull(), place, "bulk and prepack marks disagree"),
        Rule("form_category", F.col("cat").isNull(), place, "neither knit nor woven is ticked"),
    ]
    fine = F.col("problem").isNull()
    of_line = [
        Rule("form_line", ~fine, line, F.col("problem")),
        Rule("form_line_total", fine & (F.col("adds_up") == 0), line, "sizes do not add up", expected="ttl_qty"),
    ]
    found = [
        stacked_exceptions(headers, of_form),
        exception_rows(body_end(cells).filter("not ended"), "form_body", ["file"], "no blank row ends the lines"),
        stacked_exceptions(_placed_lines(cells, headers, labels, scales), of_line),
    ]
    return headers, good, all_exceptions(found)
