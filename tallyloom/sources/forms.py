"""Purchase-order forms as cell tables ``(file, row, col, value)``.

A form is a sheet whose fields sit at fixed cells. Cells arrive in long
form, so one scan serves any number of files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, scale_after_at

# fixed values: (row, column) of the header fields
HEADER_CELLS = {
    "hfc_nbr": (2, 2),
    "season_text": (2, 7),
    "customer_text": (2, 10),
    "scale_text": (3, 7),
    "kind_text": (3, 10),
    "div": (6, 2),
    "carton_text": (8, 11),
    "knit_box": (8, 16),
    "woven_box": (9, 16),
    "x_orient": (10, 2),
    "agent": (11, 16),
    "ship_date": (12, 2),
    "maker": (13, 16),
    "coo": (17, 15),
}

# fixed values: first body row and the body columns
BODY_ROW = 22
BODY_COLUMNS = {
    "style": 0,
    "asst": 2,
    "style_desc": 3,
    "proto": 7,
    "color_code": 8,
    "ttl_qty": 9,
    "size_curve": 10,
    "fob": 13,
    "msrp": 15,
    "elc": 16,
    "sp": 17,
}


def _at(row: int, col: int) -> Column:
    return (F.col("row") == row) & (F.col("col") == col)


def header_cells(cells: DataFrame, layout: Mapping[str, tuple[int, int]] = HEADER_CELLS) -> DataFrame:
    """One row per form with the cells at fixed places."""
    rows = {r for r, _ in layout.values()}
    wanted = cells.filter(F.col("row").isin(*rows))
    fields = [F.max(F.when(_at(r, c), F.col("value"))).alias(name) for name, (r, c) in layout.items()]
    return wanted.groupBy("file").agg(*fields)


def _sheet_rows(cells: DataFrame, columns: Mapping[str, int]) -> DataFrame:
    """One row per body row of each form, and one without a number for what stands above the body.

    ``_used`` counts the rows down to this one whose leading cell is not
    blank; ``_leading`` marks those before the first blank one. Cells are
    summed up before rows meet, and all that follows is partitioned by form.
    """
    inside = F.col("row") >= BODY_ROW
    known = cells.filter(F.col("file").isNotNull())
    fields = [F.max(F.when(F.col("col") == c, F.col("value"))).alias(n) for n, c in columns.items()]
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    sheet = [F.max("row").alias("_last"), flag(_names_scale()).alias("_mixed")]
    body = known.filter(inside).groupBy("file", "row").agg(
        *fields,
        *sheet,
        flag((F.col("col") == 0) & ~is_blank("value")).alias("_filled"),
        flag(F.col("col").isin(*columns.values())).alias("_line"),
    )
    # only numbers are summed here, which needs no sort
    above = known.filter(~F.coalesce(inside, F.lit(False))).groupBy("file").agg(*sheet)
    rows = body.unionByName(above, allowMissingColumns=True)
    down = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.withColumn("_used", F.sum("_filled").over(down))
    leading = (F.col("_filled") == 1) & (F.col("_used") == F.col("row") - (BODY_ROW - 1))
    return counted.withColumn("_leading", F.coalesce(leading, F.lit(False)).cast("int"))


def body_end(cells: DataFrame) -> DataFrame:
    """First body row whose leading cell is blank, and the last row of the form.

    ``ended`` is false for forms that never reach a blank row.
    """
    ends = _sheet_rows(cells, {}).groupBy("file").agg(
        F.sum("_leading").alias("_n"), F.max("_last").alias("last_row")
    ).filter(F.col("last_row").isNotNull())
    end = (F.col("_n") + BODY_ROW).cast(cells.schema["row"].dataType)
    return ends.select("file", end.alias("end_row"), (end <= F.col("last_row")).alias("ended"))


def body_lines(cells: DataFrame, columns: Mapping[str, int] = BODY_COLUMNS) -> DataFrame:
    """Body rows of every form that ends properly, one column per field."""
    return marked_lines(cells, columns).drop("mixed")


def marked_lines(cells: DataFrame, columns: Mapping[str, int] = BODY_COLUMNS) -> DataFrame:
    """Body rows as in :func:`body_lines`; ``mixed`` as :func:`mixed_forms` has it."""
    whole = Window.partitionBy("file")
    rows = _sheet_rows(cells, columns).withColumns(
        {
            "_n": F.sum("_leading").over(whole),
            "_end": F.max("_last").over(whole),
            "mixed": F.max("_mixed").over(whole) == 1,
        }
    )
    ended = F.col("_n") + BODY_ROW <= F.col("_end")
    return rows.filter((F.col("_leading") == 1) & (F.col("_line") == 1) & ended).select("file", "row", *columns, "mixed")


def _names_scale() -> Column:
    return (F.col("col") == 3) & F.col("value").contains("@")


def mixed_forms(cells: DataFrame) -> DataFrame:
    """Forms that name a scale behind ``@`` in any description cell."""
    return cells.filter(_names_scale()).select("file").distinct()


def named_scales(cells: DataFrame) -> DataFrame:
    """Scales that description cells name, once each."""
    return cells.filter(_names_scale()).select(scale_after_at("value").alias("scale_code")).distinct()
