"""Delimited extracts: by position, by header, whole families, sheet exports."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shape import drop_last
from ..session import stage

Positions = Mapping[int, tuple[str, str]]

POSITION = ("_file", "_block", "_row")

#: Lines of a block that are put in order together.
SLICE_ROWS = 1_000_000


class MissingFeed(FileNotFoundError):
    """A mandatory feed has no file."""


def _guarded(load, what: str) -> DataFrame:
    """Turn Spark's missing-path error into a missing feed."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() and error.getCondition().startswith("PATH_NOT_FOUND"):
            raise MissingFeed(what) from error
        raise


def require_feed(spark: SparkSession, *paths: str) -> None:
    """Fail before any work when a mandatory feed is missing."""
    for path in paths:
        _guarded(lambda p=path: spark.read.text(p), path)


def _text_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def typed(c: Column, kind: str) -> Column:
    """Force a text cell to a type.

    Blank text cells are the empty text, blank numbers are null; a bad number
    stops the job.
    """
    if kind == "string":
        return F.coalesce(c, F.lit(""))
    if kind == "nullable string":
        return F.nullif(c, F.lit(""))
    return F.nullif(F.trim(c), F.lit("")).cast(kind)


def read_positional(
    spark: SparkSession,
    path: str,
    positions: Positions,
    skip: int = 1,
    with_position: bool = False,
) -> DataFrame:
    """Header-less read: skip the preamble, keep some positions, name and type them.

    One preamble row is left to Spark's own header handling, so the scan stays
    splittable and prunes columns. Longer preambles, or a request for row
    positions, number the raw lines of each file.
    """
    schema = _text_schema(max(positions) + 1)
    if skip <= 1 and not with_position:
        rows = _guarded(
            lambda: spark.read.option("header", skip == 1).schema(schema).csv(path), path
        )
        rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    else:
        rows = numbered_lines(spark, path, skip)
        rows = rows.withColumn("_r", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " ")))
        rows = rows.select(*POSITION, "_r.*")
    kept = [typed(F.col(f"_c{p}"), kind).alias(name) for p, (name, kind) in positions.items()]
    extra = [F.col(c) for c in (POSITION if with_position else ("_file",))]
    return rows.select(*kept, *extra)


def numbered_lines(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """Raw lines with (file, block, row) positions, without the preamble.

    Positions order the lines of a file: blocks by their offset, lines within
    a block as they are read. The feed is read once: the numbered lines are
    written, so that all branches see the same numbers. Only each file's first
    row number is joined back.
    """
    raw = _guarded(lambda: spark.read.text(path), path)
    lines = stage(
        raw.select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    if skip:
        first = lines.filter("_block = 0").groupBy("_file").agg(F.min("_row").alias("_first"))
        beyond = (F.col("_block") > 0) | (F.col("_row") - F.col("_first") >= skip)
        # the text itself depends on the row number: a later condition on typed cells is not moved to preamble rows
        lines = lines.join(first, "_file", "left").withColumn("value", F.when(beyond, F.col("value"))).drop("_first")
    return lines.filter(F.trim("value") != "")


def feed_slice(rows: int = SLICE_ROWS) -> Column:
    """Consecutive slices of a file with positions, of at most so many lines.

    A feed that cannot be split, as a compressed one, is a single block; its
    slices let operators that go by the order of lines work in several tasks.
    """
    return F.struct(F.col("_block").alias("block"), F.floor(F.col("_row") / rows).alias("part"))


def read_headered(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """CSV with a header row; columns are found by name and forced to a type."""
    rows = _guarded(lambda: spark.read.option("header", True).csv(path), path)
    return rows.select(*[typed(F.col(f"`{name}`"), kind).alias(name) for name, kind in columns.items()])


def decoded(c: Column) -> Column:
    """A path as it is stored; Spark gives it in encoded form."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def file_name() -> Column:
    """Name of the file a row came from; Spark gives paths in encoded form."""
    return decoded(F.substring_index(F.col("_file"), "/", -1))


def season_first(name: Column) -> Column:
    """``'sp-20 ALL.csv'`` -> ``'SP-20'``."""
    return F.upper(F.left(name, F.lit(5)))


def season_last(name: Column) -> Column:
    """``'SOURCE_HFC_ASSOC_SP-20.csv'`` -> ``'SP-20'``."""
    return F.right(F.substring_index(name, ".", 1), F.lit(5))


def read_feed_family(
    spark: SparkSession, folder: str, pattern: str, positions: Positions, skip: int = 1
) -> DataFrame:
    """All files of a feed in one scan; ``FILE`` tells them apart.

    A member may be a folder of part files, as Spark writes it; its rows carry
    the name of the folder.
    """
    folder = folder.rstrip("/")
    rows = read_positional(spark, f"{folder}/{pattern}", positions, skip)
    base = re.escape(folder.rpartition("/")[2])
    member = F.regexp_extract(decoded(F.col("_file")), f"^.*/{base}/([^/]+)", 1)
    return rows.withColumn("FILE", F.coalesce(F.nullif(member, F.lit("")), file_name())).drop("_file")


def not_cancelled(df: DataFrame, name: Column) -> DataFrame:
    """Keep ``*.xls`` forms whose name does not end in CANCEL."""
    stem_end = F.upper(F.substr(name, F.length(name) - 9, F.lit(6)))
    return df.filter(name.endswith(".xls") & (stem_end != "CANCEL"))


def read_sheet(
    spark: SparkSession, folder: str, sheet: str, positions: Positions, skip: int = 1, footer: int = 0
) -> DataFrame:
    """One exported workbook tab, stored as ``folder/sheet=<tab>/``."""
    return trim_footer(
        read_positional(spark, f"{folder}/sheet={sheet}", positions, skip, with_position=True), footer
    )


def read_sheet_family(
    spark: SparkSession, folder: str, contains: str, positions: Positions, skip: int = 1
) -> DataFrame:
    """All tabs whose name contains a text; ``SHEET`` tells them apart."""
    rows = read_positional(spark, f"{folder}/sheet=*{contains}*", positions, skip)
    tab = F.regexp_extract("_file", r"/sheet=([^/]*)/", 1)
    return rows.withColumn("SHEET", decoded(tab)).drop(*POSITION)


def trim_footer(df: DataFrame, n: int = 1) -> DataFrame:
    """Drop the last n rows of each file."""
    return drop_last(df, ["_file"], ["_block", "_row"], n)
