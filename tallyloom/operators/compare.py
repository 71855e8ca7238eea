"""Comparisons whose treatment of nulls differs from SQL, and shared filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ColumnOrName, as_col


def ne_or_null(a: ColumnOrName, b: ColumnOrName) -> Column:
    """True when the values differ or either side is unknown."""
    return F.coalesce(as_col(a) != as_col(b), F.lit(True))


def beyond_tolerance(a: ColumnOrName, b: ColumnOrName, tolerance: str = "0.01") -> Column:
    """Money differs by at least the tolerance; unknown values do not count."""
    diff = F.abs(as_col(a).cast("decimal(28,6)") - as_col(b).cast("decimal(28,6)"))
    return F.coalesce(diff >= F.lit(tolerance).cast("decimal(10,6)"), F.lit(False))


def live(df: DataFrame, cxl: str = "CXL") -> DataFrame:
    return df.filter(F.col(cxl) == 0)


def in_seasons(df: DataFrame, seasons: Sequence[str], col: str = "SEASON") -> DataFrame:
    return df.filter(F.col(col).isin(*seasons))


def active_orders(orders: DataFrame, seasons: Sequence[str] | None = None) -> DataFrame:
    """Order lines that are neither purged nor deactivated."""
    kept = live(orders).filter(F.col("COMMENT") != "DEACTIVE")
    return kept if seasons is None else in_seasons(kept, seasons)


def open_kind(shipped: ColumnOrName = "SHIPPED", balance: ColumnOrName = "BAL") -> Column:
    """``full`` for untouched open lines, ``partial`` for started ones, else NULL."""
    shipped, balance = as_col(shipped), as_col(balance)
    return F.when((shipped == 0) & (balance > 0), "full").when((shipped > 0) & (balance > 0), "partial")
