"""Arithmetic over money, units and the eight size buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnOrName, as_col

BUCKETS = range(1, 9)


def buckets(prefix: str = "S", suffix: str = "") -> list[str]:
    """Names of the eight size columns, e.g. ``BAL_S1 … BAL_S8``."""
    return [f"{prefix}{i}{suffix}" for i in BUCKETS]


def line_amount(price: ColumnOrName, hanger: ColumnOrName, pieces: ColumnOrName) -> Column:
    return (as_col(price) + as_col(hanger)) * as_col(pieces)


def duty_free_amount(price: ColumnOrName, hanger: ColumnOrName, pieces: ColumnOrName) -> Column:
    """As ``line_amount``; no duty-free price means an amount of zero."""
    price = as_col(price)
    return F.when(price.isNull(), F.lit(0.0)).otherwise(line_amount(price, hanger, pieces))


def clamp0(c: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), c)


def row_max(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Larger of two values; when they do not compare, the second one."""
    a, b = as_col(a), as_col(b)
    return F.when(a > b, a).otherwise(b)


def bucket_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Sum across columns; NULL when any is NULL."""
    return reduce(add, [as_col(c) for c in cols])


def pack_count(total: ColumnOrName, pack: ColumnOrName) -> Column:
    """Whole packs in a total; NULL when the pack is empty or does not divide it."""
    total, pack = as_col(total).cast("long"), as_col(pack).cast("long")
    fits = (pack > 0) & (F.try_mod(total, pack) == 0)
    return F.when(fits, int_div(total, pack))


def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division of whole numbers truncating toward zero; NULL for a zero divisor.

    Never goes through floating point, so large totals stay exact.
    """
    a, b = as_col(a).cast("long"), as_col(b).cast("long")
    return F.call_function("div", a, F.when(b != 0, b))


def money(c: ColumnOrName) -> Column:
    """Exact decimal, so that sums do not depend on the order of partitions."""
    return as_col(c).cast("decimal(24,6)")


def money_sum(c: ColumnOrName) -> Column:
    """Sum of money as an exact decimal, zero for a group of nulls."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast("decimal(34,6)"))


def sum0(c: ColumnOrName) -> Column:
    """Sum that is zero, not NULL, for a group of nulls."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def fill(c: ColumnOrName, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def override(base: ColumnOrName, manual: ColumnOrName) -> Column:
    """Manual value where one is given, else the base value."""
    base, manual = as_col(base), as_col(manual)
    return F.when(manual != "", manual).otherwise(base)
