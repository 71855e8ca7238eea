"""Data-quality checks.

Each check returns the offending rows; ``exception_rows`` brings them to one
shape so that all checks of a load can be counted and reported together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ColumnOrName, as_col
from ..session import shuffles_removed
from .compare import beyond_tolerance, ne_or_null
from .mutate import require_keys
from .shape import key_text

EXCEPTION_SCHEMA = "check_id string, key string, expected string, actual string, reason string"
POLICIES = ("fail", "proceed", "quarantine")


class CheckFailed(RuntimeError):
    """A load was stopped by its checks; ``counts`` says which ones."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in sorted(counts.items())))
        self.counts = counts


def _text(value) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return as_col(value).cast("string")


def exception_rows(
    df: DataFrame,
    check_id: str,
    key: Sequence[ColumnOrName],
    reason: str | Column,
    expected: ColumnOrName | None = None,
    actual: ColumnOrName | None = None,
) -> DataFrame:
    return df.select(
        F.lit(check_id).alias("check_id"),
        key_text(*key).alias("key"),
        _text(expected).alias("expected"),
        _text(actual).alias("actual"),
        (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"),
    )


@dataclass(frozen=True)
class Rule:
    """A check on rows of one frame: which are bad, and how they are reported."""

    check_id: str
    bad: Column
    key: Sequence[ColumnOrName]
    reason: str | Column
    expected: ColumnOrName | None = None
    actual: ColumnOrName | None = None


def stacked_exceptions(df: DataFrame, rules: Sequence[Rule], carry: Sequence[str] = ()) -> DataFrame:
    """Exceptions of several checks on one frame, found in a single pass over its rows.

    A row gives one exception for each rule that it breaks; a rule whose
    condition is null is kept. The columns ``carry`` come along.
    """
    rows = [
        F.when(
            rule.bad,
            F.struct(
                F.lit(rule.check_id).alias("check_id"),
                key_text(*rule.key).alias("key"),
                _text(rule.expected).alias("expected"),
                _text(rule.actual).alias("actual"),
                F.lit(rule.reason).cast("string").alias("reason"),
            ),
        )
        for rule in rules
    ]
    found = df.select(*carry, F.explode(F.array_compact(F.array(*rows))).alias("_found"))
    return found.select(*carry, "_found.*")


def no_exceptions(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], EXCEPTION_SCHEMA)


def all_exceptions(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def count_by_check(exceptions: DataFrame) -> dict[str, int]:
    """Number of exceptions per check; one row per check reaches the driver."""
    counts = exceptions.groupBy("check_id").agg(F.count("*").alias("n"))
    with shuffles_removed(exceptions.sparkSession):
        return {r["check_id"]: r["n"] for r in counts.collect()}


def review_gate(exceptions: DataFrame, policy: str = "fail", accepted: Sequence[str] = ()) -> dict[str, int]:
    """Stop the load unless every check that found something is accepted.

    ``proceed`` accepts everything, ``fail`` only the checks named;
    ``quarantine`` goes on as well, and the caller publishes the states
    without the rows of the checks that are not accepted.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy: {policy}")
    counts = count_by_check(exceptions)
    blocking = {k: v for k, v in counts.items() if k not in accepted}
    if policy == "fail" and blocking:
        raise CheckFailed(blocking)
    return counts


def hold_back(old: DataFrame, new: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New state in which the held keys stay as they are stored; unstored ones are left out."""
    return missing_reference(new, held, keys).unionByName(with_reference(old, held, keys).select(*new.columns))


def null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def missing_reference(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the other table does not have.

    The other side is reduced to its distinct keys before it is shuffled, so a
    key with very many copies there costs nothing.
    """
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def with_reference(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), list(keys), "left_semi")


def bad_format(df: DataFrame, valid: Column) -> DataFrame:
    return df.filter(~F.coalesce(valid, F.lit(False)))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("COPIES")).filter(F.col("COPIES") > 1)


def prepack_mismatch(headers: DataFrame, scales: DataFrame, bulk: str = "00") -> DataFrame:
    """Prepack orders whose carton size is not the total of their scale.

    ``scales`` holds ``SIZE_SCALE_CODE`` and ``TTL_QTY``; an unknown scale is
    a mismatch too.
    """
    totals = scales.select(F.col("SIZE_SCALE_CODE").alias("HFC_SIZE_SCALE"), "TTL_QTY")
    totals = require_keys(totals, ["HFC_SIZE_SCALE"], "size scales")
    return (
        headers.join(totals, "HFC_SIZE_SCALE", "left")
        .withColumn("PPK_DIFF", F.col("CARTON_SIZE") - F.col("TTL_QTY"))
        .filter((F.col("HFC_SIZE_SCALE") != bulk) & ne_or_null("PPK_DIFF", F.lit(0)))
    )


def attribute_conflict(df: DataFrame, derived: str, manual: str) -> DataFrame:
    """Both attributes are given and disagree."""
    a, b = F.col(derived), F.col(manual)
    return df.filter((a != "") & (b != "") & (a != b))


def totals_mismatch(df: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows where any (calculated, given, tolerance) pair is too far apart.

    Rows without a calculated total are not reported.
    """
    return df.filter(apart(pairs))


def apart(pairs: Sequence[tuple[str, str, str]]) -> Column:
    """Any (calculated, given, tolerance) pair is too far apart."""
    return reduce(lambda a, b: a | b, [beyond_tolerance(c, g, t) for c, g, t in pairs])


def control_totals(before: DataFrame, after: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Groups whose total in the new state is not the total of the feed."""
    sent = before.groupBy(*keys).agg(F.sum(measure).alias("TTL_SENT"))
    sent = sent.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    stored = after.groupBy(*keys).agg(F.sum(measure).alias("TTL_STORED"))
    return sent.join(stored, list(keys), "left").filter(ne_or_null("TTL_SENT", "TTL_STORED"))
