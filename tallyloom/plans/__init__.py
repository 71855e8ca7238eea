"""Loads: pure functions from feeds and current tables to new states and exceptions.

Only :func:`commit` writes. A load whose checks fail publishes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import CheckFailed, count_by_check, exception_rows, hold_back, review_gate, with_reference
from ..schemas import SEASON_TABLES
from ..session import staging
from ..sources.warehouse import Split, Warehouse


@dataclass
class Load:
    """Outcome of a load before it is written.

    ``parts`` lists, per table stored by season, the seasons the new state
    covers (``None``: all of them). ``without`` gives the states without the
    rows that the named checks report; it is asked only under quarantine.
    ``held`` gives the keys of these rows: a load of a table that refers to
    this one takes them, and keeps its own rows for them as they are stored.
    """

    states: dict[str, DataFrame]
    exceptions: DataFrame | None = None
    parts: dict[str, Sequence | None] = field(default_factory=dict)
    without: Callable[[Collection[str]], dict[str, DataFrame]] | None = None
    held: Callable[[Collection[str]], DataFrame] | None = None


def write_exceptions(exceptions: DataFrame, folder: str, check: str) -> None:
    """Exception report of one check or load, as a folder of its own."""
    exceptions.write.mode("errorifexists").parquet(f"{folder}/{check}")


def commit(
    warehouse: Warehouse, load: Load, policy: str = "fail", accepted: Sequence[str] = ()
) -> dict[str, int]:
    """Run the checks, then publish every new state in one commit.

    Under ``quarantine`` the rows of checks that are not accepted are left
    out; a load that cannot leave them out stops.
    """
    counts = {} if load.exceptions is None else review_gate(load.exceptions, policy, accepted)
    states = load.states
    blocking = {k: v for k, v in counts.items() if k not in accepted}
    if policy == "quarantine" and blocking:
        if load.without is None:
            raise CheckFailed(blocking)
        states = {**states, **load.without(set(blocking))}
    splits = {name: Split("SEASON", load.parts.get(name)) for name in states if name in SEASON_TABLES}
    warehouse.publish(states, splits)
    return counts


def run_load(
    warehouse: Warehouse, build: Callable[[], Load], policy: str = "fail", accepted: Sequence[str] = ()
) -> dict[str, int]:
    """Build a load and commit it; what it staged is removed when it ends or fails."""
    with staging(warehouse.spark):
        return commit(warehouse, build(), policy, accepted)


def held_keys(
    found: Mapping[str, DataFrame], checks: Collection[str], keys: Sequence[str]
) -> DataFrame | None:
    """Keys of the rows that the named checks found; none of the checks: ``None``."""
    named = [rows.select(*keys) for check, rows in found.items() if check in checks]
    return reduce(lambda a, b: a.unionByName(b), named) if named else None


def quarantined(load: Load, accepted: Sequence[str] = ()) -> DataFrame | None:
    """Keys that quarantine keeps out of the table of a load; nothing reported: ``None``.

    Loads of tables that refer to this one take them as ``held``, so that a
    row is not published beside a reference that stayed behind.
    """
    counts = {} if load.exceptions is None else count_by_check(load.exceptions)
    blocking = {k: v for k, v in counts.items() if k not in accepted}
    if not blocking:
        return None
    if load.held is None:
        raise CheckFailed(blocking)
    return load.held(set(blocking))


def kept_back(
    state: DataFrame, new: DataFrame, feed: DataFrame, held: DataFrame | None, keys: Mapping[str, str], reported: Sequence[str]
) -> Load:
    """A table of which the rows that refer to held keys stay as they are stored.

    ``keys`` maps columns of the table, which ``held`` has too, to those of the
    feed. Rows of the feed that refer to held keys are reported as ``held_back``.
    """
    (table,) = reported[:1]
    if held is None:
        return Load({table: new})
    held = held.select(*keys)
    found = with_reference(feed, held.withColumnsRenamed(dict(keys)), list(keys.values()))
    exceptions = exception_rows(found, "held_back", list(reported[1:]), "what it refers to is held back")
    return Load({table: hold_back(state, new, held, list(keys))}, exceptions, without=lambda checks: {})


def empty_table(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Bring a frame to a table's columns and types; missing columns are null."""
    schema = df.sparkSession.createDataFrame([], ddl).schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
