"""Table changes as pure functions ``(state, source) -> new state``.

Every operator returns a lazy plan. Keys of both sides are shuffled once and
joined; the unique-key check on the source runs on that same partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Assignments = Mapping[str, "str | Column"]


@dataclass(frozen=True)
class Scope:
    """Limits a soft delete to target rows whose value occurs in the source.

    ``column`` names the target's (old) value, ``source`` the frame and
    column that list the values in play.
    """

    column: str
    source: DataFrame
    source_column: str


def key_map(keys: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    """Target key -> source key."""
    return dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}


def require_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """Stop the job on a null or repeated key.

    Rows are numbered within their key while they stream by, so a key with
    very many copies is noticed at its second row and nothing is buffered.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    w = Window.partitionBy(*keys).orderBy(*keys)
    name = ", ".join(keys)
    complaint = F.when(~known, F.lit(f"null key in {what}: {name}")).otherwise(
        F.lit(f"repeated key in {what}: {name}")
    )
    # one condition on the window's result, so that it is never evaluated on
    # rows an earlier join or filter removes
    fine = F.assert_true(known & (F.col("_copy") == 1), complaint).isNull()
    return df.withColumn("_copy", F.row_number().over(w)).filter(fine).drop("_copy")


def _unique_source(source: DataFrame, keys: Sequence[str], on_duplicate: str, order: Sequence[str]) -> DataFrame:
    if on_duplicate == "trusted":
        return source
    if on_duplicate == "first":
        from .shape import first_by

        return first_by(source, keys, order)
    if on_duplicate != "fail":
        raise ValueError(f"on_duplicate: {on_duplicate}")
    return require_keys(source, keys)


def _prefixed(source: DataFrame) -> DataFrame:
    return source.select(*[F.col(f"`{c}`").alias(f"_s_{c}") for c in source.columns])


def _value(v: "str | Column") -> Column:
    """A name refers to a source column, a Column is used as it is."""
    return F.col(f"`_s_{v}`") if isinstance(v, str) else v


def scope_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, without null."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def _with_scope(target: DataFrame, scope: Scope) -> DataFrame:
    """Flag target rows in scope; a null value is never in scope.

    The distinct values are joined. Their side holds one row per value: Spark
    broadcasts it where it is small, and can split a frequent value of the
    target where it is not.
    """
    listed = scope_values(scope.source.select(F.col(scope.source_column).alias("_v")), "_v")
    listed = listed.withColumn("_hit", F.lit(True))
    return (
        target.join(listed, F.col(scope.column) == F.col("_v"), "left")
        .withColumn("_scope", F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_v", "_hit")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    set_map: Assignments,
    insert_map: Assignments | None = None,
    *,
    delete_set: Assignments | None = None,
    scope: Scope | None = None,
    on_duplicate: str = "fail",
    order: Sequence[str] = (),
) -> DataFrame:
    """Update matched rows, insert new ones, optionally soft-delete the rest.

    ``set_map`` gives target column -> source column name (or a Column) for
    matched rows; ``insert_map`` the same for new rows and defaults to
    ``set_map``. ``delete_set`` is applied to target rows the source does not
    have, all of them or those in ``scope``. Columns named nowhere keep their
    value, and are null (``CXL``: 0) in new rows.
    """
    pairs = key_map(keys)
    insert_map = dict(set_map if insert_map is None else insert_map)
    old = target
    if delete_set:
        old = _with_scope(old, scope) if scope else old.withColumn("_scope", F.lit(True))
    old = old.withColumn("_in_target", F.lit(True))
    unique = _unique_source(source, list(pairs.values()), on_duplicate, order)
    new = _prefixed(unique).withColumn("_in_source", F.lit(True))
    condition = [F.col(f"`{t}`") == F.col(f"`_s_{s}`") for t, s in pairs.items()]
    joined = old.join(new, condition, "full_outer")

    from_source = F.col("_in_source").isNotNull()
    inserted = F.col("_in_target").isNull()
    lost = ~from_source & F.col("_scope") if delete_set else None

    def final(field) -> Column:
        name, kind = field.name, field.dataType
        current = F.col(f"`{name}`")
        if name in pairs:
            return F.when(inserted, F.col(f"`_s_{pairs[name]}`").cast(kind)).otherwise(current).alias(name)
        default = F.lit(0).cast(kind) if name == "CXL" else F.lit(None).cast(kind)
        fresh = _value(insert_map[name]).cast(kind) if name in insert_map else default
        out = F.when(inserted, fresh)
        if name in set_map:
            out = out.when(from_source, _value(set_map[name]).cast(kind))
        if delete_set and name in delete_set:
            out = out.when(lost, _value(delete_set[name]).cast(kind))
        return out.otherwise(current).alias(name)

    return joined.select(*[final(f) for f in target.schema.fields])


def upsert_soft_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    set_map: Assignments,
    insert_map: Assignments | None = None,
    *,
    zero: Sequence[str] = (),
    scope: Scope | None = None,
    on_duplicate: str = "fail",
    order: Sequence[str] = (),
) -> DataFrame:
    """Snapshot upsert: matched rows revive, missing rows get ``CXL = 1``.

    ``zero`` names measures set to zero together with the flag.
    """
    return upsert(
        target,
        source,
        keys,
        {**set_map, "CXL": F.lit(0)},
        dict(set_map if insert_map is None else insert_map),
        delete_set={"CXL": F.lit(1), **{c: F.lit(0) for c in zero}},
        scope=scope,
        on_duplicate=on_duplicate,
        order=order,
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    set_map: Assignments,
    *,
    on_duplicate: str = "fail",
    order: Sequence[str] = (),
) -> DataFrame:
    """Update the target rows that have a source row; others stay untouched.

    A source row with a null in its key matches nothing and is ignored.
    """
    pairs = key_map(keys)
    keyed = source.na.drop(subset=list(pairs.values()))
    unique = _unique_source(keyed, list(pairs.values()), on_duplicate, order)
    new = _prefixed(unique).withColumn("_in_source", F.lit(True))
    condition = [F.col(f"`{t}`") == F.col(f"`_s_{s}`") for t, s in pairs.items()]
    joined = target.join(new, condition, "left")
    matched = F.col("_in_source").isNotNull()

    def final(field) -> Column:
        current = F.col(f"`{field.name}`")
        if field.name not in set_map:
            return current
        value = _value(set_map[field.name]).cast(field.dataType)
        return F.when(matched, value).otherwise(current).alias(field.name)

    return joined.select(*[final(f) for f in target.schema.fields])


def update_where(target: DataFrame, condition: Column, set_map: Mapping[str, Column]) -> DataFrame:
    """Update the rows that meet a condition."""
    return target.withColumns(
        {
            name: F.when(condition, value.cast(target.schema[name].dataType)).otherwise(F.col(name))
            for name, value in set_map.items()
        }
    )


def apply_corrections(target: DataFrame, corrections: Sequence[tuple[Mapping, Mapping]]) -> DataFrame:
    """Manual fixes ``(where, set)``, one after the other.

    The fixes are a short hand-kept list, so they become expressions over the
    table and need no join.
    """
    for where, assign in corrections:
        hit = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in where.items()])
        target = update_where(target, hit, {k: F.lit(v) for k, v in assign.items()})
    return target
