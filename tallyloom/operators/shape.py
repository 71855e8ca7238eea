"""Row-shaping operators: unpivot, carry forward, first per key, tagged union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ColumnOrName, as_col
from ..session import stage


def unpivot_pairs(df: DataFrame, code_name: str = "SIZE_SCALE_CODE", desc_name: str = "DESCRIPTION") -> DataFrame:
    """Repeated (…SCALE…, …DESC…) column pairs -> one row per complete pair.

    Columns are found by name, SCALE before DESC, and the k-th of one kind
    belongs to the k-th of the other; a column without its partner is an error.
    """
    codes = [c for c in df.columns if "SCALE" in c]
    descs = [c for c in df.columns if "SCALE" not in c and "DESC" in c]
    pairs = [
        F.struct(
            F.col(f"`{code}`").cast("string").alias(code_name),
            F.col(f"`{desc}`").cast("string").alias(desc_name),
        )
        for code, desc in zip(codes, descs, strict=True)
    ]
    return df.select(F.inline(F.array(*pairs))).na.drop()


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """First row per key in the given order.

    Spark limits each group to one row before the shuffle as well, so a key
    that holds a large share of the rows does not end up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def carry_forward(
    df: DataFrame,
    cols: Sequence[str],
    group: Sequence[str],
    order: Sequence[ColumnOrName],
    slice_by: ColumnOrName,
) -> DataFrame:
    """Fill each null with the last known value before it within the group.

    ``slice_by`` cuts a group into consecutive slices (it must not decrease
    along ``order``); group columns hold no nulls. Only one row per slice is ordered across the whole
    group; the rows themselves are ordered within their slice, so a group may
    hold any share of the data.
    """
    order = [as_col(o) for o in order]
    keys = list(group)
    sliced = df.withColumn("_slice", as_col(slice_by))
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])

    ends = sliced.groupBy(*keys, "_slice").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in cols]
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys, "_slice", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in cols]
    )
    joined = sliced.join(carried, [*keys, "_slice"], "left")
    within = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = {
        c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(within), F.col(f"_in_{c}")) for c in cols
    }
    return joined.withColumns(filled).select(*df.columns)


def last_or_match(
    df: DataFrame,
    run: Sequence[str],
    match: Column,
    group: Sequence[str],
    order: Sequence[ColumnOrName],
    slice_by: ColumnOrName,
) -> DataFrame:
    """Rows that match, and of runs that nothing matches the last row.

    A run is a stretch of rows, in the given order, with equal ``run``
    columns. A run has also been matched when the last match before it, in
    the whole group, had the same columns. Looking ahead needs the first row
    of the next slice only: slices are as in :func:`carry_forward`.
    """
    order, keys = [as_col(o) for o in order], list(group)
    match = F.coalesce(match, F.lit(False))
    own = F.struct(*run)
    marked = df.withColumns({"_key": own, "_match": match, "_found": F.when(match, own)})
    found = carry_forward(marked, ["_found"], keys, order, slice_by).withColumn("_slice", as_col(slice_by))
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    firsts = found.groupBy(*keys, "_slice").agg(F.min_by("_key", rank).alias("_first"))
    following = Window.partitionBy(*keys).orderBy("_slice")
    ahead = firsts.select(*keys, "_slice", F.lead("_first").over(following).alias("_ahead"))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    looked = found.join(ahead, [*keys, "_slice"]).withColumn("_next", F.coalesce(F.lead("_key").over(within), F.col("_ahead")))
    last = ~F.col("_next").eqNullSafe(F.col("_key"))
    return looked.filter(F.col("_match") | (last & ~F.col("_found").eqNullSafe(F.col("_key")))).select(*df.columns)


def drop_last(df: DataFrame, group: Sequence[str], order: Sequence[ColumnOrName], n: int = 1) -> DataFrame:
    """Remove the last n rows of each group (the totals rows of a sheet), and rows at the same positions.

    Spark keeps n rows per group and task before it ranks them. The rows are
    matched on group and position together, so a group of any size is spread
    over all tasks, in whatever follows too.
    """
    if n < 1:
        return df
    place = {f"_o{i}": as_col(o) for i, o in enumerate(order)}
    placed = df.withColumns(place)
    backwards = Window.partitionBy(*group).orderBy(*[F.col(p).desc() for p in place])
    last = (
        placed.select(*group, *place)
        .withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= n)
        .select(*[F.col(c).alias(f"_l_{c}") for c in [*group, *place]])
    )
    # written first: where it is small Spark sees that, and the rows need no shuffle
    last = stage(last)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_l_{c}`")) for c in [*group, *place]]
    return placed.join(last, same, "left_anti").select(*df.columns)


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "TYPE") -> DataFrame:
    """Stack frames, each row carrying the name of the frame it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def require_complete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (in the subset)."""
    return df.na.drop(subset=list(subset) if subset else None)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def key_text(*cols: ColumnOrName) -> Column:
    """Readable key of a reported row."""
    return F.concat_ws("|", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])
