"""Size scales and size curves as arrays and maps.

Texts are taken apart with regular expressions over the whole text. What is
needed several times is bound once (``_let``): Spark would evaluate a shared
expression again in each conditional branch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnOrName, as_col
from .text import is_blank, spaced

WIDTH = 8

# one "qty/size" word, whatever follows a second slash is dropped
_WORD = r"(?<![^ ])([^ /]*)/([^ /]*)[^ ]*"
# one "qty/size" part of a dashed text, blanks around both trimmed
_PART = r"(?:^|-) *([^-/]*?) */ *([^-/]*?) *(?=/|-|$)"
_QUANTITIES = r"^[+-]?[0-9]+(?:,[+-]?[0-9]+)*$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate a value once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairs(text: Column, pattern: str) -> Column:
    """Sizes and quantity texts of all words, as two arrays."""

    def group(n: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(n))

    return F.struct(group(2).alias("sizes"), group(1).alias("quantities"))


def _readable(quantities: Column) -> Column:
    """Every quantity is a whole number."""
    return (F.size(quantities) == 0) | F.array_join(quantities, ",").rlike(_QUANTITIES)


def _numbers(quantities: Column) -> Column:
    """Quantities as longs; one beyond a long, or no number, is null."""
    return quantities.try_cast("array<bigint>")


def _padded(values: Column, filler: Column) -> Column:
    return F.slice(F.concat(values, F.array_repeat(filler, WIDTH)), 1, WIDTH)


def parse_scale(desc: ColumnOrName) -> Column:
    """``'2/S 4/M …'`` -> struct(sizes, quantities, error).

    Words without a slash are skipped; short scales are padded with NONE and
    zero. More than eight sizes, or a quantity that is no whole number or
    beyond a long, set ``error`` instead of stopping the load.
    """

    def result(pair: Column) -> Column:
        sizes, quantities = pair["sizes"], pair["quantities"]
        numbers = F.when(_readable(quantities), _numbers(quantities))
        return F.struct(sizes.alias("sizes"), numbers.alias("quantities"))

    def judged(pair: Column) -> Column:
        sizes, numbers = pair["sizes"], pair["quantities"]
        error = (
            F.when(sizes.isNull(), "no description")
            .when(numbers.isNull(), "quantity is not a whole number")
            .when(F.exists(numbers, lambda n: n.isNull()), "quantity is too large")
            .when(F.size(sizes) > WIDTH, "more than eight sizes")
        )
        return F.struct(sizes.alias("sizes"), numbers.alias("quantities"), error.alias("error"))

    def finished(found: Column) -> Column:
        fine = found["error"].isNull()
        return F.struct(
            F.when(fine, _padded(found["sizes"], F.lit("NONE"))).alias("sizes"),
            F.when(fine, _padded(found["quantities"], F.lit(0).cast("bigint"))).alias("quantities"),
            found["error"].alias("error"),
        )

    return _let(_let(_let(_pairs(spaced(desc), _WORD), result), judged), finished)


def _last_wins_map(pairs: Column, parts: Column) -> Column:
    """Map of size -> qty where the last of several equal sizes counts.

    NULL when a part has no slash or no whole quantity, or one beyond a long.
    """

    def read(pair: Column) -> Column:
        quantities = pair["quantities"]
        numbers = F.when(_readable(quantities), _numbers(quantities))
        return F.struct(pair["sizes"].alias("sizes"), numbers.alias("quantities"))

    def result(pair: Column) -> Column:
        sizes, numbers = pair["sizes"], pair["quantities"]
        known = F.coalesce(~F.exists(numbers, lambda n: n.isNull()), F.lit(False))
        distinct = F.array_distinct(sizes)
        # rare: look the last position of each size up in the reversed arrays
        latest = F.transform(
            distinct,
            lambda s: F.get(F.reverse(numbers), (F.array_position(F.reverse(sizes), s) - 1).cast("int")),
        )
        mapped = F.when(F.size(distinct) == F.size(sizes), F.map_from_arrays(sizes, numbers)).otherwise(
            F.map_from_arrays(distinct, latest)
        )
        return F.when((F.size(sizes) == parts) & known, mapped)

    return _let(_let(pairs, read), result)


def _no_sizes() -> Column:
    return F.create_map(F.lit("none"), F.lit(0).cast("bigint"))


def scale_map(desc: ColumnOrName) -> Column:
    """Scale description -> map; no slash at all gives ``{none: 0}``, bad text NULL."""
    text = spaced(desc)
    words = F.regexp_count(text, F.lit("[^ ]+"))
    return F.when(
        text.contains("/"), _last_wins_map(_pairs(text, _WORD), words)
    ).otherwise(_no_sizes())


def curve_map(curve: ColumnOrName) -> Column:
    """``'10/S-20/M'`` -> map; blank gives ``{none: 0}``, bad text NULL."""
    text = F.upper(spaced(curve))
    parts = F.regexp_count(text, F.lit("-")) + 1
    return F.when(is_blank(curve), _no_sizes()).otherwise(
        _last_wins_map(_pairs(text, _PART), parts)
    )


def range_labels(cols: list[ColumnOrName]) -> Column:
    """Distinct size labels in bucket order, without trailing blanks."""
    labels = [F.coalesce(as_col(c), F.lit("")) for c in cols]
    last = F.greatest(F.lit(0), *[F.when(s != "", i + 1) for i, s in enumerate(labels)])
    return F.array_distinct(F.slice(F.array(*labels), F.lit(1), last))


def align_curve(curve: ColumnOrName, labels: ColumnOrName) -> Column:
    """Quantities in label order, missing sizes zero, always eight places.

    NULL when there are more than eight labels or either side is unknown.
    """
    curve, labels = as_col(curve), as_col(labels)
    places = [
        F.coalesce(F.try_element_at(curve, F.get(labels, F.lit(i))), F.lit(0).cast("bigint"))
        for i in range(WIDTH)
    ]
    return F.when(curve.isNotNull() & (F.size(labels) <= WIDTH), F.array(*places))


def placed_total(values: ColumnOrName) -> Column:
    """Sum of an aligned curve."""
    return reduce(add, [F.get(as_col(values), F.lit(i)).cast("long") for i in range(WIDTH)])


def pack_size(scale: ColumnOrName) -> Column:
    """Pieces in one prepack carton."""
    return F.aggregate(F.map_values(as_col(scale)), F.lit(0).cast("long"), lambda acc, v: acc + v)


def explode_prepack(scale: ColumnOrName, packs: ColumnOrName) -> Column:
    """Scale quantities times the number of cartons."""
    packs = as_col(packs)
    return F.transform_values(as_col(scale), lambda _, v: (v * packs).cast("bigint"))


def fold_to_columns(values: ColumnOrName, names: list[str]) -> list[Column]:
    """Array -> one column per place."""
    return [F.get(as_col(values), F.lit(i)).alias(n) for i, n in enumerate(names)]
