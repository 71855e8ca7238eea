"""Identifier, code and text normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnOrName, as_col

# fixed values: characters that count as white space
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# fixed values: container number format and the carriers exempt from it
WHOLE_NUMBER = "^[+-]?[0-9]+$"
CONTAINER_PATTERN = "^[A-Z]{4}[0-9]{7}$"
CONTAINER_EXEMPT = ("AIR", "FEDEX")


def zfill(c: ColumnOrName, width: int) -> Column:
    """Pad with zeros on the left; longer values stay whole, a sign stays in front."""
    c = as_col(c).cast("string")
    signed = F.concat(F.left(c, F.lit(1)), F.lpad(F.substr(c, F.lit(2)), width - 1, "0"))
    short = F.when(F.left(c, F.lit(1)).isin("-", "+"), signed).otherwise(F.lpad(c, width, "0"))
    return F.when(F.length(c) >= width, c).otherwise(short)


def strip(c: ColumnOrName) -> Column:
    """Remove leading and trailing white space of every kind."""
    return F.btrim(as_col(c), F.lit(WHITE_SPACE))


def spaced(c: ColumnOrName) -> Column:
    """White space of every kind as plain blanks."""
    return F.translate(as_col(c), WHITE_SPACE, " " * len(WHITE_SPACE))


def is_blank(c: ColumnOrName) -> Column:
    c = as_col(c)
    return c.isNull() | (strip(c) == "")


def whole_number(c: ColumnOrName) -> Column:
    """Text -> long; NULL for any other text and for numbers beyond a long.

    The text is looked at before it is cast: a failing ``try_cast`` raises
    and catches an exception for every row.
    """
    c = strip(c)
    return F.when(c.rlike(WHOLE_NUMBER), c.try_cast("long"))


def numeric_code(c: ColumnOrName, width: int) -> Column:
    """``5`` or ``5.0`` becomes a padded code; text codes are left alone."""
    c = as_col(c)
    digits = F.regexp_extract(c, r"^([0-9]+)(\.0+)?$", 1)
    return F.when(digits != "", zfill(digits, width)).otherwise(c)


def code_part(c: ColumnOrName, width: int = 3, sep: str = "-") -> Column:
    """``'12-NAVY'`` -> ``'012'``."""
    return zfill(F.substring_index(as_col(c), sep, 1), width)


def desc_part(c: ColumnOrName, sep: str = "-") -> Column:
    """``'12-NAVY'`` -> ``'NAVY'``; no separator gives the empty text."""
    return F.coalesce(F.get(F.split(as_col(c), sep), F.lit(1)), F.lit(""))


def po_ref(c: ColumnOrName, generation: int = 3) -> Column:
    """Purchase-order number in front of the dash.

    Generation 3 turns a missing reference and anything not six characters
    long into the empty text. A blank (not null) reference pads to
    ``'000000'`` and is kept, as in the source system's feed.
    """
    ref = zfill(F.substring_index(as_col(c), "-", 1), 6)
    if generation < 3:
        return ref
    return F.when(F.length(ref) == 6, ref).otherwise(F.lit(""))


def clean_id(c: ColumnOrName) -> Column:
    """Drop blanks and upper-case."""
    return F.upper(F.replace(as_col(c), F.lit(" "), F.lit("")))


def squeeze_id(c: ColumnOrName) -> Column:
    """Drop white space of every kind and upper-case."""
    return F.upper(F.translate(as_col(c), WHITE_SPACE, ""))


def season_code(c: ColumnOrName) -> Column:
    """``'spring 20'`` -> ``'SP-20'``."""
    c = as_col(c)
    return F.concat(F.upper(F.left(c, F.lit(2))), F.lit("-"), F.right(c, F.lit(2)))


def season_after_colon(c: ColumnOrName) -> Column:
    """Season of a form cell such as ``'SEASON: SP 2020'``; case is kept."""
    text = strip(F.substring_index(as_col(c), ":", -1))
    return F.concat(F.left(text, F.lit(2)), F.lit("-"), F.right(text, F.lit(2)))


def season_from_open(ssn: ColumnOrName, year: ColumnOrName) -> Column:
    """Opening season letter and year -> season code."""
    head = F.when(F.upper(as_col(ssn)) == "S", "SP-").otherwise("FA-")
    return F.concat(head, F.right(as_col(year).cast("string"), F.lit(2)))


def contains_flag(c: ColumnOrName, needles: Sequence[str]) -> Column:
    """1 when any needle occurs, else 0."""
    hit = reduce(lambda a, b: a | b, [as_col(c).contains(n) for n in needles])
    return F.coalesce(hit, F.lit(False)).cast("int")


def prefix_po(customer: ColumnOrName, po: ColumnOrName, lengths: Mapping[str, int]) -> Column:
    """Customers listed in ``lengths`` keep only that many characters of the PO."""
    customer, po = as_col(customer), as_col(po)
    out = po
    for number, length in lengths.items():
        out = F.when(customer == number, F.left(po, F.lit(length))).otherwise(out)
    return out


def alias_name(c: ColumnOrName, aliases: Mapping[str, str]) -> Column:
    c = as_col(c)
    out = c
    for name, canonical in aliases.items():
        out = F.when(c == name, F.lit(canonical)).otherwise(out)
    return out


def drop_leading(c: ColumnOrName, marker: str) -> Column:
    """Cut as many leading characters as the marker has."""
    return F.substr(as_col(c), F.lit(len(marker) + 1))


def valid_container(c: ColumnOrName) -> Column:
    """Well-formed container number, or a carrier that has none."""
    c = as_col(c)
    return F.coalesce(c.isin(*CONTAINER_EXEMPT) | c.rlike(CONTAINER_PATTERN), F.lit(False))


def matches_or_exempt(c: ColumnOrName, pattern: str, exempt: Sequence[str]) -> Column:
    c = as_col(c)
    return F.coalesce(c.isin(*exempt) | c.rlike(pattern), F.lit(False))


def before(c: ColumnOrName, sep: str) -> Column:
    return F.substring_index(as_col(c).cast("string"), sep, 1)


def count_after_colon(c: ColumnOrName) -> Column:
    """``'CTN: 24X'`` -> 24; NULL when the text has another shape."""
    text = strip(F.get(F.split(as_col(c), ":"), F.lit(1)))
    return whole_number(F.left(text, F.length(text) - 1))


def scale_after_at(c: ColumnOrName) -> Column:
    """Scale code behind the last ``@`` of a description."""
    return strip(F.substring_index(as_col(c), "@", -1))
