"""Business classifications as ``when`` chains; the order of branches matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnOrName, as_col

# fixed values: inventory groups and marker texts
POLY_KNIT_GROUPS = ("POLY POLO", "POLY QTR ZIP", "PRINT POLY (KPR GROUP)")
MICROFIBER_GROUP = "MICROFIBER"
CHECKED_BOX = "( X )"


def unconfirmed_flag(c: ColumnOrName, generation: int = 3) -> Column:
    """Generation 1 takes any mark, later ones only the star."""
    c = F.coalesce(as_col(c), F.lit(""))
    return (c != "" if generation == 1 else c == "*").cast("int")


def _either(c: Column, first: str, second: str) -> Column:
    return c.contains(first) | c.contains(second)


def category(desc: ColumnOrName) -> Column:
    """Knit or woven from the style description."""
    desc = as_col(desc)
    return (
        F.when(_either(desc, " KS ", " KL "), "K")
        .when(_either(desc, " WS ", " WL "), "W")
        .otherwise("")
    )


def sleeve(desc: ColumnOrName) -> Column:
    """Long or short sleeve from the style description."""
    desc = as_col(desc)
    return (
        F.when(_either(desc, " KL ", " WL "), "L/S")
        .when(_either(desc, " WS ", " KS "), "S/S")
        .otherwise("")
    )


def rm_group(inv_group: ColumnOrName, cat: ColumnOrName) -> Column:
    inv_group, cat = as_col(inv_group), as_col(cat)
    return (
        F.when(inv_group.isin(*POLY_KNIT_GROUPS), "POLY KNITS")
        .when(inv_group == MICROFIBER_GROUP, "MICROFIBER")
        .when(cat == "K", "OTHER KNITS")
        .when(cat == "W", "OTHER WOVEN")
        .otherwise("")
    )


def order_status(
    shipped: ColumnOrName = "SHIPPED_UNITS",
    ordered: ColumnOrName = "ORDERED_UNITS",
    balance: ColumnOrName = "BAL",
    ship_date: ColumnOrName = "SHIP_ON_DATE",
    unconfirmed: ColumnOrName = "UNCONFIRMED",
    generation: int = 3,
) -> Column:
    """Life-cycle status of an order line; generation 1 knows no UNCONFIRMED."""
    shipped, ordered, balance = as_col(shipped), as_col(ordered), as_col(balance)
    dated = as_col(ship_date).isNotNull()
    status = (
        F.when(dated & (shipped == 0) & (balance == 0), "DEACTIVE")
        .when(dated & (shipped >= ordered), "COMPLETE")
        .when(dated & (balance > 0), "PARTIAL")
    )
    if generation > 1:
        status = status.when(as_col(unconfirmed) == 1, "UNCONFIRMED")
    return status.otherwise("ACTIVE")


def bulk_or_prepack(scale_cell: ColumnOrName, kind_cell: ColumnOrName) -> Column:
    """BULK or PPK when both marks on the form agree, else NULL."""
    zero_scale = F.coalesce(as_col(scale_cell), F.lit("")).contains("00")
    says_bulk = F.coalesce(as_col(kind_cell), F.lit("")).contains("BULK")
    return F.when(zero_scale & says_bulk, "BULK").when(~zero_scale & ~says_bulk, "PPK")


def knit_or_woven(knit_cell: ColumnOrName, woven_cell: ColumnOrName) -> Column:
    """K or W by the box that is ticked; NULL when neither is."""
    return F.when(as_col(knit_cell) == CHECKED_BOX, "K").when(
        as_col(woven_cell) == CHECKED_BOX, "W"
    )
