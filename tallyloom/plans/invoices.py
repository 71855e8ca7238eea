"""Commercial invoices: five reconciliations, then three tables in one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.amounts import duty_free_amount, fill, line_amount, money, money_sum
from ..operators.checks import Rule, all_exceptions, apart, missing_reference, stacked_exceptions, totals_mismatch
from ..operators.compare import live, ne_or_null
from ..operators.mutate import require_keys, update_from, upsert
from ..params import MONEY_TOLERANCE
from ..schemas import KEYS
from ..session import stage
from . import Load

_PAIR = ["CONTAINER_NBR", "HFC_NBR"]
_HEADER_SET = {
    "LC_NBR": "LC_NBR",
    "DN_NBR": "DN_NBR",
    "DN_AMT": "DN_AMT",
    "PAID_DATE": "PAID_DATE",
    "COM_PAID_DATE": "COMMISSION_PAID_DATE",
    "FILE_NBR": "FILE_NBR",
    "ACH_PAID_DATE": "ACH_PAID_DATE",
    "ACH_AMT": "ACH_AMOUNT",
    "CARTON_CTN": "CARTON_COUNT",
    "OBL_AWB": "OBL_AWB",
    "FIRST_SALE_AMT": "FIRST_SALE_AMT",
    "LC_AMT": "LC_AMT",
    "QTY": "QTY",
    "CTNS": "CTNS",
}
_DETAIL_SET = {
    c: c
    for c in ("PCS", "PRICE", "HANGER_COST", "LINE_AMT", "DUTY_FREE_PRICE", "DUTY_FREE_LINE_AMT")
}


_TOTALS = [
    ("DUTY_FREE_LINE_AMT", "FIRST_SALE_AMT", MONEY_TOLERANCE),
    ("LINE_AMT", "LC_AMT", MONEY_TOLERANCE),
    ("PCS", "QTY", "0.000001"),
]


def clean_invoice_headers(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: text.clean_id(c) for c in ("INVOICE_NBR", "LC_NBR", "OBL_AWB")})


def clean_invoice_details(raw: DataFrame) -> DataFrame:
    """Invoice lines with their full and duty-free amounts."""
    return raw.withColumns(
        {
            "INVOICE_NBR": text.clean_id("INVOICE_NBR"),
            "HFC": text.zfill("HFC", 6),
            "STYLE": text.zfill("STYLE", 6),
            "LINE_AMT": line_amount("PRICE", "HANGER_COST", "PCS"),
            "DUTY_FREE_LINE_AMT": duty_free_amount("DUTY_FREE_PRICE", "HANGER_COST", "PCS"),
        }
    )


def clean_payments(raw: DataFrame) -> DataFrame:
    """Payments, with the bank transfer of a file copied to all its invoices.

    A file names its transfer once; a second one would double its invoices
    and stops the job.
    """
    paid = raw.withColumns(
        {
            "INVOICE_NBR": text.clean_id("INVOICE_NBR"),
            **{c: dates.to_day(c) for c in ("PAID_DATE", "COMMISSION_PAID_DATE", "ACH_PAID_DATE")},
        }
    )
    transfer = ["FILE_NBR", "ACH_PAID_DATE", "ACH_AMOUNT"]
    transfers = require_keys(paid.select(*transfer).na.drop(), ["FILE_NBR"], "bank transfers")
    return paid.drop("ACH_PAID_DATE", "ACH_AMOUNT").join(transfers, "FILE_NBR", "left")


def clean_invoice_containers(raw: DataFrame) -> DataFrame:
    return raw.select(
        text.clean_id("INVOICE_NBR").alias("INVOICE_NBR"),
        text.clean_id("CONTAINER_NBR").alias("CONTAINER_NBR"),
        text.zfill("HFC", 6).alias("HFC_NBR"),
    )


def invoice_totals(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Agents' totals of billed invoices next to the totals of their lines."""
    sums = details.groupBy("INVOICE_NBR").agg(
        F.sum("PCS").alias("PCS"),
        money_sum("LINE_AMT").alias("LINE_AMT"),
        money_sum("DUTY_FREE_LINE_AMT").alias("DUTY_FREE_LINE_AMT"),
    )
    return headers.filter(F.col("OBL_AWB").isNotNull()).join(sums, "INVOICE_NBR", "left")


def total_differences(summary: DataFrame) -> DataFrame:
    return totals_mismatch(summary, _TOTALS)


def carton_differences(summary: DataFrame, shipped: DataFrame) -> DataFrame:
    """Invoices whose carton count is not the sum of their containers."""
    cartons = shipped.groupBy("INVOICE_NBR").agg(F.sum("CARTON_CTN").alias("CTN_SUM"))
    return (
        summary.join(cartons, "INVOICE_NBR", "left")
        .withColumn("CTN_SUM", fill("CTN_SUM", 0))
        .filter(ne_or_null("CTN_SUM", "CTNS"))
    )


def piece_differences(details: DataFrame, po_headers: DataFrame, shipped: DataFrame) -> DataFrame:
    """Invoice/order pairs whose pieces do not fill the cartons shipped.

    Pairs known on one side only are not reported; an unknown or empty carton
    size is.
    """
    pieces = details.groupBy("INVOICE_NBR", "HFC").agg(F.sum("PCS").alias("PCS"))
    sizes = live(po_headers).select(F.col("HFC_NBR").alias("HFC"), "CARTON_SIZE")
    sizes = require_keys(sizes, ["HFC"], "purchase order headers")
    cartons = shipped.groupBy("INVOICE_NBR", F.col("HFC_NBR").alias("HFC")).agg(
        F.sum("CARTON_CTN").alias("CTN_SUM")
    )
    return (
        pieces.join(cartons, ["INVOICE_NBR", "HFC"])
        .join(sizes, "HFC", "left")
        .withColumn("CARTONS", F.try_divide(F.col("PCS"), F.col("CARTON_SIZE")))
        .filter(ne_or_null("CARTONS", "CTN_SUM"))
    )


def bill(headers: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoice headers with their payments; either side may be missing."""
    return headers.join(payments, "INVOICE_NBR", "full_outer")


def loaded_boxes(containers: DataFrame) -> DataFrame:
    """Containers that are on a bill of lading."""
    return containers.filter(F.col("OBL_AWB").isNotNull()).select(*_PAIR, "OBL_AWB", "CARTON_CTN")


def new_headers(state: DataFrame, billed: DataFrame) -> DataFrame:
    return upsert(state, billed, KEYS["INVOICE_HEADER"], _HEADER_SET)


def new_details(state: DataFrame, details: DataFrame) -> DataFrame:
    return upsert(state, details, KEYS["INVOICE_DETAIL"], _DETAIL_SET)


def stamp(containers: DataFrame, shipped: DataFrame) -> DataFrame:
    """Containers with the invoice of each shipped box."""
    return update_from(containers, shipped.select(*_PAIR, "INVOICE_NBR"), _PAIR, {"INVOICE_NBR": "INVOICE_NBR"})


def order_sums(lines: DataFrame, boxes: DataFrame) -> DataFrame:
    """Sums of lines and boxes per invoice and order: both are stacked and aggregated once.

    The rows are dealt by invoice before they are summed: an invoice hardly
    has two lines of an order, and sums in decimals are wider than the rows.
    The orders of an invoice stay together for :func:`invoice_sums`.
    """
    amounts = ("LINE_AMT", "DUTY_FREE_LINE_AMT")
    stacked = lines.select("INVOICE_NBR", "HFC", "PCS", *amounts, F.lit(1).alias("LINES")).unionByName(
        boxes.select("INVOICE_NBR", F.col("HFC_NBR").alias("HFC"), "CARTON_CTN", F.lit(1).alias("BOXES")), allowMissingColumns=True
    )
    sums = [F.sum("PCS").alias("PCS"), *[F.sum(money(c)).alias(c) for c in amounts]]
    return stacked.repartition("INVOICE_NBR").groupBy("INVOICE_NBR", "HFC").agg(
        *sums, F.sum("CARTON_CTN").alias("CTN_SUM"), F.max("LINES").alias("LINES"), F.max("BOXES").alias("BOXES")
    )


def invoice_sums(orders: DataFrame) -> DataFrame:
    """Sums per invoice; totals of the lines are null for an invoice without lines."""
    amounts = [
        F.when(F.max("LINES") == 1, F.coalesce(F.sum(c), F.lit(0)).cast("decimal(34,6)")).alias(c)
        for c in ("LINE_AMT", "DUTY_FREE_LINE_AMT")
    ]
    return orders.groupBy("INVOICE_NBR").agg(F.sum("PCS").alias("PCS"), *amounts, F.sum("CTN_SUM").alias("CTN_SUM"))


def reconcile_invoices(
    headers: DataFrame,
    details: DataFrame,
    payments: DataFrame,
    invoice_containers: DataFrame,
    containers: DataFrame,
    po_headers: DataFrame,
    po_details: DataFrame,
    state_headers: DataFrame,
    state_details: DataFrame,
) -> Load:
    """Tie agents' summaries, lines, payments, packing lists and containers
    together; all inputs but the tables are cleaned feeds.

    Lines and packing lists meet what they refer to once, which leaves a flag
    on each; both are stacked and summed per invoice and order, and those sums
    per invoice. The seven checks read these four frames once each, and their
    exceptions are written once for the count, the report and quarantine.

    Under quarantine a reported invoice is held back as a whole: its header
    and lines stay as stored and it stamps no container. A single table is
    cheaper by :func:`new_headers`, :func:`new_details` or :func:`stamp`.
    """
    known = live(po_details).select(F.col("HFC_NBR").alias("HFC"), "STYLE").distinct()
    details = stage(details)
    lines = details.join(known.withColumn("KNOWN", F.lit(True)), ["HFC", "STYLE"], "left")
    loaded = loaded_boxes(containers)
    boxes = stage(invoice_containers.join(loaded, _PAIR, "left"))
    shipped = boxes.filter(F.col("OBL_AWB").isNotNull())
    billed = bill(headers, payments)
    orders = stage(order_sums(details, shipped))

    bills = loaded.select("OBL_AWB").distinct().withColumn("LOADED", F.lit(True))
    book = billed.join(invoice_sums(orders), "INVOICE_NBR", "left").join(bills, "OBL_AWB", "left")
    sizes = live(po_headers).select(F.col("HFC_NBR").alias("HFC"), "CARTON_SIZE")
    sizes = require_keys(sizes, ["HFC"], "purchase order headers")
    both = (F.col("LINES") == 1) & (F.col("BOXES") == 1) & F.col("HFC").isNotNull()
    cartons = (
        orders.filter(both).join(sizes, "HFC", "left").withColumn("CARTONS", F.try_divide(F.col("PCS"), F.col("CARTON_SIZE")))
    )
    on_bill = F.col("OBL_AWB").isNotNull()
    invoice = ["INVOICE_NBR"]
    rules = [
        (lines, [Rule("invoice_line_unknown", F.col("KNOWN").isNull(), ["INVOICE_NBR", "HFC", "STYLE"], "order and style do not exist")]),
        (
            boxes,
            [Rule("invoice_container_unknown", F.col("OBL_AWB").isNull(), ["INVOICE_NBR", *_PAIR], "container and order were never loaded")],
        ),
        (
            book.withColumn("CTN_SUM", fill("CTN_SUM", 0)),
            [
                Rule("invoice_unbilled", F.col("LC_NBR").isNull(), invoice, "paid but not in the invoice headers"),
                Rule("invoice_totals", on_bill & apart(_TOTALS), invoice, "totals of the lines differ from the agent's", "LC_AMT", "LINE_AMT"),
                Rule(
                    "bill_of_lading_unknown", on_bill & F.col("LOADED").isNull(), ["INVOICE_NBR", "OBL_AWB"],
                    "bill of lading was never loaded",
                ),
                Rule(
                    "invoice_cartons", on_bill & ne_or_null("CTN_SUM", "CTNS"), invoice, "cartons differ from the containers",
                    "CTNS", "CTN_SUM",
                ),
            ],
        ),
        (
            cartons,
            [
                Rule(
                    "invoice_pieces", ne_or_null("CARTONS", "CTN_SUM"), ["INVOICE_NBR", "HFC"], "pieces do not fill the cartons",
                    "CTN_SUM", "CARTONS",
                )
            ],
        ),
    ]
    found = stage(all_exceptions([stacked_exceptions(frame, of_frame, invoice) for frame, of_frame in rules]))
    states = {
        "INVOICE_HEADER": new_headers(state_headers, billed),
        "INVOICE_DETAIL": new_details(state_details, details),
        "HFC_CONTAINER": stamp(containers, shipped),
    }

    def held(checks):
        return found.filter(F.col("check_id").isin(*checks)).select("INVOICE_NBR").distinct()

    own = {rule.check_id for _, of_frame in rules for rule in of_frame}

    def without(checks):
        if not own & set(checks):
            return {}
        kept_back = stage(held(checks))  # three tables leave them out
        return {
            "INVOICE_HEADER": new_headers(state_headers, missing_reference(billed, kept_back, ["INVOICE_NBR"])),
            "INVOICE_DETAIL": new_details(state_details, missing_reference(details, kept_back, ["INVOICE_NBR"])),
            "HFC_CONTAINER": stamp(containers, missing_reference(shipped, kept_back, ["INVOICE_NBR"])),
        }

    return Load(states, found.drop("INVOICE_NBR"), without=without, held=held)
