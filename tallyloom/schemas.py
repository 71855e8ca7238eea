"""Feed layouts (position -> name, type) and table schemas."""

from __future__ import annotations

from .functions.amounts import buckets

# fixed values: positions, names and types of the extracts
_SIZES_19_26 = {19 + i: (name, "long") for i, name in enumerate(buckets())}

CUSTOMER_ORDER = {
    0: ("DIV", "int"),
    2: ("CUST_NBR", "string"),
    4: ("CUST_PO", "string"),
    5: ("GREEN_BAR", "string"),
    6: ("ORDER_DATE", "string"),
    7: ("START_SHIP", "string"),
    8: ("CXL_SHIP", "string"),
    10: ("SEASON", "string"),
    11: ("STYLE", "string"),
    13: ("COLOR", "string"),
    14: ("SP", "double"),
    16: ("ORDERED_UNITS", "long"),
    18: ("SHIPPED_UNITS", "long"),
    19: ("SHIP_ON_DATE", "string"),
    21: ("PICK_UNITS", "long"),
    22: ("UNCONFIRMED", "string"),
}
OPEN_ORDERS = {
    4: ("GREEN_BAR", "string"),
    10: ("STYLE", "string"),
    12: ("COLOR", "string"),
    16: ("SHIPPED", "long"),
    17: ("BAL", "long"),
    **_SIZES_19_26,
}
ASSOCIATION = {
    1: ("GREEN_BAR", "string"),
    3: ("STYLE", "string"),
    4: ("COLOR", "string"),
    5: ("HFC", "string"),
}
INVENTORY = {
    7: ("STYLE", "string"),
    8: ("COLOR_DESC", "nullable string"),
    9: ("COLOR_CODE", "string"),
    14: ("OH", "int"),
    **_SIZES_19_26,
}
BUY_SUMMARY_HEADER = {
    0: ("DIV", "int"),
    2: ("CUST_NBR", "nullable string"),
    3: ("SSN", "nullable string"),
    4: ("HFC", "nullable string"),
    6: ("X_ORIENT", "nullable string"),
    10: ("X_SHIP", "nullable string"),
    15: ("CAT", "nullable string"),
    35: ("AGENT", "nullable string"),
    37: ("COO", "nullable string"),
    39: ("CARTON_SIZE", "int"),
    40: ("HFC_SIZE_SCALE", "nullable string"),
}
BUY_SUMMARY_LINES = {
    3: ("SSN", "nullable string"),
    4: ("HFC", "nullable string"),
    17: ("STYLE", "string"),
    19: ("ASST", "nullable string"),
    21: ("COLOR", "string"),
    22: ("FOB", "double"),
    23: ("ELC", "double"),
    24: ("SP", "double"),
    25: ("MSRP", "double"),
    27: ("UNITS", "long"),
    40: ("HFC_LINE_SIZE_SCALE", "nullable string"),
}
BUY_SIZE_BREAK = {
    3: ("HFC", "string"),
    10: ("STYLE", "string"),
    12: ("COLOR", "string"),
    **_SIZES_19_26,
}
STYLE_MASTER_FEED = {
    1: ("STYLE", "string"),
    2: ("STYLE_DESC", "nullable string"),
    3: ("PROTO", "nullable string"),
    4: ("SIZE_RANGE", "nullable string"),
    5: ("OPEN_SSN", "string"),
    6: ("OPEN_YR", "string"),
    7: ("DIV", "int"),
    8: ("LABEL", "nullable string"),
    11: ("SP", "double"),
    12: ("ELC", "double"),
    13: ("ILC", "double"),
    15: ("BRAND_NAME", "nullable string"),
    16: ("FABRIC", "nullable string"),
    29: ("RESERVE", "double"),
    30: ("ROYALTY", "double"),
    34: ("PPK", "nullable string"),
}
RECEIVING_1 = {
    0: ("CTRL_NBR", "string"),
    1: ("REC_NBR", "string"),
    2: ("REC_DATE", "string"),
    3: ("HFC", "string"),
    4: ("STYLE", "string"),
    5: ("COLOR", "string"),
    8: ("REC_UNITS", "long"),
}
RECEIVING_2 = {
    "CTRL_NBR": "nullable string",
    "HFC": "nullable string",
    "STYLE": "nullable string",
    "COLOR": "nullable string",
    "REC_UNITS": "int",
    **{b: "int" for b in buckets()},
    "CONTAINER_NBR": "nullable string",
    "REC_DATE": "nullable string",
    "INVOICE_NBR": "nullable string",
}
UPCOMING_CONTAINERS = {
    0: ("SHIPMENT_NBR", "nullable string"),
    2: ("ETA", "nullable string"),
    4: ("CONTAINER_NBR", "nullable string"),
    5: ("HFC_NBR", "nullable string"),
    6: ("CARTON_CTN", "int"),
}
CUSTOMER_FEED = {"CUST_NBR": "string", "CUST_NAME": "nullable string", "AD": "double", "LOAD": "double"}
MAKER_ECOM = {"HFC": "string", "MAKER": "nullable string", "ECOM": "int"}
STYLE_OVERRIDES = {
    "STYLE": "string",
    "CAT_2": "nullable string",
    "SLV_2": "nullable string",
    "INV_GROUP": "nullable string",
    "BUY_GROUP_MAIN": "nullable string",
    "BUY_GROUP_SUB": "nullable string",
    "SIZE": "nullable string",
}
SHORT_OVER_FEED = {"PO": "string", "STYLE": "string", "COLOR": "string", "DIFF": "int"}
INVOICE_HEADER_FEED = {
    "INVOICE_NBR": "string",
    "LC_NBR": "nullable string",
    "DN_NBR": "nullable string",
    "DN_AMT": "double",
    "OBL_AWB": "nullable string",
    "FIRST_SALE_AMT": "double",
    "LC_AMT": "double",
    "QTY": "long",
    "CTNS": "long",
}
INVOICE_DETAIL_FEED = {
    "INVOICE_NBR": "string",
    "HFC": "string",
    "STYLE": "string",
    "PCS": "long",
    "PRICE": "double",
    "HANGER_COST": "double",
    "DUTY_FREE_PRICE": "double",
}
INVOICE_CONTAINER_FEED = {"INVOICE_NBR": "string", "CONTAINER_NBR": "string", "HFC": "string"}
INVOICE_PAID_FEED = {
    "INVOICE_NBR": "string",
    "PAID_DATE": "nullable string",
    "COMMISSION_PAID_DATE": "nullable string",
    "ACH_PAID_DATE": "nullable string",
    "ACH_AMOUNT": "double",
    "FILE_NBR": "nullable string",
    "CARTON_COUNT": "long",
}


def _cols(names: list[str], kind: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names)


TABLES = {
    "CUSTOMER": "CUST_NBR string, CUST_NAME string, AD_PCT double, LOAD_PCT double",
    "SIZE_RANGE": "SIZE_RANGE_CODE string, " + _cols(buckets(), "string"),
    "SIZE_SCALE": "SIZE_SCALE_CODE string, SIZE_SCALE_DESC string, "
    + _cols(buckets("S", "_SIZE"), "string")
    + ", "
    + _cols(buckets("S", "_QTY"), "int"),
    "STYLE_MASTER": "STYLE string, STYLE_DESC string, DIV int, PROTO string, SIZE_RANGE_CODE string, "
    "SLV string, SEASON string, LABEL_CODE string, CAT string, INV_GROUP string, BUY_GROUP_MAIN string, "
    "BUY_GROUP_SUB string, RM_GROUP string, SP double, ELC double, ILC double, BRAND_NAME string, "
    "FABRIC string, RESERVE double, ROYALTY double, PPK string, REG_BT string, CXL int",
    "HFC_HEADER": "HFC_NBR string, SHIP_DATE date, SEASON string, DIV int, CUST_NBR string, CARTON_SIZE int, "
    "X_ORIENT date, AGENT string, COO string, HFC_SIZE_SCALE_CODE string, CAT string, CXL int, "
    "MAKER string, IS_ECOM int, CTN_TO_COME long",
    "HFC_DETAIL": "HFC_NBR string, STYLE string, COLOR_CODE string, COLOR_DESC string, "
    "HFC_LINE_SIZE_SCALE_CODE string, ASST string, FOB double, ELC double, SP double, MSRP double, "
    "TTL_QTY long, " + _cols(buckets("S", "_QTY"), "long") + ", CXL int",
    "HFC_ASSOC": "GREEN_BAR string, STYLE string, COLOR string, HFC string, SEASON string, CXL int",
    "CUST_ORDER": "GREEN_BAR string, STYLE string, COLOR string, DIV int, CUST_NBR string, ORDER_DATE date, "
    "START_SHIP date, CXL_SHIP date, CUST_PO string, SEASON string, SP double, ORDERED_UNITS long, "
    "SHIPPED_UNITS long, BAL_UNITS long, PICK_UNITS long, SHIP_ON_DATE date, UNCONFIRMED int, "
    "COMMENT string, COMMENT_2 string, "
    + _cols(buckets("ORDERED_S"), "long")
    + ", "
    + _cols(buckets("BAL_S"), "long")
    + ", CXL int",
    "INV": "STYLE string, COLOR_CODE string, COLOR_DESC string, OH long, "
    + _cols(buckets("OH_S"), "long")
    + ", CXL int",
    "RECEIVING": "CTRL_NBR string, HFC_NBR string, STYLE string, COLOR string, CONTAINER_NBR string, "
    "REC_NBR string, REC_DATE date, " + _cols(buckets("REC_S"), "long") + ", REC_UNITS long, INVOICE_NBR string",
    "SHORT_OVER": "HFC string, STYLE string, COLOR string, DIFF int",
    "HFC_CONTAINER": "HFC_NBR string, CONTAINER_NBR string, CARTON_CTN int, ETA date, SHIPMENT_NBR string, "
    "RECVD int, CTN_TO_COME long, INVOICE_NBR string, WHSE_REC_DATE date, OBL_AWB string",
    "INVOICE_HEADER": "INVOICE_NBR string, LC_NBR string, OBL_AWB string, FIRST_SALE_AMT double, LC_AMT double, "
    "QTY long, CTNS long, DN_NBR string, DN_AMT double, PAID_DATE date, COM_PAID_DATE date, FILE_NBR string, "
    "ACH_PAID_DATE date, ACH_AMT double, CARTON_CTN long",
    "INVOICE_DETAIL": "INVOICE_NBR string, HFC string, STYLE string, PCS long, PRICE double, HANGER_COST double, "
    "LINE_AMT double, DUTY_FREE_PRICE double, DUTY_FREE_LINE_AMT double",
}

# fixed values: unique key of each table
KEYS = {
    "CUSTOMER": ["CUST_NBR"],
    "SIZE_RANGE": ["SIZE_RANGE_CODE"],
    "SIZE_SCALE": ["SIZE_SCALE_CODE"],
    "STYLE_MASTER": ["STYLE"],
    "HFC_HEADER": ["HFC_NBR"],
    "HFC_DETAIL": ["HFC_NBR", "STYLE", "COLOR_CODE"],
    "HFC_ASSOC": ["GREEN_BAR", "STYLE", "COLOR"],
    "CUST_ORDER": ["GREEN_BAR", "STYLE", "COLOR"],
    "INV": ["STYLE", "COLOR_CODE"],
    "RECEIVING": ["CTRL_NBR", "HFC_NBR", "STYLE", "COLOR", "CONTAINER_NBR"],
    "SHORT_OVER": ["HFC", "STYLE", "COLOR"],
    "HFC_CONTAINER": ["HFC_NBR", "CONTAINER_NBR"],
    "INVOICE_HEADER": ["INVOICE_NBR"],
    "INVOICE_DETAIL": ["INVOICE_NBR", "HFC", "STYLE"],
}

# tables stored by season, so that a load rewrites only the seasons it touches
SEASON_TABLES = ("CUST_ORDER", "HFC_ASSOC", "HFC_HEADER")
