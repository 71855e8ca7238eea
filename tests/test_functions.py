import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import amounts, dates, nested, rules, text


def one(spark, expr, **values):
    """Value of an expression over one row; columns come from a scan, not folded."""
    types = {str: "string", int: "int", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).collect()[0][0]


@pytest.mark.parametrize("value", ["", "7", "-5", "+5", "123456", "1234567", "AB", "-"])
@pytest.mark.parametrize("width", [2, 3, 6])
def test_zfill_is_pythons(spark, value, width):
    assert one(spark, text.zfill("c", width), c=value) == value.zfill(width)


def test_zfill_null(spark):
    assert one(spark, text.zfill("c", 6), c=None) is None


@pytest.mark.parametrize(
    "value,generation,expected",
    [
        ("1234-A", 3, "001234"),
        ("", 3, "000000"),
        (None, 3, ""),
        ("1234567-A", 3, ""),
        ("1234567-A", 2, "1234567"),
        (None, 2, None),
        ("", 1, "000000"),
    ],
)
def test_po_ref(spark, value, generation, expected):
    assert one(spark, text.po_ref("c", generation), c=value) == expected


def test_ids_and_seasons(spark):
    assert one(spark, text.clean_id("c"), c=" ab 1\t") == "AB1\t"
    assert one(spark, text.squeeze_id("c"), c=" ab 1\t2 ") == "AB12"
    assert one(spark, text.strip("c"), c="\t a b ") == "a b"
    assert one(spark, text.season_code("c"), c="spring 2020") == "SP-20"
    assert one(spark, text.season_after_colon("c"), c="x: SEASON: fa 2019 ") == "fa-19"
    assert one(spark, text.season_from_open("a", "b"), a="s", b="2020") == "SP-20"
    assert one(spark, text.season_from_open("a", "b"), a="F", b="2020") == "FA-20"
    assert one(spark, text.count_after_colon("c"), c="CTN: 24X") == 24
    assert one(spark, text.count_after_colon("c"), c="CTN") is None
    assert one(spark, text.scale_after_at("c"), c="a @B1 @ C2 ") == "C2"
    assert one(spark, text.numeric_code("c", 2), c="5.0") == "05"
    assert one(spark, text.numeric_code("c", 2), c="5") == "05"
    assert one(spark, text.numeric_code("c", 2), c="A5") == "A5"
    assert one(spark, text.code_part("c"), c="12-NAVY-X") == "012"
    assert one(spark, text.desc_part("c"), c="12-NAVY-X") == "NAVY"
    assert one(spark, text.desc_part("c"), c="12") == ""


@pytest.mark.parametrize(
    "value,ok", [("ABCD1234567", 1), ("AIR", 1), ("FEDEX", 1), ("ABC1234567", 0), ("abcd1234567", 0), (None, 0)]
)
def test_container_format(spark, value, ok):
    assert one(spark, text.valid_container("c").cast("int"), c=value) == ok


def test_dates(spark):
    assert one(spark, dates.us_date("c"), c="7/4/2020") == dt.date(2020, 7, 4)
    assert one(spark, dates.us_date("c"), c="07/04/2020") == dt.date(2020, 7, 4)
    assert one(spark, dates.us_date_or_null("c"), c=" ") is None
    assert one(spark, dates.iso_date_prefix("c"), c="2020-07-04 00:00:00") == dt.date(2020, 7, 4)
    assert one(spark, dates.days_until(F.to_date("c"), "2020-07-01"), c="2020-07-04") == 3
    with pytest.raises(Exception, match="not a month/day/year date"):
        one(spark, dates.us_date("c"), c="2020-07-04")
    with pytest.raises(Exception, match="not a month/day/year date"):
        one(spark, dates.us_date("c"), c="")


def test_amounts(spark):
    assert one(spark, amounts.row_max("a", "b"), a=1, b=2) == 2
    assert one(spark, amounts.row_max(F.lit(None).cast("int"), "b"), b=2) == 2
    assert one(spark, amounts.int_div("a", "b"), a=-7, b=2) == -3
    assert one(spark, amounts.int_div("a", "b"), a=7, b=0) is None
    assert one(spark, amounts.pack_count("a", "b"), a=12, b=4) == 3
    assert one(spark, amounts.pack_count("a", "b"), a=13, b=4) is None
    assert one(spark, amounts.pack_count("a", "b"), a=13, b=0) is None
    assert one(spark, amounts.duty_free_amount(F.lit(None).cast("double"), "b", "c"), b=1.0, c=3) == 0.0
    assert one(spark, amounts.override("a", "b"), a="K", b="") == "K"
    assert one(spark, amounts.override("a", "b"), a="K", b="W") == "W"


@pytest.mark.parametrize(
    "shipped,ordered,bal,dated,mark,expected",
    [
        (0, 10, 0, True, 1, "DEACTIVE"),
        (10, 10, 0, True, 1, "COMPLETE"),
        (4, 10, 6, True, 1, "PARTIAL"),
        (0, 10, 10, False, 1, "UNCONFIRMED"),
        (0, 10, 10, False, 0, "ACTIVE"),
        (4, 10, 0, True, 0, "ACTIVE"),
        (10, 10, 0, False, 0, "ACTIVE"),
    ],
)
def test_order_status(spark, shipped, ordered, bal, dated, mark, expected):
    day = F.when(F.col("d") == 1, F.current_date())
    status = rules.order_status("s", "o", "b", day, "u")
    assert one(spark, status, s=shipped, o=ordered, b=bal, d=int(dated), u=mark) == expected
    if expected == "UNCONFIRMED":
        first = rules.order_status("s", "o", "b", day, "u", generation=1)
        assert one(spark, first, s=shipped, o=ordered, b=bal, d=int(dated), u=mark) == "ACTIVE"


def test_classification(spark):
    assert one(spark, rules.category("c"), c="MENS KL X WS Y") == "K"
    assert one(spark, rules.sleeve("c"), c="MENS WS X KL Y") == "L/S"
    assert one(spark, rules.category("c"), c=None) == ""
    assert one(spark, rules.rm_group("g", "c"), g="POLY POLO", c="W") == "POLY KNITS"
    assert one(spark, rules.rm_group("g", "c"), g="", c="W") == "OTHER WOVEN"
    assert one(spark, rules.bulk_or_prepack("a", "b"), a="00/x", b="BULK") == "BULK"
    assert one(spark, rules.bulk_or_prepack("a", "b"), a="A1", b="PPK") == "PPK"
    assert one(spark, rules.bulk_or_prepack("a", "b"), a="00", b="PPK") is None
    assert one(spark, rules.knit_or_woven("a", "b"), a="", b="( X )") == "W"
    assert one(spark, rules.unconfirmed_flag("c", 1), c="x") == 1
    assert one(spark, rules.unconfirmed_flag("c", 3), c="x") == 0


def scale_by_hand(desc):
    pairs = [w.split("/") for w in desc.split() if "/" in w]
    try:
        sizes, quantities = [p[1] for p in pairs], [int(p[0]) for p in pairs]
    except ValueError:
        return None, None, "quantity is not a whole number"
    if len(sizes) > 8:
        return None, None, "more than eight sizes"
    missing = 8 - len(sizes)
    return sizes + ["NONE"] * missing, quantities + [0] * missing, None


@pytest.mark.parametrize(
    "desc",
    [
        "2/S 4/M 4/L 2/XL",
        "  2/S\t4/M junk  ",
        "no slash here",
        "",
        "x/S 2/M",
        "/S",
        "2/S 2.0/M",
        " ".join(["1/A"] * 8),
        " ".join(["1/A"] * 9),
        "1/2/3 4/5",
    ],
)
def test_parse_scale(spark, desc):
    scale = one(spark, nested.parse_scale("c"), c=desc)
    assert (scale["sizes"], scale["quantities"], scale["error"]) == scale_by_hand(desc)


@pytest.mark.parametrize(
    "text_,expected",
    [
        ("10/S-20/M", {"S": 10, "M": 20}),
        (" 10 / s - 20/m l", {"S": 10, "M L": 20}),
        ("1/S-2/M-3/S", {"S": 3, "M": 2}),
        ("", {"none": 0}),
        (None, {"none": 0}),
        ("10S-20/M", None),
        ("x/S", None),
        ("5/S/M", {"S": 5}),
        ("1234567890123/S-1/M", {"S": 1234567890123, "M": 1}),
        ("9223372036854775808/S-1/M", None),
    ],
)
def test_curve_map(spark, text_, expected):
    assert one(spark, nested.curve_map("c"), c=text_) == expected


@pytest.mark.parametrize(
    "text_,expected",
    [
        ("1/S 2/M", {"S": 1, "M": 2}),
        ("ASSORTED", {"none": 0}),
        ("1/S junk", None),
        ("1/S 3/S", {"S": 3}),
        ("1234567890/S 1/M", {"S": 1234567890, "M": 1}),
    ],
)
def test_scale_map(spark, text_, expected):
    assert one(spark, nested.scale_map("c"), c=text_) == expected


def test_long_quantities(spark):
    scale = one(spark, nested.parse_scale("c"), c="1234567890/S 2/M")
    assert (scale["quantities"][:2], scale["error"]) == ([1234567890, 2], None)
    scale = one(spark, nested.parse_scale("c"), c="1/S 99999999999999999999/M")
    assert (scale["quantities"], scale["error"]) == (None, "quantity is too large")
    assert one(spark, text.whole_number("c"), c=" 1234567890 ") == 1234567890
    assert one(spark, text.whole_number("c"), c="99999999999999999999") is None


def test_labels_and_alignment(spark):
    labels = nested.range_labels([F.lit(v) for v in ("S", "", "M", "S", "", "", "", "")])
    assert one(spark, labels, c="x") == ["S", "", "M"]
    assert one(spark, nested.range_labels([F.lit("")] * 8), c="x") == []
    df = spark.createDataFrame([({"M": 2, "S": 1, "Z": 9}, ["S", "L", "M"])], "c map<string,int>, l array<string>")
    assert df.select(nested.align_curve("c", "l")).collect()[0][0] == [1, 0, 2, 0, 0, 0, 0, 0]
    nine = F.array(*[F.lit(str(i)) for i in range(9)])
    assert df.select(nested.align_curve("c", nine)).collect()[0][0] is None
    assert df.select(nested.pack_size("c")).collect()[0][0] == 12
    assert df.select(nested.explode_prepack("c", F.lit(3))).collect()[0][0] == {"M": 6, "S": 3, "Z": 27}
