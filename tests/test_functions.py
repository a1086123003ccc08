import math

import pytest
from pyspark.sql import functions as F

from cardrail.functions import amounts, cards, codes, dates, text
from cardrail.functions.payload import Payload


def test_strip_covers_every_blank(apply):
    assert apply(text.strip, [" \t\n a b \x1f\xa0 　", "", "  ", None]) == ["a b", "", "", None]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("16/09/2025 09:49:28", "2025-09-16T09:49:28Z"),
        ("1/9/2025", "2025-09-01T00:00:00Z"),
        ("2025-09-16 09:49:28", "2025-09-16T09:49:28Z"),
        ("2025-09-16T09:49:28", "2025-09-16T09:49:28Z"),
        ("2025-09-16T09:49:28Z", "2025-09-16T09:49:28Z"),
        ("29/02/2024", "2024-02-29T00:00:00Z"),
        ("16/9/2025 9:5:7", "2025-09-16T09:05:07Z"),
        ("2025-09-16t09:49:28z", "2025-09-16T09:49:28Z"),
        ("16/09/2025\t \t09:49:28", "2025-09-16T09:49:28Z"),
        (" 16/09/2025 \n", "2025-09-16T00:00:00Z"),
        ("2025-09- 5 10:00:00", "2025-09-05T10:00:00Z"),
        ("16/09/0999", "999-09-16T00:00:00Z"),
        ("016/09/2025", None),
        ("16/009/2025", None),
        ("16/09/0000", None),
        ("16/09/2025 09:49", None),
        ("2025-09-16T09:49:28+00:00", None),
        ("31/02/2025", None),
        ("0/1/2025", None),
        ("16/13/2025", None),
        ("16/09/25", None),
        ("2025-09-16", None),
        ("2025-09-16 09:49:28Z", None),
        ("16/09/2025 24:00:00", None),
        ("16/09/2025 23:59:60", None),
        ("2025-09-16T09:49:28.5", None),
        ("2025-09-  5 10:00:00", None),
        ("16/09/2025\nx", None),
        ("", None),
        ("   ", None),
        (None, None),
    ],
)
def test_dates(apply, value, expected):
    assert apply(dates.to_iso8601, [value]) == [expected]


def test_dates_do_not_depend_on_the_session_zone(spark, apply):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        # this wall-clock time does not exist in that zone
        assert apply(dates.to_iso8601, ["2025-03-30 02:30:00"]) == ["2025-03-30T02:30:00Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("150.00", 150.0),
        (" 12 ", 12.0),
        ("1e5", 1e5),
        ("+5", 5.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1_000", 1000.0),
        ("1_0.0_1e1_0", 1.001e11),
        ("Infinity", math.inf),
        ("-inf", -math.inf),
        ("1e400", math.inf),
        ("abc", None),
        ("", None),
        ("1.0d", None),
        ("1f", None),
        ("0x10", None),
        ("1__0", None),
        ("_1", None),
        ("1_", None),
        ("1_e5", None),
        (".", None),
        ("+", None),
        ("1e", None),
        (None, None),
    ],
)
def test_amounts(apply, value, expected):
    assert apply(amounts.parse_amount, [value]) == [expected]


def test_signed_nan(apply):
    assert all(math.isnan(v) for v in apply(amounts.parse_amount, ["nan", "+nan", "-NaN"]))


VALID_PANS = """4539578763621486 5321962100025057 2223003122003222 378282246310005 6200000000000005
6011111111111117 6500000000000002 3530111333300000 2221000000000009 2721000000000004""".split()


def test_luhn(apply):
    good = [*VALID_PANS, "4539 5787 6362 1486", "4539-5787-6362-1486"]
    bad = ["4539578763621487", "4111", "", "   ", "0" * 20]
    assert apply(cards.passes_luhn, good + bad) == [True] * len(good) + [False] * len(bad)


@pytest.mark.parametrize(
    "pan, scheme",
    [
        ("4", "VISA"),
        ("51", "MASTERCARD"),
        ("55", "MASTERCARD"),
        ("2220", "UNKNOWN"),
        ("2221", "MASTERCARD"),
        ("2720", "MASTERCARD"),
        ("2721", "UNKNOWN"),
        ("222", "UNKNOWN"),
        ("34", "AMEX"),
        ("37", "AMEX"),
        ("3 45", "UNKNOWN"),
        ("62", "UNIONPAY"),
        ("6011", "DISCOVER"),
        ("65", "DISCOVER"),
        ("35", "UNKNOWN"),
        ("X1", None),
        ("None", None),
        ("", None),
    ],
)
def test_card_scheme(apply, pan, scheme):
    assert apply(cards.card_scheme, [pan]) == [scheme]


def test_mask_and_bin(apply):
    pans = ["", "123456789", "1234567890", "12345678901", "4539578763621486", "12345"]
    assert apply(cards.mask_pan, pans) == [
        "",
        "*" * 9,
        "1234567890",
        "123456*8901",
        "453957******1486",
        "*****",
    ]
    assert apply(cards.pan_bin, pans) == [None, "123456", "123456", "123456", "453957", None]


def test_code_tables(apply):
    assert apply(codes.currency_alpha, ["504", "999", "", None]) == ["MAD", None, None, None]
    assert apply(codes.currency_minor_units, ["392", "788", "999", "None"]) == [0, 3, 2, 2]
    assert apply(codes.mti_name, ["1430", "9999"]) == ["Reversal Advice Response", None]
    assert apply(codes.mcc_description, ["6012"]) == [
        "Financial Institutions — Merchandise, Services"
    ]
    assert (len(codes.MESSAGE_TYPES), len(codes.CURRENCIES), len(codes.MERCHANT_CATEGORIES)) == (15, 23, 19)


def test_payload_tells_null_from_absent(spark):
    rows = spark.createDataFrame(
        [({"A": " x "},), ({"A": None},), ({"B": "y"},), ({"A": ""},)], "payload map<string,string>"
    )
    words = rows.select(Payload.of(rows).text("A").alias("t")).collect()
    assert [r.t for r in words] == ["x", "None", "", ""]
    blanks = rows.select(Payload.of(rows, none_as_text=False).text("A").alias("t")).collect()
    assert [r.t for r in blanks] == ["x", "", "", ""]
    table = rows.select(F.struct(F.lit(None).cast("string").alias("A")).alias("payload"))
    p = Payload.of(table)
    assert tuple(table.select(p.text("A"), p.text("B"), p.raw("B")).first()) == ("None", "", None)


def test_mask_in_text(apply):
    texts = {
        "card 4539578763621486.": "card 453957******1486.",
        "4539 5787 6362 1486": "4539 5*********1486",
        "12 4539-5787-6362-1486 x": "12 4539-5*********1486 x",
        "1700000000000 4539578763621486 2024": "1700000000000 453957******1486 2024",
        "3782 822463 10005": "3782 8" + "*" * 7 + "0005",
        "4539578763621487": "4539578763621487",
        "45395787636214860000000": "45395787636214860000000",
        "no number": "no number",
        "": "",
        '{"a":"4111111111111111","b":4111111111111111': '{"a":"411111******1111","b":411111******1111',
        "two 4111111111111111 and 5555 5555 5555 4444": "two 411111******1111 and 5555 5*********4444",
    }
    assert apply(cards.mask_in_text, list(texts)) == list(texts.values())
    assert apply(cards.mask_in_text, [None]) == [None]
