"""Card-number functions: check digit, masking, issuer range, scheme."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Leading digits per scheme; the first scheme that matches wins.
VISA_PREFIX = "4"
MASTERCARD_PREFIXES = ("51", "52", "53", "54", "55")
MASTERCARD_RANGE = (2221, 2720)
AMEX_PREFIXES = ("34", "37")
UNIONPAY_PREFIX = "62"
DISCOVER_PREFIXES = ("6011", "65")

PAN_DIGITS = (13, 19)
BIN_LENGTH = 6
MASK_KEEP_HEAD, MASK_KEEP_TAIL = 6, 4


def passes_luhn(pan: Column) -> Column:
    """Mod-10 check over the digits of ``pan``; separators are ignored, 13 to 19 digits required."""
    digits = F.regexp_replace(pan, "[^0-9]", "")
    return F.length(digits).between(*PAN_DIGITS) & F.call_function("luhn_check", digits)


def mask_pan(pan: Column) -> Column:
    """First six and last four characters around stars; shorter than ten is stars only."""
    n = F.length(pan)
    keep = MASK_KEEP_HEAD + MASK_KEEP_TAIL
    return F.when(n < keep, F.repeat(F.lit("*"), n)).otherwise(
        F.concat(
            F.substring(pan, 1, MASK_KEEP_HEAD),
            F.repeat(F.lit("*"), n - keep),
            F.right(pan, F.lit(MASK_KEEP_TAIL)),
        )
    )


# Runs of 13 to 19 digits in a text: without separators, in groups of four, and with single separators anywhere.
_NUMBERS_IN_TEXT = (
    r"(?<![0-9])[0-9]{13,19}(?![0-9])",
    r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?(?![0-9])",
    r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
)


def mask_in_text(text: Column) -> Column:
    """A text of any kind with the card numbers in it masked: digit runs, with single spaces or hyphens between, that
    pass the check digit. A number that only looks like one is left, unless it passes by chance."""
    found = F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in _NUMBERS_IN_TEXT))
    numbers = F.array_distinct(F.filter(found, passes_luhn))
    masked = F.aggregate(numbers, text, lambda so_far, number: F.replace(so_far, number, mask_pan(number)))
    return F.when(text.rlike(_NUMBERS_IN_TEXT[-1]), masked).otherwise(text)


def pan_bin(pan: Column) -> Column:
    return F.when(F.length(pan) >= BIN_LENGTH, F.substring(pan, 1, BIN_LENGTH))


def card_scheme(pan: Column) -> Column:
    two = F.substring(pan, 1, 2)
    four = F.substring(pan, 1, 4)
    low, high = (str(bound) for bound in MASTERCARD_RANGE)
    # four digits compare as text exactly as they do as numbers
    in_range = F.coalesce(four.rlike("^[0-9]{4}$") & four.between(low, high), F.lit(False))
    return (
        F.when(~F.coalesce(F.substring(pan, 1, 1).between("0", "9"), F.lit(False)), None)
        .when(pan.startswith(VISA_PREFIX), "VISA")
        .when(two.isin(*MASTERCARD_PREFIXES) | in_range, "MASTERCARD")
        .when(two.isin(*AMEX_PREFIXES), "AMEX")
        .when(two == UNIONPAY_PREFIX, "UNIONPAY")
        .when((four == DISCOVER_PREFIXES[0]) | (two == DISCOVER_PREFIXES[1]), "DISCOVER")
        .otherwise("UNKNOWN")
    )
