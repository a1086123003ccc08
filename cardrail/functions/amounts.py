"""Amount texts to doubles, and the amount object of the canonical record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardrail.functions.codes import currency_alpha, currency_minor_units
from cardrail.functions.text import strip

# Accepted number texts. Underscores may stand between digits only.
NUMBER = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)$"
STRAY_UNDERSCORE = r"(^|[^0-9])_|_([^0-9]|$)"


def parse_amount(value: Column) -> Column:
    """Double value of a number text; null when it is not one.

    A plain cast would accept a type suffix (``1f``) and refuse ``1_000``.
    """
    text = strip(value)
    plain = F.translate(text, "_", "")
    usable = plain.rlike(NUMBER) & ((plain == text) | ~text.rlike(STRAY_UNDERSCORE))
    # a signed nan is the one accepted text the cast refuses
    return F.when(usable, F.coalesce(plain.try_cast("double"), F.lit(float("nan"))))


def amount(number: Column, currency: Column) -> Column:
    """``{value, currencyCode, currencyAlpha, minorUnits}``, or null without a usable number.

    ``number`` is a parsed amount in a stored column: it is read twice.
    """
    return F.when(
        number.isNotNull(),
        F.struct(
            number.alias("value"),
            currency.alias("currencyCode"),
            currency_alpha(currency).alias("currencyAlpha"),
            currency_minor_units(currency).alias("minorUnits"),
        ),
    )
