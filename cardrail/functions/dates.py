"""Date texts in five layouts to one ISO 8601 text, without the session time zone taking part."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardrail.functions.text import BLANK_RUN

# Accepted layouts, day first with slashes or year first with dashes. Day, month and
# time fields have one or two digits, the year four and not all zero; case of T and Z is free. A day
# below ten may be padded with one blank after a dash. Blanks around the text do not count.
_YEAR = r"((?!0000)\d{4})"
_TIME = r"(\d{1,2}:\d{1,2}:\d{1,2})"
_DAY_FIRST = rf"(\d{{1,2}})/(\d{{1,2}})/{_YEAR}(?:{BLANK_RUN}{_TIME})?"
_YEAR_FIRST = rf"{_YEAR}-(\d{{1,2}})-(\d{{1,2}}| [1-9])(?:{BLANK_RUN}{_TIME}|[Tt]{_TIME}[Zz]?)"
# One pass puts the parts in order; any other text turns into separators only, which is no date.
LAYOUTS = rf"(?s)^(?:(?:{BLANK_RUN})?(?:{_DAY_FIRST}|{_YEAR_FIRST})(?:{BLANK_RUN})?|.*)\z"
IN_ORDER = "$3$5-$2$6-$1$7 $4$8$9"


def to_iso8601(value: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` for a valid date text, taken as UTC; null for anything else."""
    ordered = F.replace(F.regexp_replace(value, LAYOUTS, IN_ORDER), F.lit("- "), F.lit("-"))
    at = ordered.try_cast("timestamp_ntz").cast("string")
    # years below 1000 are written without leading zeros
    return F.concat(F.replace(F.ltrim(at, F.lit("0")), F.lit(" "), F.lit("T")), F.lit("Z"))


def business_date(value: Column) -> Column:
    """The date part of the normalized text."""
    return F.substring(to_iso8601(value), 1, 10)
