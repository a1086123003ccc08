"""Text helpers with the blank rules the records were written under."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that counts as blank when a field is stripped.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# One run of blanks, as a regular expression.
BLANK_RUN = f"[{BLANKS}]+"


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends; ``trim`` alone removes spaces only."""
    return F.btrim(text, F.lit(BLANKS))


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def is_empty(text: Column) -> Column:
    """True for null and for the empty text; blanks are not empty."""
    return text.isNull() | (text == "")
