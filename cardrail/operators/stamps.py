"""Stage stamps in the ``_processing`` member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardrail.schemas import PROCESSING_DDL, PROCESSING_FIELDS


def now_millis(now_ms: int | None = None) -> Column:
    """Milliseconds of the batch's start, or a given instant for repeatable results."""
    if now_ms is None:
        return F.unix_millis(F.current_timestamp())
    return F.lit(now_ms).cast("bigint")


def utc_text(millis: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of an instant, whatever the session time zone."""
    seconds = F.floor(millis / 1000).cast("decimal(18,6)")
    zero = F.lit(0)
    wall_clock = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        zero, zero, zero, seconds
    )
    return F.concat(F.translate(wall_clock.cast("string"), " ", "T"), F.lit("Z"))


def stamped(df: DataFrame, **stamps: Column) -> Column:
    """The ``_processing`` struct of ``df`` with ``stamps`` set; other members keep their value."""
    blank = F.struct(*(F.lit(None).alias(f) for f in PROCESSING_FIELDS)).cast(PROCESSING_DDL)
    merged = F.coalesce(F.col("_processing"), blank) if "_processing" in df.columns else blank
    for name, value in stamps.items():
        merged = merged.withField(name, value)
    return merged


def latency(df: DataFrame, first: str, last: str) -> Column:
    """Milliseconds between two stamps."""
    processing = df["_processing"]
    return processing.getField(last) - processing.getField(first)
