"""Code look-ups as joins, for queries and for larger tables a user brings.

The built-in tables have a fixed number of rows and are broadcast. A table passed in is joined
without a hint: its measured size decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardrail.functions.codes import DEFAULT_MINOR_UNITS, currency_table, mcc_table, mti_table


def _side(df: DataFrame, given: DataFrame | None, built_in) -> DataFrame:
    return given if given is not None else F.broadcast(built_in(df.sparkSession))


def with_mti_name(df: DataFrame, mti: str, table: DataFrame | None = None) -> DataFrame:
    names = _side(df, table, mti_table).select(F.col("mti").alias("_mti"), F.col("name").alias("mti_name"))
    return df.join(names, F.col(mti) == F.col("_mti"), "left").drop("_mti")


def with_currency(
    df: DataFrame, code: str, prefix: str = "", table: DataFrame | None = None
) -> DataFrame:
    """Adds alphabetic code and minor units; several currencies of a row use several prefixes."""
    entries = _side(df, table, currency_table).select(
        F.col("code").alias("_code"),
        F.col("alpha").alias(f"{prefix}currency_alpha"),
        F.col("minor_units").alias("_units"),
    )
    units = F.coalesce(F.col("_units"), F.lit(DEFAULT_MINOR_UNITS)).alias(f"{prefix}minor_units")
    joined = df.join(entries, F.col(code) == F.col("_code"), "left")
    return joined.select(*df.columns, f"{prefix}currency_alpha", units)


def with_mcc_description(df: DataFrame, mcc: str, table: DataFrame | None = None) -> DataFrame:
    entries = _side(df, table, mcc_table).select(
        F.col("mcc").alias("_mcc"), F.col("description").alias("mcc_description")
    )
    return df.join(entries, F.col(mcc) == F.col("_mcc"), "left").drop("_mcc")


def unknown_mti(df: DataFrame, mti: str, table: DataFrame | None = None) -> DataFrame:
    """Rows whose message type is not in the table."""
    known = _side(df, table, mti_table).select(F.col("mti").alias("_mti"))
    return df.join(known, F.col(mti) == F.col("_mti"), "left_anti")


def known_currency(df: DataFrame, code: str, table: DataFrame | None = None) -> DataFrame:
    """Rows whose currency is in the table."""
    known = _side(df, table, currency_table).select(F.col("code").alias("_code"))
    return df.join(known, F.col(code) == F.col("_code"), "left_semi")
