"""Operation rows from CSV files, and a dense row index for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardrail.schemas import OPERATION_TEXT_SCHEMA
from cardrail.session import kept_small, scratch_path
from cardrail.sources import quoted_lines

# A quote inside a quoted field is doubled.
_CSV = {"header": "true", "quote": '"', "escape": '"', "inferSchema": "false"}
# Text no field holds: with it as the null text, a quoted empty field stays empty text.
_NEVER = "\x00null\x00"


def scan_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, named by the header; only the empty field is null (``NA`` is text).

    ``multiline`` admits line breaks inside quoted fields; the files are then read twice, by as many tasks.
    """
    if multiline:
        return scan_quoted(spark, path)
    return spark.read.options(**_CSV, nullValue="").csv(path)


def scan_quoted(spark: SparkSession, path: str, index: str | None = None) -> DataFrame:
    """The same for files with line breaks inside quoted fields. ``index`` adds a dense number from 0, by file name and
    place in the file; it takes one row for each file in one task."""
    names = spark.read.options(**_CSV, multiLine="true").csv(path).columns
    text = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = quoted_lines.records(spark, path)
    if index:
        sizes = rows.groupBy("file").agg((F.max("number")).alias("rows"))
        before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_first"))
        rows = rows.join(kept_small(sizes, "file-sizes"), "file")
    fields = F.from_csv("value", text, {**_CSV, "header": "false", "nullValue": ""}).alias("r")
    places = [(F.col("_first") + F.col("number") - 1).alias(index)] if index else []
    return rows.filter("number > 0").select(*places, fields).select(*([index] if index else []), "r.*")


def bulk_load(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Rows of the operations table from files whose columns are in table order.

    The header line is skipped, not read. An unquoted empty field is null, a quoted one is empty
    text. A line with too few or too many fields fails the load. Ids are unique, not dense.
    ``multiline`` admits line breaks inside quoted fields; the files are then read twice, by as many tasks.
    """
    strict = {"mode": "FAILFAST", "nullValue": _NEVER, "emptyValue": ""}
    if multiline:
        fields = F.from_csv("value", OPERATION_TEXT_SCHEMA.toDDL(), {**_CSV, **strict, "header": "false"}).alias("r")
        rows = quoted_lines.records(spark, path).filter("number > 0").select(fields).select("r.*")
    else:
        rows = spark.read.schema(OPERATION_TEXT_SCHEMA).options(**_CSV, **strict, enforceSchema="true").csv(path)
    return rows.select(
        (F.monotonically_increasing_id() + 1).alias("id"),
        *rows.columns,
        F.current_timestamp().alias("ingested_at"),
    )


def with_row_index(scan: DataFrame, name: str = "row_idx") -> DataFrame:
    """Adds a dense index from 0, by file name and place in the file, without sorting the rows.

    The rows of a file scan are stored once with the file and the offset of the split they came from;
    sizes and places are both read from what is stored, so no two scans have to agree. A split's rows
    lie in one stored file, in their order. The running total over splits takes one row for each of
    them; a row whose split has no start is an error.
    """
    split = ["_split_file", "_split_at"]
    rows = scan.select(
        "*",
        F.col("_metadata.file_path").alias(split[0]),
        F.col("_metadata.file_block_start").alias(split[1]),
    )
    path = scratch_path(scan.sparkSession, "row-index")
    rows.write.option("maxRecordsPerFile", 0).option("compression", "zstd").parquet(path)
    stored = scan.sparkSession.read.schema(rows.schema).parquet(path)
    stored = stored.select("*", F.col("_metadata.row_index").alias("_place"))
    sizes = stored.groupBy(*split).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    start = F.coalesce("_start", F.raise_error(F.concat(F.lit("no start for a split of "), F.col(split[0]))).cast("long"))
    joined = stored.join(kept_small(starts, "split-starts"), split, "left")
    return joined.select((start + F.col("_place") - F.col("_first")).alias(name), *scan.columns)


def limit_rows(rows: DataFrame, limit: int, index: str = "row_idx") -> DataFrame:
    """The first ``limit`` rows by ``index``; 0 keeps all."""
    return rows.orderBy(index).limit(limit) if limit > 0 else rows
