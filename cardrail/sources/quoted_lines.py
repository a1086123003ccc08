"""CSV files whose quoted fields hold line breaks, read by many tasks.

A line break ends a record where the quotes before it, from the file's start on, are even in number. A task that reads a
split in the middle of a file does not know that number, so it takes both cases along: for each line the quotes since the
split's start, and where the record began if the split starts outside of quotes, and if inside. One small row for each
split, added up in the file's order, then says which case holds, and which record is still open where the split starts.
Most records are one line and stay where they are; the lines of the others meet by the record that they belong to.

Quotes stand around fields or, doubled, inside quoted ones. A quote that is never closed makes one record of the rest of its
file. Empty lines between records are none. Compressed files have one split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardrail.session import kept_small

SPLIT = ["file", "split_at"]
_COUNTS = ["odd int", "inside int", "start_0 long", "start_1 long", "number_0 long", "number_1 long", "blank boolean"]
_LINES = f"file string, split_at long, line long, {', '.join(_COUNTS)}"


def _counted(with_text: bool):
    """A pass over lines in their order: quotes and record starts of each, counted from its split's start."""

    def run(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split, lines, inside, start, number = None, 0, 0, [-1, -1], [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            files, places, text = (batch.column(c) for c in (*SPLIT, "value"))
            odd = pc.count_substring(text, '"').to_numpy(zero_copy_only=False).astype("i8") & 1
            blank = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(text)), 0).to_numpy(zero_copy_only=False)
            names, at = files.dictionary_encode(), places.to_numpy()
            of_file = names.indices.to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(of_file) != 0) | (np.diff(at) != 0)) + 1).tolist(), batch.num_rows]
            columns = {c: np.empty(batch.num_rows, "i8") for c in ("line", "inside", "start_0", "start_1", "number_0", "number_1")}
            for a, b in zip(edges, edges[1:]):
                found = (names.dictionary[int(of_file[a])].as_py(), int(at[a]))
                if found != split:
                    split, lines, inside, start, number = found, 0, 0, [-1, -1], [0, 0]
                before = (inside + np.cumsum(odd[a:b]) - odd[a:b]) & 1
                line = lines + np.arange(b - a)
                columns["line"][a:b], columns["inside"][a:b] = line, before
                for case in (0, 1):
                    here = (before == case) & ~blank[a:b]
                    starts = np.maximum.accumulate(np.where(before == case, line, start[case]))
                    columns[f"start_{case}"][a:b] = np.maximum(starts, start[case])
                    columns[f"number_{case}"][a:b] = number[case] + np.cumsum(here) - here
                    start[case] = int(columns[f"start_{case}"][b - 1])
                    number[case] += int(here.sum())
                inside, lines = int((before[-1] + odd[b - 1]) & 1), lines + b - a
            kept = [columns["line"], odd.astype("i4"), columns["inside"].astype("i4")]
            kept += [columns[c] for c in ("start_0", "start_1", "number_0", "number_1")] + [blank]
            arrays = [files, places, *map(pa.array, kept)] + [text] * with_text
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _LINES.split(", ")] + ["value"] * with_text)

    return run


def _splits(lines: DataFrame) -> DataFrame:
    """For each split: whether it starts inside quotes, the record open there, and the records of its file before it."""
    counted = lines.mapInArrow(_counted(False), _LINES)
    cases = []
    for case in (0, 1):
        here = (F.col("inside") == case) & ~F.col("blank")
        cases += [F.max(f"start_{case}").alias(f"last_{case}"), F.count_if(here).alias(f"records_{case}")]
    rows = counted.groupBy(*SPLIT).agg(F.sum("odd").alias("quotes"), *cases)
    before = Window.partitionBy("file").orderBy("split_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    last, records = (F.when(F.col("state") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1")) for c in ("last", "records"))
    opened = F.when(last >= 0, F.struct(F.col("split_at").alias("split_at"), last.alias("line")))
    return rows.select(
        *SPLIT,
        "state",
        records.alias("records"),
        F.last(opened, ignorenulls=True).over(before).alias("open"),
        F.coalesce(F.sum(records).over(before), F.lit(0)).alias("before"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files below ``path``: ``file``, ``number`` (its place in the file, from 0) and its text.

    The files are read twice: for the one row of each split, and for the records.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_at"), "value")
    counted = lines.mapInArrow(_counted(True), f"{_LINES}, value string")
    rows = counted.join(kept_small(_splits(lines), "splits"), SPLIT)
    outside = F.col("state") == 0
    start = F.when(outside, F.col("start_0")).otherwise(F.col("start_1"))
    number = F.col("before") + F.when(outside, F.col("number_0")).otherwise(F.col("number_1"))
    begins = (F.col("inside") + F.col("state")) % 2 == 0
    rows = rows.filter(~(begins & F.col("blank"))).select(
        *SPLIT,
        "line",
        number.alias("number"),
        F.regexp_replace("value", "\r$", "").alias("bare"),
        "value",
        (begins & (F.col("odd") == 0)).alias("whole"),
        F.when(start >= 0, F.struct("split_at", start.alias("line"))).otherwise(F.col("open")).alias("record"),
    )
    single = rows.filter("whole").select("file", "number", F.col("bare").alias("value"))
    parts = rows.filter(~F.col("whole")).groupBy("file", "record")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("split_at", "line", "number", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda x: x["value"]), "\n")
    several = parts.select("file", F.col("parts")[0]["number"].alias("number"), F.regexp_replace(joined, "\r$", "").alias("value"))
    return single.unionByName(several)
