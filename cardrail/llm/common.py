"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardrail.session import scratch_path

T = TypeVar("T")

#: Text handled at a time inside a task, in characters, so that Python lists of words stay small.
SLICE_CHARS = 1_000_000


def found_by_workers(spark: SparkSession) -> None:
    """Puts the folder of this package on the path of Python workers started from now on.

    For a driver that runs elsewhere on the same machine; a cluster gets the package by ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    found_by_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as Parquet in the folder that all executors share, and read back.

    The stored table ends the lineage: a lost executor costs the running tasks only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``written`` stored, once what reads them is stored itself."""
    for df in frames:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Marked:
    """A filter of keys in a fixed 16 MB: it never misses a key it was made of, and may pass others."""

    BITS = 1 << 27

    def __init__(self, keys: DataFrame, key: str):
        """``keys.key`` are 64-bit hashes. Words of 64 bits come to the driver, at most ``BITS / 64`` of them."""
        spark, place = keys.sparkSession, F.pmod(F.col(key), F.lit(self.BITS))
        bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
        words = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
        rows = words.toArrow()
        held = np.zeros(self.BITS // 64, "i8")
        held[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
        self.held = spark.sparkContext.broadcast(held.view("u8"))
        self.empty = not rows.num_rows

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys.view("i8") % self.BITS
        return (self.held.value[place >> 6] >> (place & 63).astype("u8")) & np.uint64(1) == 1

    def divided(self, df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """The rows of ``df`` whose 64-bit hash may be among the keys, and those whose is not. Narrow passes."""
        (name,) = fresh(df, "marked_key")

        def chosen(wanted: bool):
            def run(batches):
                import pyarrow as pa

                for batch in batches:
                    hit = self.has(batch.column(name).to_numpy())
                    yield batch.drop_columns([name]).filter(pa.array(hit == wanted))

            return df.withColumn(name, key).mapInArrow(run, df.schema)

        return chosen(True), chosen(False)


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, those of smallest hash of ``key``.

    A threshold on the hash leaves about twice as many first, so that tasks send few rows however many there are.
    """
    total, place = df.count(), F.xxhash64(*key)
    if total > 4 * rows:
        df = df.filter(F.pmod(place, F.lit(1 << 40)) < (1 << 40) * 2 * rows // total)
    return df.orderBy(F.pmod(place, F.lit(1 << 40)), *key).limit(rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (names compare without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small(batches, rows: int = 1_000) -> Iterator:
    """The rows of Arrow batches in parts of at most ``rows``, so that texts become Python objects a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


_held: dict[object, object] = {}


def held_in_worker(key: object, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task: one thing at a time, so that operators do not add up in it."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive runs of ``texts`` of about ``limit`` characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
