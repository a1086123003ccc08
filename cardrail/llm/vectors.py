"""Searches of a stated set of query vectors against all vectors: classes of equal vectors, shards, blocks, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardrail.llm.common import written

#: Rows in a shard, and queries in a block: a task holds one of each at a time.
SHARD_ROWS, BLOCK_QUERIES = 4_096, 1_024

CLASS_SCHEMA = "vector array<{kind}>, ids array<long>"
INDEX_SCHEMA = "shard int, width int, index binary"
BLOCK_SCHEMA = "block int, width int, queries binary, vectors binary"


def whole_vectors(df: DataFrame, vec_id: str, vector: str, zeros: bool) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part.

    Left out: a null id, and a vector that is null, empty, or holds a null or a non-finite component; without ``zeros``
    also a vector of zeros. Minus zero becomes zero.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    rows = df.filter(F.col(vec_id).isNotNull() & (F.size(value) > 0) & finite)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(value, lambda x: x + 0.0).alias("vector"))
    return rows if zeros else rows.filter(F.exists("vector", lambda x: x != 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """One row for each different vector, with its ``keep`` smallest ids, stored in the shared folder.

    No vector beyond the first ``keep`` of its class can be among the first ``keep - 1`` answers to any query, since
    ties go to smaller ids. Spark limits every class before the shuffle, so a class of any size costs a task few rows.
    """
    ranked = rows.withColumn("place", F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id")))
    kept = ranked.filter(F.col("place") <= keep).groupBy("vector")
    return written(kept.agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "vector-classes")


def query_rows(rows: DataFrame, divisor: int) -> DataFrame:
    """The rows whose id ``divisor`` divides; an id that repeats counts with its least vector."""
    return rows.filter(F.col("vec_id") % divisor == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def by_width(batches, kind: str) -> Iterator[tuple[int, np.ndarray, list]]:
    """The vectors of a partition, and what stands beside each, for each vector width."""
    found: dict[int, tuple[list, list]] = {}
    for batch in batches:
        vectors = batch.column("vector")
        ends, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
        for a, b, beside in zip(ends, ends[1:], batch.column(1 - batch.schema.get_field_index("vector")).to_pylist()):
            rows, others = found.setdefault(int(b - a), ([], []))
            rows.append(flat[a:b])
            others.append(beside)
    for width, (rows, others) in sorted(found.items()):
        yield width, np.array(rows, kind), others


def index_shards(classed: DataFrame, build: Callable[[np.ndarray, list[list[int]]], bytes], kind: str) -> DataFrame:
    """One stored row for each shard and vector width: what ``build`` makes of its vectors and ids.

    Classes are dealt out evenly, without a key.
    """
    shards = max(1, -(-classed.count() // SHARD_ROWS))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        for width, vectors, ids in by_width(batches, kind):
            columns = [pa.array([shard], pa.int32()), pa.array([width], pa.int32()), pa.array([build(vectors, ids)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "width", "index"])

    return written(classed.repartition(shards).mapInArrow(run, INDEX_SCHEMA), "vector-index")


def query_blocks(queries: DataFrame, kind: str) -> DataFrame:
    """One stored row for each block of queries of one width."""
    kept = written(queries.select("vector", "vec_id"), "vector-queries")
    blocks = max(1, -(-kept.count() // BLOCK_QUERIES))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        for width, vectors, ids in by_width(batches, kind):
            cells = [(block, pa.int32()), (width, pa.int32())]
            cells += [(np.array(ids, "i8").tobytes(), pa.binary()), (vectors.tobytes(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in cells], ["block", "width", "queries", "vectors"])

    return written(kept.repartition(blocks).mapInArrow(run, BLOCK_SCHEMA), "vector-blocks")


def search(
    index: DataFrame, blocks: DataFrame, find: Callable[..., Iterator[tuple]], k: int, best: Column, kind: str, score: str
) -> DataFrame:
    """The ``k`` best answers to each query over all shards.

    Each block meets each shard of its width once; a task takes the pairs of a shard one after another. ``find`` gets the
    index, the query ids and the query vectors, and yields (query_id, vec_id, score), at most ``k`` for each query; these
    are merged by ``best``, then by id.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["queries"], "i8")
                vectors = np.frombuffer(row["vectors"], kind).reshape(len(ids), row["width"])
                columns = list(zip(*find(row["index"], ids, vectors))) or [(), (), ()]
                kinds = [pa.int64(), pa.int64(), pa.float64() if score == "double" else pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    places = index.select("shard", "width").distinct()
    pairs = blocks.join(places, "width").join(index, ["shard", "width"])
    found = pairs.select("index", "queries", "vectors", "width").mapInArrow(
        run, f"query_id long, vec_id long, score {score}"
    )
    order = Window.partitionBy("query_id").orderBy(best, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
