"""Token ids of documents in ORC files, ordered by document id.

ORC stores the ids of a stripe as integer runs, keeps row indexes with the least and greatest ``doc_id`` of every
10,000 rows, and Bloom filters on ``doc_id``: a reader takes stripes in parallel, and one that asks for a few documents
skips stripes and row groups by their metadata.

Defined results: a null text counts as empty and gives the end id only; rows with a null ``doc_id`` come first; repeated
ids are all kept, ordered by the digest of their text; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardrail.llm.common import small
from cardrail.llm.word_ids import word_ids
from cardrail.session import path_exists

FILE_SCHEMA = "part int, place long, doc_id long, ids array<int>"

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}


def encode_in_order(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """One row for each document: the range it fell in, its place there, its id and its token ids.

    The texts are dealt out by ranges of ``doc_id`` and encoded after the shuffle, so that sampling the ranges reads
    texts but encodes none, and ids are shuffled never.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        coder, end = word_ids(vocabulary), end_id.to_bytes(4, "little")
        for batch in small(batches):
            doc_id, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            packed = [ids + end for ids in coder.encode(texts)]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)], dtype="int32")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            places = pa.array(np.arange(place, place + len(texts)))
            parts = pa.array(np.full(len(texts), part, "int32"))
            place += len(texts)
            yield pa.RecordBatch.from_arrays([parts, places, doc_id, ids], ["part", "place", "doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    order = ["doc_id", F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Writes the ids of ``docs`` below ``path``. File order and the order in each file follow ``doc_id``."""
    encode_in_order(docs, vocabulary, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(FILE_SCHEMA).orc(path)


def documents_in(tokens: DataFrame) -> DataFrame:
    """Per stored document: where its ids start among all ids, how many they are, and their checksum.

    The files are read once. Sums run per range, over one small row for each document; the ranges themselves, a row
    for each, are added up in one task.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().astype("int64")
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            kept = [batch.column(c) for c in ("part", "place", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                ["part", "place", "doc_id", "n_tokens", "ids_crc32"],
            )

    rows = tokens.mapInArrow(run, "part int, place long, doc_id long, n_tokens long, ids_crc32 long")
    in_part = Window.partitionBy("part").orderBy("place")
    rows = rows.withColumn("until", F.sum("n_tokens").over(in_part))
    parts = rows.groupBy("part").agg(F.max("until").alias("total"))
    parts = parts.withColumn("before", F.sum("total").over(Window.orderBy("part")) - F.col("total"))
    start = F.col("before") + F.col("until") - F.col("n_tokens")
    return rows.join(parts, "part").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
