import os

from pyspark.sql import functions as F

from cardrail.functions import tokens
from cardrail.plans import catalog
from cardrail.sources import changes
from cardrail.sources.operations import scan_csv, scan_quoted, with_row_index
from cardrail.sources.topics import FolderTopic
from cardrail.streaming.jobs import _for_rejects


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_snapshot_are_not_dealt_out_by_chunk(spark):
    rows = spark.range(9).select("id", F.struct("id").alias("after"))
    marks = spark.createDataFrame([(0, 0, 5), (1, 10, 15)], "chunk int, low long, high long")
    log = rows.select("id", F.lit(12).cast("long").alias("position"), F.lit("u").alias("op"), "after").filter("id = 7")
    events = changes.handover(rows, marks, log, [5])
    assert "hashpartitioning(chunk" not in plan(events)
    assert sorted((r.id, r.position, r.op) for r in events.collect()) == [
        *((i, 5, "r") for i in range(5)), (5, 15, "r"), (6, 15, "r"), (7, 12, "u"), (8, 15, "r"),
    ]


def test_last_images_are_dealt_out_by_key(spark):
    events = spark.range(100).selectExpr("id % 10 id", "id position", "'u' op", "struct(id) after")
    found = catalog.last_images(events, 7)
    assert "hashpartitioning(id" in plan(found) and ", 7)" in plan(found)
    assert sorted(r.id for r in found.collect()) == list(range(90, 100))


def test_lines_are_not_shuffled_for_their_splits(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'a\n"{i}"' if i % 2 else f"b{i}") for i in range(40)], "i int, t string")
    path = catalog._csv_folder(spark, rows.repartition(3))
    names = [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("part-")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    back = scan_quoted(spark, path, "n")
    assert "SortMergeJoin" not in plan(back)
    got = back.collect()
    assert sorted(r.n for r in got) == list(range(40))
    assert {(int(r.i), r.t) for r in got} == {(r.i, r.t) for r in rows.collect()}
    flat = catalog._csv_folder(spark, rows.filter("i % 2 = 0").repartition(3))
    numbered = with_row_index(scan_csv(spark, flat), "n")
    assert "SortMergeJoin" not in plan(numbered)
    assert sorted(r.n for r in numbered.collect()) == list(range(20))


def test_messages_take_the_space_of_their_bits(spark, tmp_path):
    text = F.base64(F.concat(*(F.unhex(F.sha2(F.concat_ws("-", "id", F.lit(k)), 256)) for k in range(30))))
    topic = FolderTopic(str(tmp_path), "t")
    topic.append(spark.range(2000, numPartitions=1).select(F.lit("k").alias("key"), text.alias("value")), "p")
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert stored < 0.85 * 2000 * 1280


def test_cached_rows_hold_texts_for_rejects_only(spark):
    rows = spark.createDataFrame([("a", None), ("b", "bad")], "value string, fault string")
    assert [r.value for r in _for_rejects(rows, "value").orderBy("fault").collect()] == [None, "b"]


def test_decoder_tells_clean_texts(spark):
    rows = spark.createDataFrame([("QUI=",), ("QUI=\n",), ("QU-=",), (None,)], "t string")
    got = tokens.with_base64_bytes(rows, F.col("t"), "b", clean="c").select("t", "c").collect()
    assert [r.c for r in got] == [True, False, False, False]
