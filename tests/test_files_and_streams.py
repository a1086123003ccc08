import glob
import os

import pytest
from pyspark.sql import functions as F

from cardrail.operators import envelope, monitoring, normalization
from cardrail.plans import catalog
from cardrail.schemas import (
    OPERATION_COLUMNS,
    SOURCE_CSV,
    TOPIC_CDC,
    TOPIC_DECRYPTED,
    TOPIC_DLQ,
    TOPIC_NORMALIZED,
    TOPIC_SEALED,
    TOPIC_VALIDATED,
)
from cardrail.session import scratch_path
from cardrail.sinks import files
from cardrail.sinks.store import Store
from cardrail.sources import operations
from cardrail.sources.topics import PUBLISHER_OPTIONS, FolderTopic, KafkaTopic
from cardrail.streaming.jobs import Jobs

SF = "/root/testdata/sf0.001"


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return str(folder)


def test_scan_csv(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A,B,C\nNA,,""\n" x ","say ""hi"", ok",é\n')
    rows = operations.scan_csv(spark, path).collect()
    assert [tuple(r) for r in rows] == [("NA", None, None), (" x ", 'say "hi", ok', "é")]


def test_scan_csv_line_breaks(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A,B\n"x\ny",1\n')
    assert tuple(operations.scan_csv(spark, path, multiline=True).first()) == ("x\ny", "1")


def test_bulk_load_is_positional(spark, tmp_path):
    first = ['""'] + [""] + ["v"] * (len(OPERATION_COLUMNS) - 2)
    header = ",".join(f"h{i}" for i in range(len(OPERATION_COLUMNS)))
    path = write(tmp_path, "a.csv", f"{header}\n{','.join(first)}\n")
    row = operations.bulk_load(spark, path).first()
    assert (row.message_type, row.function_code, row.processing_code) == ("", None, "v")
    assert row.id > 0 and row.ingested_at is not None
    write(tmp_path, "b.csv", f"{header}\nonly,two\n")
    with pytest.raises(Exception):
        operations.bulk_load(spark, path).collect()


def test_row_index_is_dense_in_file_order(spark, tmp_path):
    body = "".join(f"{i},{'x' * 50}\n" for i in range(20_000))
    path = write(tmp_path, "a.csv", "A,B\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        indexed = operations.with_row_index(operations.scan_csv(spark, path))
        rows = indexed.select("row_idx", F.col("A").cast("long").alias("a")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.row_idx for r in rows) == list(range(20_000))
    assert all(r.row_idx == r.a for r in rows)


def test_row_index_goes_by_file_name(spark, tmp_path):
    for name, numbers in (("b.csv", range(3, 4)), ("a.csv", range(3)), ("c.csv", range(4, 9))):
        path = write(tmp_path, name, "A\n" + "".join(f"{i}\n" for i in numbers))
    rows = operations.with_row_index(operations.scan_csv(spark, path)).collect()
    assert sorted((r.row_idx, int(r.A)) for r in rows) == [(i, i) for i in range(9)]


def test_publish_csv(spark, key, tmp_path):
    from cardrail.operators import decryption
    from cardrail.plans import pipelines

    path = write(tmp_path, "a.csv", "MESSAGE_TYPE,CARD_NUMBER\n1100,\nNA,4\n1200,5\n")
    for limit, ids in ((0, ["evt-00000000", "evt-00000001", "evt-00000002"]), (1, ["evt-00000000"])):
        topic = FolderTopic(scratch_path(spark, "t"), TOPIC_SEALED)
        pipelines.publish_csv(spark, path, key, topic, limit)
        messages = topic.read(spark)
        assert sorted(r.key for r in messages.collect()) == ids
        opened = decryption.accepted(decryption.decrypt(envelope.read_sealed(messages), key))
        first = opened.filter("eventId = 'evt-00000000'").first()
        assert first.payload == '{"MESSAGE_TYPE":"1100","CARD_NUMBER":null}' and first.source == SOURCE_CSV


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stages_read_only_what_they_use_and_never_shuffle(spark, key, tmp_path):
    import re

    from cardrail.operators import validation
    from cardrail.plans import pipelines
    from cardrail.plans.payments import INDEX, operations as payment_rows

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    path = str(tmp_path / "rows")
    payment_rows(spark, SF).write.parquet(path)
    opened = envelope.as_envelopes(spark.read.parquet(path), INDEX, now_ms=1)
    valid = plan_of(validation.accepted(validation.validate(opened, 1)).select("eventId"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", valid).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {INDEX, *validation.MANDATORY_FIELDS}
    records = normalization.flatten(pipelines.canonical_from_open(opened, 1))
    dates = plan_of(records.select("business_date"))
    assert "CARD_ACC_NAME_ADDRESS" not in re.search(r"ReadSchema: struct<([^>]*)>", dates).group(1)
    sealed = envelope.seal(opened, key, now_ms=1)
    for df in (records, pipelines.canonical_from_sealed(sealed, key, 1), pipelines.rejects_from_sealed(sealed, key, 1)):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    assert plan_of(pipelines.canonical_from_sealed(sealed, key, 1)).count("aesDecrypt") == 1


def test_limit(spark):
    rows = spark.range(10).select(F.col("id").alias("row_idx"))
    assert operations.limit_rows(rows, 3).count() == 3 and operations.limit_rows(rows, 0).count() == 10


def test_kafka_options():
    topic = KafkaTopic("host:9092", "payments")
    read = topic.read_options(500)
    assert read["startingOffsets"] == "earliest" and read["maxOffsetsPerTrigger"] == "500"
    assert set(PUBLISHER_OPTIONS.items()) <= set(topic.write_options().items())
    assert topic.write_options()["topic"] == "payments" and "groupIdPrefix" not in read
    assert KafkaTopic("h", "t", {"kafka.acks": "1"}).write_options()["kafka.acks"] == "1"


class Told(KafkaTopic):
    """Writes to and reads from a folder, and tells the options it would have given a broker."""

    told: list = []

    def append(self, messages, producer, batch_id=0):
        Told.told.append(("write", producer, self.write_options()))
        FolderTopic(self.servers, self.name).append(messages, producer, batch_id)

    def stream(self, spark, max_per_trigger=None):
        Told.told.append(("read", self.consumer, self.read_options(max_per_trigger)))
        return FolderTopic(self.servers, self.name).stream(spark, max_per_trigger)


def test_jobs_and_publisher_use_the_delivery_settings(spark, key, tmp_path):
    from cardrail.plans import pipelines

    root = scratch_path(spark, "told")
    Told.told.clear()
    path = write(tmp_path, "a.csv", "MESSAGE_TYPE,CARD_NUMBER\n1100,4\n")
    pipelines.publish_csv(spark, path, key, Told(f"{root}/topics", TOPIC_SEALED))
    jobs = Jobs(spark, lambda name: Told(f"{root}/topics", name), f"{root}/data", f"{root}/checks", key)
    jobs.decryption().awaitTermination()
    jobs.validation().awaitTermination()
    writes = [(who, options) for kind, who, options in Told.told if kind == "write"]
    assert {who for who, _ in writes} >= {"publisher", "decryption"}
    assert all(set(PUBLISHER_OPTIONS.items()) <= set(options.items()) for _, options in writes)
    reads = {who: options["groupIdPrefix"] for kind, who, options in Told.told if kind == "read"}
    assert reads == {"decryption": "decryption", "validation": "validation"}


def test_readers_see_whole_batches_only(spark, monkeypatch):
    from cardrail.sources import topics

    topic = FolderTopic(scratch_path(spark, "t"), "x")
    rows = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    checks, out = scratch_path(spark, "c"), scratch_path(spark, "o")

    def read_on():
        stream = topic.stream(spark).writeStream.option("checkpointLocation", checks).trigger(availableNow=True)
        stream.format("parquet").option("path", out).start().awaitTermination()

    topic.append(rows.limit(10), "p", 0)
    with monkeypatch.context() as m:  # the writer dies when its files are written but not yet handed over
        m.setattr(topics, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            topic.append(rows, "p", 1)
    read_on()
    assert topic.read(spark).count() == 10 and spark.read.parquet(out).count() == 10
    topic.append(rows, "p", 1)
    read_on()
    assert topic.read(spark).count() == 110 and spark.read.parquet(out).count() == 110


def test_complete_batches_are_left_alone(spark):
    topic = FolderTopic(scratch_path(spark, "t"), "x")
    rows = spark.createDataFrame([("k", "v")], "key string, value string")
    topic.append(rows, "p", 1)
    topic.append(rows.union(rows), "p", 1)
    topic.append(rows, "p", 2)
    assert topic.read(spark).count() == 2
    path = scratch_path(spark, "d")
    for _ in range(2):
        files.write_json_lines(rows, F.col("value"), path, 3)
    assert spark.read.text(path).count() == 1


def test_store_folders(spark):
    records = catalog.canonical(spark, SF).persist()
    path = scratch_path(spark, "store")
    for _ in range(2):
        files.write_canonical(records, path, batch_id=4)
    store = spark.read.parquet(path)
    assert store.count() == records.count()
    assert store.filter("businessDate IS NULL").count() == records.filter("coalesce(businessDate, '') = ''").count() > 0
    day = records.filter("businessDate > ''").first().businessDate
    plan = store.filter(f"businessDate = '{day}'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(businessDate" in plan
    written = glob.glob(f"{path}/businessDate=*/mti=*/batch_id=4/*.parquet")
    # a folder's rows lie in one task, but for those at the border between two
    assert len(written) - len({os.path.dirname(f) for f in written}) < 16
    coarse = scratch_path(spark, "store")
    files.write_canonical(records, coarse, partition_by=("businessDate",))
    by_day = spark.read.parquet(coarse)
    assert by_day.count() == records.count() and not glob.glob(f"{coarse}/businessDate=*/mti=*")
    assert by_day.filter("mti = '1200'").count() == records.filter("iso8583.mti = '1200'").count()
    records.unpersist()


def test_storage_usage(spark, tmp_path):
    write(tmp_path / "a" / "deep", "x.txt", "12345")
    write(tmp_path / "a", "y.txt", "123")
    write(tmp_path / "b", "z.txt", "1")
    usage = monitoring.storage_usage(spark, str(tmp_path)).collect()
    assert {(r.dataset, r.bytes, r["files"]) for r in usage} == {("a", 8, 2), ("b", 1, 1)}


def values(topic, spark):
    return sorted(r.value for r in topic.read(spark).select("value").collect())


@pytest.fixture(scope="module")
def finished(spark, key):
    jobs = Jobs.in_folder(spark, scratch_path(spark, "run"), key, max_per_trigger=800)
    messages = catalog.damaged_messages(spark, SF).repartition(3)
    jobs.topic(TOPIC_SEALED).append(messages, "publisher")
    jobs.topic(TOPIC_CDC).append(
        catalog.change_events(spark, SF).select(F.lit(None).cast("string").alias("key"), "value"), "cdc"
    )
    log = monitoring.ProgressLog()
    spark.streams.addListener(log)
    for start in (jobs.cdc_adapter, jobs.decryption, jobs.validation, jobs.normalization, jobs.store):
        start().awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(log)
    return jobs, log, messages.count()


def count(spark, jobs, topic):
    return jobs.topic(topic).read(spark).count()


def test_streams_lose_nothing(spark, finished):
    jobs, _, sent = finished
    adapted = jobs.topic(TOPIC_DECRYPTED).read(spark).filter(F.col("value").contains('"cdcOp"')).count()
    assert adapted == sum(1 for i in range(sent) if i % 10 < 4)
    good, bad = count(spark, jobs, TOPIC_VALIDATED), count(spark, jobs, TOPIC_DLQ)
    assert good + bad == sent + adapted
    assert count(spark, jobs, TOPIC_NORMALIZED) == good
    assert spark.read.parquet(jobs.dataset("canonical-partitioned")).count() == good
    for name in ("normalized", "canonical"):
        assert spark.read.option("recursiveFileLookup", True).text(jobs.dataset(name)).count() == good
    texts = jobs.topic(TOPIC_NORMALIZED).read(spark).select("value")
    assert texts.filter(F.col("value").rlike('"panMasked":"[0-9 ]{13,}')).count() == 0


def test_running_again_adds_nothing(spark, finished):
    jobs, *_ = finished
    before = {t: count(spark, jobs, t) for t in (TOPIC_DECRYPTED, TOPIC_VALIDATED, TOPIC_NORMALIZED, TOPIC_DLQ)}
    for start in (jobs.cdc_adapter, jobs.decryption, jobs.validation, jobs.normalization, jobs.store):
        start().awaitTermination()
    assert before == {t: count(spark, jobs, t) for t in before}


def test_progress_is_logged(spark, finished):
    _, log, sent = finished
    assert log.sent["decryption"] == sent
    assert log.rate["decryption"] > 0


def test_batch_equals_stream(spark, finished):
    from cardrail.operators import decryption, validation

    jobs, *_ = finished
    sealed = envelope.read_sealed(jobs.topic(TOPIC_SEALED).read(spark))
    good = decryption.accepted(decryption.decrypt(sealed, jobs.key))
    checked = validation.validate(good)
    records = normalization.normalize(validation.accepted(checked)).select("msgId", "businessDate", "iso8583")
    streamed = spark.read.parquet(jobs.dataset("canonical-partitioned")).filter("msgId like 'evt-%'")
    streamed = streamed.select("msgId", F.col("businessDate").cast("string"), "iso8583")
    assert records.exceptAll(streamed).count() == 0 and streamed.exceptAll(records).count() == 0


def test_failure_between_outputs_leaves_each_row_once(spark, key, monkeypatch):
    jobs = Jobs.in_folder(spark, scratch_path(spark, "crash"), key)
    messages = envelope.sealed_messages(catalog.sealed(spark, SF))
    jobs.topic(TOPIC_SEALED).append(messages, "publisher")
    with monkeypatch.context() as m:
        m.setattr(files, "write_json_parquet", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            jobs.decryption().awaitTermination()
    first = values(jobs.topic(TOPIC_DECRYPTED), spark)
    jobs.decryption().awaitTermination()
    jobs.decryption().awaitTermination()
    assert values(jobs.topic(TOPIC_DECRYPTED), spark) == first
    sent = messages.count()
    assert len(first) == sent
    stored = spark.read.option("recursiveFileLookup", True)
    assert stored.text(jobs.dataset("decrypted")).count() == sent
    in_parquet = stored.parquet(jobs.dataset("decrypted-parquet"))
    assert sorted(r.json_data for r in in_parquet.collect()) == first


def test_one_query_gives_the_same_store(spark, key):
    jobs = Jobs.in_folder(spark, scratch_path(spark, "fused"), key, mask_dead_letters=True)
    messages = envelope.sealed_messages(catalog.sealed(spark, SF))
    jobs.topic(TOPIC_SEALED).append(messages, "publisher")
    jobs.sealed_to_canonical().awaitTermination()
    good = spark.read.parquet(jobs.dataset("canonical-partitioned")).count()
    assert good == catalog.canonical(spark, SF).count()
    assert good + count(spark, jobs, TOPIC_DLQ) == messages.count()


def test_a_batch_has_no_more_messages_than_the_cap(spark):
    topic = FolderTopic(scratch_path(spark, "capped"), "x", messages_per_file=70)
    messages = spark.range(1000).selectExpr("cast(id as string) key", "cast(id as string) value")
    topic.append(messages.repartition(2), "a")
    topic.append(messages.limit(10), "b")
    with pytest.raises(ValueError):
        topic.stream(spark, 50)
    sizes = []
    query = (
        topic.stream(spark, 200)
        .writeStream.option("checkpointLocation", scratch_path(spark, "capped-checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: sizes.append(batch.count()))
        .start()
    )
    query.awaitTermination()
    assert sum(sizes) == 1010 and max(sizes) <= 200 and len(sizes) >= 7


def test_old_batches_of_a_topic_expire(spark):
    topic = FolderTopic(scratch_path(spark, "expiring"), "x")
    messages = spark.range(10).selectExpr("cast(id as string) key", "cast(id as string) value")
    for batch in range(3):
        topic.append(messages, "a", batch)
    for batch, when in ((0, 1_000), (1, 5_000_000)):
        os.utime(f"{topic.path.removeprefix('file:')}/a/batch_id={batch}", (when, when))
    assert topic.expire(spark, 4_000_000 * 1_000) == 1
    assert topic.read(spark).count() == 20
    assert topic.expire(spark, 4_000_000 * 1_000) == 0


def test_jobs_keep_a_history(spark, key):
    jobs = Jobs.in_folder(spark, scratch_path(spark, "history"), key, history=True)
    jobs.topic(TOPIC_SEALED).append(envelope.sealed_messages(catalog.sealed(spark, SF)), "publisher")
    query = jobs.sealed_to_canonical()
    query.awaitTermination()
    want = sorted(r.msgId for r in catalog.canonical(spark, SF).select("msgId").collect())
    store = Store(spark, jobs.dataset("canonical-history"))
    assert sorted(r.msgId for r in store.read().select("msgId").collect()) == want
    counted = monitoring.progress_counts(spark, [query]).first()
    assert (counted.accepted, counted.rejected) == (1500, 0)
