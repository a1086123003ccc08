"""Registered queries: one per operator and pipeline, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardrail.functions import cards, codes, dates
from cardrail.functions.amounts import parse_amount
from cardrail.functions.payload import Payload, members_in_order
from cardrail.functions.records import KEEP_NULLS
from cardrail.functions.text import empty_to_null, strip
from cardrail.functions.tokens import IV_BYTES, TokenKey
from cardrail.operators import (
    cdc,
    dead_letters,
    decryption,
    envelope,
    lookups,
    monitoring,
    normalization,
    validation,
)
from cardrail.operators.stamps import latency
from cardrail.plans import pipelines
from cardrail.plans.payments import INDEX, operations, parts
from cardrail.schemas import (
    CANONICAL_DDL,
    OPERATION_COLUMNS,
    RECORD_COLUMNS,
    SOURCE_CSV,
    STATUS_TOPICS,
    TOPIC_CDC,
    TOPIC_DECRYPTED,
    TOPIC_DLQ,
    TOPIC_NORMALIZED,
    TOPIC_SEALED,
    TOPIC_VALIDATED,
)
from cardrail.session import remove, scratch_path
from cardrail.sinks import files
from cardrail.sinks.store import Store
from cardrail.sources import changes, operations as operation_files
from cardrail.sources.topics import FolderTopic, read_text_messages
from cardrail.streaming.jobs import Jobs

Query = Callable[[SparkSession, str], DataFrame]

# A key for queries over derived data only, published with the token format's specification.
SAMPLE_KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
OTHER_KEY = "AAECAwQFBgcICQoLDA0ODxAREhMUFRYXGBkaGxwdHh8="

# Fixed stage instants, so that results repeat.
PRODUCED_MS = 1_700_000_000_000
DECRYPTED_MS = PRODUCED_MS + 250
VALIDATED_MS = PRODUCED_MS + 600
NORMALIZED_MS = PRODUCED_MS + 1_000

REPORT_LIMIT = 100

# Messages that a stage takes, caches and hands on at a time.
MESSAGES_PER_BATCH = 400_000
# Queries keep the progress of their last 100 batches; files that are not full make more batches than this.
MOST_BATCHES = 50
# Sealed messages that lie in a topic at a time, some 4,400 bytes each on disk, and rounds that a larger input takes at most.
MESSAGES_PER_ROUND = 800_000
MOST_ROUNDS = 24
# Rows that are written or published at a time where nothing else of that size is on disk.
ROWS_PER_ROUND = 1_500_000
# Later than any batch of a topic.
ALL_BATCHES = 2**62

WHOLE = (0, 1)


def sample_key(spark: SparkSession) -> TokenKey:
    return TokenKey(spark, SAMPLE_KEY)


def repeatable_iv() -> Column:
    return F.substring(F.unhex(F.sha2(F.col("eventId"), 256)), 1, IV_BYTES)


def envelopes(spark, sf_dir, part=WHOLE) -> DataFrame:
    return envelope.as_envelopes(operations(spark, sf_dir, part=part), INDEX, RECORD_COLUMNS, PRODUCED_MS)


def sealed(spark, sf_dir, part=WHOLE) -> DataFrame:
    return envelope.seal(envelopes(spark, sf_dir, part), sample_key(spark), repeatable_iv(), PRODUCED_MS)


def checked(spark, sf_dir) -> DataFrame:
    return validation.validate(envelopes(spark, sf_dir), VALIDATED_MS)


def canonical(spark, sf_dir) -> DataFrame:
    return pipelines.canonical_from_open(envelopes(spark, sf_dir), NORMALIZED_MS)


def row_index(event_id: str = "eventId") -> Column:
    return F.substring(event_id, 5, 20).cast("bigint")


def payload_members(df: DataFrame, *names: str) -> list[Column]:
    p = Payload.of(df)
    return [p.raw(name).alias(name.lower()) for name in names]


# --- sources ---------------------------------------------------------------------------------


def topic_scan(spark, sf_dir):
    """Messages written to a topic and read back from its start."""
    opened = envelopes(spark, sf_dir)
    topic = FolderTopic(scratch_path(spark, "topics"), TOPIC_DECRYPTED)
    topic.append(envelope.keyed_messages(opened, envelope.open_text(opened)), "publisher")
    back = envelope.read_open(topic.read(spark))
    return back.select(
        F.col("eventId").alias("event_id"),
        "source",
        F.col("producedAt").alias("produced_at"),
        *payload_members(back, *RECORD_COLUMNS),
    )


def _csv_folder(spark, rows: DataFrame) -> str:
    path = scratch_path(spark, "csv")
    writer = rows.write.option("header", True).option("escape", '"').option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("compression", "gzip").csv(path)
    return path


def csv_scan(spark, sf_dir):
    """Rows written as CSV and scanned by header name, all as text."""
    rows = operation_files.scan_csv(spark, _csv_folder(spark, operations(spark, sf_dir)))
    return rows.select(F.col(INDEX), *(F.col(c).alias(c.lower()) for c in RECORD_COLUMNS))


def csv_line_breaks(spark, sf_dir):
    """Rows whose merchant names hold line breaks, quotes and commas, written as CSV and scanned by many tasks."""
    i = F.col(INDEX)
    name = (
        F.when(i % 4 == 0, F.concat(F.lit('line one\n"'), i.cast("string"), F.lit('", line two\n')))
        .when(i % 4 == 1, F.concat(F.lit("\n"), i.cast("string")))
        .when(i % 4 == 2, '"\n"')
        .otherwise(F.col("CARD_ACC_NAME_ADDRESS"))
    )
    rows = operations(spark, sf_dir).withColumn("CARD_ACC_NAME_ADDRESS", name)
    back = operation_files.scan_quoted(spark, _csv_folder(spark, rows))
    return back.select(F.col(INDEX), *(F.col(c).alias(c.lower()) for c in RECORD_COLUMNS))


def bulk_load(spark, sf_dir):
    """Table rows loaded by position from CSV, and that they have ids."""
    path = scratch_path(spark, "bulk")
    writer = operations(spark, sf_dir).drop(INDEX).write.option("header", True)
    writer = writer.option("escape", '"').option("nullValue", "").option("emptyValue", '""')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("compression", "gzip").csv(path)
    loaded = operation_files.bulk_load(spark, path)
    return loaded.select(
        (F.col("id") > 0).alias("has_id"),
        F.col("ingested_at").isNotNull().alias("has_ingested_at"),
        *(c.lower() for c in RECORD_COLUMNS),
    )


def change_events(spark, sf_dir, part=WHOLE) -> DataFrame:
    """Change messages of every operation, flat and wrapped, with and without a row, some malformed."""
    rows = operations(spark, sf_dir, part=part)
    i = F.col(INDEX)
    after = F.struct(
        i.alias("id"),
        *(F.col(c).alias(c.lower()) for c in RECORD_COLUMNS),
        F.lit("2025-01-01T00:00:00Z").alias("ingested_at"),
    )
    image = (
        F.when(i % 10 == 4, "null")
        .when(i % 10 == 5, "{}")
        .otherwise(F.to_json(after, KEEP_NULLS))
    )
    op = F.element_at(F.array(*(F.lit(o) for o in "ccurdctccc")), (i % 10 + 1).cast("int"))
    change = F.concat(
        F.lit('{"before":null,"after":'), image, F.lit(',"op":"'), op, F.lit('"}')
    )
    wrapped = F.concat(F.lit('{"payload":'), change, F.lit("}"))
    value = F.when(i % 3 == 0, wrapped).otherwise(change)
    tail = F.when(i % 10 == 7, "]").when(i % 10 == 8, '],[{"op":"c"}').when(i % 10 == 9, '},{"op":"c"').otherwise("")
    return rows.select(i, F.concat(value, tail).alias("value"))


def cdc_scan(spark, sf_dir):
    """A table snapshot as change messages in the change topic, read back."""
    rows = operations(spark, sf_dir)
    table = rows.select(F.col(INDEX).alias("id"), *(F.col(c).alias(c.lower()) for c in rows.columns[1:]))
    topic = FolderTopic(scratch_path(spark, "topics"), TOPIC_CDC)
    topic.append(changes.snapshot(table).withColumn("key", F.lit(None).cast("string")), "snapshot")
    read = cdc.unwrap(topic.read(spark))
    key, *members = members_in_order(F.col("after"), table.columns)
    return read.select(
        key.try_cast("bigint").alias(INDEX),
        "op",
        *(member.alias(c) for member, c in zip(members, table.columns[1:])),
    )


#: Log positions between the starts of two chunk reads; a chunk is read at 3 and marked at 0 and 6 of 10 of them.
READ_EVERY = 100


def change_log(rows: DataFrame) -> DataFrame:
    """Changes of three in five rows: an update, a deletion, both in turn; and new rows."""
    i, after = F.col("id"), F.struct(*rows.columns)
    at = F.pmod(F.xxhash64("id"), F.lit(9 * READ_EVERY)) + 1
    changed = F.struct(*(F.lit("1.00").alias(c) if c == "transaction_amount" else F.col(c) for c in rows.columns))
    new = F.struct(*((-i - 1).alias("id") if c == "id" else F.col(c) for c in rows.columns))

    def change(op: str, position: Column, image: Column, key: Column = i) -> Column:
        return F.struct(key.alias("id"), position.alias("position"), F.lit(op).alias("op"), image.alias("after"))

    gone = F.lit(None).cast(rows.select(after).schema[0].dataType)
    listed = (
        F.when(i % 5 == 1, F.array(change("u", at, changed)))
        .when(i % 5 == 2, F.array(change("d", at, gone)))
        .when(i % 5 == 3, F.array(change("u", at, changed), change("d", at + 2 * READ_EVERY, gone)))
        .when(i % 5 == 4, F.array(change("c", at, new, -i - 1)))
    )
    return rows.select(F.explode(listed).alias("x")).select("x.*")


#: Each task sorts the events of so many keys.
KEYS_PER_TASK = 50_000


def last_images(events: DataFrame, tasks: int) -> DataFrame:
    """The rows that are there after all events."""
    last = F.max_by(F.struct("op", "after"), "position").alias("last")
    return events.repartition(tasks, "id").groupBy("id").agg(last).filter("last.op <> 'd'").select("last.after.*")


def cdc_snapshot_then_changes(spark, sf_dir):
    """Rows after a snapshot in chunks, each read at another time, and the changes of a table that never stood still."""
    columns = ("MESSAGE_TYPE", "TRANSACTION_AMOUNT")
    rows = operations(spark, sf_dir, columns).select(F.col(INDEX).alias("id"), *(F.col(c).alias(c.lower()) for c in columns))
    log, bounds = change_log(rows), changes.key_bounds(rows, chunks=8)
    marks = spark.createDataFrame(
        [(k, READ_EVERY * k, READ_EVERY * k + 60) for k in range(len(bounds) + 1)], "chunk int, low long, high long"
    )
    begun = rows.select("id", F.lit(0).cast("long").alias("position"), F.lit("r").alias("op"), F.struct(*rows.columns).alias("after"))
    read_at = READ_EVERY * changes.chunk_of(F.col("id"), bounds) + 30
    tasks = max(1, -(-rows.count() // KEYS_PER_TASK))
    read = last_images(begun.unionByName(log).filter(F.col("position") <= read_at), tasks)
    read = read.select("id", F.struct(*read.columns).alias("after"))
    return last_images(changes.handover(read, marks, log, bounds), tasks)


def limit_rows(spark, sf_dir):
    """The first rows in index order: the limit is the feature."""
    columns = ("MESSAGE_TYPE", "TRANSACTION_AMOUNT")
    rows = operation_files.limit_rows(operations(spark, sf_dir, columns), REPORT_LIMIT, INDEX)
    return rows.select(INDEX, *(F.col(c).alias(c.lower()) for c in columns))


# --- envelopes, crypto, change events --------------------------------------------------------


def envelope_build(spark, sf_dir):
    built = envelopes(spark, sf_dir)
    return built.select(
        F.col("eventId").alias("event_id"),
        F.col("schemaVersion").alias("schema_version"),
        "source",
        F.col("producedAt").alias("produced_at"),
        *payload_members(built, *RECORD_COLUMNS),
    )


def _opened_messages(messages: DataFrame, key: TokenKey) -> DataFrame:
    """Published messages: the envelope, and every member of the payload that the token holds."""
    fields = "eventId string, schemaVersion string, source string, encrypted_payload string, producedAt bigint"
    records = messages.select("key", F.from_json("value", fields).alias("r")).select("key", "r.*")
    accepted = decryption.accepted(decryption.decrypt(records, key, DECRYPTED_MS))
    opened = validation.parse_payload(accepted, RECORD_COLUMNS)
    return opened.select(
        F.col("key").alias("message_key"),
        F.col("eventId").alias("event_id"),
        F.col("schemaVersion").alias("schema_version"),
        "source",
        F.col("producedAt").alias("produced_at"),
        *payload_members(opened, *RECORD_COLUMNS),
    )


def publish_rows(spark, sf_dir):
    """Keyed messages as the publisher sends them, their tokens opened again."""
    return _opened_messages(envelope.sealed_messages(sealed(spark, sf_dir)), sample_key(spark))


def publish_csv(spark, sf_dir):
    """CSV rows numbered, sealed and published with and without a row limit, then opened again.

    The given rows come in no stated order, so numbers are checked as a whole: every one from 0 on. Messages are opened
    round by round and expire then; what is asked of each is kept.
    """
    path, key = _csv_folder(spark, operations(spark, sf_dir)), sample_key(spark)
    asked = ("message_key", "event_id", "source", "message_type", "reference_number")
    frames = []
    for name, limit in (("all", 0), ("limited", REPORT_LIMIT)):
        topic = FolderTopic(scratch_path(spark, "topics"), TOPIC_SEALED)
        kept = scratch_path(spark, "opened")

        def take() -> None:
            _opened_messages(topic.read(spark), key).select(*asked).write.mode("append").parquet(kept)
            topic.expire(spark, ALL_BATCHES)

        rounds = 1 if limit else len(parts(spark, sf_dir, ROWS_PER_ROUND, MOST_ROUNDS // 2))
        pipelines.publish_csv(spark, path, key, topic, limit, rounds=rounds, sent=take)
        opened = spark.read.parquet(kept)
        same = F.col("message_key") == F.col("event_id")
        number = row_index("event_id")
        frames.append(
            opened.agg(
                F.lit(name).alias("run"),
                F.count(F.lit(1)).alias("messages"),
                F.count_distinct(number).alias("numbers"),
                F.min(number).alias("first_number"),
                F.max(number).alias("last_number"),
                F.count_if(same).alias("keyed"),
                F.count_if(F.col("source") == SOURCE_CSV).alias("from_csv"),
                F.count("message_type").alias("with_message_type") if not limit else F.lit(None).cast("bigint").alias("with_message_type"),
                F.sum(F.col("reference_number").cast("bigint")).alias("reference_sum") if not limit else F.lit(None).cast("bigint").alias("reference_sum"),
            )
        )
    return frames[0].unionByName(frames[1])


def encrypt_decrypt_roundtrip(spark, sf_dir):
    """Every payload member after sealing and opening again."""
    opened = decryption.accepted(
        decryption.decrypt(sealed(spark, sf_dir), sample_key(spark), DECRYPTED_MS)
    )
    parsed = validation.parse_payload(opened, RECORD_COLUMNS)
    return parsed.select(
        F.col("eventId").alias("event_id"), *payload_members(parsed, *RECORD_COLUMNS)
    )


def decrypt_ok(spark, sf_dir):
    """Envelope members of decrypted records, with the stage stamp."""
    opened = decryption.accepted(
        decryption.decrypt(sealed(spark, sf_dir), sample_key(spark), DECRYPTED_MS)
    )
    parsed = validation.parse_payload(opened, RECORD_COLUMNS)
    return parsed.select(
        F.col("eventId").alias("event_id"),
        F.col("schemaVersion").alias("schema_version"),
        "source",
        F.col("producedAt").alias("produced_at"),
        F.col("_processing.decryptedAt").alias("decrypted_at"),
        *payload_members(parsed, *RECORD_COLUMNS),
    )


def damaged_messages(spark, sf_dir, part=WHOLE) -> DataFrame:
    """Sealed messages, most of them spoiled in one of eleven ways by row index."""
    i = row_index()
    text = envelope.payload_json(F.col("payload"))
    tail = F.when(i % 12 == 9, "]").when(i % 12 == 10, '],[{"a":1}').otherwise("")
    opened = envelopes(spark, sf_dir, part).withColumn("payload", F.concat(text, tail))
    good = envelope.seal(opened, sample_key(spark), repeatable_iv(), PRODUCED_MS)
    token = F.col("encrypted_payload")
    inner = F.unbase64(token).cast("string")
    body = F.unbase64(F.replace(F.replace(inner, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/")))
    n = F.octet_length(body)

    def packed(raw: Column) -> Column:
        plain = F.replace(F.base64(raw), F.lit("\r\n"))
        safe = F.replace(F.replace(plain, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))
        return F.replace(F.base64(safe.cast("binary")), F.lit("\r\n"))

    last = F.substring(F.hex(body), -2, 2)
    flipped = F.concat(
        F.substring(body, F.lit(1), n - 1), F.unhex(F.when(last == "00", "01").otherwise("00"))
    )
    versioned = F.concat(F.unhex(F.lit("81")), F.substring(body, F.lit(2), n - 1))
    spoiled = (
        F.when(i % 12 == 1, F.lit(None))
        .when(i % 12 == 2, "")
        .when(i % 12 == 3, "abcde")
        .when(i % 12 == 4, packed(flipped))
        .when(i % 12 == 5, packed(versioned))
        .when(i % 12 == 6, F.replace(F.base64(F.lit("no token").cast("binary")), F.lit("\r\n")))
        .otherwise(token)
    )
    record = F.to_json(F.struct("eventId", "schemaVersion", "source", spoiled.alias("encrypted_payload"), "producedAt"))
    value = (
        F.when(i % 12 == 7, F.concat(record, F.lit(" }")))
        .when(i % 12 == 8, "[1, 2]")
        .when(i % 12 == 11, F.concat(record, F.lit("] junk")))
        .otherwise(record)
    )
    return good.select(F.col("eventId").alias("key"), value.alias("value"))


def dlq_decrypt(spark, sf_dir):
    """Dead letters of decryption by kind of damage."""
    messages = damaged_messages(spark, sf_dir)
    decrypted = decryption.decrypt(
        envelope.read_sealed(messages), sample_key(spark), DECRYPTED_MS
    )
    return (
        decryption.rejected(decrypted)
        .groupBy("stage", "errorCode", "errorMessage", "timestamp")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(
            "stage",
            F.col("errorCode").alias("error_code"),
            F.col("errorMessage").alias("error_message"),
            F.col("timestamp").alias("rejected_at"),
            "messages",
        )
    )


def wrong_key(spark, sf_dir):
    """Records sealed under another key: all of them are dead letters."""
    opened = envelopes(spark, sf_dir)
    foreign = envelope.seal(opened, TokenKey(spark, OTHER_KEY), repeatable_iv(), PRODUCED_MS)
    decrypted = decryption.decrypt(foreign, sample_key(spark), DECRYPTED_MS)
    return decrypted.select(
        F.col("eventId").alias("event_id"), F.col("fault").alias("error_message")
    )


def stage_latency(spark, sf_dir):
    """Milliseconds between the stamps of each accepted record."""
    opened = envelopes(spark, sf_dir)
    stamped_once = envelope.seal(opened, sample_key(spark), repeatable_iv(), PRODUCED_MS)
    decrypted = decryption.accepted(
        decryption.decrypt(stamped_once, sample_key(spark), DECRYPTED_MS)
    )
    valid = validation.accepted(validation.validate(decrypted, VALIDATED_MS))
    done = normalization.normalize(valid, NORMALIZED_MS)
    return done.select(
        F.col("msgId").alias("event_id"),
        latency(done, "decryptedAt", "validatedAt").alias("validation_ms"),
        latency(done, "validatedAt", "normalizedAt").alias("normalization_ms"),
        latency(done, "decryptedAt", "normalizedAt").alias("total_ms"),
    )


def cdc_unwrap(spark, sf_dir):
    changes_read = cdc.unwrap(change_events(spark, sf_dir))
    return changes_read.select(
        INDEX,
        "op",
        F.col("after").isNotNull().alias("has_after"),
        F.coalesce(F.size("after"), F.lit(0)).alias("after_columns"),
    )


def cdc_op_filter(spark, sf_dir):
    return cdc.keep_rows(cdc.unwrap(change_events(spark, sf_dir))).select(INDEX, "op")


def cdc_project(spark, sf_dir):
    """Row images as payloads: every member, and proof that bookkeeping columns are gone."""
    kept = cdc.keep_rows(cdc.unwrap(change_events(spark, sf_dir)))
    rows = kept.select(INDEX, cdc.record_columns(F.col("after")).alias("payload"))
    return rows.select(
        INDEX,
        F.size("payload").alias("members"),
        F.array_contains(F.map_keys("payload"), "ID").alias("has_id"),
        *payload_members(rows, *RECORD_COLUMNS),
    )


def cdc_adapted(spark, sf_dir) -> DataFrame:
    return cdc.adapt(
        change_events(spark, sf_dir), PRODUCED_MS, F.format_string("chg-%d", F.col(INDEX))
    )


def cdc_envelope(spark, sf_dir):
    adapted = cdc_adapted(spark, sf_dir)
    return adapted.select(
        F.col("eventId").alias("event_id"),
        "source",
        F.col("eventTime").alias("event_time"),
        F.col("_processing.cdcOp").alias("cdc_op"),
        F.col("_processing.cdcIngestedAt").alias("cdc_ingested_at"),
        *payload_members(adapted, *RECORD_COLUMNS),
    )


# --- validation ------------------------------------------------------------------------------


def mandatory_check(spark, sf_dir):
    rows = operations(spark, sf_dir, validation.MANDATORY_FIELDS)
    return rows.select(
        INDEX,
        *(
            (F.col(c).isNull() | (F.col(c) == "")).alias(f"{c.lower()}_missing")
            for c in validation.MANDATORY_FIELDS
        ),
    )


def _one_field(spark, sf_dir, column: str) -> tuple[DataFrame, Column]:
    """Rows as envelopes of one member, and that member as the stages read it."""
    rows = operations(spark, sf_dir, (column,))
    df = rows.select(F.col(INDEX), F.struct(column).alias("payload"))
    return df, Payload.of(df).text(column)


def mti_check(spark, sf_dir):
    df, mti = _one_field(spark, sf_dir, "MESSAGE_TYPE")
    return df.select(
        INDEX, mti.alias("mti"), ((mti == "") | codes.is_known_mti(mti)).alias("mti_ok")
    )


def currency_check(spark, sf_dir):
    df, code = _one_field(spark, sf_dir, "TRANSACTION_CURRENCY")
    return df.select(
        INDEX,
        code.alias("currency"),
        ((code == "") | codes.is_known_currency(code)).alias("currency_ok"),
    )


def luhn_check(spark, sf_dir):
    df, pan = _one_field(spark, sf_dir, "CARD_NUMBER")
    return df.select(INDEX, ((pan == "") | cards.passes_luhn(pan)).alias("luhn_ok"))


def validation_errors(spark, sf_dir):
    """One row per error, in report order."""
    return dead_letters.one_per_error(
        validation.rejected(checked(spark, sf_dir))
    ).select("event_id", "position", "code", "field", "value", "value_bin")


def split_valid(spark, sf_dir):
    valid = validation.accepted(checked(spark, sf_dir))
    return valid.select(
        F.col("eventId").alias("event_id"),
        F.col("validation.valid").alias("valid"),
        F.col("_processing.validatedAt").alias("validated_at"),
        *payload_members(valid, *RECORD_COLUMNS),
    )


def split_dlq(spark, sf_dir):
    rejects = validation.rejected(checked(spark, sf_dir))
    return rejects.select(
        F.col("eventId").alias("event_id"),
        "stage",
        F.col("validation.valid").alias("valid"),
        F.size("validation.errors").alias("errors"),
        F.col("_processing.validatedAt").alias("validated_at"),
        *payload_members(rejects, *RECORD_COLUMNS),
    )


def odd_messages(spark, sf_dir) -> DataFrame:
    """Open envelopes as texts; one in fourteen of them is whole, the others are odd in as many ways."""
    opened = envelopes(spark, sf_dir)
    i = row_index()
    head = F.concat(F.lit('{"eventId":"'), F.col("eventId"), F.lit('","payload":'))
    whole = F.concat(head, envelope.payload_json(F.col("payload")), F.lit("}"))
    value = (
        F.when(i % 14 == 1, F.concat(head, F.lit("null}")))
        .when(i % 14 == 2, F.concat(head, F.lit("{}}")))
        .when(i % 14 == 3, F.concat(head, F.lit('"text"}')))
        .when(i % 14 == 4, F.concat(head, F.lit("[1]}")))
        .when(i % 14 == 5, F.concat(head, F.lit("0}")))
        .when(i % 14 == 6, F.concat(head, F.lit("7}")))
        .when(i % 14 == 7, "not json")
        .when(i % 14 == 8, "[]")
        .when(i % 14 == 10, F.concat(head, F.lit("{}}]")))
        .when(i % 14 == 11, F.concat(head, F.lit("{}}] junk")))
        .when(i % 14 == 12, F.concat(head, F.lit("{}}],[{}")))
        .when(i % 14 == 13, F.concat(head, F.lit("{}}},{}")))
        .when(i % 14 == 9, F.concat(head, F.lit('{},"_processing":null}')))
        .otherwise(whole)
    )
    return opened.select(value.alias("value"))


def dlq_parse(spark, sf_dir):
    """Technical dead letters of validation, with the text that caused them."""
    rejects = validation.rejected(
        validation.validate(envelope.read_open(odd_messages(spark, sf_dir)), VALIDATED_MS)
    )
    return rejects.filter(dead_letters.is_technical()).select(
        "stage",
        F.col("errorCode").alias("error_code"),
        F.col("errorMessage").alias("error_message"),
        F.col("originalMessage").alias("original_message"),
        F.col("timestamp").alias("rejected_at"),
    )


def broken_messages(spark, sf_dir) -> DataFrame:
    """Texts that break off behind a card number, inside a note in every third of them."""
    rows = operations(spark, sf_dir, ("CARD_NUMBER",))
    pan, i = F.coalesce("CARD_NUMBER", F.lit("None")), F.col(INDEX)
    note = F.concat(F.lit('{"note":"call 12, card '), pan, F.lit(" of "), i.cast("string"), F.lit(' times"'))
    member = F.concat(F.lit('{"payload":{"CARD_NUMBER":"'), pan, F.lit('"'))
    return rows.select(F.when(i % 3 == 0, note).otherwise(member).alias("value"))


def dlq_masked(spark, sf_dir):
    """Texts of technical dead letters of two stages, the card numbers in them masked."""
    opened = envelope.read_open(broken_messages(spark, sf_dir))
    rejects = dead_letters.union(
        validation.rejected(validation.validate(opened, VALIDATED_MS), mask_card_numbers=True),
        normalization.rejected(normalization.normalize(opened, NORMALIZED_MS), mask_card_numbers=True),
    )
    return rejects.select("stage", F.col("errorCode").alias("error_code"), F.col("originalMessage").alias("original_message"))


# --- normalization ---------------------------------------------------------------------------

DATE_COLUMNS = (
    "TRANSMISSION_DATE_AND_TIME",
    "TRANSACTION_LOCAL_DATE",
    "BUSINESS_DATE",
    "CAPTURE_DATE",
    "END_EXPIRY_DATE",
)


def iso8601_dates(spark, sf_dir):
    rows = operations(spark, sf_dir, DATE_COLUMNS)
    return rows.select(INDEX, *(dates.to_iso8601(F.col(c)).alias(c.lower()) for c in DATE_COLUMNS))


def business_date(spark, sf_dir):
    columns = ("BUSINESS_DATE", "TRANSACTION_LOCAL_DATE", "TRANSMISSION_DATE_AND_TIME")
    rows = operations(spark, sf_dir, columns).select(F.col(INDEX), F.struct(*columns).alias("payload"))
    return rows.select(
        INDEX, normalization.payload_business_date(Payload.of(rows)).alias("business_date")
    )


def amounts(spark, sf_dir):
    fields = tuple(normalization.AMOUNT_FIELDS.values())
    rows = operations(spark, sf_dir, fields)
    return rows.select(INDEX, *(parse_amount(F.col(c)).alias(c.lower()) for c in fields))


def amounts_fallback(spark, sf_dir):
    columns = ("TRANSACTION_CURRENCY", "BILLING_CURRENCY", "ISS_SETTLEMENT_CURRENCY")
    rows = operations(spark, sf_dir, columns).select(F.col(INDEX), F.struct(*columns).alias("payload"))
    chosen = normalization.currencies(Payload.of(rows))
    return rows.select(INDEX, *(c.alias(f"{field.lower()}_currency") for field, c in chosen.items()))


def currency_enrich(spark, sf_dir):
    df, code = _one_field(spark, sf_dir, "TRANSACTION_CURRENCY")
    return lookups.with_currency(df.select(INDEX, code.alias("currency")), "currency")


def mti_enrich(spark, sf_dir):
    df, mti = _one_field(spark, sf_dir, "MESSAGE_TYPE")
    return lookups.with_mti_name(df.select(INDEX, mti.alias("mti")), "mti")


def mcc_enrich(spark, sf_dir):
    df, mcc = _one_field(spark, sf_dir, "CARD_ACCEPTOR_ACTIVITY")
    return lookups.with_mcc_description(
        df.select(INDEX, empty_to_null(mcc).alias("mcc")), "mcc"
    )


def pan_mask(spark, sf_dir):
    df, pan = _one_field(spark, sf_dir, "CARD_NUMBER")
    return df.select(INDEX, cards.mask_pan(pan).alias("pan_masked"))


def pan_bin(spark, sf_dir):
    df, pan = _one_field(spark, sf_dir, "CARD_NUMBER")
    return df.select(INDEX, cards.pan_bin(pan).alias("pan_bin"))


def card_scheme(spark, sf_dir):
    df, pan = _one_field(spark, sf_dir, "CARD_NUMBER")
    return df.select(INDEX, cards.card_scheme(pan).alias("card_scheme"))


def strip_text(spark, sf_dir):
    columns = ("MESSAGE_TYPE", "CARD_ACC_NAME_ADDRESS")
    rows = operations(spark, sf_dir, columns)
    return rows.select(
        INDEX,
        strip(F.col("MESSAGE_TYPE")).alias("message_type"),
        empty_to_null(strip(F.col("CARD_ACC_NAME_ADDRESS"))).alias("merchant_name"),
    )


def canonical_flat(spark, sf_dir):
    return normalization.flatten(canonical(spark, sf_dir))


def _flat_from_text(texts: DataFrame) -> DataFrame:
    """Canonical texts, taken apart again member by member."""
    return normalization.flatten(
        texts.select(F.from_json(texts.columns[0], CANONICAL_DDL).alias("r")).select("r.*")
    )


def canonical_json(spark, sf_dir):
    records = canonical(spark, sf_dir)
    return _flat_from_text(records.select(normalization.canonical_text(records)))


# --- joins and unions ------------------------------------------------------------------------


def unknown_mti_anti(spark, sf_dir):
    df, mti = _one_field(spark, sf_dir, "MESSAGE_TYPE")
    return lookups.unknown_mti(df.select(INDEX, mti.alias("mti")), "mti")


def known_currency_semi(spark, sf_dir):
    df, code = _one_field(spark, sf_dir, "TRANSACTION_CURRENCY")
    return lookups.known_currency(df.select(INDEX, code.alias("currency")), "currency")


def _decrypted(spark, sf_dir) -> DataFrame:
    opened = decryption.accepted(
        decryption.decrypt(sealed(spark, sf_dir), sample_key(spark), DECRYPTED_MS)
    )
    return validation.open_payload(opened).drop("value", "fault")


def union_sources(spark, sf_dir):
    """Decrypted rows and adapted changes as one input of validation."""
    from_rows = _decrypted(spark, sf_dir)
    both = from_rows.unionByName(cdc_adapted(spark, sf_dir), allowMissingColumns=True)
    return both.select(
        F.col("eventId").alias("event_id"),
        "source",
        F.col("producedAt").alias("produced_at"),
        F.col("eventTime").alias("event_time"),
        *payload_members(both, *RECORD_COLUMNS),
    )


def union_dlq(spark, sf_dir):
    """Technical rejects of decryption and business rejects of validation in one frame."""
    messages = damaged_messages(spark, sf_dir)
    decrypted = decryption.decrypt(envelope.read_sealed(messages), sample_key(spark), DECRYPTED_MS)
    rejects = dead_letters.union(
        decryption.rejected(decrypted),
        validation.rejected(checked(spark, sf_dir)),
    )
    return rejects.select(
        "stage",
        F.col("errorCode").alias("error_code"),
        F.col("eventId").alias("event_id"),
        F.size("validation.errors").alias("errors"),
        F.col("timestamp").alias("rejected_at"),
    )


# --- status ----------------------------------------------------------------------------------


def load_count(spark, sf_dir):
    return monitoring.load_count(operations(spark, sf_dir, ("MESSAGE_TYPE",)))


def storage_usage(spark, sf_dir):
    """Rows of the datasets written for the operations, and bytes where the format fixes them.

    A part of the operations is written, listed and counted at a time, and its files go before the next part's come.
    """
    text = envelope.payload_json(F.col("payload"))
    found = []
    for part in parts(spark, sf_dir, ROWS_PER_ROUND, MOST_ROUNDS):
        root = scratch_path(spark, "storage")
        opened = envelopes(spark, sf_dir, part)
        files.write_json_lines(opened, text, f"{root}/payloads")
        files.write_json_parquet(opened, text, f"{root}/payloads-parquet")
        usage = monitoring.storage_usage(spark, root)
        stored = {
            "payloads": read_text_messages(spark, f"{root}/payloads"),
            "payloads-parquet": spark.read.parquet(f"{root}/payloads-parquet"),
        }
        rows = monitoring.stage_counts(stored).select(F.col("stage").alias("dataset"), F.col("messages").alias("rows"))
        listed = usage.join(rows, "dataset")
        found.append(spark.createDataFrame(listed.collect(), listed.schema))
        remove(spark, root)
    whole = reduce(DataFrame.unionByName, found).groupBy("dataset").agg(*(F.sum(c).alias(c) for c in ("bytes", "files", "rows")))
    fixed = F.when(~F.col("dataset").endswith("-parquet"), F.col("bytes"))
    return whole.select("dataset", fixed.alias("bytes"), (F.col("files") > 0).alias("has_files"), "rows")


# --- sinks -----------------------------------------------------------------------------------


def jsonl_roundtrip(spark, sf_dir):
    records = canonical(spark, sf_dir)
    path = f"{scratch_path(spark, 'jsonl')}/normalized"
    files.write_json_lines(records, normalization.canonical_text(records), path)
    return _flat_from_text(read_text_messages(spark, path))


def parquet_roundtrip(spark, sf_dir):
    records = canonical(spark, sf_dir)
    path = f"{scratch_path(spark, 'parquet')}/normalized-parquet"
    files.write_json_parquet(records, normalization.canonical_text(records), path)
    return _flat_from_text(spark.read.parquet(path))


def canonical_partitioned(spark, sf_dir):
    """The store read back by its partition columns."""
    path = f"{scratch_path(spark, 'store')}/canonical"
    files.write_canonical(canonical(spark, sf_dir), path)
    store = spark.read.option("basePath", path).parquet(path)
    return store.groupBy(
        F.col("businessDate").cast("string").alias("business_date"), F.col("mti").cast("string").alias("mti")
    ).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("transaction.amount.value").isNotNull().cast("bigint")).alias("with_amount"),
    )


def _history(spark, sf_dir) -> Store:
    """A store that got the canonical records year by year, one year of them twice."""
    path = scratch_path(spark, "canonical")
    canonical(spark, sf_dir).write.parquet(path)
    records = spark.read.parquet(path)
    store = Store(spark, scratch_path(spark, "history"))
    year = F.coalesce(F.substring("businessDate", 1, 4), F.lit("none"))
    years = [r.year for r in records.select(year.alias("year")).distinct().orderBy("year").collect()]
    for name in [*years, *years[:1]]:
        store.append(records.filter(year == name), name)
    return store


def store_compaction(spark, sf_dir):
    """Records and files before a compaction, as a reader sees them that began before it, and after it."""
    store = _history(spark, sf_dir)
    before, files_before = store.read(), store.live()
    files_before = spark.createDataFrame(files_before.collect(), files_before.schema)
    store.compact()
    frames = []
    for moment, records, listed in (("before", before, files_before), ("after", store.read(), store.live())):
        counts = listed.agg(F.sum("rows").alias("listed"), F.count(F.lit(1)).alias("files"))
        found = records.agg(
            F.lit(moment).alias("moment"),
            F.count(F.lit(1)).alias("records"),
            F.count_distinct("msgId").alias("ids"),
            F.count("transaction.amount.value").alias("with_amount"),
            F.min("businessDate").alias("first_date"),
            F.max("businessDate").alias("last_date"),
        )
        frames.append(found.crossJoin(counts))  # one row each
    both = frames[0].unionByName(frames[1])
    fewest = F.min("files").over(Window.partitionBy())
    return both.withColumn("fewer_files", (F.col("moment") == "after") & (F.col("files") == fewest)).drop("files")


LOOKED_UP = {"dates": ("1995-01-01", "1995-03-31"), "types": ("1100", "1420")}


def store_lookups(spark, sf_dir):
    """Records of a store found by date, by type and by id, and whether fewer files were opened than there are."""
    store = _history(spark, sf_dir)
    ends = store.live().agg(F.min("min_id"), F.max("max_id")).first()
    frames, files = [], store.live().count()
    for name, asked in (*LOOKED_UP.items(), ("ids", tuple(ends))):
        opened = store.files(**{name: asked}).count()
        found = store.read(**{name: asked})
        frames.append(
            found.select(
                F.lit(name).alias("look_up"),
                (F.lit(opened < files) if name != "types" else F.lit(None).cast("boolean")).alias("opened_fewer"),
                F.col("msgId").alias("event_id"),
                F.col("businessDate").alias("business_date"),
                F.col("iso8583.mti").alias("mti"),
                F.col("transaction.amount.value").alias("amount_value"),
            )
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _finished_jobs(spark, sf_dir, changes: bool = False, store: bool = False, damaged: bool = False) -> tuple[Jobs, DataFrame]:
    """The stages as streams over topics, run to the end of their input, the finished queries in ``ran``; and how many
    messages each topic got.

    A large input comes in rounds: the publisher sends a part, all stages take it to its end from where they stopped, and
    the messages that no one reads any more are counted and expire. Normalized messages stay, and so do all datasets.
    """
    jobs = Jobs.in_folder(spark, scratch_path(spark, "jobs"), sample_key(spark), text_compression="gzip")
    taken = [*([TOPIC_CDC] if changes else []), TOPIC_SEALED, TOPIC_DECRYPTED, TOPIC_VALIDATED, TOPIC_DLQ]
    starts = [*([jobs.cdc_adapter] if changes else []), jobs.decryption, jobs.validation, jobs.normalization]
    counts = []

    def finish(start) -> None:
        query = start()
        query.awaitTermination()
        jobs.ran.append(query)

    for part in parts(spark, sf_dir, MESSAGES_PER_ROUND // (2 if damaged else 1), MOST_ROUNDS):
        messages = envelope.sealed_messages(sealed(spark, sf_dir, part))
        if damaged:
            messages = messages.unionByName(damaged_messages(spark, sf_dir, part))
        jobs.topic(TOPIC_SEALED).append(messages, "publisher", part[0])
        if changes:
            events = change_events(spark, sf_dir, part).select(F.lit(None).cast("string").alias("key"), "value")
            jobs.topic(TOPIC_CDC).append(events, "connector", part[0])
        total = sum(jobs.topic(name).read(spark).count() for name in (TOPIC_SEALED, TOPIC_CDC))
        jobs.max_per_trigger = max(MESSAGES_PER_BATCH, total // MOST_BATCHES)
        for start in starts:
            finish(start)
        sent = monitoring.stage_counts({name: jobs.topic(name).read(spark) for name in taken})
        counts.append(spark.createDataFrame(sent.collect(), sent.schema))
        for name in taken:
            jobs.topic(name).expire(spark, ALL_BATCHES)
    if store:
        # each batch of the store adds a file to every folder, so that it takes all in one
        finish(replace(jobs, max_per_trigger=None).store)
    counts.append(monitoring.stage_counts({TOPIC_NORMALIZED: jobs.topic(TOPIC_NORMALIZED).read(spark)}))
    return jobs, monitoring.added_counts(counts)


def stage_counts(spark, sf_dir):
    """Messages per topic after a run of all stages over both sources."""
    _, counts = _finished_jobs(spark, sf_dir, changes=True)
    return counts.filter(F.col("stage").isin(*STATUS_TOPICS))


def progress_counts(spark, sf_dir):
    """Records each stage accepted and rejected, as counted by its own pass, over whole and damaged messages."""
    jobs, _ = _finished_jobs(spark, sf_dir, changes=True, store=True, damaged=True)
    return monitoring.progress_counts(spark, jobs.ran)


def pipeline_stream(spark, sf_dir):
    """The stages as streams over topics, up to the canonical texts."""
    jobs, _ = _finished_jobs(spark, sf_dir)
    return _flat_from_text(jobs.topic(TOPIC_NORMALIZED).read(spark).select("value"))


def stream_fanout(spark, sf_dir):
    """Rows each output of the streams received, the partitioned store among them."""
    jobs, counts = _finished_jobs(spark, sf_dir, store=True)
    frames = {}
    for name in ("decrypted", "validated", "normalized", "canonical"):
        frames[name] = read_text_messages(spark, jobs.dataset(name))
        frames[f"{name}-parquet"] = (
            spark.read.option("recursiveFileLookup", "true").parquet(jobs.dataset(f"{name}-parquet"))
        )
    frames["canonical-partitioned"] = spark.read.parquet(jobs.dataset("canonical-partitioned"))
    return counts.unionByName(monitoring.stage_counts(frames))


# --- pipelines -------------------------------------------------------------------------------


def pipeline_canonical(spark, sf_dir):
    return normalization.flatten(
        pipelines.canonical_from_sealed(sealed(spark, sf_dir), sample_key(spark), NORMALIZED_MS)
    )


def pipeline_cdc(spark, sf_dir):
    return normalization.flatten(
        pipelines.canonical_from_changes(
            change_events(spark, sf_dir), NORMALIZED_MS, F.format_string("chg-%d", F.col(INDEX))
        )
    )


def pipeline_dlq(spark, sf_dir):
    """All rejects of both stages over all sealed messages, whole and damaged ones, one row per error."""
    whole = envelope.sealed_messages(sealed(spark, sf_dir))
    messages = whole.unionByName(damaged_messages(spark, sf_dir))
    return dead_letters.one_per_error(
        pipelines.rejects_from_sealed(envelope.read_sealed(messages), sample_key(spark), VALIDATED_MS)
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        topic_scan,
        csv_scan,
        csv_line_breaks,
        bulk_load,
        cdc_scan,
        cdc_snapshot_then_changes,
        limit_rows,
        publish_rows,
        publish_csv,
        jsonl_roundtrip,
        parquet_roundtrip,
        canonical_partitioned,
        store_compaction,
        store_lookups,
        stream_fanout,
        envelope_build,
        encrypt_decrypt_roundtrip,
        decrypt_ok,
        dlq_decrypt,
        wrong_key,
        split_valid,
        split_dlq,
        stage_latency,
        cdc_unwrap,
        cdc_op_filter,
        cdc_project,
        cdc_envelope,
        mandatory_check,
        mti_check,
        currency_check,
        luhn_check,
        validation_errors,
        dlq_parse,
        dlq_masked,
        iso8601_dates,
        business_date,
        amounts,
        amounts_fallback,
        currency_enrich,
        mti_enrich,
        mcc_enrich,
        pan_mask,
        pan_bin,
        card_scheme,
        strip_text,
        canonical_flat,
        canonical_json,
        unknown_mti_anti,
        known_currency_semi,
        union_sources,
        union_dlq,
        stage_counts,
        progress_counts,
        load_count,
        storage_usage,
        pipeline_canonical,
        pipeline_cdc,
        pipeline_dlq,
        pipeline_stream,
    )
}
