"""Envelopes: wrapping rows, sealing payloads, reading and writing the wire form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardrail.functions import tokens
from cardrail.functions.payload import PAYLOAD_TEXT
from cardrail.functions.records import (
    CORRUPT,
    JSON_BLANKS,
    is_falsy,
    is_object_text,
    is_one_json_value,
    member_json,
    fenced,
    parse_object,
    settled,
    splice,
    type_word,
    unknown_members,
)
from cardrail.operators.stamps import now_millis
from cardrail.schemas import (
    ENVELOPE_HEAD,
    ENVELOPE_HEAD_TYPES,
    PROCESSING_DDL,
    SCHEMA_VERSION,
    SOURCE_CSV,
    STRING_MAP,
)

BAD_JSON = "JSONDecodeError: not a single JSON value"


def event_id(index: Column) -> Column:
    """``evt-`` and the row index in at least eight digits (``lpad`` would cut longer ones)."""
    return F.format_string("evt-%08d", index)


def as_envelopes(
    df: DataFrame,
    index: str,
    columns: list[str] | tuple[str, ...] | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """Open envelopes around rows; the payload is a struct of ``columns``, all text.

    With ``columns`` left out, every column but the index becomes a member.
    """
    members = columns or [c for c in df.columns if c != index]
    return df.select(
        event_id(F.col(index)).alias("eventId"),
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(SOURCE_CSV).alias("source"),
        now_millis(now_ms).alias("producedAt"),
        F.struct(*(F.col(c).cast("string").alias(c) for c in members)).alias("payload"),
    )


def payload_json(payload: Column) -> Column:
    """JSON text of a payload struct or map; null members are written."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def seal(
    envelopes: DataFrame,
    key: tokens.TokenKey,
    iv: Column | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """Replace the payload by its encrypted text. ``iv`` is random unless given (tests only).

    A payload that is a text already is sealed as it is.
    """
    seconds = (now_millis(now_ms) / 1000).cast("bigint")
    is_text = envelopes.schema["payload"].dataType.typeName() == "string"
    plain = (F.col("payload") if is_text else payload_json(F.col("payload"))).cast("binary")
    body = tokens.token_body(plain, seconds, tokens.random_iv() if iv is None else iv, key)
    # the body gets a column first: its MAC and its text must come from one encryption
    return envelopes.withColumn("_body", body).select(
        "eventId",
        "schemaVersion",
        "source",
        tokens.sealed_text(F.col("_body"), key).alias("encrypted_payload"),
        "producedAt",
    )


def keyed_messages(df: DataFrame, value: Column, key: str = "eventId") -> DataFrame:
    """Topic messages: the key and the record text."""
    return df.select(F.col(key).alias("key"), value.alias("value"))


def sealed_messages(sealed: DataFrame) -> DataFrame:
    """Sealed envelopes as messages keyed by event id."""
    return keyed_messages(sealed, F.to_json(F.struct(*sealed.columns)))


def _head_fields() -> str:
    # producedAt is read as text so that an odd value does not condemn the record
    return ", ".join(f"{name} string" for name in ENVELOPE_HEAD)


def _head_columns(record: Column) -> list[Column]:
    return [
        record.getField(name).try_cast(ENVELOPE_HEAD_TYPES[name]).alias(name)
        for name in ENVELOPE_HEAD
    ]


def _record_fault(value: Column, corrupt: Column) -> Column:
    """Error text for a record that is not one JSON object, null when it is one."""
    root = member_json(value, "$")
    return (
        F.when(value.isNull() | (F.ltrim(value, F.lit(JSON_BLANKS)) == ""), BAD_JSON)
        .when(~is_one_json_value(value), BAD_JSON)
        .when(
            corrupt.isNotNull(),
            F.when(root.isNull() & ~value.rlike(r'^\s*["\d\-tfn\[]'), BAD_JSON).when(
                ~is_object_text(F.coalesce(root, value)), no_get(F.coalesce(root, value))
            ),
        )
    )


def no_get(json: Column) -> Column:
    """The error text for reading members of something that is not an object."""
    return F.concat(F.lit("AttributeError: '"), type_word(json), F.lit("' object has no attribute 'get'"))


def _processing_fault(value: Column, processing: Column) -> Column:
    """Error text when ``_processing`` is there but is no object: it cannot take a stamp.

    The kind is looked up only where no struct was parsed from a record that names the member.
    """
    json = member_json(value, "$._processing")
    kind = type_word(json)
    return F.when(
        processing.isNull() & value.contains('"_processing"') & json.isNotNull(),
        F.when(kind == "list", "TypeError: list indices must be integers or slices, not str").when(
            kind != "dict",
            F.concat(
                F.lit("TypeError: '"), kind, F.lit("' object does not support item assignment")
            ),
        ),
    )


def read_sealed(messages: DataFrame) -> DataFrame:
    """Sealed envelopes from message texts; ``fault`` says why a record cannot be used."""
    value = F.col("value")
    fields = f"{_head_fields()}, encrypted_payload string, _processing {PROCESSING_DDL}"
    parsed = fenced(messages, _record=parse_object(value, fields))
    record = F.col("_record")
    known = (*ENVELOPE_HEAD, "encrypted_payload", "payload", "_processing")
    return parsed.select(
        "value",
        *_head_columns(record),
        record.getField("encrypted_payload").alias("encrypted_payload"),
        record.getField("_processing").alias("_processing"),
        unknown_members(value, known).alias("extras"),
        _record_fault(value, record.getField(CORRUPT)).alias("fault"),
        _processing_fault(value, record.getField("_processing")).alias("late_fault"),
    )


def read_open(messages: DataFrame) -> DataFrame:
    """Open envelopes from message texts, the payload as a map.

    A payload that counts as nothing (null, empty, zero, false) reads as an empty map; any other
    payload that is not an object is a fault.
    """
    value = F.col("value")
    fields = f"{_head_fields()}, payload {STRING_MAP}, _processing {PROCESSING_DDL}"
    parsed = messages.withColumn("_record", parse_object(value, fields))
    record = F.col("_record")
    corrupt = record.getField(CORRUPT)
    payload = record.getField("payload")
    odd = member_json(value, "$.payload")
    payload_fault = F.when(
        corrupt.isNotNull() & payload.isNull() & odd.isNotNull() & ~is_falsy(odd) & ~is_object_text(odd),
        no_get(odd),
    )
    known = (*ENVELOPE_HEAD, "payload", "_processing", "validation", "stage")
    fault = F.coalesce(
        _record_fault(value, corrupt),
        payload_fault,
        _processing_fault(value, record.getField("_processing")),
    )
    whole = F.coalesce(settled(payload), F.create_map().cast(STRING_MAP))
    judged = fenced(parsed, payload=whole, fault=fault)
    return judged.select(
        "value",
        *_head_columns(record),
        "payload",
        record.getField("_processing").alias("_processing"),
        unknown_members(value, known).alias("extras"),
        "fault",
    )


def open_text(envelopes: DataFrame, *more: str) -> Column:
    """Wire text of open envelopes: head, payload, stamps, ``more`` members, then unknown ones.

    Members without a value are left out, except inside the payload, where a null is kept.
    """
    names = [c for c in (*ENVELOPE_HEAD, "_processing", *more) if c in envelopes.columns]
    dtype = envelopes.schema["payload"].dataType.typeName()
    if PAYLOAD_TEXT in envelopes.columns:
        payload = F.col(PAYLOAD_TEXT)
    elif dtype == "string":
        payload = F.col("payload")
    else:
        payload = payload_json(F.col("payload"))
    text = splice(
        F.to_json(F.struct(*names)),
        F.concat(F.lit('{"payload":'), F.coalesce(payload, F.lit("null")), F.lit("}")),
    )
    if "extras" in envelopes.columns:
        text = splice(text, F.coalesce(F.to_json(F.col("extras")), F.lit("{}")))
    return text
