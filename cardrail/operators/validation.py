"""Validation stage: every rule that fails is listed; records with any failure are rejected."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardrail.functions.cards import BIN_LENGTH, mask_in_text, mask_pan, passes_luhn
from cardrail.functions.codes import is_known_currency, is_known_mti
from cardrail.functions.payload import PAYLOAD_TEXT, Payload
from cardrail.functions.records import JSON_OPTIONS, bound, fenced, is_falsy, is_object_text, settled
from cardrail.functions.text import is_empty, strip
from cardrail.operators.envelope import no_get, open_text
from cardrail.operators.stamps import now_millis, stamped
from cardrail.schemas import ENVELOPE_HEAD, PAYLOAD_COLUMNS, STRING_MAP

STAGE = "validation"

# Error codes, and the fields that must be there, in report order.
PARSE_FAILED = "PARSE_FAILED"
MISSING_FIELD = "MANDATORY_FIELD_MISSING"
UNKNOWN_MTI = "ISO8583_UNKNOWN_MTI"
INVALID_CURRENCY = "ISO4217_INVALID_CURRENCY"
LUHN_FAILED = "ISO7812_LUHN_FAILED"
MANDATORY_FIELDS = ("MESSAGE_TYPE", "CARD_NUMBER", "TRANSACTION_AMOUNT", "TRANSACTION_CURRENCY")

ERRORS_TYPE = f"array<{STRING_MAP}>"


def _error(code: str, field: str, **more: Column) -> Column:
    members = {"code": F.lit(code), "field": F.lit(field), **more}
    return F.create_map(*(x for name, value in members.items() for x in (F.lit(name), value)))


def rules(payload: Payload) -> list[tuple[Column, Column]]:
    """Pairs of a never-null failure test and the error it reports, in report order."""
    checks = [
        (is_empty(payload.raw(field)), _error(MISSING_FIELD, field)) for field in MANDATORY_FIELDS
    ]
    mti = payload.text("MESSAGE_TYPE")
    currency = payload.text("TRANSACTION_CURRENCY")
    pan = payload.text("CARD_NUMBER")
    checks.append(
        ((mti != "") & ~is_known_mti(mti), _error(UNKNOWN_MTI, "MESSAGE_TYPE", value=mti))
    )
    checks.append(
        (
            (currency != "") & ~is_known_currency(currency),
            _error(INVALID_CURRENCY, "TRANSACTION_CURRENCY", value=currency),
        )
    )
    checks.append(
        (
            (pan != "") & ~passes_luhn(pan),
            _error(LUHN_FAILED, "CARD_NUMBER", valueBin=F.substring(pan, 1, BIN_LENGTH)),
        )
    )
    return checks


def open_payload(envelopes: DataFrame) -> DataFrame:
    """Parse a payload that is still JSON text into a map; leaves maps and structs alone.

    Text that counts as nothing gives an empty map, any other non-object sets ``fault``.
    """
    if not isinstance(envelopes.schema["payload"].dataType, T.StringType):
        return envelopes
    text, members = F.col("payload"), F.col("_members")
    blank = F.coalesce(is_falsy(text), F.lit(True))
    fault = F.when(members.isNull() & ~blank, no_get(text))
    if "fault" in envelopes.columns:
        fault = F.coalesce(F.col("fault"), fault)
    if "value" not in envelopes.columns:
        envelopes = envelopes.withColumn("value", open_text(envelopes))
    parsed = envelopes.withColumn("_members", F.from_json(text, STRING_MAP, JSON_OPTIONS))
    whole = F.coalesce(settled(members), F.create_map().cast(STRING_MAP))
    return fenced(parsed, payload=whole, fault=fault).drop("_members")


def parse_payload(
    envelopes: DataFrame, members: tuple[str, ...] = PAYLOAD_COLUMNS
) -> DataFrame:
    """Parse the members that the stages read from a payload that is still JSON text.

    The text itself stays beside them, for rejects and for the wire. Maps and structs are left alone;
    faults are those of ``open_payload``.
    """
    if not isinstance(envelopes.schema["payload"].dataType, T.StringType):
        return envelopes
    text = F.col("payload")
    usable = is_object_text(text) & ~is_falsy(text)
    fault = F.when(~usable & ~F.coalesce(is_falsy(text), F.lit(True)), no_get(text))
    if "fault" in envelopes.columns:
        fault = F.coalesce(F.col("fault"), fault)
    if "value" not in envelopes.columns:
        envelopes = envelopes.withColumn("value", open_text(envelopes))
    fields = ", ".join(f"{name} string" for name in members)
    parsed = F.from_json(F.when(usable, text), fields, JSON_OPTIONS)
    return fenced(envelopes.withColumn(PAYLOAD_TEXT, text), payload=parsed, fault=fault)


def validate(
    envelopes: DataFrame, now_ms: int | None = None, none_as_text: bool = True
) -> DataFrame:
    """Adds ``valid``, ``errors`` and the stage stamp; ``fault`` marks records that do not parse.

    ``valid`` is a plain test without the error list, so keeping the valid records never builds it.
    """
    opened = parse_payload(envelopes)
    checks = rules(Payload.of(opened, none_as_text=none_as_text))
    failed = reduce(or_, (test for test, _ in checks))
    none = F.array().cast(ERRORS_TYPE)
    errors = F.concat(*(F.when(test, F.array(error)).otherwise(none) for test, error in checks))
    fault = F.col("fault") if "fault" in opened.columns else F.lit(None).cast("string")
    kept = [c for c in opened.columns if c not in ("fault", "_processing")]
    return opened.select(
        *kept,
        stamped(opened, validatedAt=now_millis(now_ms)).alias("_processing"),
        fault.alias("fault"),
        (fault.isNull() & ~failed).alias("valid"),
        F.when(fault.isNull(), errors).alias("errors"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Valid envelopes with their verdict."""
    return (
        checked.filter("valid")
        .withColumn("validation", F.struct(F.lit(True).alias("valid")))
        .drop("valid", "errors", "fault", "value")
    )


def payload_as_map(df: DataFrame) -> Column:
    """The payload as a map, so that rejects of every origin share one type."""
    if PAYLOAD_TEXT in df.columns:
        members = F.from_json(F.col(PAYLOAD_TEXT), STRING_MAP, JSON_OPTIONS)
        return F.coalesce(bound(members, settled), F.create_map().cast(STRING_MAP))
    dtype = df.schema["payload"].dataType
    if isinstance(dtype, T.MapType):
        return F.col("payload")
    return F.create_map(
        *(x for name in dtype.fieldNames() for x in (F.lit(name), F.col("payload").getField(name)))
    )


def rejected(checked: DataFrame, mask_card_numbers: bool = False) -> DataFrame:
    """Dead letters: whole envelopes with their error list, or technical ones for ``fault``.

    Card numbers stay readable unless ``mask_card_numbers`` is set; it also masks those in members that no one
    expects, and in the original text of a record that did not parse.
    """
    columns = reject_columns(checked, mask_card_numbers)
    return checked.filter(~F.col("valid")).select(*(c.alias(n) for n, c in columns.items()))


def _masked_value(value: Column) -> Column:
    """A JSON value with the card numbers in it masked; a number that is one becomes text."""
    text = mask_in_text(F.to_json(value))
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.concat(F.lit('"'), text, F.lit('"'))))


def reject_columns(checked: DataFrame, mask_card_numbers: bool = False) -> dict[str, Column]:
    """Members of a dead letter."""
    parsed = F.col("fault").isNull()
    payload = payload_as_map(checked)
    original = F.col("value") if "value" in checked.columns else F.lit(None).cast("string")
    if mask_card_numbers:
        payload = F.transform_values(
            payload,
            lambda name, text: F.when(name == "CARD_NUMBER", mask_pan(strip(text))).otherwise(text),
        )
        original = mask_in_text(original)
    head = {c: F.col(c) for c in (*ENVELOPE_HEAD, "_processing", "extras") if c in checked.columns}
    if mask_card_numbers and "extras" in head:
        head["extras"] = F.transform_values("extras", lambda name, value: _masked_value(value))
    verdict = F.struct(F.lit(False).alias("valid"), F.col("errors").alias("errors"))
    return {
        **{name: F.when(parsed, c) for name, c in head.items()},
        "payload": F.when(parsed, payload),
        "validation": F.when(parsed, verdict),
        "stage": F.lit(STAGE),
        "errorCode": F.when(~parsed, PARSE_FAILED),
        "errorMessage": F.col("fault"),
        "originalMessage": F.when(~parsed, original),
        "timestamp": F.when(~parsed, F.col("_processing.validatedAt")),
    }
