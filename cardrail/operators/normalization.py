"""Normalization stage: validated envelopes to one canonical record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardrail.functions.amounts import amount, parse_amount
from cardrail.functions.cards import card_scheme, mask_in_text, mask_pan, pan_bin
from cardrail.functions.codes import mcc_description, mti_name
from cardrail.functions.dates import business_date, to_iso8601
from cardrail.functions.payload import Payload
from cardrail.functions.records import KEEP_NULLS, splice
from cardrail.functions.text import empty_to_null, strip
from cardrail.operators.stamps import now_millis, stamped
from cardrail.operators.validation import PARSE_FAILED, parse_payload
from cardrail.schemas import CANONICAL_SCHEMA

STAGE = "normalization"

# Members of the record, in order.
CANONICAL_MEMBERS = (
    "msgId",
    "schema",
    "creDtTm",
    "businessDate",
    "iso8583",
    "transaction",
    "card",
    "merchant",
    "acquirer",
    "issuer",
    "audit",
    "_processing",
)

# Flat column name and path of every canonical member, stage stamps aside.
FLAT_COLUMNS = {
    "msg_id": "msgId",
    "schema": "schema",
    "cre_dt_tm": "creDtTm",
    "business_date": "businessDate",
    "mti": "iso8583.mti",
    "mti_name": "iso8583.mtiName",
    "processing_code": "iso8583.processingCode",
    "action_code": "iso8583.actionCode",
    "response_code": "iso8583.responseCode",
    **{
        f"{flat}_{part_flat}": f"transaction.{member}.{part}"
        for flat, member in (
            ("amount", "amount"),
            ("billing_amount", "billingAmount"),
            ("settlement_amount", "settlementAmount"),
            ("cash_back_amount", "cashBackAmount"),
        )
        for part_flat, part in (
            ("value", "value"),
            ("currency_code", "currencyCode"),
            ("currency_alpha", "currencyAlpha"),
            ("minor_units", "minorUnits"),
        )
    },
    "transaction_local_date": "transaction.transactionLocalDate",
    "capture_date": "transaction.captureDate",
    "pan_masked": "card.panMasked",
    "pan_bin": "card.panBin",
    "card_scheme": "card.scheme",
    "expiry_date": "card.expiryDate",
    "sequence_number": "card.sequenceNumber",
    "merchant_id": "merchant.id",
    "merchant_name": "merchant.name",
    "mcc": "merchant.mcc",
    "mcc_description": "merchant.mccDescription",
    "terminal_id": "merchant.terminalId",
    "acquirer_institution_code": "acquirer.institutionCode",
    "acquirer_bank": "acquirer.bank",
    "acquirer_country_code": "acquirer.countryCode",
    "issuer_bank": "issuer.bank",
    "issuer_network_code": "issuer.networkCode",
    "stan": "audit.stan",
    "rrn": "audit.rrn",
    "auth_code": "audit.authCode",
    "auth_source": "audit.authSource",
    "original_auth_code": "audit.originalAuthCode",
}


# Amount member of the record and the field its number comes from.
AMOUNT_FIELDS = {
    "amount": "TRANSACTION_AMOUNT",
    "billingAmount": "BILLING_AMOUNT",
    "settlementAmount": "ISS_SETTLEMENT_AMOUNT",
    "cashBackAmount": "CASH_BACK_AMOUNT",
}


def _struct(**members: Column) -> Column:
    return F.struct(*(column.alias(name) for name, column in members.items()))


def currencies(payload: Payload) -> dict[str, Column]:
    """Currency per amount; billing and settlement fall back to the transaction's."""
    own = payload.text("TRANSACTION_CURRENCY")
    return {
        "TRANSACTION_AMOUNT": own,
        "BILLING_AMOUNT": F.coalesce(empty_to_null(payload.text("BILLING_CURRENCY")), own),
        "ISS_SETTLEMENT_AMOUNT": F.coalesce(
            empty_to_null(payload.text("ISS_SETTLEMENT_CURRENCY")), own
        ),
        "CASH_BACK_AMOUNT": own,
    }


def payload_business_date(payload: Payload) -> Column:
    """From the first date field that holds anything; a text that does not parse is not skipped."""
    return business_date(
        F.coalesce(
            empty_to_null(payload.raw("BUSINESS_DATE")),
            empty_to_null(payload.raw("TRANSACTION_LOCAL_DATE")),
            payload.raw("TRANSMISSION_DATE_AND_TIME"),
        )
    )


def normalize(
    envelopes: DataFrame, now_ms: int | None = None, none_as_text: bool = True
) -> DataFrame:
    """The canonical record: a closed projection, whatever else the envelope holds."""
    opened = parse_payload(envelopes)
    p = Payload.of(opened, none_as_text=none_as_text)
    raw, text = p.raw, p.text
    # What is parsed and then read more than once gets a column of its own first; building the
    # record in one step would repeat the parsing per use.
    fields = {
        "mti": text("MESSAGE_TYPE"),
        "pan": text("CARD_NUMBER"),
        "mcc": text("CARD_ACCEPTOR_ACTIVITY"),
        **{f"{field}_currency": code for field, code in currencies(p).items()},
        **{f"{field}_number": parse_amount(raw(field)) for field in AMOUNT_FIELDS.values()},
    }
    prepared = opened.withColumns({f"_{name}": column for name, column in fields.items()})
    mti, pan, mcc = F.col("_mti"), F.col("_pan"), F.col("_mcc")
    amounts = {
        member: amount(F.col(f"_{field}_number"), F.col(f"_{field}_currency"))
        for member, field in AMOUNT_FIELDS.items()
    }
    return prepared.select(
        F.col("eventId").alias("msgId"),
        F.lit(CANONICAL_SCHEMA).alias("schema"),
        to_iso8601(raw("TRANSMISSION_DATE_AND_TIME")).alias("creDtTm"),
        payload_business_date(p).alias("businessDate"),
        _struct(
            mti=mti,
            mtiName=mti_name(mti),
            processingCode=raw("PROCESSING_CODE"),
            actionCode=raw("ACTION_CODE"),
            responseCode=raw("ORIGINAL_ACTION_CODE"),
        ).alias("iso8583"),
        _struct(
            **amounts,
            transactionLocalDate=to_iso8601(raw("TRANSACTION_LOCAL_DATE")),
            captureDate=to_iso8601(raw("CAPTURE_DATE")),
        ).alias("transaction"),
        _struct(
            panMasked=mask_pan(pan),
            panBin=pan_bin(pan),
            scheme=card_scheme(pan),
            expiryDate=to_iso8601(raw("END_EXPIRY_DATE")),
            sequenceNumber=raw("CARD_SEQUENCE_NUMBER"),
        ).alias("card"),
        _struct(
            id=raw("CARD_ACCEPTOR_ID"),
            name=empty_to_null(strip(raw("CARD_ACC_NAME_ADDRESS"))),
            mcc=empty_to_null(mcc),
            mccDescription=mcc_description(mcc),
            terminalId=raw("CARD_ACCEPTOR_TERM_ID"),
        ).alias("merchant"),
        _struct(
            institutionCode=raw("ACQUIRER_INSTITUTION_CODE"),
            bank=raw("ACQUIRER_BANK"),
            countryCode=raw("ACQUIRING_COUNTRY_CODE"),
        ).alias("acquirer"),
        _struct(bank=raw("ISSUING_BANK"), networkCode=raw("NETWORK_CODE")).alias("issuer"),
        _struct(
            stan=raw("INTERNAL_STAN"),
            rrn=raw("REFERENCE_NUMBER"),
            authCode=raw("AUTHORIZATION_CODE"),
            authSource=raw("AUTHORIZATION_SOURCE"),
            originalAuthCode=raw("ORIGINAL_AUTHORIZATION_CODE"),
        ).alias("audit"),
        stamped(opened, normalizedAt=now_millis(now_ms)).alias("_processing"),
        *(c for c in ("fault", "value") if c in opened.columns),
    )


def accepted(normalized: DataFrame) -> DataFrame:
    """Canonical records of envelopes that could be read."""
    return normalized.filter(F.col("fault").isNull()).select(*CANONICAL_MEMBERS)


def rejected(normalized: DataFrame, mask_card_numbers: bool = False) -> DataFrame:
    """Technical dead letters for envelopes that could not be read; the stage does not stop."""
    original = mask_in_text(F.col("value")) if mask_card_numbers else F.col("value")
    return normalized.filter(F.col("fault").isNotNull()).select(
        F.lit(STAGE).alias("stage"),
        F.lit(PARSE_FAILED).alias("errorCode"),
        F.col("fault").alias("errorMessage"),
        original.alias("originalMessage"),
        F.col("_processing.normalizedAt").alias("timestamp"),
    )


def flatten(canonical: DataFrame) -> DataFrame:
    """Canonical records as scalar columns."""
    return canonical.select(*(F.col(path).alias(name) for name, path in FLAT_COLUMNS.items()))


def canonical_text(canonical: DataFrame) -> Column:
    """Wire text: nulls are written, except among the stage stamps."""
    members = [c for c in CANONICAL_MEMBERS if c != "_processing"]
    return splice(
        F.to_json(F.struct(*members), KEEP_NULLS), F.to_json(F.struct("_processing"))
    )
