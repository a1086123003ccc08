"""Check queries: the same results in plain SQL over the given tables.

They share the row derivation and the code tables with the library and nothing else.
"""

from __future__ import annotations

from cardrail.functions.codes import CURRENCIES, MERCHANT_CATEGORIES, MESSAGE_TYPES
from cardrail.plans import catalog
from cardrail.plans.payments import operations_sql
from cardrail.schemas import (
    CANONICAL_SCHEMA,
    RECORD_COLUMNS,
    SOURCE_CDC,
    SOURCE_CSV,
    TOPIC_CDC,
    TOPIC_DECRYPTED,
    TOPIC_DLQ,
    TOPIC_NORMALIZED,
    TOPIC_SEALED,
    TOPIC_VALIDATED,
)


def _quote(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


_TABLES = ",\n".join(
    (
        _values("mti_t", "mti, name", MESSAGE_TYPES.items()),
        _values("cur_t", "code, alpha, name, minor_units", CURRENCIES),
        _values("mcc_t", "mcc, description", MERCHANT_CATEGORIES.items()),
    )
)

# The date formats that are read, in the order they are tried.
_FORMATS = "['%d/%m/%Y %H:%M:%S', '%d/%m/%Y', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ']"


def _iso(value: str) -> str:
    return f"strftime(try_strptime(trim({value}), {_FORMATS}), '%Y-%m-%dT%H:%M:%SZ')"


def _text(column: str) -> str:
    return f"trim(coalesce({column}, 'None'))"


def _luhn(pan: str) -> str:
    digits = f"regexp_replace({pan}, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({digits}, i, 1) AS INTEGER)"
    return (
        f"(length({digits}) BETWEEN 13 AND 19 AND "
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: "
        f"CASE WHEN (length({digits}) - i) % 2 = 0 THEN {digit} "
        f"WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END)) % 10 = 0)"
    )


_PAN = _text("CARD_NUMBER")
_MTI = _text("MESSAGE_TYPE")
_CUR = _text("TRANSACTION_CURRENCY")
_EVENT = "printf('evt-%08d', row_idx)"

_F1 = f"f1 AS ({operations_sql()})"

# Each row with its stripped fields and its verdict on every rule.
_VERDICTS = f"""{_TABLES},
t AS (SELECT *, {_EVENT} AS event_id, {_MTI} AS mti, {_CUR} AS cur, {_PAN} AS pan FROM f1),
v AS (SELECT *,
  coalesce(MESSAGE_TYPE, '') = '' AS no_mti, coalesce(CARD_NUMBER, '') = '' AS no_pan,
  coalesce(TRANSACTION_AMOUNT, '') = '' AS no_amount, coalesce(TRANSACTION_CURRENCY, '') = '' AS no_cur,
  (mti <> '' AND mti NOT IN (SELECT mti FROM mti_t)) AS bad_mti,
  (cur <> '' AND cur NOT IN (SELECT code FROM cur_t)) AS bad_cur,
  (pan <> '' AND NOT {_luhn("pan")}) AS bad_pan
  FROM t),
w AS (SELECT *, (CAST(no_mti AS INT) + CAST(no_pan AS INT) + CAST(no_amount AS INT) + CAST(no_cur AS INT)
  + CAST(bad_mti AS INT) + CAST(bad_cur AS INT) + CAST(bad_pan AS INT)) AS errors FROM v)"""
_CHECKED = f"{_F1}, {_VERDICTS}"

_MASK = (
    "CASE WHEN length({p}) < 10 THEN repeat('*', length({p})) "
    "ELSE substr({p}, 1, 6) || repeat('*', length({p}) - 10) || right({p}, 4) END"
)
_SCHEME = (
    "CASE WHEN NOT regexp_matches({p}, '^[0-9]') THEN NULL WHEN substr({p}, 1, 1) = '4' THEN 'VISA' "
    "WHEN substr({p}, 1, 2) BETWEEN '51' AND '55' "
    "OR TRY_CAST(substr({p}, 1, 4) AS INTEGER) BETWEEN 2221 AND 2720 THEN 'MASTERCARD' "
    "WHEN substr({p}, 1, 2) IN ('34', '37') THEN 'AMEX' WHEN substr({p}, 1, 2) = '62' THEN 'UNIONPAY' "
    "WHEN substr({p}, 1, 4) = '6011' OR substr({p}, 1, 2) = '65' THEN 'DISCOVER' ELSE 'UNKNOWN' END"
)
_BIN = "CASE WHEN length({p}) >= 6 THEN substr({p}, 1, 6) END"
_BUSINESS = _iso(
    "coalesce(nullif(BUSINESS_DATE, ''), nullif(TRANSACTION_LOCAL_DATE, ''), TRANSMISSION_DATE_AND_TIME)"
)
_BILLING_CUR = f"coalesce(nullif({_text('BILLING_CURRENCY')}, ''), {_CUR})"
_SETTLEMENT_CUR = f"coalesce(nullif({_text('ISS_SETTLEMENT_CURRENCY')}, ''), {_CUR})"


def _amount(prefix: str, field: str, code: str, alias: str) -> str:
    number = f"TRY_CAST({field} AS DOUBLE)"
    return (
        f"{number} AS {prefix}_value, CASE WHEN {number} IS NOT NULL THEN {code} END AS {prefix}_currency_code, "
        f"CASE WHEN {number} IS NOT NULL THEN {alias}.alpha END AS {prefix}_currency_alpha, "
        f"CASE WHEN {number} IS NOT NULL THEN coalesce({alias}.minor_units, 2) END AS {prefix}_minor_units"
    )


def _canonical(event_id: str = "event_id", where: str = "") -> str:
    mcc = _text("CARD_ACCEPTOR_ACTIVITY")
    return f"""WITH {_F1}, {_VERDICTS}
SELECT {event_id} AS msg_id, '{CANONICAL_SCHEMA}' AS schema,
  {_iso("TRANSMISSION_DATE_AND_TIME")} AS cre_dt_tm, substr({_BUSINESS}, 1, 10) AS business_date,
  w.mti AS mti, mti_t.name AS mti_name, PROCESSING_CODE AS processing_code, ACTION_CODE AS action_code,
  ORIGINAL_ACTION_CODE AS response_code,
  {_amount("amount", "TRANSACTION_AMOUNT", "w.cur", "c1")},
  {_amount("billing_amount", "BILLING_AMOUNT", _BILLING_CUR, "c2")},
  {_amount("settlement_amount", "ISS_SETTLEMENT_AMOUNT", _SETTLEMENT_CUR, "c3")},
  {_amount("cash_back_amount", "CASH_BACK_AMOUNT", "w.cur", "c1")},
  {_iso("TRANSACTION_LOCAL_DATE")} AS transaction_local_date, {_iso("CAPTURE_DATE")} AS capture_date,
  {_MASK.format(p="pan")} AS pan_masked, {_BIN.format(p="pan")} AS pan_bin,
  {_SCHEME.format(p="pan")} AS card_scheme, {_iso("END_EXPIRY_DATE")} AS expiry_date,
  CARD_SEQUENCE_NUMBER AS sequence_number, CARD_ACCEPTOR_ID AS merchant_id,
  nullif(trim(CARD_ACC_NAME_ADDRESS), '') AS merchant_name, nullif({mcc}, '') AS mcc,
  mcc_t.description AS mcc_description, CARD_ACCEPTOR_TERM_ID AS terminal_id,
  ACQUIRER_INSTITUTION_CODE AS acquirer_institution_code, ACQUIRER_BANK AS acquirer_bank,
  ACQUIRING_COUNTRY_CODE AS acquirer_country_code, ISSUING_BANK AS issuer_bank,
  NETWORK_CODE AS issuer_network_code, INTERNAL_STAN AS stan, REFERENCE_NUMBER AS rrn,
  AUTHORIZATION_CODE AS auth_code, AUTHORIZATION_SOURCE AS auth_source,
  ORIGINAL_AUTHORIZATION_CODE AS original_auth_code
FROM w LEFT JOIN mti_t ON w.mti = mti_t.mti LEFT JOIN mcc_t ON {mcc} = mcc_t.mcc
  LEFT JOIN cur_t c1 ON w.cur = c1.code LEFT JOIN cur_t c2 ON {_BILLING_CUR} = c2.code
  LEFT JOIN cur_t c3 ON {_SETTLEMENT_CUR} = c3.code
WHERE errors = 0 {where}"""


def _f1(select: str, tail: str = "") -> str:
    return f"WITH {_F1}, {_TABLES} SELECT {select} FROM f1 {tail}"


def _checked(select: str, tail: str = "") -> str:
    return f"WITH {_CHECKED} SELECT {select} FROM w {tail}"


def _lower(*columns: str) -> str:
    return ", ".join(f"{c} AS {c.lower()}" for c in columns)


_OP = "CASE row_idx % 10 WHEN 0 THEN 'c' WHEN 1 THEN 'c' WHEN 2 THEN 'u' WHEN 3 THEN 'r' WHEN 4 THEN 'd' WHEN 5 THEN 'c' WHEN 6 THEN 't' END"
_ADAPTED = "row_idx % 10 < 4"

# Errors in report order, with their place among the row's own errors.
_ERRORS = f"""WITH {_CHECKED}, listed AS (
  SELECT event_id, 1 AS place, 'MANDATORY_FIELD_MISSING' AS code, 'MESSAGE_TYPE' AS field, NULL AS value, NULL AS value_bin FROM w WHERE no_mti
  UNION ALL SELECT event_id, 2, 'MANDATORY_FIELD_MISSING', 'CARD_NUMBER', NULL, NULL FROM w WHERE no_pan
  UNION ALL SELECT event_id, 3, 'MANDATORY_FIELD_MISSING', 'TRANSACTION_AMOUNT', NULL, NULL FROM w WHERE no_amount
  UNION ALL SELECT event_id, 4, 'MANDATORY_FIELD_MISSING', 'TRANSACTION_CURRENCY', NULL, NULL FROM w WHERE no_cur
  UNION ALL SELECT event_id, 5, 'ISO8583_UNKNOWN_MTI', 'MESSAGE_TYPE', mti, NULL FROM w WHERE bad_mti
  UNION ALL SELECT event_id, 6, 'ISO4217_INVALID_CURRENCY', 'TRANSACTION_CURRENCY', cur, NULL FROM w WHERE bad_cur
  UNION ALL SELECT event_id, 7, 'ISO7812_LUHN_FAILED', 'CARD_NUMBER', NULL, substr(pan, 1, 6) FROM w WHERE bad_pan),
errs AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY place) - 1 AS INTEGER) AS position FROM listed)"""

_DAMAGE = (
    (1, "ValueError: envelope missing encrypted_payload"),
    (2, "ValueError: envelope missing encrypted_payload"),
    (3, "Error: not valid base64"),
    (4, "InvalidToken: "),
    (5, "InvalidToken: "),
    (6, "InvalidToken: "),
    (7, "JSONDecodeError: not a single JSON value"),
    (8, "AttributeError: 'list' object has no attribute 'get'"),
    (9, "JSONDecodeError: payload is not a single JSON value"),
    (10, "JSONDecodeError: payload is not a single JSON value"),
    (11, "JSONDecodeError: not a single JSON value"),
)


def _counts(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT {_quote(name)} AS stage, count(*) AS messages FROM w WHERE {condition}"
        for name, condition in pairs
    )


def statements() -> dict[str, str]:
    damage = " ".join(f"WHEN {i} THEN {_quote(m)}" for i, m in _DAMAGE)
    members = _lower(*RECORD_COLUMNS)
    nullified = ", ".join(f"nullif({c}, '') AS {c.lower()}" for c in RECORD_COLUMNS)
    lines = (
        "CASE row_idx % 4 WHEN 0 THEN 'line one' || chr(10) || '\"' || CAST(row_idx AS STRING) || '\", line two' || chr(10) "
        "WHEN 1 THEN chr(10) || CAST(row_idx AS STRING) WHEN 2 THEN '\"' || chr(10) || '\"' ELSE CARD_ACC_NAME_ADDRESS END"
    )
    broken = ", ".join(
        f"nullif({lines if c == 'CARD_ACC_NAME_ADDRESS' else c}, '') AS {c.lower()}" for c in RECORD_COLUMNS
    )
    opened = (
        f"{_EVENT} AS event_id, '1.0' AS schema_version, '{SOURCE_CSV}' AS source, "
        f"CAST({catalog.PRODUCED_MS} AS BIGINT) AS produced_at"
    )
    valid, everything = "errors = 0", "true"
    stream = [(TOPIC_SEALED, everything), (TOPIC_DECRYPTED, everything)]
    stream += [(n, valid) for n in (TOPIC_VALIDATED, TOPIC_NORMALIZED)] + [(TOPIC_DLQ, "errors > 0")]
    for name in ("decrypted", "validated", "normalized", "canonical"):
        rows = everything if name == "decrypted" else valid
        stream += [(name, rows), (f"{name}-parquet", rows)]
    stream.append(("canonical-partitioned", valid))
    both = (
        (TOPIC_DECRYPTED, everything),
        (TOPIC_VALIDATED, valid),
        (TOPIC_NORMALIZED, valid),
        (TOPIC_DLQ, "errors > 0"),
    )
    status = f"SELECT '{TOPIC_CDC}' AS stage, count(*) AS messages FROM w" + "".join(
        f" UNION ALL SELECT '{name}', count(*) FILTER ({rows}) + count(*) FILTER ({_ADAPTED} AND {rows}) FROM w"
        for name, rows in both
    )
    cdc_id = "'chg-' || CAST(row_idx AS STRING)"
    odd = f"""'{{"eventId":"' || {_EVENT} || '","payload":' || """
    flat = _canonical()
    payload = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in RECORD_COLUMNS) + "))"
    published = (
        "count(*) AS messages, count(*) AS numbers, CAST(0 AS BIGINT) AS first_number, count(*) - 1 AS last_number, "
        "count(*) AS keyed, count(*) AS from_csv"
    )
    missing = ", ".join(
        f"(coalesce({c}, '') = '') AS {c.lower()}_missing"
        for c in ("MESSAGE_TYPE", "CARD_NUMBER", "TRANSACTION_AMOUNT", "TRANSACTION_CURRENCY")
    )
    return {
        "topic_scan": _f1(
            f"{_EVENT} AS event_id, '{SOURCE_CSV}' AS source, CAST({catalog.PRODUCED_MS} AS BIGINT) AS produced_at, {members}"
        ),
        "csv_scan": _f1(f"CAST(row_idx AS STRING) AS row_idx, {nullified}"),
        "csv_line_breaks": _f1(f"CAST(row_idx AS STRING) AS row_idx, {broken}"),
        "bulk_load": _f1(f"true AS has_id, true AS has_ingested_at, {members}"),
        "cdc_scan": _f1(f"row_idx, 'r' AS op, {members}"),
        "cdc_snapshot_then_changes": f"""WITH {_F1} SELECT row_idx AS id, MESSAGE_TYPE AS message_type,
  CASE WHEN row_idx % 5 = 1 THEN '1.00' ELSE TRANSACTION_AMOUNT END AS transaction_amount FROM f1 WHERE row_idx % 5 NOT IN (2, 3)
UNION ALL SELECT -row_idx - 1, MESSAGE_TYPE, TRANSACTION_AMOUNT FROM f1 WHERE row_idx % 5 = 4""",
        "limit_rows": _f1(
            "row_idx, " + _lower("MESSAGE_TYPE", "TRANSACTION_AMOUNT"),
            f"ORDER BY row_idx LIMIT {catalog.REPORT_LIMIT}",
        ),
        "publish_rows": _f1(f"{_EVENT} AS message_key, {opened}, {members}"),
        "publish_csv": f"""WITH {_F1} SELECT 'all' AS run, {published}, count(nullif(MESSAGE_TYPE, '')) AS with_message_type,
  CAST(sum(CAST(REFERENCE_NUMBER AS BIGINT)) AS BIGINT) AS reference_sum FROM f1
UNION ALL SELECT 'limited', {published}, NULL, NULL FROM (SELECT * FROM f1 LIMIT {catalog.REPORT_LIMIT})""",
        "jsonl_roundtrip": flat,
        "parquet_roundtrip": flat,
        "canonical_json": flat,
        "canonical_flat": flat,
        "pipeline_canonical": flat,
        "pipeline_stream": flat,
        "canonical_partitioned": f"SELECT business_date, mti, count(*) AS records, count(amount_value) AS with_amount FROM ({flat}) GROUP BY business_date, mti",
        "store_compaction": " UNION ALL ".join(
            f"SELECT '{moment}' AS moment, count(*) AS records, count(DISTINCT msg_id) AS ids, count(amount_value) AS with_amount, "
            f"min(business_date) AS first_date, max(business_date) AS last_date, count(*) AS listed, {fewer} AS fewer_files FROM ({flat})"
            for moment, fewer in (("before", "false"), ("after", "true"))
        ),
        "store_lookups": f"""WITH r AS ({flat})
SELECT 'dates' AS look_up, true AS opened_fewer, msg_id AS event_id, business_date, mti, amount_value FROM r
WHERE business_date BETWEEN '{catalog.LOOKED_UP["dates"][0]}' AND '{catalog.LOOKED_UP["dates"][1]}'
UNION ALL SELECT 'types', NULL, msg_id, business_date, mti, amount_value FROM r WHERE mti IN {catalog.LOOKED_UP["types"]}
UNION ALL SELECT 'ids', true, msg_id, business_date, mti, amount_value FROM r
WHERE msg_id IN ((SELECT min(msg_id) FROM r), (SELECT max(msg_id) FROM r))""",
        "stream_fanout": f"WITH {_CHECKED} {_counts(stream)}",
        "stage_counts": f"WITH {_CHECKED} {status}",
        "progress_counts": f"""WITH {_CHECKED}, c AS (SELECT count(*) AS everything, count(*) FILTER (errors = 0) AS good,
  count(*) FILTER (row_idx % 12 = 0) AS opened, count(*) FILTER (row_idx % 12 = 0 AND errors = 0) AS opened_good,
  count(*) FILTER ({_ADAPTED}) AS changed, count(*) FILTER ({_ADAPTED} AND errors = 0) AS changed_good FROM w)
SELECT 'cdc-adapter' AS job, changed AS accepted, CAST(0 AS BIGINT) AS rejected FROM c
UNION ALL SELECT 'decryption', everything + opened, everything - opened FROM c
UNION ALL SELECT 'validation', good + opened_good + changed_good, everything + opened + changed - good - opened_good - changed_good FROM c
UNION ALL SELECT 'normalization', good + opened_good + changed_good, 0 FROM c
UNION ALL SELECT 'store', good + opened_good + changed_good, 0 FROM c""",
        "storage_usage": f"""WITH {_F1} SELECT 'payloads' AS dataset, CAST(sum(strlen({payload}) + 1) AS BIGINT) AS bytes,
  true AS has_files, count(*) AS rows FROM f1 UNION ALL SELECT 'payloads-parquet', NULL, true, count(*) FROM f1""",
        "envelope_build": _f1(f"{opened}, {members}"),
        "encrypt_decrypt_roundtrip": _f1(f"{_EVENT} AS event_id, {members}"),
        "decrypt_ok": _f1(
            f"{opened}, CAST({catalog.DECRYPTED_MS} AS BIGINT) AS decrypted_at, {members}"
        ),
        "dlq_decrypt": f"""WITH {_F1}, bad AS (SELECT CASE row_idx % 12 {damage} END AS error_message FROM f1 WHERE row_idx % 12 > 0)
SELECT 'decryption' AS stage, 'DECRYPT_FAILED' AS error_code, error_message,
  CAST({catalog.DECRYPTED_MS} AS BIGINT) AS rejected_at, count(*) AS messages FROM bad GROUP BY error_message""",
        "wrong_key": _f1(f"{_EVENT} AS event_id, 'InvalidToken: ' AS error_message"),
        "split_valid": _checked(
            f"event_id, true AS valid, CAST({catalog.VALIDATED_MS} AS BIGINT) AS validated_at, {members}", f"WHERE {valid}"
        ),
        "split_dlq": _checked(
            f"event_id, 'validation' AS stage, false AS valid, CAST(errors AS INTEGER) AS errors, CAST({catalog.VALIDATED_MS} AS BIGINT) AS validated_at, {members}",
            "WHERE errors > 0",
        ),
        "stage_latency": _checked(
            f"event_id, CAST({catalog.VALIDATED_MS - catalog.DECRYPTED_MS} AS BIGINT) AS validation_ms, "
            f"CAST({catalog.NORMALIZED_MS - catalog.VALIDATED_MS} AS BIGINT) AS normalization_ms, "
            f"CAST({catalog.NORMALIZED_MS - catalog.DECRYPTED_MS} AS BIGINT) AS total_ms",
            f"WHERE {valid}",
        ),
        "cdc_unwrap": _f1(
            f"row_idx, {_OP} AS op, row_idx % 10 NOT IN (4, 7, 8, 9) AS has_after, "
            f"CAST(CASE WHEN row_idx % 10 IN (4, 5, 7, 8, 9) THEN 0 ELSE {len(RECORD_COLUMNS) + 2} END AS INTEGER) AS after_columns"
        ),
        "cdc_op_filter": _f1(f"row_idx, {_OP} AS op", f"WHERE {_ADAPTED}"),
        "cdc_project": _f1(
            f"row_idx, CAST({len(RECORD_COLUMNS)} AS INTEGER) AS members, false AS has_id, {members}",
            f"WHERE {_ADAPTED}",
        ),
        "cdc_envelope": _f1(
            f"{cdc_id} AS event_id, '{SOURCE_CDC}' AS source, "
            f"strftime(epoch_ms({catalog.PRODUCED_MS}), '%Y-%m-%dT%H:%M:%SZ') AS event_time, {_OP} AS cdc_op, "
            f"CAST({catalog.PRODUCED_MS} AS BIGINT) AS cdc_ingested_at, {members}",
            f"WHERE {_ADAPTED}",
        ),
        "mandatory_check": _f1(f"row_idx, {missing}"),
        "mti_check": _checked("row_idx, mti, NOT bad_mti AS mti_ok"),
        "currency_check": _checked("row_idx, cur AS currency, NOT bad_cur AS currency_ok"),
        "luhn_check": _checked("row_idx, NOT bad_pan AS luhn_ok"),
        "validation_errors": f"{_ERRORS} SELECT event_id, position, code, field, value, value_bin FROM errs",
        "pipeline_dlq": f"""{_ERRORS}
SELECT event_id, 'validation' AS stage, position, code, field, value, value_bin FROM errs
UNION ALL SELECT event_id, 'validation', position, code, field, value, value_bin FROM errs
WHERE CAST(substr(event_id, 5) AS BIGINT) % 12 = 0  -- the one damaged message in twelve that can be opened
UNION ALL SELECT NULL, 'decryption', 0, 'DECRYPT_FAILED', NULL, NULL, NULL FROM f1 WHERE row_idx % 12 > 0""",
        "dlq_parse": f"""WITH {_F1} SELECT 'validation' AS stage, 'PARSE_FAILED' AS error_code,
  CASE row_idx % 14 WHEN 3 THEN 'AttributeError: ''str'' object has no attribute ''get'''
   WHEN 4 THEN 'AttributeError: ''list'' object has no attribute ''get'''
   WHEN 6 THEN 'AttributeError: ''int'' object has no attribute ''get'''
   WHEN 7 THEN 'JSONDecodeError: not a single JSON value' WHEN 10 THEN 'JSONDecodeError: not a single JSON value'
   WHEN 11 THEN 'JSONDecodeError: not a single JSON value' WHEN 12 THEN 'JSONDecodeError: not a single JSON value'
   WHEN 13 THEN 'JSONDecodeError: not a single JSON value'
   WHEN 8 THEN 'AttributeError: ''list'' object has no attribute ''get'''
   ELSE 'TypeError: ''NoneType'' object does not support item assignment' END AS error_message,
  CASE row_idx % 14 WHEN 3 THEN {odd} '"text"}}' WHEN 4 THEN {odd} '[1]}}' WHEN 6 THEN {odd} '7}}'
   WHEN 7 THEN 'not json' WHEN 8 THEN '[]' WHEN 10 THEN {odd} '{{}}}}]' WHEN 11 THEN {odd} '{{}}}}] junk'
   WHEN 12 THEN {odd} '{{}}}}],[{{}}' WHEN 13 THEN {odd} '{{}}}}}},{{}}' ELSE {odd} '{{}},"_processing":null}}' END AS original_message,
  CAST({catalog.VALIDATED_MS} AS BIGINT) AS rejected_at
FROM f1 WHERE row_idx % 14 IN (3, 4, 6, 7, 8, 9, 10, 11, 12, 13)""",
        "dlq_masked": f"""WITH {_F1}, p AS (SELECT row_idx, coalesce(CARD_NUMBER, 'None') AS pan FROM f1),
m AS (SELECT row_idx, CASE WHEN {_luhn("pan")} THEN {_MASK.format(p="pan")} ELSE pan END AS pan FROM p)
SELECT stage, 'PARSE_FAILED' AS error_code, CASE WHEN row_idx % 3 = 0
  THEN '{{"note":"call 12, card ' || pan || ' of ' || CAST(row_idx AS STRING) || ' times"'
  ELSE '{{"payload":{{"CARD_NUMBER":"' || pan || '"' END AS original_message
FROM m, (VALUES ('validation'), ('normalization')) s(stage)""",
        "iso8601_dates": _f1(
            "row_idx, " + ", ".join(f"{_iso(c)} AS {c.lower()}" for c in catalog.DATE_COLUMNS)
        ),
        "business_date": _f1(f"row_idx, substr({_BUSINESS}, 1, 10) AS business_date"),
        "amounts": _f1(
            "row_idx, "
            + ", ".join(
                f"TRY_CAST({c} AS DOUBLE) AS {c.lower()}"
                for c in ("TRANSACTION_AMOUNT", "BILLING_AMOUNT", "ISS_SETTLEMENT_AMOUNT", "CASH_BACK_AMOUNT")
            )
        ),
        "amounts_fallback": _f1(
            f"row_idx, {_CUR} AS transaction_amount_currency, {_BILLING_CUR} AS billing_amount_currency, "
            f"{_SETTLEMENT_CUR} AS iss_settlement_amount_currency, {_CUR} AS cash_back_amount_currency"
        ),
        "currency_enrich": _f1(
            f"row_idx, {_CUR} AS currency, alpha AS currency_alpha, coalesce(minor_units, 2) AS minor_units",
            f"LEFT JOIN cur_t ON {_CUR} = code",
        ),
        "mti_enrich": _f1(f"row_idx, {_MTI} AS mti, name AS mti_name", f"LEFT JOIN mti_t ON {_MTI} = mti_t.mti"),
        "mcc_enrich": _f1(
            f"row_idx, nullif({_text('CARD_ACCEPTOR_ACTIVITY')}, '') AS mcc, description AS mcc_description",
            f"LEFT JOIN mcc_t ON {_text('CARD_ACCEPTOR_ACTIVITY')} = mcc_t.mcc",
        ),
        "pan_mask": _f1(f"row_idx, {_MASK.format(p=_PAN)} AS pan_masked"),
        "pan_bin": _f1(f"row_idx, {_BIN.format(p=_PAN)} AS pan_bin"),
        "card_scheme": _f1(f"row_idx, {_SCHEME.format(p=_PAN)} AS card_scheme"),
        "strip_text": _f1(
            "row_idx, trim(MESSAGE_TYPE) AS message_type, nullif(trim(CARD_ACC_NAME_ADDRESS), '') AS merchant_name"
        ),
        "unknown_mti_anti": _f1(f"row_idx, {_MTI} AS mti", f"WHERE {_MTI} NOT IN (SELECT mti FROM mti_t)"),
        "known_currency_semi": _f1(f"row_idx, {_CUR} AS currency", f"WHERE {_CUR} IN (SELECT code FROM cur_t)"),
        "union_sources": f"""WITH {_F1} SELECT {_EVENT} AS event_id, '{SOURCE_CSV}' AS source,
  CAST({catalog.PRODUCED_MS} AS BIGINT) AS produced_at, CAST(NULL AS STRING) AS event_time,
  {members} FROM f1
UNION ALL SELECT {cdc_id}, '{SOURCE_CDC}', NULL, strftime(epoch_ms({catalog.PRODUCED_MS}), '%Y-%m-%dT%H:%M:%SZ'),
  {", ".join(RECORD_COLUMNS)} FROM f1 WHERE {_ADAPTED}""",
        "union_dlq": f"""WITH {_CHECKED} SELECT 'decryption' AS stage, 'DECRYPT_FAILED' AS error_code,
  CAST(NULL AS STRING) AS event_id, CAST(NULL AS INTEGER) AS errors, CAST({catalog.DECRYPTED_MS} AS BIGINT) AS rejected_at
FROM w WHERE row_idx % 12 > 0
UNION ALL SELECT 'validation', NULL, event_id, CAST(errors AS INTEGER), NULL FROM w WHERE errors > 0""",
        "load_count": "SELECT count(*) AS row_count FROM orders",
        "pipeline_cdc": _canonical(cdc_id, f"AND {_ADAPTED}"),
    }
