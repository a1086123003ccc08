import json

import pytest
from pyspark.sql import functions as F

from cardrail.operators import cdc, dead_letters, decryption, envelope, normalization, validation
from cardrail.schemas import CANONICAL_DDL

GOOD = {
    "MESSAGE_TYPE": "1100",
    "CARD_NUMBER": "5321962100025057",
    "TRANSACTION_AMOUNT": "100",
    "TRANSACTION_CURRENCY": "504",
}


def errors_of(spark, payload, none_as_text=True):
    rows = spark.createDataFrame([("e", payload)], "eventId string, payload map<string,string>")
    row = validation.validate(rows, 1, none_as_text).first()
    assert row.valid == (not row.errors)
    return row.errors


def missing(field):
    return {"code": "MANDATORY_FIELD_MISSING", "field": field}


def test_sample_record_is_valid(spark):
    assert errors_of(spark, GOOD) == []


def test_null_absent_and_empty_fields(spark):
    unknown = {"code": "ISO8583_UNKNOWN_MTI", "field": "MESSAGE_TYPE", "value": "None"}
    assert errors_of(spark, {**GOOD, "MESSAGE_TYPE": None}) == [missing("MESSAGE_TYPE"), unknown]
    assert errors_of(spark, {**GOOD, "MESSAGE_TYPE": None}, False) == [missing("MESSAGE_TYPE")]
    assert errors_of(spark, {**GOOD, "MESSAGE_TYPE": ""}) == [missing("MESSAGE_TYPE")]
    absent = {k: v for k, v in GOOD.items() if k != "CARD_NUMBER"}
    assert errors_of(spark, absent) == [missing("CARD_NUMBER")]
    assert errors_of(spark, {**GOOD, "CARD_NUMBER": None}) == [
        missing("CARD_NUMBER"),
        {"code": "ISO7812_LUHN_FAILED", "field": "CARD_NUMBER", "valueBin": "None"},
    ]


def test_blank_mandatory_fields_pass(spark):
    assert errors_of(spark, {k: "  " for k in GOOD}) == []


def test_errors_come_in_rule_order(spark):
    found = errors_of(
        spark, {"MESSAGE_TYPE": " 9999 ", "CARD_NUMBER": "4111111111111112", "TRANSACTION_CURRENCY": "7"}
    )
    assert found == [
        missing("TRANSACTION_AMOUNT"),
        {"code": "ISO8583_UNKNOWN_MTI", "field": "MESSAGE_TYPE", "value": "9999"},
        {"code": "ISO4217_INVALID_CURRENCY", "field": "TRANSACTION_CURRENCY", "value": "7"},
        {"code": "ISO7812_LUHN_FAILED", "field": "CARD_NUMBER", "valueBin": "411111"},
    ]


def no_get(word):
    return f"AttributeError: '{word}' object has no attribute 'get'"


def test_payload_kinds(spark):
    whole = json.dumps(GOOD)
    falsy = ["null", "{}", '""', "0", "0.0", "-0.0", "false", "[]", "[ ]"]
    odd = {'"x"': "str", '"{}"': "str", "[1]": "list", "7": "int", "1.5": "float", "true": "bool"}
    texts = {f'{{"payload":{p}}}': (None, 4) for p in falsy}
    texts |= {'{"eventId":"e"}': (None, 4), f'{{"payload":{whole}}}': (None, 0)}
    texts |= {f'{{"payload":{p}}}': (no_get(w), None) for p, w in odd.items()}
    texts |= {f'{{"payload":{whole}}} x': (envelope.BAD_JSON, None), "": (envelope.BAD_JSON, None)}
    texts |= {f'{{"payload":{whole},"payload":{{}}}}': (None, 4)}
    texts |= {'{"payload":{"MESSAGE_TYPE":"1","MESSAGE_TYPE":"1100"}}': (None, 3)}
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = validation.validate(envelope.read_open(rows))
    got = {r.value: (r.fault, None if r.errors is None else len(r.errors)) for r in checked.collect()}
    assert got == texts


def test_payload_text_kinds(spark):
    twice = '{"MESSAGE_TYPE":"1","MESSAGE_TYPE":"1100"}'
    cases = {json.dumps(GOOD): (None, 0), twice: (None, 3), "[]": (None, 4), "null": (None, 4), "[1]": (no_get("list"), None)}
    rows = spark.createDataFrame([("e", t) for t in cases], "eventId string, payload string")
    checked = validation.validate(rows)
    got = [(r.fault, None if r.errors is None else len(r.errors)) for r in checked.collect()]
    assert got == list(cases.values())


def test_rejects_split_and_mask(spark):
    bad = {**GOOD, "CARD_NUMBER": "4539578763621487"}
    rows = spark.createDataFrame([("a", GOOD), ("b", bad)], "eventId string, payload map<string,string>")
    checked = validation.validate(rows, 5)
    assert [r.eventId for r in validation.accepted(checked).collect()] == ["a"]
    rejects = validation.rejected(checked)
    out = json.loads(rejects.select(dead_letters.text(rejects)).first()[0])
    assert out["eventId"] == "b" and out["stage"] == "validation" and out["payload"] == bad
    assert out["validation"] == {
        "valid": False,
        "errors": [{"code": "ISO7812_LUHN_FAILED", "field": "CARD_NUMBER", "valueBin": "453957"}],
    }
    assert out["_processing"] == {"validatedAt": 5} and "errorCode" not in out
    masked = validation.rejected(checked, mask_card_numbers=True)
    assert "4539578763621487" not in masked.select(dead_letters.text(masked)).first()[0]


def canonical_of(spark, payload, **envelope_members):
    fields = ", ".join(f"{k} string" for k in envelope_members)
    rows = spark.createDataFrame(
        [(*envelope_members.values(), payload)], f"{fields}, payload map<string,string>"
    )
    record = normalization.normalize(rows, 9)
    return json.loads(record.select(normalization.canonical_text(record)).first()[0])


def test_canonical_record(spark):
    payload = {
        **GOOD,
        "TRANSACTION_AMOUNT": "150.50",
        "BILLING_AMOUNT": "abc",
        "ISS_SETTLEMENT_AMOUNT": "1_0",
        "ISS_SETTLEMENT_CURRENCY": None,
        "CASH_BACK_AMOUNT": "20",
        "BUSINESS_DATE": "",
        "TRANSACTION_LOCAL_DATE": "bad",
        "TRANSMISSION_DATE_AND_TIME": "16/09/2025 09:49:28",
        "CARD_ACC_NAME_ADDRESS": "  Café ",
        "CARD_ACCEPTOR_ACTIVITY": "5411",
        "ORIGINAL_ACTION_CODE": "00",
    }
    out = canonical_of(spark, payload, eventId="evt-1", source="dropped")
    assert out["msgId"] == "evt-1" and "source" not in out
    assert out["creDtTm"] == "2025-09-16T09:49:28Z"
    # the first date that holds anything decides, even if it does not parse
    assert out["businessDate"] is None
    assert out["iso8583"] == {
        "mti": "1100",
        "mtiName": "Authorization Request",
        "processingCode": None,
        "actionCode": None,
        "responseCode": "00",
    }
    assert out["transaction"]["amount"] == {
        "value": 150.5,
        "currencyCode": "504",
        "currencyAlpha": "MAD",
        "minorUnits": 2,
    }
    assert out["transaction"]["billingAmount"] is None
    # a stored null currency is a word of its own and does not fall back
    assert out["transaction"]["settlementAmount"] == {
        "value": 10.0,
        "currencyCode": "None",
        "currencyAlpha": None,
        "minorUnits": 2,
    }
    assert out["transaction"]["cashBackAmount"]["currencyCode"] == "504"
    assert out["card"]["panMasked"] == "532196******5057" and out["card"]["scheme"] == "MASTERCARD"
    assert out["merchant"]["name"] == "Café"
    assert out["merchant"]["mccDescription"] == "Grocery Stores, Supermarkets"
    assert out["_processing"] == {"normalizedAt": 9}


def test_empty_envelope_still_normalizes(spark):
    out = canonical_of(spark, {}, eventId=None)
    assert out["iso8583"]["mti"] == "" and out["card"]["panMasked"] == "" and out["merchant"]["mcc"] is None


def test_canonical_schema_matches(spark):
    rows = spark.createDataFrame([("e", {})], "eventId string, payload map<string,string>")
    got = normalization.normalize(rows, 1).schema
    want = spark.range(1).select(F.lit(None).cast(CANONICAL_DDL).alias("r")).select("r.*").schema
    assert got.simpleString() == want.simpleString()


def change(op="c", after='{"id":1,"card_number":"4","amount":null,"ingested_at":"x"}', extra=""):
    return f'{{"before":null,"after":{after},"op":"{op}"{extra}}}'


def test_change_events(spark):
    kept = {"CARD_NUMBER": "4", "AMOUNT": None}
    cases = {
        change(): kept,
        change("u"): kept,
        change("r"): kept,
        f'{{"payload":{change()}}}': kept,
        change(extra=',"payload":null'): kept,
        change(extra=',"payload":{}'): kept,
        change(extra=',"payload":""'): kept,
        change(extra=',"payload":[]'): kept,
        change(extra=',"payload":0'): kept,
        change("c", '{"ID":"5","Id":null}'): {"ID": None},
        change("c", '{"a":"1","a":"2","b":null}'): {"A": "2", "B": None},
        change("c", '{"a":1.5,"b":7}'): {"A": "1.5", "B": "7"},
        change("d", "null"): None,
        change("d"): None,
        change("t"): None,
        change("c", "null"): None,
        change("c", "{}"): None,
        change("c", '"x"'): None,
        change(extra=',"payload":"x"'): None,
        change(extra=',"payload":[1]'): None,
        change(extra=',"payload":{"x":1}'): None,
        change() + " x": None,
        change()[:-1]: None,
        "": None,
        "null": None,
        "[]": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "value string")
    adapted = cdc.adapt(rows, 1_000, F.col("value"))
    got = {r.eventId: r.payload for r in adapted.collect()}
    assert got == {t: row for t, row in cases.items() if row is not None}


def test_change_envelope(spark):
    rows = spark.createDataFrame([(change("u"), "t", "0", 5)], "value string, topic string, partition string, offset long")
    first, again = (cdc.adapt(rows, 1_758_016_168_123).first() for _ in range(2))
    assert first.eventId == again.eventId and len(first.eventId) == 36
    assert first.source == "postgresql-cdc" and first.eventTime == "2025-09-16T09:49:28Z"
    assert first._processing.cdcOp == "u" and first._processing.cdcIngestedAt == 1_758_016_168_123
    adapted = cdc.adapt(rows, 1)
    wire = json.loads(adapted.select(envelope.open_text(adapted)).first()[0])
    assert wire["payload"] == {"CARD_NUMBER": "4", "AMOUNT": None} and "schemaVersion" not in wire


def test_event_ids_grow_past_eight_digits(spark):
    ids = spark.createDataFrame([(0,), (123456789,)], "i long").select(envelope.event_id(F.col("i")).alias("e"))
    assert [r.e for r in ids.collect()] == ["evt-00000000", "evt-123456789"]


PAYLOAD_TEXTS = [
    '{"MESSAGE_TYPE":"1100","CARD_NUMBER":"4539578763621486","TRANSACTION_AMOUNT":"1","TRANSACTION_CURRENCY":"840"}',
    '{"MESSAGE_TYPE":null,"CARD_NUMBER":null,"TRANSACTION_AMOUNT":1.50,"TRANSACTION_CURRENCY":840,"BILLING_CURRENCY":null}',
    '{"MESSAGE_TYPE":"9999","MESSAGE_TYPE":"1200","CARD_NUMBER":"1","OTHER":{"CARD_NUMBER":"2"},"TRANSACTION_AMOUNT":"x"}',
    ' {"CARD_NUMBER":{"a":[1,2]},"MESSAGE_TYPE":true,"TRANSACTION_CURRENCY":" 978 ","TRANSACTION_AMOUNT":""} ',
    '{"message_type":"1100"}',
    "{}", "null", "0", '""', "[]", "false", "[1]", '"text"', "7", "true", None,
]


def test_parsed_members_equal_the_map(spark):
    """Typed members and the open map give the same verdicts, rejects, records and wire texts."""
    texts = spark.createDataFrame([(f"e{i}", t) for i, t in enumerate(PAYLOAD_TEXTS)], "eventId string, payload string")
    typed, mapped = validation.validate(texts, 5), validation.validate(validation.open_payload(texts), 5)
    assert typed.schema["payload"].dataType.typeName() == "struct"

    def rows(df):
        return sorted(map(str, df.toJSON().collect()))

    for columns in (["eventId", "valid", "errors", "fault"],):
        assert rows(typed.select(*columns)) == rows(mapped.select(*columns))
    assert rows(validation.rejected(typed)) == rows(validation.rejected(mapped))
    for none_as_text in (True, False):
        a, b = (normalization.normalize(validation.accepted(df), 6, none_as_text) for df in (typed, mapped))
        assert rows(a) == rows(b)
    sent = validation.accepted(typed)
    assert '"OTHER":{"CARD_NUMBER":"2"}' in str(rows(typed.select(envelope.open_text(typed).alias("t")))).replace("\\", "")
    assert sent.count() == 1


def test_a_member_that_was_not_parsed_is_an_error(spark):
    from cardrail.functions.payload import Payload

    texts = spark.createDataFrame([("e", "{}")], "eventId string, payload string")
    with pytest.raises(KeyError):
        Payload.of(validation.parse_payload(texts)).raw("USER_CREATE")


def test_change_payload_is_built_once(spark):
    from cardrail.plans import catalog

    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    plan = catalog.pipeline_cdc(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert 1 <= plan.count("map_filter(") <= 2


STRAY_CLOSERS = ['{"a":1}]', '{"a":1}] x', '{"a":1}],[{"b":2}', '{"a":1}},{"b":2}', '{"a":1},"w":0},{"v":1', '1,"w":0}', "1,2", ""]


def test_one_value_and_no_more(apply):
    from cardrail.functions.records import is_one_json_value

    whole = ['{"a":1}', " [1, 2] ", '"x"', "7", "null", "true", "NaN", '{"v":1,"w":2}']
    assert apply(is_one_json_value, whole) == [True] * len(whole)
    assert apply(is_one_json_value, STRAY_CLOSERS) == [False] * len(STRAY_CLOSERS)


def test_masked_dead_letters_hold_no_card_number(spark, key):
    number = "4539578763621486"
    text = '{"eventId":"e","payload":{"CARD_NUMBER":"%s","MESSAGE_TYPE":"9"},"odd":%s,"odder":{"n":"x %s"}}' % ((number,) * 3)
    messages = spark.createDataFrame([(text,), (text[:-3],), (f'"{number}"',)], "value string")
    opened = envelope.read_open(messages)
    frames = [
        validation.rejected(validation.validate(opened, 1), mask_card_numbers=True),
        normalization.rejected(normalization.normalize(opened, 1), mask_card_numbers=True),
        decryption.rejected(decryption.decrypt(envelope.read_sealed(messages), key, 1), mask_card_numbers=True),
    ]
    texts = [r[0] for frame in frames for r in frame.select(dead_letters.text(frame)).collect()]
    assert len(texts) > 5 and not any(number in t for t in texts)
    assert all("453957******1486" in t for t in texts)
