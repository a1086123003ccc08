"""Reading records at size: one scan for a text's form, members by place, base64 without patterns."""

import pytest
from pyspark.sql import functions as F

from cardrail.functions import tokens
from cardrail.functions.payload import Payload, members_in_order
from cardrail.functions.records import is_one_json_value
from cardrail.operators import cdc
from cardrail.schemas import RECORD_COLUMNS


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("text", "whole"),
    [
        ('{"a":1}', True),
        ('{"a":"\\u005c"}', True),
        ('{"a":NaN}', True),
        ('[-Infinity]', True),
        ("{}]", False),
        ("{}},{}", False),
        ('0,"\\\\":0', False),
        ('0,"\\\\":0}', False),
        ('0,"\\u005c":0}', False),
        ("NaN]", False),
        ("NaN,1", False),
        ("", False),
    ],
)
def test_a_name_in_the_text_does_not_pass_for_the_last_member(spark, text, whole):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_one_json_value(F.col("t"))).first()[0] is whole


def test_a_change_is_judged_once(spark):
    plan = plan_of(cdc.unwrap(spark.createDataFrame([("{}",)], "value string")))
    assert plan.count("json_object_keys") + plan.count("jsonObjectKeys") == 1


@pytest.mark.parametrize("none_as_text", [True, False])
def test_members_by_place_and_by_search_are_the_same(spark, none_as_text):
    def held(names, value):
        return {name: value(name) for name in names}

    def some(name):
        return None if name in ("MESSAGE_TYPE", "CARD_NUMBER") else f" {name} "

    whole = held(RECORD_COLUMNS, some)
    turned = held(reversed(RECORD_COLUMNS), some)
    fewer = held(RECORD_COLUMNS[1:], some)
    rows = [(0, whole), (1, turned), (2, fewer), (3, {**whole, "MORE": "m"}), (4, {}), (5, None)]
    df = spark.createDataFrame(rows, "i int, payload map<string,string>")
    p = Payload.of(df, none_as_text=none_as_text)
    names = [*RECORD_COLUMNS, "MORE"]
    found = df.select(*(p.raw(n).alias(n) for n in names), *(p.text(n).alias(f"{n}_") for n in names)).orderBy("i").collect()
    for (_, payload), row in zip(rows, found):
        for n in names:
            value = (payload or {}).get(n)
            assert row[n] == value
            stored = "None" if none_as_text and n in (payload or {}) and value is None else value or ""
            assert row[f"{n}_"] == stored.strip()
    listed = df.select(*members_in_order(F.col("payload"), RECORD_COLUMNS)).collect()
    assert [list(r) for r in listed] == [[(payload or {}).get(n) for n in RECORD_COLUMNS] for _, payload in rows]


def test_members_in_order_are_not_searched(spark):
    whole = spark.createDataFrame([({n: n for n in RECORD_COLUMNS},)], "payload map<string,string>")
    assert "map_values" in plan_of(whole.select(Payload.of(whole).raw("CARD_NUMBER")))


def test_base64_of_odd_texts(spark):
    texts = ["QUJD", "QUI=", "QQ==", "", "QU\nJD", "QUJD　", '"QUJD', "QU\\/D", "\\u0051UJD", 'QUJD","b":"QUJD', "QQ==QQ==", "A", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = tokens.with_base64_bytes(df, F.col("t"), "x", clean="c").orderBy("i").collect()
    assert [r.c for r in found] == [True] * 4 + [False] * 9
    assert [r.x and bytes(r.x) for r in found[:7]] == [b"ABC", b"AB", b"A", b"", b"ABC", b"ABC", b"ABC"]
    assert found[11].x is None and found[12].x is None
    assert "RLIKE" not in plan_of(tokens.with_base64_bytes(df, F.col("t"), "x"))


def test_long_base64_is_one_line_and_null_stays_null(spark):
    df = spark.createDataFrame([(bytes(range(256)) * 3,), (b"",), (None,)], "b binary")
    import base64

    assert [r[0] for r in df.select(tokens._base64(F.col("b"))).collect()] == [base64.b64encode(bytes(range(256)) * 3).decode(), "", None]
