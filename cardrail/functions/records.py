"""JSON texts: strictness, kinds of members, and putting objects together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Parse options under which only standard JSON objects pass; the text of a record that does not fit
# its type lands in CORRUPT.
CORRUPT = "_corrupt"
JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": CORRUPT}
KEEP_NULLS = {"ignoreNullFields": "false"}

JSON_BLANKS = " \t\n\r"

# Bytes below which a text cannot pass the parsers' limit of a value.
LONG_TEXT = 10_000_000


def parse_object(text: Column, fields: str) -> Column:
    """Parse into a struct of ``fields`` (a DDL list), which also gets the CORRUPT member."""
    return F.from_json(text, f"{fields}, {CORRUPT} string", JSON_OPTIONS)


def is_one_json_value(text: Column) -> Column:
    """True when the text is exactly one JSON value with nothing after it.

    ``from_json`` stops after the first value. The text is put into an object before a last member, whose name is a
    backslash. A stray closer can only pass if the text has that name itself, so only texts with a backslash are put into
    a list as well; no stray closer can satisfy both. Counting members is a token scan that builds nothing. The parsed
    forms also admit ``NaN`` and infinities, and run only where a scan fails and a text has such a word (or is longer
    than a scanner may take).
    """
    names = F.array(F.lit("v"), F.lit("\\"))
    in_list = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit(r',"\\":0}'))
    unnamed = ~text.contains("\\")
    scanned = (F.json_object_keys(in_object) == names) & (unnamed | (F.json_array_length(in_list) == 1))
    listed = F.size(F.from_json(in_list, "array<string>", JSON_OPTIONS)) == 1
    members = F.map_keys(F.from_json(in_object, "map<string,string>", JSON_OPTIONS)) == names
    words = text.contains("NaN") | text.contains("INF") | text.contains("Infinity")
    unscanned = words | (F.octet_length(text) > LONG_TEXT)
    return F.coalesce(scanned, F.when(unscanned, listed & members), F.lit(False))


def member_json(text: Column, path: str) -> Column:
    """JSON text of the member at ``path``, null when absent; ``$`` is the value itself."""
    member = F.try_variant_get(F.try_parse_json(text), F.lit(path), "variant")
    return F.when(F.is_variant_null(member), F.lit("null")).otherwise(F.to_json(member))


def is_object_text(json: Column) -> Column:
    return F.ltrim(json, F.lit(JSON_BLANKS)).startswith("{")


def is_falsy(json: Column) -> Column:
    """Null, false, zero, or empty text, list or object, as JSON text."""
    return json.rlike(r'^\s*(null|false|""|\[\s*\]|\{\s*\}|-?0+(\.0*)?([eE][+-]?\d+)?)\s*$')


def type_word(json: Column) -> Column:
    """The type named in error messages for a JSON text."""
    first = F.substring(F.ltrim(json, F.lit(JSON_BLANKS)), 1, 1)
    return (
        F.when(first == "{", "dict")
        .when(first == "[", "list")
        .when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "n", "NoneType")
        .when(json.rlike("[.eEN]"), "float")
        .otherwise("int")
    )


def splice(first: Column, second: Column) -> Column:
    """One JSON object text with the members of two; neither may be null."""
    head = F.left(first, F.length(first) - 1)
    tail = F.substr(second, F.lit(2))
    return (
        F.when(first == "{}", second)
        .when(second == "{}", first)
        .otherwise(F.concat(head, F.lit(","), tail))
    )


def unknown_members(text: Column, known: tuple[str, ...]) -> Column:
    """The members a stage does not know, kinds kept, or null when there are none.

    The variant parse runs only for records that have such members.
    """
    known_keys = F.array(*(F.lit(k) for k in known))
    extra = F.map_filter(
        F.from_json(text, "map<string,variant>", JSON_OPTIONS), lambda k, _: ~k.isin(*known)
    )
    keys = F.json_object_keys(text)
    return F.when(F.size(F.array_except(keys, known_keys)) > 0, extra)


def last_wins(names: Column, values: Column) -> Column:
    """A map from parallel arrays; of a repeated name the last value counts, as in JSON texts.

    Parsed maps keep repeated names and give the first; only rows that have any are rebuilt.
    """

    def settled_by(names: Column) -> Column:
        distinct = F.array_distinct(names)
        pairs = F.arrays_zip(names.alias("name"), values.alias("value"))
        last = F.transform(
            distinct,
            lambda wanted: F.element_at(F.filter(pairs, lambda pair: pair["name"] == wanted), -1)["value"],
        )
        return F.when(F.size(distinct) < F.size(names), F.map_from_arrays(distinct, last)).otherwise(
            F.map_from_arrays(names, values)
        )

    return bound(names, settled_by)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def settled(parsed: Column) -> Column:
    """A parsed map with repeated names settled."""
    names = F.map_keys(parsed)
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    return F.when(repeated, last_wins(names, F.map_values(parsed))).otherwise(parsed)


def fenced(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose results later filters test as stored values.

    A filter on a plain computed column is pushed below its projection and the expression is then
    evaluated twice, once to test and once to keep. Generating the columns stops that, which pays
    off for decryption and JSON parsing.
    """
    # Structs go through the generator as well: the optimizer would split those that pass beside it
    # into their members, and loses some of these when a batch is cached.
    beside = [c for c in df.columns if c not in columns]
    structs = [c for c in beside if isinstance(df.schema[c].dataType, T.StructType)]
    made = F.struct(
        *(col.alias(name) for name, col in columns.items()), *(F.col(f"`{c}`") for c in structs)
    )
    kept = [F.col(f"`{c}`") for c in beside if c not in structs]
    return df.select(*kept, F.inline(F.array(made)))
