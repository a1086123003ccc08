"""Uniform access to payload members.

A payload is an open ``MAP<STRING,STRING>``, a ``STRUCT`` of table columns, or a ``STRUCT`` of the members
that the stages read, parsed from the JSON text beside it. With table columns, Catalyst resolves each
member to its source, so a stage that looks at four members makes the scan read four columns. With a
parsed struct a member is a field and no search; the text tells whether a null member is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardrail.functions.text import strip
from cardrail.schemas import RECORD_COLUMNS

# The column that holds the text of a parsed payload.
PAYLOAD_TEXT = "payload_json"

PLACES = {name: place for place, name in enumerate(RECORD_COLUMNS)}


def in_order(members: Column, keys: list[str] | tuple[str, ...]) -> Column:
    """True for a map whose names are ``keys`` in this order."""
    return F.map_keys(members) == F.split(F.lit(",".join(keys)), ",")


def members_in_order(members: Column, keys: list[str] | tuple[str, ...]) -> list[Column]:
    """The values of all ``keys`` in a map.

    A search for each of a record's names reads half of the others every time. A map whose names are ``keys`` in this
    order is read by place; any other one is searched.
    """
    ordered, values = in_order(members, keys), F.map_values(members)
    return [
        F.when(ordered, F.get(values, F.lit(i))).otherwise(F.try_element_at(members, F.lit(key)))
        for i, key in enumerate(keys)
    ]


class Payload:
    def __init__(
        self,
        column: Column,
        members: frozenset[str] | None,
        none_as_text: bool = True,
        source: Column | None = None,
    ):
        self._column = column
        self._source = source
        self._members = members
        self._none_as_text = none_as_text
        # a map is searched for a name only if it does not hold a record's members as they come from a table
        self._ordered = in_order(column, RECORD_COLUMNS) if members is None else None

    @classmethod
    def of(cls, df: DataFrame, name: str = "payload", none_as_text: bool = True) -> "Payload":
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.StructType):
            source = F.col(PAYLOAD_TEXT) if PAYLOAD_TEXT in df.columns else None
            return cls(F.col(name), frozenset(dtype.fieldNames()), none_as_text, source)
        if isinstance(dtype, T.MapType):
            return cls(F.col(name), None, none_as_text)
        raise TypeError(f"payload column {name!r} must be a map or a struct, not {dtype.simpleString()}")

    def raw(self, member: str) -> Column:
        """The member as stored; null when it is null or absent."""
        if self._members is None:
            found = F.try_element_at(self._column, F.lit(member))
            if member not in PLACES:
                return found
            return F.when(self._ordered, F.get(F.map_values(self._column), F.lit(PLACES[member]))).otherwise(found)
        if member in self._members:
            return self._column.getField(member)
        if self._source is not None:
            raise KeyError(f"{member} was not parsed")
        return F.lit(None).cast("string")

    def text(self, member: str) -> Column:
        """The member stripped; absent reads as empty, a stored null as the word ``None``.

        The word is what the stages have always produced for a null code or card number, and
        downstream results depend on it; ``none_as_text=False`` reads a null as empty instead.
        """
        value = self.raw(member)
        if self._source is not None:
            present = F.array_contains(F.json_object_keys(self._source), member)
        elif self._members is not None:
            present = F.lit(member in self._members)
        else:
            present = F.map_contains_key(self._column, member)
            present = self._ordered | present if member in PLACES else present
        if not self._none_as_text or (self._members is not None and member not in self._members):
            return strip(F.coalesce(value, F.lit("")))
        if self._members is not None and self._source is None:
            return strip(F.coalesce(value, F.lit("None")))
        # the value first: presence is looked up only where it is null
        return strip(F.coalesce(value, F.when(present, F.lit("None")), F.lit("")))
