"""JSON payload access: typed fields out of raw response text, including object-keyed-by-item-id payloads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse(payload, schema: StructType | str) -> Column:
    """Raw JSON text -> struct; malformed text gives a struct of nulls (PERMISSIVE), never an error."""
    return F.from_json(_c(payload), schema, {"mode": "PERMISSIVE"})


def keyed_entry(payload, key, value_type: DataType | str) -> Column:
    """``payload[str(key)]`` for a payload that is an object keyed by item id.

    Missing key or malformed JSON -> null (the original raised on a missing key). Only the entry asked for is read
    with ``value_type``: an entry of another type under another key does no harm.
    """
    return F.from_json(entry_text(payload, _c(key).cast("string")), value_type, {"mode": "PERMISSIVE"})


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def entry_text(payload, name) -> Column:
    """JSON text of one entry of an object; null when the text is no object, or has no such entry, or holds null."""
    return F.try_element_at(F.from_json(_c(payload), "map<string,string>"), _c(name))


def json_shape_ok(payload) -> Column:
    """True when the text parses as a JSON object (used to tell a bad body from a good one)."""
    return F.from_json(_c(payload), "map<string,string>").isNotNull()
