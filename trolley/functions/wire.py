"""How records look on the wire: JSON text, timestamps to the second without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: timestamp pattern of the wire format.
WIRE_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

# How JSON is read, wherever it is: what the parser rejects for a record is not JSON elsewhere.
READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "timeZone": "UTC",
    "allowSingleQuotes": "false",
    "allowUnquotedControlChars": "false",
}

_WRITE_OPTIONS = {
    "timeZone": "UTC",
    "timestampFormat": WIRE_TIMESTAMP,
    "timestampNTZFormat": WIRE_TIMESTAMP,
    "ignoreNullFields": "false",
}


def wire_timestamp(ts: Column | str) -> Column:
    """A timestamp as wire text; null stays null."""
    return F.date_format(ts, WIRE_TIMESTAMP)


def record_json(*columns: Column | str) -> Column:
    """One record as JSON text, every field present even where it is null."""
    return F.to_json(F.struct(*(columns or ("*",))), _WRITE_OPTIONS)


def is_object(text: Column) -> Column:
    """True where ``text`` starts with a complete JSON object, by the parser that reads records."""
    return F.from_json(text, "map<string,string>", READ_OPTIONS).isNotNull()


def is_one_json(text: Column) -> Column:
    """True where ``text`` is exactly one JSON value, with nothing after it.

    The parser stops at the end of the first value. Wrapped into an array *and* into an
    object, only a text without leftovers stays well-formed both times.
    """
    in_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", READ_OPTIONS)
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return F.coalesce((F.size(in_array) == 1) & is_object(in_object), F.lit(False))


def compact_line(text: Column) -> Column:
    """A JSON document on one line. A line break is only legal JSON between tokens."""
    return F.translate(text, "\r\n", "  ")
