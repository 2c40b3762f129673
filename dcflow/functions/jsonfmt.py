"""JSON text scalars for the list-valued columns (stored as JSON text in a
relational table). Built on Spark's VARIANT functions, so they stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, empty_if_null

# A JSON string, which is kept, or white space between tokens.
JSON_STRING_OR_SPACE = r'("(?:[^"\\]|\\.)*+")|[ \t\r\n]+'


def array_to_json(arr: Column | str) -> Column:
    """List of strings -> JSON array text; NULL or missing -> ``[]``."""
    return F.to_json(empty_if_null(arr))


def json_to_array(s: Column | str) -> Column:
    """JSON text -> its string elements, in order.

    Non-string elements are skipped; a value that is not an array, or text that
    is not JSON, gives an empty array. NULL gives an empty array too.
    """
    items = F.try_variant_get(F.try_parse_json(_c(s)), "$", "array<variant>")
    strings = F.filter(items, lambda v: F.schema_of_variant(v) == F.lit("STRING"))
    as_text = F.transform(strings, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(as_text, F.array().cast("array<string>"))


def is_json(s: Column | str) -> Column:
    """Whether a text is one JSON value and nothing else, with numbers of any length and object
    keys that repeat allowed.

    The parser stops at the end of a value, so a text is tried inside an array and inside an
    object: what would close the one early is malformed in the other.
    """
    c = _c(s)
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    listed = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", strict)
    held = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string, bad string", {**strict, "columnNameOfCorruptRecord": "bad"})
    return F.coalesce((F.size(listed) == 1) & held["bad"].isNull(), F.lit(False))


def minify_json(s: Column | str) -> Column:
    """JSON text without the white space outside its strings; every other character stays."""
    return F.regexp_replace(_c(s), JSON_STRING_OR_SPACE, "$1")


def safe_serialize(s: Column | str, empty_as_null: bool = False, preserve: bool = False) -> Column:
    """Valid JSON text -> canonical JSON text; anything else -> a JSON string.

    NULL stays NULL. ``empty_as_null=True`` turns ``''`` into JSON ``null``
    (the other implementation's rule); by default ``''`` becomes ``""``.
    Canonical form is Spark's: minified, object keys sorted, numbers normalised.
    ``preserve=True`` only minifies: digits, key order and repeated keys stay as they are.
    """
    c = _c(s)
    parsed = minify_json(c) if preserve else F.to_json(F.try_parse_json(c))
    out = F.coalesce(F.when(is_json(c), parsed), F.to_json(c.cast("variant")))
    if empty_as_null:
        out = F.when(c == F.lit(""), F.lit("null")).otherwise(out)
    return out


def safe_serialize_array(arr: Column | str) -> Column:
    """Array overload: same as ``array_to_json``."""
    return array_to_json(arr)
