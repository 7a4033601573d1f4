"""Structured model responses: text out of the envelope, strict JSON objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.functions.text import line_feeds, unfenced


def response_text(content: Column, reasoning_content: Column, reasoning: Column) -> Column:
    """The first of three strings that is not empty."""
    full = [F.when(c != "", c) for c in (content, reasoning_content, reasoning)]
    return line_feeds(F.coalesce(*full))


def response_parts(parts: Column) -> Column:
    """An array of content parts as one text."""
    return line_feeds(F.array_join(F.transform(parts, lambda p: F.coalesce(p, F.lit(""))), "\n"))


def parsed(text: Column) -> Column:
    """The response as a variant, null if it is no JSON.

    The parser stops after the first value, so the text is also read inside an
    array and an object, where nothing may follow it."""
    t = unfenced(line_feeds(text))
    alone = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
    return F.when(alone, F.try_parse_json(t))


def parse_error(text: Column) -> Column:
    """INVALID_JSON, JSON_ROOT_NOT_OBJECT or null.  A null response is ''."""
    v = parsed(text)
    return F.when(v.isNull(), "INVALID_JSON").when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "JSON_ROOT_NOT_OBJECT")


def structured_value(text: Column, key: str) -> Column:
    """The string at a literal key; other kinds of values count as missing."""
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    v = F.try_variant_get(parsed(text), f'$["{quoted}"]', "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
