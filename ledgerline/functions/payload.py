"""Encoded and semi-structured payloads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arith import col


def json_field(c: Column | str, path: str, dtype: str = "string") -> Column:
    """Typed value at a JSON path; quote keys with dashes: ``$['a-b']``."""
    return F.get_json_object(col(c), path).try_cast(dtype)


def variant_field(c: Column | str, path: str, dtype: str) -> Column:
    return F.try_variant_get(F.try_parse_json(col(c)), path, dtype)


def first_json_object(text: Column) -> Column:
    """Text up to the brace that closes the first object; NULL when it is never closed.

    The text is cut into pieces that end in a string, ``{`` or ``}``, and the depth is folded over them.
    """
    pieces = F.regexp_extract_all(text, F.lit(r'[^{}"]*(?:"(?:\\.|[^"\\])*"|[{}])'), F.lit(0))

    def step(state: Column, piece: Column) -> Column:
        last = F.right(piece, F.lit(1))
        depth = state["depth"] + F.when(last == "{", 1).when(last == "}", -1).otherwise(0)
        at = state["at"] + F.length(piece)
        closed = (depth <= 0) & (last == "}")
        moved = F.struct(depth.alias("depth"), at.alias("at"), F.when(closed, at).otherwise(0).alias("end"))
        return F.when(state["end"] > 0, state).otherwise(moved)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))
    end = F.aggregate(pieces, start, step, lambda state: state["end"])
    return F.when(end > 0, F.substring(text, F.lit(1), end))


def decode_payload_json(c: Column | str) -> Column:
    """Base64 text to the JSON object it starts with; signature bytes after the object are dropped."""
    # One character per byte, so that bytes that are no UTF-8 text do no harm.
    text = F.decode(F.unbase64(col(c)), "ISO-8859-1")
    return F.decode(F.encode(first_json_object(text), "ISO-8859-1"), "UTF-8")


def php_field(c: Column | str, name: str) -> Column:
    """Text value of a field in a serialised PHP array."""
    return F.nullif(F.regexp_extract(col(c), f'"{name}";s:[0-9]+:"([^"]*)"', 1), F.lit(""))
