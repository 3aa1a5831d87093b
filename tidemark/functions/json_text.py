"""Expressions over raw JSON lines. The whole line is examined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds on raw JSON lines, strict landing form and general contract form.
LANDING_MAX_DEPTH = 32
LANDING_MAX_LINE_BYTES = 1024 * 1024
CONTRACT_MAX_DEPTH = 64
CONTRACT_MAX_LINE_BYTES = 16 * 1024 * 1024

_STRING_LITERAL = r'"(?:[^"\\]|\\.)*+"'


def bracket_depth(line: Column) -> Column:
    """Deepest nesting of objects and arrays, ignoring brackets inside string literals."""
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("deepest"))

    def step(state: Column, mark: Column) -> Column:
        depth = state["open"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("open"), F.greatest(state["deepest"], depth).alias("deepest"))

    return F.aggregate(F.split(_brackets(line), ""), start, step, lambda state: state["deepest"])


def _brackets(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(line, _STRING_LITERAL, ""), r"[^\[\]{}]", "")


def deeper_than(line: Column, limit: int) -> Column:
    """Whether the nesting exceeds a limit; the walk is spared where there are too few brackets."""
    opening = F.length(line) - F.length(F.translate(line, "[{", ""))
    return F.when(opening <= limit, F.lit(False)).otherwise(bracket_depth(line) > limit)


# Fixed value: JSON number syntax.
NUMBER_TEXT = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"


def parsed(line: Column) -> Column:
    """Variant value; null for malformed text and for duplicate object members."""
    return F.try_parse_json(line)


def is_object(line: Column, variant: Column) -> Column:
    """Whether a parsed line is an object: well-formed text that opens with a brace is one."""
    return variant.isNotNull() & F.ltrim(line, F.lit(" \t\r\n")).startswith("{")


def _path(dotted_path: str) -> str:
    return "$" + "".join(f'["{part}"]' for part in dotted_path.split("."))


def member(variant: Column, dotted_path: str, sql_type: str) -> Column:
    """Value at a dotted path, null when absent or not of that type."""
    return F.try_variant_get(variant, _path(dotted_path), sql_type)


def member_shape(variant: Column, dotted_path: str) -> Column:
    """Type text of the member at a dotted path: STRING, BIGINT, VOID for JSON null; null when absent."""
    return F.schema_of_variant(member(variant, dotted_path, "variant"))


def text_schema(dotted_paths: Sequence[str]) -> T.StructType:
    """Nested struct of texts holding every path."""
    members: dict = {}
    for path in dotted_paths:
        level = members
        for part in path.split("."):
            level = level.setdefault(part, {})

    def build(level: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(name, build(below) if below else T.StringType()) for name, below in level.items()]
        )

    return build(members)


def member_texts(line: Column, dotted_paths: Sequence[str]) -> Column:
    """Members as text: strings without quotes, integers with all digits, fractions as doubles."""
    return F.from_json(line, text_schema(dotted_paths))
