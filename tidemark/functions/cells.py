"""Per-value rules of the logical type lattice, one boolean expression per type.

Each function takes a text column (a CSV cell) and says whether the text is a legal value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text patterns and ranges of the contract's logical types.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
LOCAL_TIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?$"
OFFSET_TIME_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:Z|[+-][0-9]{2}:[0-9]{2})$"
)
INTEGER_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64}
UNSIGNED_BITS = {"uint8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
FLOAT_LIMITS = {"float32": 3.4028234663852886e38, "float64": 1.7976931348623157e308}

SPARK_TYPES = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp-tz": T.TimestampType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "json": T.VariantType(),
}

_DECIMAL_NAME = re.compile(r"decimal\(([0-9]+),([0-9]+)\)")


def decimal_shape(logical_type: str) -> tuple[int, int] | None:
    match = _DECIMAL_NAME.fullmatch(logical_type)
    if match is None:
        return None
    precision, scale = int(match.group(1)), int(match.group(2))
    if not (1 <= precision <= 38 and 0 <= scale <= precision):
        raise ValueError(f"decimal bounds are invalid: {logical_type}")
    return precision, scale


def spark_type(logical_type: str) -> T.DataType:
    shape = decimal_shape(logical_type)
    if shape is not None:
        return T.DecimalType(*shape)
    return SPARK_TYPES[logical_type]


def logical_type(data_type: T.DataType) -> str:
    """Lattice name of a column type read from a file; nested types have none."""
    if isinstance(data_type, T.DecimalType):
        return f"decimal({data_type.precision},{data_type.scale})"
    names = {
        T.BooleanType: "boolean",
        T.ByteType: "int8",
        T.ShortType: "int16",
        T.IntegerType: "int32",
        T.LongType: "int64",
        T.FloatType: "float32",
        T.DoubleType: "float64",
        T.DateType: "date",
        T.TimestampNTZType: "timestamp",
        T.TimestampType: "timestamp-tz",
        T.StringType: "string",
        T.BinaryType: "binary",
        T.VariantType: "json",
    }
    if type(data_type) not in names:
        raise ValueError(f"nested or unsupported column type: {data_type.simpleString()}")
    return names[type(data_type)]


def _unsigned(text: Column) -> Column:
    """Text without its sign and leading zeros."""
    return F.ltrim(F.ltrim(text, F.lit("+-")), F.lit("0"))


def _integer_ok(text: Column, low: int, high: int) -> Column:
    if high < 1 << 63:
        return text.rlike(INTEGER_TEXT) & text.try_cast("long").between(low, high)
    digits = _unsigned(text)
    number = F.when(F.length(digits) <= 20, F.concat(F.lit("0"), digits)).try_cast("decimal(21,0)")
    small = number <= F.lit(str(high)).cast("decimal(21,0)")
    return text.rlike(INTEGER_TEXT) & small & (~text.startswith("-") | (digits == ""))


def _decimal_ok(text: Column, precision: int, scale: int) -> Column:
    """Digits written after the point count as scale; leading zeros do not count as precision."""
    body = _unsigned(text)
    point = F.instr(body, ".")
    whole = F.when(point > 0, point - 1).otherwise(F.length(body))
    fraction = F.when(point > 0, F.length(body) - point).otherwise(F.lit(0))
    return text.rlike(DECIMAL_TEXT) & (fraction <= scale) & (whole + fraction <= precision)


def _calendar_ok(text: Column) -> Column:
    """A real day, for a text that starts in the form yyyy-MM-dd."""
    return F.substring(text, 1, 10).try_cast("date").isNotNull() & ~text.startswith("0000")


def _clock_ok(text: Column) -> Column:
    """Hours to 23, minutes and seconds to 59, for two-digit parts at their fixed places."""
    return (
        (F.substring(text, 12, 2) <= "23") & (F.substring(text, 15, 2) <= "59") & (F.substring(text, 18, 2) <= "59")
    )


def _offset_ok(text: Column) -> Column:
    hours, minutes = F.substring(text, -5, 2), F.substring(text, -2, 2)
    return text.endswith("Z") | ((hours <= "23") & (minutes <= "59"))


def is_legal(text: Column, logical_type: str) -> Column:
    """Whether a non-empty cell is a legal value; never null."""
    shape = decimal_shape(logical_type)
    if shape is not None:
        rule = _decimal_ok(text, *shape)
    elif logical_type in ("string", "binary"):
        rule = text.isNotNull()
    elif logical_type == "json":
        rule = F.try_parse_json(text).isNotNull()
    elif logical_type == "boolean":
        rule = F.lower(text).isin("true", "false")
    elif logical_type in INTEGER_BITS:
        half = 1 << (INTEGER_BITS[logical_type] - 1)
        rule = _integer_ok(text, -half, half - 1)
    elif logical_type in UNSIGNED_BITS:
        rule = _integer_ok(text, 0, (1 << UNSIGNED_BITS[logical_type]) - 1)
    elif logical_type in FLOAT_LIMITS:
        number = text.try_cast("double")
        rule = text.rlike(DECIMAL_TEXT) & (F.abs(number) <= F.lit(FLOAT_LIMITS[logical_type]))
    elif logical_type == "date":
        rule = text.rlike(DATE_TEXT) & _calendar_ok(text)
    elif logical_type == "timestamp":
        rule = text.rlike(LOCAL_TIME_TEXT) & _calendar_ok(text) & _clock_ok(text)
    elif logical_type == "timestamp-tz":
        rule = text.rlike(OFFSET_TIME_TEXT) & _calendar_ok(text) & _clock_ok(text) & _offset_ok(text)
    else:
        raise ValueError(f"unknown logical type: {logical_type}")
    return F.coalesce(rule, F.lit(False))


def cell_violation(text: Column, logical_type: str, nullable: bool) -> Column:
    """True for a cell that breaks its contract; a null or empty cell is legal only when nullable."""
    missing = text.isNull() | (text == "")
    return F.when(missing, F.lit(not nullable)).otherwise(~is_legal(text, logical_type))
