"""Fields inside packed and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.keys import as_column

# Fixed value: separator pattern of packed descriptions such as ``1:text:0.14:0.02``.
PACK_SEPARATOR = ":+"


def packed_field(packed: str | Column, position: int) -> Column:
    """Field at the 1-based position, or NULL when there are fewer fields."""
    return F.get(F.split(as_column(packed), PACK_SEPARATOR), F.lit(position - 1))


def json_field(document: str | Column, name: str) -> Column:
    """One top-level field of a JSON text as text."""
    return F.get_json_object(as_column(document), f"$.{name}")


def json_fields(document: str | Column, schema: str) -> Column:
    """Several fields in one parse; a broken document gives NULL fields."""
    return F.from_json(as_column(document), schema)


def comma_decimal(value: str | Column, to: str = "float") -> Column:
    """Number written with a decimal comma."""
    return F.regexp_replace(as_column(value), ",", ".").try_cast(to)


def plain_number(text: str | Column) -> Column:
    """Number text without an exponent: ``1.0E7`` becomes ``10000000.0``.

    Spark prints doubles from ten million on, and below a thousandth, with an exponent; hash
    keys need the digits other systems print. Magnitudes of 1e16 and more stay as they are.
    """
    c = as_column(text)
    value = c.try_cast("double")
    digits = F.rtrim(value.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    written = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(c.contains("E") & (F.abs(value) < 1e16), F.coalesce(written, c)).otherwise(c)
