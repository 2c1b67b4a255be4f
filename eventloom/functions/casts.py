"""Typed column conversions.

Each conversion turns one VARIANT (with its type name next to it) into a typed Column that
is NULL when the value is not acceptable.  A few kinds have values that are acceptable
*and* empty (a NaN float, an address no block covers); the text cell shows those as '' so
that "skipped" is never inferred from an empty value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from eventloom.functions import layouts, text
from eventloom.functions.variants import as_string, let

# Accepted range of whole unix seconds, and the magnitude under which a
# float is stored as zero.
UNIX_SECONDS_MIN = 1000000000
UNIX_SECONDS_MAX = 13140000000
FLOAT_ZERO_BELOW = 10e-300

INTEGER_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_TEXT = r"(?i)^[+-]?inf(inity)?$"
# Decimal text of at most this length has at most 15 digits, which a double keeps.
EXACT_TEXT = 15

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
WALL_CLOCK_ZONE = "America/Los_Angeles"


@dataclass(frozen=True)
class Conversion:
    """How one transformer reads a value.

    ``value(raw, type)`` is the typed result, ``cell(raw, type)`` the text: NULL = skipped,
    '' = accepted but empty, anything else = the value.  ``from_seconds`` is a shortcut for
    the server time, which is a BIGINT column and needs no VARIANT.
    """

    sql_type: str
    value: Callable[[Column, Column], Column]
    text_cell: Callable[[Column, Column], Column] | None = None
    from_seconds: Callable[[Column], Column] | None = None

    def cell(self, raw: Column, kind: Column) -> Column:
        if self.text_cell is not None:
            return self.text_cell(raw, kind)
        return self.value(raw, kind).cast("string")


def is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def _as_bigint(raw: Column) -> Column:
    return F.try_variant_get(raw, "$", "bigint")


def bigint_value(raw: Column, kind: Column) -> Column:
    s = as_string(raw)
    return F.when(kind == "BIGINT", _as_bigint(raw)).when(
        (kind == "STRING") & s.rlike(INTEGER_TEXT), s.try_cast("bigint")
    )


def int_value(raw: Column, kind: Column) -> Column:
    return bigint_value(raw, kind).try_cast("int")


def float_value(raw: Column, kind: Column) -> Column:
    s = as_string(raw)
    number = F.when(is_number(kind), F.try_variant_get(raw, "$", "double")).when(
        (kind == "STRING") & s.rlike(FLOAT_TEXT), s.try_cast("double")
    )

    def settle(x: Column) -> Column:
        finite = F.when(F.abs(x) < FLOAT_ZERO_BELOW, F.lit(0.0)).when(
            F.abs(x) < float("inf"), x
        )
        spelled = F.when(s.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        return F.coalesce(finite, F.when((kind == "STRING") & s.rlike(INFINITY_TEXT), spelled))

    return let(number, settle)


def float_cell(raw: Column, kind: Column) -> Column:
    s = as_string(raw)
    short = F.length(s) <= EXACT_TEXT
    return (
        # Spark spells these as plain decimals without trailing zeros.
        F.when(((kind == "BIGINT") | kind.startswith("DECIMAL")) & short & (s != "-0"), s)
        .when((kind == "STRING") & (F.lower(s) == "nan"), F.lit(""))
        .otherwise(let(float_value(raw, kind), text.float_text))
    )


def varchar_value(raw: Column, kind: Column) -> Column:
    return F.when(kind == "STRING", as_string(raw))


def bool_value(raw: Column, kind: Column) -> Column:
    return F.when(kind == "BOOLEAN", F.try_variant_get(raw, "$", "boolean")).when(
        (kind == "BIGINT") & _as_bigint(raw).isin(0, 1), _as_bigint(raw) == 1
    )


def unix_millis(raw: Column, kind: Column) -> Column:
    """Milliseconds since the epoch, sub-millisecond digits cut off (never rounded)."""
    def cut(d: Column) -> Column:
        nanos = ((d - F.floor(d).cast("double")) * F.lit(1e9)).cast("bigint")
        millis = F.floor(d) * 1000 + F.floor(nanos / 1000000)
        return F.when((d >= UNIX_SECONDS_MIN) & (d < UNIX_SECONDS_MAX + 1), millis)

    return let(F.when(is_number(kind), F.try_variant_get(raw, "$", "double")), cut)


def _utc(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, F.expr(EPOCH_NTZ))


def _wall_clock(millis: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(WALL_CLOCK_ZONE), _utc(millis))


def _millis_of(seconds: Column) -> Column:
    return F.when(seconds.between(UNIX_SECONDS_MIN, UNIX_SECONDS_MAX), seconds * 1000)


INT = Conversion("int", int_value)
BIGINT = Conversion("bigint", bigint_value)
FLOAT = Conversion("double", float_value, float_cell)
VARCHAR = Conversion("string", varchar_value)
BOOL = Conversion("boolean", bool_value)
UNIX_WALL_CLOCK = Conversion(
    "timestamp_ntz",
    lambda raw, kind: _wall_clock(unix_millis(raw, kind)),
    from_seconds=lambda s: _wall_clock(_millis_of(s)),
)
UNIX_UTC = Conversion(
    "timestamp_ntz",
    lambda raw, kind: _utc(unix_millis(raw, kind)),
    from_seconds=lambda s: _utc(_millis_of(s)),
)


def layout_conversion(layout: str) -> Conversion:
    return Conversion(
        "timestamp_ntz", lambda raw, kind: layouts.parse(varchar_value(raw, kind), layout)
    )
