"""Column helpers over VARIANT values (one JSON value with its type kept)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, however often the body uses it.

    A one-element ``transform`` keeps the expression tree (and the generated code) from
    growing with every use.
    """
    return F.transform(F.array(value), body)[0]


def pinned(value: Column) -> Column:
    """``value`` as a column the optimizer computes where it stands, once.

    A filter on a computed column is normally pushed below its projection by copying the
    whole expression, which for parsed payloads and projected cells means doing the work
    again for every filter.  A (trivially true) partition-dependent test forbids the copy.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def json_path(key: str) -> str | None:
    """Variant path of one object key, or None when path syntax cannot hold it."""
    if "'" not in key and "?" not in key and key:
        return f"$['{key}']"
    if '"' not in key and "?" not in key and key:
        return f'$["{key}"]'
    if key and "." not in key and "[" not in key:
        return f"$.{key}"
    return None


def prop(properties: Column, key: str) -> Column:
    """Value of one property as VARIANT.

    SQL NULL means the key is absent; a JSON null stays a (void) variant, so callers can
    tell "missing" from "present but null".
    """
    path = json_path(key)
    if path is not None:
        return F.try_variant_get(properties, path, "variant")
    as_map = F.try_variant_get(properties, "$", "map<string,variant>")
    return F.try_element_at(as_map, F.lit(key))


def type_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_string(value: Column) -> Column:
    return type_of(value) == "STRING"


def is_object(value: Column) -> Column:
    # Reading one (absent) field as a struct is much cheaper than spelling the whole type.
    return F.try_variant_get(value, "$", "struct<_:int>").isNotNull()


def as_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def string_only(value: Column) -> Column:
    """Text of a JSON string, NULL for every other JSON type."""
    return F.when(is_string(value), as_string(value))


def to_variant(value: Column) -> Column:
    return value.cast("variant")
