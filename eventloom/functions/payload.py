"""Payload text: URL-unescape, base64 in three alphabets, JSON object or array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.variants import is_object, is_string, pinned, prop


def payload_text(data: Column) -> Column:
    """Decoded payload text, NULL when the escape or the base64 is malformed.

    Unescaping turns ``+`` into a blank, so a blank stands for ``+`` here; ``-`` and ``_``
    are the URL-safe alphabet.  Bytes that are not UTF-8 become the replacement character.
    """
    # Most payloads are plain base64, which the escapes and other alphabets never parse as.
    plain = F.when(~data.contains(" "), F.try_to_binary(data, F.lit("base64")))
    standard = F.translate(F.try_url_decode(data), "-_ ", "+/+")
    decoded = F.coalesce(plain, F.try_to_binary(standard, F.lit("base64")))
    return F.make_valid_utf8(decoded.cast("string"))


def _is_event(item: Column) -> Column:
    """A JSON object (or null) whose ``event``, where present and not null, is a string."""
    name = prop(item, "event")
    return F.when(name.isNotNull(), is_string(name) | F.is_variant_null(name)).otherwise(
        F.is_variant_null(item) | is_object(item)
    )


def with_payload_items(df: DataFrame, payload: str, items: str) -> DataFrame:
    """Adds ``items ARRAY<VARIANT>``: one item per tracked event, NULL for unusable text.

    Only text that begins exactly with ``[{`` is read as an array.  The text is parsed
    inside an extra pair of brackets so that trailing characters make it invalid.  Each
    step is a column of its own, so the text is parsed once however often it is used.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col(payload), F.lit("]")))
    many = F.try_variant_get(F.try_element_at("_outer", F.lit(1)), "$", "array<variant>")
    return (
        df.withColumn("_outer", F.try_variant_get(wrapped, "$", "array<variant>"))
        .withColumn(
            "_found",
            F.when(
                F.size("_outer") == 1,
                F.when(F.col(payload).startswith("[{"), many).otherwise(F.col("_outer")),
            ),
        )
        .withColumn(items, pinned(F.when(F.forall("_found", _is_event), F.col("_found"))))
        .drop("_outer", "_found")
    )
