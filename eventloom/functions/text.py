"""Text forms: number and timestamp text, quoted TSV fields and their inverse."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eventloom.functions.variants import let

# Characters that need an escape inside a quoted field: the quote, the backslash and
# everything not printable (controls, format characters, separators but the plain blank).
NOT_PRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"
NEEDS_ESCAPE = r'["\\]|' + NOT_PRINTABLE

# Short escapes of a quoted field.
SHORT_ESCAPES = {
    "\\": "\\\\",
    '"': '\\"',
    "\a": "\\a",
    "\b": "\\b",
    "\f": "\\f",
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
    "\v": "\\v",
}


def _digits(number_text: Column) -> Column:
    """Significant digits of a number text, as text."""
    return F.regexp_replace(number_text, r"E.*$|^-?0[.]0*|[-.]", "")


def _spell_out(number_text: Column) -> Column:
    """Plain decimal spelling of a text like ``-1.25E-7``."""
    def join(p: Column) -> Column:
        whole = F.when(p["point"] <= 0, F.lit("0")).otherwise(
            F.rpad(F.substring(p["digits"], F.lit(1), p["point"]), p["point"], F.lit("0"))
        )
        fraction = F.when(
            p["point"] < 0, F.concat(F.repeat(F.lit("0"), -p["point"]), p["digits"])
        ).otherwise(F.substring(p["digits"], p["point"] + 1, F.length(p["digits"])))
        tail = F.regexp_replace(F.concat(F.lit("."), fraction), r"[.]?0*$", "")
        return F.concat(p["sign"], whole, tail)

    mantissa = F.regexp_extract(number_text, r"^-?([0-9.]+)", 1)
    exponent = F.regexp_extract(number_text, r"E([+-]?[0-9]+)$", 1).try_cast("int")
    parts = F.struct(
        F.when(number_text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.replace(mantissa, F.lit("."), F.lit("")).alias("digits"),
        (F.length(F.substring_index(mantissa, ".", 1)) + F.coalesce(exponent, F.lit(0))).alias("point"),
    )
    return let(parts, join)


def float_text(value: Column) -> Column:
    """Shortest decimal text without an exponent (``1234`` for 1234.0, ``+Inf``)."""
    def shortest(java: Column) -> Column:
        # Java may print more digits than needed beyond 15, which shows as a 17th digit or
        # a run of nines or zeros before the last one; then take what still round-trips.
        def rounded(digits: int) -> Column:
            return F.upper(F.format_string(f"%.{digits - 1}e", value))

        digits = _digits(java)
        best = (
            F.when(digits.rlike("(999|000)[0-9]$") & (rounded(15).try_cast("double") == value), rounded(15))
            .when((F.length(digits) > 16) & (rounded(16).try_cast("double") == value), rounded(16))
            .otherwise(java)
        )
        return (
            F.when(java.isin("Infinity", "-Infinity"), F.when(value > 0, F.lit("+Inf")).otherwise(F.lit("-Inf")))
            .when(java.contains("E"), let(F.when(F.length(digits) > 15, best).otherwise(java), _spell_out))
            .when(F.length(java) > 16, let(best, lambda b: F.when(b.contains("E"), _spell_out(b)).otherwise(b)))
            .otherwise(F.regexp_replace(java, r"[.]0$", ""))
        )

    return let(value.cast("string"), shortest)


def _escape_rare(ch: Column) -> Column:
    code = F.ascii(ch)
    hexed = F.lower(F.hex(code))
    numeric = (
        F.when(code < 128, F.concat(F.lit("\\x"), F.lpad(hexed, 2, "0")))
        .when(code < 65536, F.concat(F.lit("\\u"), F.lpad(hexed, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(hexed, 8, "0")))
    )
    return F.when(ch.rlike(NOT_PRINTABLE), numeric).otherwise(ch)


def quote_field(value: Column) -> Column:
    """Double-quoted field with escapes.

    Most values need none; the common escapes are plain replaces, and only text with
    other unprintable characters is taken apart character by character.
    """
    def body(v: Column) -> Column:
        common = v
        for raw, escaped in SHORT_ESCAPES.items():
            common = F.replace(common, F.lit(raw), F.lit(escaped))
        every = let(common, lambda c: F.when(
            c.rlike(NOT_PRINTABLE), F.array_join(F.transform(F.split(c, ""), _escape_rare), "")
        ).otherwise(c))
        return F.when(v.rlike(NEEDS_ESCAPE), every).otherwise(v)

    return F.concat(F.lit('"'), let(F.coalesce(value, F.lit("")), body), F.lit('"'))


def unquote_field(field: Column) -> Column:
    """Inverse of :func:`quote_field` (also takes an unquoted field as it is)."""
    body = F.regexp_replace(field, r'^"|"$', "")

    def unescape(part: Column) -> Column:
        plain = part
        for raw, escaped in SHORT_ESCAPES.items():
            if raw != "\\":
                plain = F.replace(plain, F.lit(escaped), F.lit(raw))
        # Numbered escapes are rewritten to JSON's, and the JSON reader does the rest.
        numbered = F.regexp_replace(part, r"\\x([0-9a-f]{2})", r"\\u00$1")
        numbered = F.replace(numbered, F.lit("\\a"), F.lit("\\u0007"))
        numbered = F.replace(numbered, F.lit("\\v"), F.lit("\\u000b"))
        numbered = F.get_json_object(F.concat(F.lit('{"v":"'), numbered, F.lit('"}')), "$.v")
        return F.when(part.rlike(r"\\[xuU]"), F.coalesce(numbered, plain)).otherwise(plain)

    # An escaped backslash is cut out first, so no escape is read across it.
    parts = F.transform(F.split(body, r"\\\\"), unescape)
    return F.when(body.contains("\\"), F.array_join(parts, "\\")).otherwise(body)


def sorted_map(record: Column) -> Column:
    """The map with its entries in the order of their keys, which are different."""
    return F.map_from_entries(F.sort_array(F.map_entries(record)))


def sorted_json(record: Column) -> Column:
    """Flat map as JSON text with sorted keys."""
    return F.to_json(sorted_map(record))


def trim_blanks(value: Column) -> Column:
    """Strip every kind of Unicode white space from both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
