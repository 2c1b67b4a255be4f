"""Decode: globs and edge records to one row per tracked event."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from eventloom.functions.payload import payload_text, with_payload_items
from eventloom.functions.variants import let, pinned, prop, string_only

GLOB_VERSION = 1
UNKNOWN_EVENT = "Unknown"
ERROR_ID = "error"
PARSED, UNABLE_TO_PARSE = 0, 1
# Seconds of year 1, which a record without a receive time carries; and the text form of
# an absent client address.
NO_RECEIVE_TIME = -62135596800
NO_ADDRESS = "<nil>"

RECORD_SCHEMA = (
    "receivedAt string, clientIp string, xForwardedFor string, uuid string, data string, "
    "recordversion bigint, userAgent string, edgeType string"
)
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
ADDRESS = r"^((25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])([.](?!$)|$)){4}$|^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$"


def glob_body(glob: bytes | None) -> str | None:
    """Text behind the version byte and raw DEFLATE; None for anything malformed."""
    if not glob or glob[0] != GLOB_VERSION:
        return None
    stream = zlib.decompressobj(-zlib.MAX_WBITS)
    try:
        body = stream.decompress(memoryview(glob)[1:]) + stream.flush()
    except zlib.error:
        return None
    return body.decode("utf-8", "replace") if stream.eof else None


@arrow_udf(StringType())
def inflate_glob(globs: pa.Array) -> pa.Array:
    """Texts of globs; NULL for anything malformed."""
    return pa.array([glob_body(g.as_py()) for g in globs], pa.string())


# Fields of a record that hold text, and the one that holds a whole number.
TEXT_FIELDS = ["receivedAt", "clientIp", "xForwardedFor", "uuid", "data", "userAgent", "edgeType"]
NUMBER_FIELD = "recordversion"
_MAYBE_NO_TEXT = r'"(' + "|".join(TEXT_FIELDS) + r')"\s*:\s*[^"n\s]'
_SPACE = re.compile(r"[ \t\n\r]*")


def _refused(text: str):
    raise ValueError(f"{text} is no JSON")


_SCAN = json.JSONDecoder(parse_constant=_refused).scan_once


def _is_record(record) -> bool:
    """An object whose known fields, where present, have their types."""
    if not isinstance(record, dict):
        return False
    number = record.get(NUMBER_FIELD)
    whole = number is None or isinstance(number, int) and not isinstance(number, bool)
    return whole and all(isinstance(record.get(f, ""), (str, type(None))) for f in TEXT_FIELDS)


def record_texts(body: str) -> Iterator[tuple[str, dict]]:
    """Records of a glob's text one after the other, as text and parsed; ValueError where the text is no JSON
    array of records. Only one record is held parsed at a time, however long the text."""
    space = lambda at: _SPACE.match(body, at).end()
    at = space(0)
    if body[at : at + 1] != "[":
        raise ValueError("no array")
    at = space(at + 1)
    more = body[at : at + 1] != "]"
    while more:
        begin = at
        try:
            record, at = _SCAN(body, at)
        except StopIteration:
            raise ValueError("cut off") from None
        if not _is_record(record):
            raise ValueError("no record")
        yield body[begin:at], record
        at = space(at)
        more = body[at : at + 1] == ","
        if more:
            at = space(at + 1)
        elif body[at : at + 1] != "]":
            raise ValueError("no end")
    if space(at + 1) != len(body):
        raise ValueError("text after the end")


@arrow_udf(StructType([StructField("n_records", IntegerType()), StructField("glob_key", StringType())]))
def _glob_facts(globs: pa.Array) -> pa.Array:
    numbers, keys = [], []
    for glob in globs:
        number, key, body = 0, None, glob_body(glob.as_py())
        try:
            for _, record in record_texts(body) if body is not None else [_refused("nothing")]:
                key = record.get("uuid") if number == 0 else key
                number += 1
        except (ValueError, RecursionError):
            number = None
        numbers.append(number)
        keys.append((key if number else None) or "")
    return pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(keys, pa.string())], ["n_records", "glob_key"])


def inflate_globs(globs: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``n_records`` and ``glob_key`` (id of the first record).

    ``n_records`` is NULL for a glob that cannot be expanded: not inflated whole, no JSON array, or with
    anything in it that is no record, also by the type of a field.  The totals report counts them.  A glob may
    be as large as a task's memory; nothing of it but these two facts leaves the function.
    """
    # Called nondeterministic, it is evaluated once and not again in filters on its result.
    facts = globs.withColumn("_facts", _glob_facts.asNondeterministic()(F.col(value)))
    return facts.select(*globs.columns, "_facts.n_records", "_facts.glob_key")


#: Bytes of record texts in one Arrow batch on the way back from Python.
BATCH_BYTES = 8 << 20


def _records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batch_of = lambda texts: pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for batch in batches:
        held, size = [], 0
        for glob in batch.column("value"):
            body = glob_body(glob.as_py())
            try:
                # The whole glob is checked before its first record leaves.
                for _ in record_texts(body) if body is not None else [_refused("nothing")]:
                    pass
            except (ValueError, RecursionError):
                continue
            for text, _ in record_texts(body):
                held.append(text)
                size += len(text)
                if size > BATCH_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
        yield batch_of(held)


def expand_globs(globs: DataFrame) -> DataFrame:
    """One row per record (``record STRUCT``) of the globs (``value``) that can be expanded; the others are
    left out, see :func:`inflate_globs`.  Records leave in batches of bounded size, whatever the size of a glob."""
    texts = globs.select("value").mapInArrow(_records_of, "text string")
    return texts.select(pinned(F.from_json("text", RECORD_SCHEMA)).alias("record"))


def parse_envelope(lines: DataFrame, value: str = "value") -> DataFrame:
    """``record STRUCT`` from one JSON record per line; NULL when the line is malformed."""
    parsed = F.from_json(F.col(value), RECORD_SCHEMA + ", _corrupt_record string")
    read = lines.withColumn("_parsed", parsed)
    fields = [F.col(f"_parsed.{f.split()[0]}") for f in RECORD_SCHEMA.split(", ")]
    ok = F.col("_parsed").isNotNull() & F.col("_parsed._corrupt_record").isNull() & F.ltrim(
        F.col(value)
    ).startswith("{")
    # Only lines where a text field may hold something else are parsed again (once), to see whether it does.
    kind = lambda whole, f: F.schema_of_variant(whole[f])
    typed = lambda whole: reduce(lambda a, b: a & b, [F.coalesce(kind(whole, f).isin("STRING", "VOID"), F.lit(True)) for f in TEXT_FIELDS])
    kinds = F.from_json(F.col(value), ", ".join(f"{f} variant" for f in TEXT_FIELDS))
    ok &= ~F.col(value).rlike(_MAYBE_NO_TEXT) | let(kinds, typed)
    return read.select(pinned(F.when(ok, F.struct(*fields))).alias("record"))


def valid_record(record: Column, received_at: Column) -> Column:
    """A record whose receive time and address, where present, are well formed."""
    at, ip = record["receivedAt"], record["clientIp"]
    return (
        record.isNotNull()
        & (at.isNull() | (received_at.isNotNull() & at.rlike(RFC3339)))
        & (ip.isNull() | (ip == "") | ip.rlike(ADDRESS))
    )


def quarantine_id(uuid: Column) -> Column:
    """Id of an undecodable row: ``error`` when empty or longer than 64 bytes."""
    return F.when(F.octet_length(uuid).between(1, 64), uuid).otherwise(F.lit(ERROR_ID))


def explode_events(records: DataFrame) -> DataFrame:
    """Tracked events of each record, plus one quarantine row per undecodable record.

    Output: ``event, uuid, event_time, received_at, client_ip, user_agent, edge_type,
    properties VARIANT, failure``.  Ids get a ``-i`` suffix only when a payload holds more
    than one event.  A narrow plan: no shuffle, no Python.
    """
    r, ok = F.col("record"), F.col("_ok")
    checked = records.withColumn("_at", F.try_to_timestamp(r["receivedAt"])).withColumn(
        "_ok", valid_record(r, F.col("_at"))
    )
    staged = checked.select(
        F.when(ok, r["uuid"]).alias("_uuid"),
        F.when(ok, F.col("_at")).alias("received_at"),
        F.when(ok, F.coalesce(F.nullif(r["clientIp"], F.lit("")), F.lit(NO_ADDRESS))).alias("client_ip"),
        F.when(ok, F.coalesce(r["userAgent"], F.lit(""))).alias("user_agent"),
        F.coalesce(r["edgeType"], F.lit("")).alias("edge_type"),
        "_ok",
        F.when(ok, payload_text(F.coalesce(r["data"], F.lit("")))).alias("_payload"),
    )
    staged = with_payload_items(staged, "_payload", "_items").withColumn("_n", F.size("_items"))
    # The count is taken before the explode so that no exploded row carries the array.
    exploded = staged.select(
        "_uuid", "received_at", "client_ip", "user_agent", "edge_type", "_ok", "_n",
        F.posexplode_outer("_items").alias("_pos", "_item"),
    )
    item = F.col("_item")
    seconds = F.when(F.col("_ok"), F.coalesce(F.unix_seconds("received_at"), F.lit(NO_RECEIVE_TIME)))
    parsed = item.isNotNull()
    plain_id = F.coalesce(F.col("_uuid"), F.lit(""))
    event_id = F.when(F.col("_n") > 1, F.concat_ws("-", plain_id, F.col("_pos"))).otherwise(plain_id)
    return exploded.select(
        F.when(parsed, F.coalesce(string_only(prop(item, "event")), F.lit(""))).otherwise(
            F.lit(UNKNOWN_EVENT)
        ).alias("event"),
        F.when(parsed, event_id).otherwise(quarantine_id(F.col("_uuid"))).alias("uuid"),
        F.coalesce(seconds, F.lit(0)).alias("event_time"),
        "received_at",
        F.when(parsed, F.col("client_ip")).otherwise(F.lit("")).alias("client_ip"),
        F.when(parsed, F.col("user_agent")).otherwise(F.lit("")).alias("user_agent"),
        "edge_type",
        prop(item, "properties").alias("properties"),
        F.when(parsed, F.lit(PARSED)).otherwise(F.lit(UNABLE_TO_PARSE)).alias("failure"),
    )


def decode_edge_log(lines: DataFrame, on_bad_line: str = "quarantine") -> DataFrame:
    """Replay lines to events; malformed lines become quarantine rows or are dropped."""
    records = parse_envelope(lines)
    if on_bad_line == "drop":
        records = records.where(valid_record(F.col("record"), F.try_to_timestamp("record.receivedAt")))
    elif on_bad_line != "quarantine":
        raise ValueError("on_bad_line is 'quarantine' or 'drop'")
    return explode_events(records)
