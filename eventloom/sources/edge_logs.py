"""Edge-record sources: packed globs, replay logs, day and file pruning, text prefilter."""

from __future__ import annotations

from base64 import b64encode
from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import BooleanType

from eventloom.sources.files import folder_names

# Replay windows are given in this zone; log folders are named by UTC day.
WINDOW_ZONE = ZoneInfo("America/Los_Angeles")
SLACK = timedelta(hours=1)


def read_globs(spark: SparkSession, path: str) -> DataFrame:
    """One row per packed file: ``value BINARY, arrival TIMESTAMP, path STRING``."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("content").alias("value"), F.col("modificationTime").alias("arrival"), "path"
    )


def read_globs_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Streaming form of :func:`read_globs` over a growing folder."""
    return (
        spark.readStream.format("binaryFile")
        .option("maxFilesPerTrigger", max_files)
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(path)
        .select(F.col("content").alias("value"), F.col("modificationTime").alias("arrival"), "path")
    )


def window_bounds(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """Aware bounds; naive values are taken as Pacific wall clock."""
    fix = lambda t: t if t.tzinfo else t.replace(tzinfo=WINDOW_ZONE)
    start, end = fix(start), fix(end)
    if end <= start:
        raise ValueError(f"need a valid time range, got {start} to {end}")
    return start, end


def edge_log_days(start: datetime, end: datetime) -> list[str]:
    """UTC days (``YYYYMMDD``) of the window, widened by an hour on both sides."""
    start, end = window_bounds(start, end)
    first = (start - SLACK).astimezone(timezone.utc).date()
    last = (end + SLACK).astimezone(timezone.utc).date()
    return [(first + timedelta(days=i)).strftime("%Y%m%d") for i in range((last - first).days + 1)]


def name_fragments(event: str) -> list[str]:
    """Base64 pieces of a quoted name at its three possible alignments.

    The quotes belong to the payload's JSON.  A name of one letter, or of two, has an empty piece at some
    alignment; every line contains the empty text, so such a name switches the prefilter off.
    """
    raw = f'"{event}"'.encode()
    cuts = ((i, (len(raw) - i) // 3 * 3 + i) for i in range(3))
    return [b64encode(raw[i:j]).decode() for i, j in cuts]


#: Pieces looked for one by one; more are looked for together.
FEW_PIECES = 24


def fragment_filter(line: Column, events: list[str]) -> Column:
    """Superset test on encoded text: keeps lines that may hold one of the events.

    Done before any decoding.  It assumes the payload is one base64 run.  A few pieces are a ``contains``
    each; many are one automaton over all of them, which reads a line once however many names there are.
    """
    pieces = sorted({p for e in events for p in name_fragments(e)})
    if "" in pieces:
        return F.lit(True)
    if len(pieces) <= FEW_PIECES:
        return reduce(lambda a, b: a | b, (line.contains(p) for p in pieces), F.lit(False))
    return _any_piece(pieces)(line)


def _any_piece(pieces: list[str]):
    """Arrow function: whether a text holds any of the pieces."""
    automaton = None

    @arrow_udf(BooleanType())
    def found(lines: pa.Array) -> pa.Array:
        nonlocal automaton
        if automaton is None:  # built once in each worker
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for piece in pieces:
                automaton.add_word(piece, True)
            automaton.make_automaton()
        return pa.array([x is not None and next(automaton.iter(x), None) is not None for x in lines.to_pylist()], pa.bool_())

    return found


def _reader(spark: SparkSession, path: str, start: datetime, end: datetime, day_column: str) -> DataFrame | None:
    """The window's files alone: its day folders by path, and in them files by modification time."""
    # Whole seconds, a little wider than the window; the exact test is made on the files that are left.
    stamp = lambda t: t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    reader = spark.read.schema("value string").option("timeZone", "UTC").option(
        "modifiedAfter", stamp(start - timedelta(seconds=1))).option("modifiedBefore", stamp(end + SLACK + timedelta(seconds=1)))
    names = folder_names(spark, path)
    if not any(n.startswith(f"{day_column}=") for n in names):
        return reader.text(path)
    days = [f"{day_column}={d}" for d in edge_log_days(start, end)]
    folders = [f"{path}/{d}" for d in days if d in names]
    return reader.option("basePath", path).text(folders) if folders else None


def read_edge_log(
    spark: SparkSession,
    path: str,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    events: list[str] | None = None,
    day_column: str = "day",
) -> DataFrame:
    """Replay lines, one JSON record each (gzip is read as it is): ``value STRING``.

    With a window, only the folders ``<day_column>=YYYYMMDD`` it touches are listed, and
    within them only files whose modification time can hold the window are read.  ``events`` adds
    the encoded-text prefilter.
    """
    if start is not None and end is not None:
        start, end = window_bounds(start, end)
        lines = _reader(spark, path, start, end, day_column)
        if lines is None:
            return spark.createDataFrame([], "value string")
        written = F.col("_metadata.file_modification_time")
        lines = lines.where((written >= F.lit(start)) & (written < F.lit(end + SLACK)))
    else:
        lines = spark.read.text(path)
    if events is not None:
        lines = lines.where(fragment_filter(F.col("value"), events))
    return lines.select("value")
