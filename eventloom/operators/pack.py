"""Size-bounded packing of stream entries into globs, and batching."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import BinaryType

from eventloom.operators.decode import GLOB_VERSION

NO_LIMIT = -1


def deflate(body: bytes) -> bytes:
    """Version byte and raw DEFLATE at the fastest level."""
    stream = zlib.compressobj(1, zlib.DEFLATED, -zlib.MAX_WBITS)
    return bytes([GLOB_VERSION]) + stream.compress(body) + stream.flush()


@arrow_udf(BinaryType())
def deflate_text(bodies: pa.Array) -> pa.Array:
    return pa.array([None if b.as_py() is None else deflate(b.as_py().encode()) for b in bodies], pa.binary())


class Greedy:
    """Open group per stream; closes it when the next entry would not fit."""

    def __init__(self, max_size: int, max_entries: int, overhead: bool):
        self.max_size, self.max_entries, self.overhead = max_size, max_entries, overhead
        self.open: dict[str, list[str]] = {}
        self.size: dict[str, int] = {}

    def add(self, stream: str, entry: str) -> list[str] | None:
        """Take one entry; the group that had to be closed before it, if any."""
        length = len(entry.encode())
        group = self.open.get(stream)
        closed = None
        full = self.max_entries != NO_LIMIT and group is not None and len(group) >= self.max_entries
        if group and (full or self.size[stream] + length > self.max_size):
            closed, group = group, None
        if not group:
            group = self.open[stream] = []
            self.size[stream] = 0
        group.append(entry)
        # A packed group also holds a bracket or comma in front of every entry.
        self.size[stream] += length + (1 if self.overhead else 0)
        return closed


def _packed(
    rows: DataFrame, stream: str, entry: str, max_size: int, max_entries: int, as_glob: bool
) -> DataFrame:
    out_type = "binary" if as_glob else "array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Greedy(max_size, max_entries, as_glob)
        shape = pa.schema(
            [("stream", pa.string()), ("entries", pa.int32()),
             ("value", pa.binary() if as_glob else pa.list_(pa.string()))]
        )

        def emit(groups: list[tuple[str, list[str]]]) -> pa.RecordBatch:
            value = [deflate(b"[" + ",".join(g).encode() + b"]") for _, g in groups] if as_glob else [g for _, g in groups]
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in groups], pa.string()),
                 pa.array([len(g) for _, g in groups], pa.int32()),
                 pa.array(value, shape.field("value").type)], schema=shape,
            )

        for batch in batches:
            closed = []
            for s, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                group = packer.add(s, e)
                if group:
                    closed.append((s, group))
            if closed:
                yield emit(closed)
        rest = [(s, g) for s, g in packer.open.items() if g]
        if rest:
            yield emit(rest)

    return rows.select(F.col(stream).cast("string"), F.col(entry).cast("string")).where(
        F.col(entry).isNotNull()
    ).mapInArrow(run, f"stream string, entries int, value {out_type}")


def pack_globs(rows: DataFrame, stream: str, entry: str, max_size: int = 990_000) -> DataFrame:
    """Entries to globs: ``stream, entries, value BINARY``.

    Greedy in arrival order inside each partition: a glob closes before an entry that
    would push it over ``max_size``; an entry larger than that goes out alone.  No shuffle;
    state is one open glob per stream, and each partition may end with a small one.
    """
    return _packed(rows, stream, entry, max_size, NO_LIMIT, True)


def batch_records(
    rows: DataFrame, stream: str, entry: str, max_size: int = 990_000, max_entries: int = 500
) -> DataFrame:
    """Entries to batches: ``stream, entries, value ARRAY<STRING>`` bounded by bytes and count."""
    return _packed(rows, stream, entry, max_size, max_entries, False)


def numbered(
    rows: DataFrame, keys: list[str], order: list[Column], slice_of: Column, number: str = "row_no"
) -> DataFrame:
    """Exact running number (from 0) per key without holding a whole key in one task.

    ``slice_of`` is a non-decreasing function of ``order`` (a minute, a range of ids).
    Slices are counted with a partial aggregation, their start numbers follow from a
    running sum over the few slice rows, and only single slices are sorted.
    """
    sliced = rows.withColumn("_slice", slice_of)
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    through = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(through), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_w", within - 1)
        .join(starts, [*keys, "_slice"])
        .withColumn(number, F.col("_start") + F.col("_w"))
        .drop("_slice", "_start", "_w")
    )


def batch_by_count(
    rows: DataFrame, keys: list[str], order: list[Column], slice_of: Column, max_entries: int
) -> DataFrame:
    """Adds ``batch_no``: consecutive groups of ``max_entries`` rows per key."""
    out = numbered(rows, keys, order, slice_of, "_row")
    if max_entries == NO_LIMIT:
        return out.withColumn("batch_no", F.lit(0).cast("bigint")).drop("_row")
    return out.withColumn("batch_no", F.floor(F.col("_row") / max_entries)).drop("_row")
