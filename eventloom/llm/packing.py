"""Concatenate and cut: all ids in one line, cut into windows of a fixed length.

Pass one tokenizes and sums ids per partition; a prefix sum over these totals gives each document
its place in the line. Pass two cuts each document at multiples of the window length. A window is
one training sequence; only the last of all is shorter. Windows that lie inside one partition are
put together there; a window across a partition edge leaves boundary records (one or two per
partition), which alone are shuffled.

Nulls: a null text is empty and still gives its end id; a null doc_id is kept. Repeated rows are
packed as often as they occur. An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import documents, give_back, written
from eventloom.llm.token_ids import forget
from eventloom.llm.token_table import crc, placed, tokenized

WINDOW = 2048


_PIECE = {
    "doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long",
    "sequence_id": "long", "offset": "long", "token_ids": "array<int>",
}
_IN_SEQUENCE = ["offset", "doc_id", "start", "length", "token_ids"]


def _placed(docs: DataFrame, vocabulary: str | None) -> DataFrame:
    tokens = placed(written(tokenized(docs, vocabulary), "tokens"))
    return tokens.select("doc_id", "start", "n_tokens", "token_ids")


def token_pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of a document in a window, with the columns of ``_PIECE``. ``start`` counts
    ids of the document, ``offset`` ids of the window."""
    schema = ", ".join(f"{name} {kind}" for name, kind in _PIECE.items())
    return _placed(docs, vocabulary).mapInArrow(lambda batches: _cut(batches, window), schema)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Pieces of placed documents, in the order of their rows, some hundred documents at a time."""
    for whole in batches:
        for k in range(0, whole.num_rows, 256):
            batch = whole.slice(k, 256)
            place, n = batch.column("start").to_numpy(), batch.column("n_tokens").to_numpy()
            ids = batch.column("token_ids").flatten().to_numpy()
            at = np.cumsum(n) - n  # of each document among the batch's ids
            first, last = place // window, (place + n - 1) // window
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(sequence * window, place[row])
            end = np.minimum((sequence + 1) * window, (place + n)[row])
            start, length = begin - place[row], end - begin
            cuts = at[row] + start
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length),
                pa.array([crc(ids[a : a + k]) for a, k in zip(cuts, length)], pa.int64()),
                pa.array(n[row]), pa.array(sequence), pa.array(begin - sequence * window),
                pa.ListArray.from_arrays(pa.array(np.append(cuts, len(ids)), pa.int32()), ids),
            ], list(_PIECE))
        give_back()


def _gather(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of pieces of one window as one row; the last run is held for the next batch."""
    def rows(batch: pa.RecordBatch, begins: np.ndarray) -> pa.RecordBatch:
        parts = pa.StructArray.from_arrays([batch.column(c) for c in _IN_SEQUENCE], _IN_SEQUENCE)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, batch.num_rows), pa.int32()), parts)
        return pa.RecordBatch.from_arrays([batch.column("sequence_id").take(pa.array(begins)), lists], ["sequence_id", "pieces"])

    held = None
    for batch in pieces:
        batch = batch.select(["sequence_id", *_IN_SEQUENCE])
        batch = pa.concat_batches([held, batch]) if held is not None else batch
        if not batch.num_rows:
            continue
        begins = np.append(0, np.flatnonzero(np.diff(batch.column("sequence_id").to_numpy())) + 1)
        held = batch.slice(begins[-1])
        if begins[-1]:
            yield rows(batch.slice(0, begins[-1]), begins[:-1])
    if held is not None and held.num_rows:
        yield rows(held, np.array([0]))


def _put_together(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows of placed documents. Workers that have encoded the texts give that memory back first."""
    forget()
    return _gather(_cut(batches, window))


def sequences(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, starts, lengths, token_ids), one row per window.

    Windows wholly read by one task are put together there. What a task holds of its first and
    last window is a boundary record; those are grouped by window, at most ``window`` ids each.
    """
    fields = ", ".join(f"{c}:{_PIECE[c]}" for c in _IN_SEQUENCE)
    parts = _placed(docs, vocabulary).mapInArrow(
        lambda batches: _put_together(batches, window), f"sequence_id long, pieces array<struct<{fields}>>")
    full = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    parts = parts.withColumn("n_tokens", full)
    whole = parts.where(F.col("n_tokens") == window).select("sequence_id", "pieces")
    edges = parts.where(F.col("n_tokens") < window).groupBy("sequence_id").agg(
        F.array_sort(F.flatten(F.collect_list("pieces"))).alias("pieces"))
    return whole.unionByName(edges).select(
        "sequence_id", full.alias("n_tokens"),
        F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.start").alias("starts"),
        F.col("pieces.length").alias("lengths"), F.flatten("pieces.token_ids").alias("token_ids"),
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pieces(documents(spark, sf_dir)).drop("token_ids")
