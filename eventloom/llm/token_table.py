"""Documents as token ids: one narrow pass, then a table whose rows know their place.

``tokenized`` encodes every whole text where its partition is read (no shuffle). Each row carries
``part`` (the task's partition), ``local_start`` (ids before it in that partition) and ``n_tokens``,
so that after one sum per partition every row knows its place among all ids: the first pass of a
two-pass prefix sum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import text_slices
from eventloom.llm.token_ids import END_ID, default_vocabulary, encoder

#: Rows of partition totals per prefix-sum task; totals of totals are summed above that.
TOTALS_BLOCK = 10_000
#: Partition bases are broadcast up to so many rows (16 bytes each), else joined by a shuffle.
BROADCAST_PARTS = 1_000_000


def crc(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def tokenized(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, part, local_start, n_tokens, token_ids) of every row of ``docs``.

    ``token_ids`` (array<int>) ends with ``end_id``; a null text is empty, so it has that id alone.
    Repeated rows stay separate. Other columns of ``docs`` are not carried.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, part int, local_start long, n_tokens long, token_ids array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before, part = encoder(vocabulary), 0, TaskContext.get().partitionId()
        for batch in batches:
            for piece in text_slices(batch):
                offsets, ids = words.encode(piece.column("text"))
                n = len(offsets) - 1
                ids = np.insert(ids, offsets[1:], end_id).astype(np.int32)
                offsets = offsets + np.arange(n + 1)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(np.full(n, part, np.int32)),
                    pa.array(before + offsets[:-1]), pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(offsets.astype(np.int32), ids),
                ], ["doc_id", "part", "local_start", "n_tokens", "token_ids"])
                before += int(offsets[-1])

    return rows.mapInArrow(encode, schema)


def part_bases(tokens: DataFrame) -> DataFrame:
    """(part, base): ids in all partitions before each; blocks of partitions are summed apart."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    totals = totals.withColumn("block", F.floor(F.col("part") / TOTALS_BLOCK))
    blocks = totals.groupBy("block").agg(F.sum("total").alias("block_total"))
    # One row per TOTALS_BLOCK partitions: a few hundred rows at any size of data.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("block_total").over(before), F.lit(0)).alias("block_base"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(blocks, "block").select(
        "part",
        (F.col("block_base") + F.coalesce(F.sum("total").over(inside), F.lit(0))).alias("base"),
    )


def placed(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``start``: ids of all rows before each, in partition and row order."""
    bases = part_bases(tokens)
    parts = tokens.agg(F.max("part")).first()[0]
    if (parts or 0) < BROADCAST_PARTS:
        bases = F.broadcast(bases)
    return tokens.join(bases, "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base")
