"""Token ids as Parquet list columns, sorted, encoded and cut so that parts can be read alone.

Rows are range-partitioned and sorted by doc_id. Ids of a vocabulary under 65,536 entries are
dictionary-encoded (a code takes 16 bits at most); the integer columns, which mostly rise, are
delta-encoded. Row groups have a bounded size, and page indexes (written by default) hold each
page's range of doc_id, so a reader of a few documents skips whole groups and pages, and a reader
of lengths never opens the list column.

Nulls: a null text is empty and keeps its end id; null doc_ids come first. Rows of one doc_id
follow each other by the hash of their text, then by the text; equal rows stay separate. An empty
table gives readable files without rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import documents, shared_folder
from eventloom.llm.token_table import crc, placed, tokenized

FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),  # bytes of a row group
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "v2",  # delta encoding where there is no dictionary
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode every text and write (doc_id, part, local_start, n_tokens, token_ids) to ``path``."""
    salt = F.xxhash64("text")  # many rows of one doc_id spread over partitions
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    rows = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", salt)
    rows = rows.sortWithinPartitions("doc_id", salt, "text")
    tokenized(rows, vocabulary).write.options(**FILE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``: ids of all documents before each, in doc_id order."""
    return placed(spark.read.parquet(path))


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the ids as read."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            ids, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            found = [crc(ids[a:b]) for a, b in zip(np.append(0, ends), ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(found, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(
        sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), path)
    return checksums(read_token_files(spark, path))
