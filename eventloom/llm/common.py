"""Helpers the text operators share: input columns, word bytes, written intermediate tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every operator here: space and the ASCII controls 9 to 13. ``bytes.split()``
#: splits at the same six bytes, and ``bytes.lower()`` changes A-Z only. Java looks characters that are
#: named one by one up in a table, but tests range after range.
BLANKS = r"[\x20\x09\x0A\x0B\x0C\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder: later steps read it instead of computing it again,
    also after executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a lookup table that are broadcast whole, and the share of all rows from which on a key is hot.
SMALL_TABLE, HOT_SHARE = 100_000, 1000


def looked_up(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table``: one row per key, ``times`` being how many of ``rows`` hold it.

    Both are written tables. A small table is broadcast. Of a large one the keys that hold over a
    thousandth of all rows, which are under a thousand keys, are broadcast, so that no task gets a
    hot key's rows; the others are shuffled.
    """
    size, total = table.agg(F.count("*"), F.sum("times")).first()
    if size <= SMALL_TABLE:
        return rows.join(F.broadcast(table.drop("times")), on)
    hot = F.col("times") > F.lit(total // HOT_SHARE)
    often, seldom = (F.broadcast(table.where(hot).drop("times")), table.where(~hot).drop("times"))
    return rows.join(often, on).unionByName(rows.join(F.broadcast(table.where(hot).select(*on)), on, "left_anti").join(seldom, on))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` would also change other alphabets."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def word_codes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII blanks, as codes of the batch's distinct words.

    Returns (offsets, codes, distinct words): the codes of text i are
    ``codes[offsets[i]:offsets[i + 1]]``. Null is an empty text. The distinct words may hold the
    empty word, which blanks at the ends of a text leave; it never counts as a word.
    """
    # A copy from offset 0: ascii_lower misreads slices.
    texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = words.dictionary_encode()
    codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:
        kept = codes != empty
        before = np.concatenate([[0], np.cumsum(kept)])
        offsets, codes = before[offsets - offsets[0]], codes[kept]
    return offsets - offsets[0], codes, distinct


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = 2 << 20):
    """The batch in slices of about ``most`` bytes of text, at least one row each. Workers serve one stage after
    the other, so what the batch took is given back at its end instead of adding up."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most, side="right")))
        yield batch.slice(at, n)
        at += n
    give_back()


def give_back() -> None:
    """Unused memory of this worker back to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
