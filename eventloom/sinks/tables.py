"""File sinks: per-table TSV, untracked events, manifests, and loading back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.text import unquote_field
from eventloom.operators.classify import UNTRACKED, WRITTEN, to_tsv_line
from eventloom.operators.schemas import TableSchema

ROWS_PER_FILE = 2_000_000


def of_route(rows: DataFrame, route: str) -> DataFrame:
    """Rows of one route of a stored table, by its partition folders; other rows as they are."""
    return rows.where(F.col("route") == route) if "route" in rows.columns else rows


def table_rows(rows: DataFrame) -> DataFrame:
    """Rows of tracked events, a skipped column included."""
    return of_route(rows, "tables").where(F.col("status").isin(*WRITTEN))


def untracked_rows(rows: DataFrame) -> DataFrame:
    return of_route(rows, "untracked").where(F.col("status") == UNTRACKED)


def write_tables(
    rows: DataFrame, path: str, *, run_tag: str | None = None, rows_per_file: int = ROWS_PER_FILE,
    mode: str = "append",
) -> str:
    """Gzip TSV files under ``event=…/version=…/``.

    REBALANCE groups rows of a table into few files and, unlike a plain hash repartition,
    splits a table that holds most of the rows over many tasks.
    """
    out = f"{path}/run_tag={run_tag}" if run_tag else path
    lines = table_rows(rows).select("event", "version", to_tsv_line(F.col("cells")).alias("value"))
    (
        lines.hint("rebalance", "event", "version")
        .write.mode(mode)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("event", "version")
        .text(out)
    )
    return out


def write_untracked(rows: DataFrame, path: str, *, rows_per_file: int = ROWS_PER_FILE, mode: str = "append") -> str:
    """Untracked events as gzip JSON lines."""
    (
        untracked_rows(rows).select(F.col("dump").alias("value"))
        .hint("rebalance")
        .write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )
    return path


# ---------------------------------------------------------------- manifests and file names


def file_event(path: Column) -> Column:
    """Event name: text after the last slash up to the first dot."""
    return F.regexp_extract(path, r"([^/.]*)([.][^/]*)?$", 1)


def file_version(path: Column) -> Column:
    """Event version: the number after the last ``.v``, up to the next dot."""
    return F.regexp_extract(path, r"^.*[.]v([^.]*)", 1).try_cast("int")


def folder_value(path: Column, key: str) -> Column:
    """Value of a ``key=…`` folder as it was written, never as a number Spark takes it for."""
    raw = F.regexp_extract(path, f"/{key}=([^/]*)/", 1)
    once = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))  # the path is a URI
    return F.url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))  # the folder's own escapes


def build_manifest(spark: SparkSession, path: str, *, untracked: bool = False) -> DataFrame:
    """One row per written file: ``key_name, table_name, table_version, n_rows, n_bytes``.

    Table and version come from the partition folders, or from the file name where files
    lie flat.  Untracked files carry their key only.
    """
    read = spark.read.text(path)
    key = F.col("_metadata.file_path")
    if untracked:
        name, version = F.lit(None).cast("string"), F.lit(None).cast("int")
    elif "event" in read.columns:
        name, version = folder_value(key, "event"), folder_value(key, "version").try_cast("int")
    else:
        name, version = file_event(key), file_version(key)
    files = read.select(
        key.alias("key_name"), name.alias("table_name"), version.alias("table_version"),
        F.col("_metadata.file_size").alias("_size"),
    )
    return files.groupBy("key_name", "table_name", "table_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("_size").alias("n_bytes")
    )


# ---------------------------------------------------------------- loading


def column_width(options: str) -> int | None:
    """Width in a creation option such as ``(32) distkey``."""
    found = re.search(r"\(\s*(\d+)\s*\)", options or "")
    return int(found.group(1)) if found else None


def _truncated(value: Column, width: int) -> Column:
    """Longest prefix of whole characters within ``width`` bytes."""
    fits = F.octet_length(value) <= width
    # Only text over the width is measured character by character.
    chars = F.split(value, "")
    cut = F.aggregate(
        chars,
        F.struct(F.lit("").alias("text"), F.lit(True).alias("open")),
        lambda acc, ch: F.struct(
            F.when(
                acc["open"] & (F.octet_length(acc["text"]) + F.octet_length(ch) <= width),
                F.concat(acc["text"], ch),
            ).otherwise(acc["text"]).alias("text"),
            (acc["open"] & (F.octet_length(acc["text"]) + F.octet_length(ch) <= width)).alias("open"),
        ),
        lambda acc: acc["text"],
    )
    return F.when(fits, value).otherwise(cut)


def load_tsv(spark: SparkSession, path: str, schema: TableSchema) -> DataFrame:
    """Typed rows of one table from its TSV files, with the load rules of the warehouse.

    Quotes and escapes are removed, missing trailing columns are NULL, empty fields are
    NULL, invalid UTF-8 becomes ``?``, trailing blanks go, text is cut to the column width,
    and a number that does not fit its column is NULL.
    """
    line = F.col("value")
    repaired = F.replace(F.make_valid_utf8(line), F.lit("\ufffd"), F.lit("?"))
    fields = F.split(F.when(F.is_valid_utf8(line), line).otherwise(repaired), "\t")
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(schema.columns):
        seen[c.outbound] = seen.get(c.outbound, 0) + 1
        name = c.outbound if seen[c.outbound] == 1 else f"{c.outbound}_{seen[c.outbound]}"
        text = unquote_field(F.get(fields, F.lit(i)))
        text = F.nullif(F.rtrim(text), F.lit(""))
        width = column_width(c.options)
        if c.sql_type == "string":
            value = _truncated(text, width) if width else text
        elif c.sql_type == "double":
            value = F.regexp_replace(text, "^[+]?(-?)Inf$", "$1Infinity").try_cast("double")
        else:
            value = text.try_cast(c.sql_type)
        out.append(value.alias(name))
    return spark.read.text(path).select("value").select(*out)


# Characters Spark writes as %XX in the folder name of a partition.
ESCAPED_IN_FOLDERS = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def table_folder(path: str, schema: TableSchema) -> str:
    """Folder ``write_tables`` gives one table."""
    name = "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS else c for c in schema.event)
    return f"{path}/event={name}/version={schema.version}"
