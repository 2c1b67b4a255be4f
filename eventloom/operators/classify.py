"""Classification, record and line of every event: the collate step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions import text
from eventloom.functions.variants import is_object, let, pinned
from eventloom.operators.lookups import BROADCAST_LIMIT
from eventloom.operators.project import (
    MAX_COMPILED_COLUMNS, PLAN_SCHEMA, CellPlan, attach_lookups, with_cells,
)
from eventloom.operators.schemas import TableSchema

# Status codes and their texts.
STATUS_TEXT = {
    0: "Success",
    1: "Malformed Data",
    2: "Untracked Event",
    3: "Badly Typed Columns",
    4: "Failed To Write",
    5: "Empty Request",
    6: "Missing One or More Columns",
    7: "Unknown Failure",
    8: "Panicked in Processing",
    9: "Failed in Transport",
}
SUCCESS, UNABLE_TO_PARSE, UNTRACKED, EMPTY_REQUEST, SKIPPED_COLUMN, PANICKED = 0, 1, 2, 5, 6, 8
WRITTEN = (SUCCESS, SKIPPED_COLUMN)
UNKNOWN_CATEGORY = "Unknown"
EDGE_TYPES = ("internal", "external")


def status_text(status: Column) -> Column:
    out = F.lit(STATUS_TEXT[7])
    for code, label in STATUS_TEXT.items():
        out = F.when(status == code, F.lit(label)).otherwise(out)
    return out


def join_schema(events: DataFrame, plan: CellPlan) -> DataFrame:
    """Left join to the schemas; ``tracked`` says whether the event has one.

    The schemas were compiled on the driver, so their size is known: they are broadcast
    within the limit, beyond it the join is left to the optimizer.
    """
    table = events.sparkSession.createDataFrame(plan.rows(), PLAN_SCHEMA).withColumn("tracked", F.lit(True))
    return (
        events.join(F.broadcast(table) if plan.size() <= BROADCAST_LIMIT else table, "event", "left")
        .withColumn("version", F.coalesce("version", F.lit(0)))
        .withColumn("tracked", F.coalesce("tracked", F.lit(False)))
    )


def collate(
    events: DataFrame,
    schemas: dict[str, TableSchema],
    *,
    geo: DataFrame | None = None,
    asn: DataFrame | None = None,
    logins: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Decoded events to collated rows: one output row per input row.

    Adds ``status``, ``category`` (event name the row is filed under), ``version``,
    ``cells`` (see ``project``), ``names`` and ``lookups``; ``dump`` is the JSON text of an
    untracked event.  The plan is narrow except for lookup tables too big to broadcast.
    """
    compiled_limit = options.pop("max_compiled_columns", MAX_COMPILED_COLUMNS)
    plan = CellPlan(schemas)
    rows = join_schema(events, plan)
    props = F.col("properties")
    # Settled before any property is read; NULL goes on to the projection.
    early = (
        F.when(F.col("failure") != 0, F.col("failure"))
        .when(F.col("event") == "", F.lit(EMPTY_REQUEST))
        .when(~F.col("tracked"), F.lit(UNTRACKED))
        .when(F.is_variant_null(props), F.lit(PANICKED))
        .when(~F.coalesce(is_object(props), F.lit(False)), F.lit(EMPTY_REQUEST))
    )
    rows = rows.withColumn("_early", pinned(early))
    rows = attach_lookups(rows, schemas, geo=geo, asn=asn, logins=logins, **options)
    rows = with_cells(rows, plan, compiled_limit)
    status = F.coalesce(
        F.col("_early"),
        F.when(F.exists("cells", lambda c: c.isNull()), F.lit(SKIPPED_COLUMN)).otherwise(F.lit(SUCCESS)),
    )
    rows = rows.withColumn("status", pinned(status))
    done = F.col("_early").isNull()
    unnamed = F.col("status").isin(EMPTY_REQUEST, PANICKED)
    panicked = F.col("status") == PANICKED
    return rows.select(
        "event",
        F.when(unnamed, F.lit(UNKNOWN_CATEGORY)).otherwise(F.col("event")).alias("category"),
        F.when(panicked, F.lit(0)).otherwise(F.col("version")).alias("version"),
        F.when(panicked, F.lit("error")).otherwise(F.col("uuid")).alias("uuid"),
        "event_time",
        "received_at",
        "edge_type",
        "status",
        F.when(done, F.col("names")).alias("names"),
        F.when(done, F.col("cells")).alias("cells"),
        F.when(done, F.col("lookups")).alias("lookups"),
        F.when(F.col("status") == UNTRACKED, dump_text(F.col("event"), props)).alias("dump"),
    )


def dump_text(event: Column, properties: Column) -> Column:
    """``{"event":…,"properties":…}`` of an untracked event; JSON-equal to what came in."""
    fields = F.struct(event.alias("event"), F.coalesce(properties, F.parse_json(F.lit("null"))).alias("properties"))
    return F.to_json(fields)


def category(rows_category: Column, version: Column) -> Column:
    return F.concat(rows_category, F.lit(".v"), version.cast("string"))


def to_tsv_line(cells: Column) -> Column:
    """Tab-separated quoted fields; a skipped column is an empty field."""
    return F.array_join(F.transform(cells, text.quote_field), "\t")


def to_record(names: Column, cells: Column) -> Column:
    """``MAP<name, text>`` without empty values; of a repeated name the last value stays."""
    pairs = F.arrays_zip(names.alias("name"), cells.alias("cell"))

    def build(filled: Column) -> Column:
        last = F.filter(
            filled,
            lambda e, i: ~F.exists(
                F.slice(filled, i + 2, F.greatest(F.size(filled) - i - 1, F.lit(0))),
                lambda later: later["name"] == e["name"],
            ),
        )
        repeated = F.size(F.array_distinct(names)) < F.size(names)
        return F.map_from_entries(F.when(repeated, last).otherwise(filled))

    return let(F.filter(pairs, lambda e: e["cell"] != ""), build)


def with_record(rows: DataFrame) -> DataFrame:
    return rows.withColumn("record", pinned(to_record(F.col("names"), F.col("cells"))))


def with_line(rows: DataFrame) -> DataFrame:
    """TSV line of a written row, dump of an untracked one, '' otherwise."""
    line = F.when(F.col("status").isin(*WRITTEN), to_tsv_line(F.col("cells"))).when(
        F.col("status") == UNTRACKED, F.col("dump")
    )
    return rows.withColumn("line", F.coalesce(line, F.lit("")))


def outcomes(rows: DataFrame) -> DataFrame:
    """Column outcomes as ``event, outcome``: one row per column and per lookup detail."""
    per_column = F.transform(
        "cells", lambda c: F.when(c.isNull(), F.lit("skippedColumn")).otherwise(F.lit("success"))
    )
    details = F.transform(
        F.coalesce(F.col("lookups"), F.array().cast("array<string>")),
        lambda d: F.concat(F.lit("cache."), d),
    )
    return rows.where(F.col("cells").isNotNull()).select(
        "event", F.explode(F.concat(per_column, details)).alias("outcome")
    )
