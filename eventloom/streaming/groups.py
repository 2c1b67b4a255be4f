"""Groups of stream entries that close by size, count or age, whichever comes first.

The open group of a stream is keyed state: its entries, their bytes and the time of its first one. An entry
that would not fit closes it, as does an entry that arrives ``max_age`` after the first; a timer closes it
where none arrives. Limits belong to the stream and travel with its entries.

A stream is spread over ``lanes``, each with an open group of its own, as a stream of many entries would have
one in each worker: no task holds more than a lane, however hot the stream. One lane keeps a stream's order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventloom.operators.fanout import BROADCAST_SPECS
from eventloom.operators.pack import NO_LIMIT, deflate

_IN = ["at", "entry", "max_size", "max_entries", "max_age"]
_OUT = "stream string, lane int, first bigint, entries int, bytes bigint, closed_by string, value array<string>"
#: Units of configured ages, in milliseconds: fixed values.
UNITS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000}


def age_millis(text: Column) -> Column:
    """Milliseconds of an age such as ``1s``, ``1m30s`` or ``500ms``; NULL for text that is none."""
    parts = F.regexp_extract_all(text, F.lit(r"([0-9]+(?:[.][0-9]+)?)(ms|s|m|h)"), F.lit(0))
    unit = lambda p: F.regexp_extract(p, "[a-z]+$", 0)
    scale = lambda p: F.element_at(F.create_map(*[F.lit(v) for kv in UNITS.items() for v in kv]), unit(p))
    total = F.aggregate(parts, F.lit(0.0), lambda sum, p: sum + F.regexp_extract(p, "^[0-9.]+", 0).cast("double") * scale(p))
    return F.when(text.rlike(r"^([0-9]+([.][0-9]+)?(ms|s|m|h))+$"), total.cast("bigint"))


def with_limits(entries: DataFrame, sinks: DataFrame, section: str = "Batcher") -> DataFrame:
    """``entries`` (``stream, arrival, entry``) with the configured limits of their stream, of its ``Globber``
    (no limit of entries) or ``Batcher``; what a sink leaves out has the defaults of ``StreamConfig`` and 1 s."""
    text = F.to_json("settings")
    given = lambda key: F.get_json_object(text, f"$.{section}.{key}")
    most = F.coalesce(given("MaxEntries").cast("bigint"), F.lit(NO_LIMIT if section == "Globber" else 500))
    limits = sinks.select(
        F.col("settings.StreamName").alias("stream"), F.coalesce(given("MaxSize").cast("bigint"), F.lit(990_000)).alias("max_size"),
        most.alias("max_entries"), F.coalesce(age_millis(given("MaxAge")), F.lit(1000)).alias("max_age")).dropDuplicates(["stream"])
    return entries.join(F.broadcast(limits) if limits.count() <= BROADCAST_SPECS else limits, "stream")


class OpenGroup(StatefulProcessor):
    """The open group of one lane of a stream. ``by_event``: entries carry the time, and the watermark is the
    clock; else the clock of the machine is."""

    def __init__(self, by_event: bool):
        self.by_event = by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getListState("entries", "entry string")
        self.open = handle.getValueState("open", "first bigint, bytes bigint, due bigint")

    def _group(self, key, first, entries, size, reason) -> tuple:
        return (key[0], key[1], first, len(entries), size, reason, entries)

    def _frame(self, groups: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(groups, columns=[c.split()[0] for c in _OUT.split(", ")])

    def handleInputRows(self, key, rows, timerValues):
        was = self.open.get() if self.open.exists() else None
        first, size, due = was if was else (0, 0, None)
        held = [r[0] for r in self.entries.get()] if was else []
        now, done = timerValues.getCurrentProcessingTimeInMs(), []
        frame = pd.concat(rows).sort_values(["at", "entry"], kind="stable")
        for at, entry, max_size, max_entries, max_age in frame[_IN].itertuples(index=False):
            at, length = int(at) if self.by_event else now, len(entry.encode())
            full = held and (size + length > max_size or max_entries != NO_LIMIT and len(held) >= max_entries)
            aged = held and at >= first + max_age
            if full or aged:
                done.append(self._group(key, first, held, size, "age" if aged else "size"))
                held, size = [], 0
            if not held:
                first = at
            held.append(entry)
            size += length
        if due is not None:
            self.handle.deleteTimer(due)
        due = int(first + frame["max_age"].iloc[-1])
        self.handle.registerTimer(due)
        self.entries.put([(e,) for e in held])
        self.open.update((first, size, due))
        yield self._frame(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        first, size, _ = self.open.get()
        held = [r[0] for r in self.entries.get()]
        self.open.clear()
        self.entries.clear()
        yield self._frame([self._group(key, first, held, size, "age")])

    def close(self) -> None:
        pass


def grouped_by_age(entries: DataFrame, *, lanes: int = 1, delay: str = "0 seconds", by_event: bool = False) -> DataFrame:
    """Closed groups ``stream, lane, first, entries, bytes, closed_by, value ARRAY<STRING>`` of a stream of
    ``stream, arrival, entry, max_size, max_entries, max_age`` (milliseconds). NULL entries are left out.

    Ages are told by the clock of the machine, or with ``by_event`` by the arrivals, ``delay`` behind the latest.
    A group stays open until it is full or old: state under the checkpoint, found again by a restart.
    """
    clocked = entries.where(F.col("entry").isNotNull())
    clocked = clocked.withWatermark("arrival", delay) if by_event else clocked
    lane = F.pmod(F.xxhash64("entry", "arrival"), F.lit(lanes)).cast("int")
    rows = clocked.select(
        F.coalesce("stream", F.lit("")).alias("stream"), lane.alias("lane"), F.coalesce(F.unix_millis("arrival"), F.lit(0)).alias("at"),
        "entry", *(F.col(c).cast("bigint").alias(c) for c in ("max_size", "max_entries", "max_age")))
    return rows.groupBy("stream", "lane").transformWithStateInPandas(
        OpenGroup(by_event), _OUT, outputMode="append", timeMode="EventTime" if by_event else "ProcessingTime")


def packed_group(group: Column) -> Column:
    """The glob of a group's entries."""
    @F.pandas_udf("binary")
    def glob(values: pd.Series) -> pd.Series:
        return values.map(lambda own: deflate(b"[" + ",".join(np.asarray(own, object).tolist()).encode() + b"]"))

    return glob(group)
