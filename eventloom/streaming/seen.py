"""Sliding-window dedupe of a glob stream with keyed state.

A stream is deduped in three steps. Each task first joins the sightings of a key that follow each
other within the time to live into one run (its first row, the arrivals of its first and last
sighting): only the first can survive, and any sighting within reach of the run is within reach of one
of its members. So a hot key sends one row per run and task, not one per sighting. Then the state of a
key, the arrival of its last sighting, settles the runs in order of arrival. It is dropped at the end of the time
to live, once the watermark has passed. Keys are dealt over ``LANES`` lanes, whose state and timer are handled at
once; a call per key took most of the time. State lives in RocksDB (see ``session``), backed by the checkpoint, by lane, with
a version per batch: a batch that runs again, or a stream that is started again, finds what the batch
before had left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventloom.operators.dedupe import DEFAULT_TTL_SECONDS

#: Start of the key of a row that has none: it meets no other row and leaves no state.
OWN = "\x00"
#: Groups of keys whose state is read and written at once: a task is called per lane, whatever the number of keys.
LANES = 4096
_RUN = "glob_key string, first bigint, last bigint, tie bigint, arrived boolean, value binary"
_KEPT = "glob_key string, first bigint, arrived boolean, value binary"


class LastSighting(StatefulProcessor):
    """Keeps the runs of a key that start over a time to live after its last sighting.

    The state of a lane is a list of its keys that are still within reach, so a key costs no call of its own.
    """

    def __init__(self, ttl_micros: int):
        self.ttl = ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "glob_key string, last bigint")
        self.due = handle.getValueState("due", "due bigint")

    def _expiry(self, last: int) -> int:
        return (last + self.ttl) // 1000 + 1

    def _set(self, seen: dict[str, int]) -> None:
        """Stores the lane's keys, with a timer at the end of the first of them."""
        was = self.due.get()[0] if self.due.exists() else None
        due = self._expiry(min(seen.values())) if seen else None
        if due is None:
            self.seen.clear()
            self.due.clear()
        else:
            self.seen.put(list(seen.items()))
            self.due.update((due,))
        if due != was:
            if was is not None:
                self.handle.deleteTimer(was)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues):
        # The runs of the lane's keys in one micro-batch, in order of arrival.
        runs = pd.concat(rows).sort_values(["first", "tie"], kind="stable")
        before = {k: last for k, last in self.seen.get()} if self.seen.exists() else {}
        reach: dict[str, int] = {}  # the latest sighting of the key's runs so far, which all start before this one
        kept = []
        for name, first, end in zip(runs["glob_key"].tolist(), runs["first"].tolist(), runs["last"].tolist()):
            if name.startswith(OWN):
                kept.append(True)
                continue
            again = name in before and abs(first - before[name]) <= self.ttl
            again |= name in reach and first - reach[name] <= self.ttl
            kept.append(not again)
            reach[name] = max(reach.get(name, end), end)
        if reach:
            self._set(before | {k: max(last, before.get(k, last)) for k, last in reach.items()})
        yield runs.loc[np.array(kept), ["glob_key", "first", "arrived", "value"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # All keys the watermark has passed, not only the first.
        end = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        self.due.clear()  # its timer is the one that has ended
        self._set({k: last for k, last in self.seen.get() if self._expiry(last) >= end})
        return iter(())

    def close(self) -> None:
        pass


def runs_of(sightings: DataFrame, ttl_micros: int) -> DataFrame:
    """Runs of each key, as far as an Arrow batch shows them; rows without a key are runs of their own."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pc.equal(batch.column("glob_key"), "").to_numpy(zero_copy_only=False)
            own |= ~batch.column("arrived").to_numpy(zero_copy_only=False)
            names = [OWN + uuid.uuid4().hex if alone else k for k, alone in zip(batch.column("glob_key").to_pylist(), own)]
            table = pa.table({
                "glob_key": pa.array(names, pa.string()), "first": batch.column("first"),
                "tie": batch.column("tie"), "place": np.arange(batch.num_rows)})
            table = table.sort_by([("glob_key", "ascending"), ("first", "ascending"), ("tie", "ascending")])
            at = table.column("first").to_numpy()
            key = table.column("glob_key").combine_chunks().dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (at[1:] - at[:-1] > ttl_micros)))
            ends = np.append(starts[1:], len(at)) - 1
            rows = table.take(pa.array(starts)).combine_chunks()
            source = batch.take(rows.column("place").combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [rows.column("glob_key").combine_chunks(), rows.column("first").combine_chunks(), pa.array(at[ends]),
                 rows.column("tie").combine_chunks(), source.column("arrived"), source.column("value")],
                ["glob_key", "first", "last", "tie", "arrived", "value"])

    return sightings.mapInArrow(join, _RUN)


def dedupe_stream(globs: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS, delay: str = "0 seconds") -> DataFrame:
    """Globs (``value, arrival, glob_key``) of a stream that are not repeats, by the rule of ``dedupe_globs``.

    State of a key ends when the watermark, ``delay`` behind the latest arrival, is a time to live past its
    last sighting. No row is dropped for being late: one whose key has no state any more is kept. Rows with
    an empty key or without an arrival are all kept. A row that arrives before its key's last sighting is a
    repeat if they are within the time to live of each other.
    """
    clocked = globs.withWatermark("arrival", delay)
    # Plain numbers carry no watermark, so the state operator takes late rows too.
    plain = clocked.select(
        F.coalesce("glob_key", F.lit("")).alias("glob_key"), F.coalesce(F.unix_micros("arrival"), F.lit(0)).alias("first"),
        F.xxhash64("value", "arrival", "glob_key").alias("tie"), F.col("arrival").isNotNull().alias("arrived"), "value")
    runs = runs_of(plain, ttl_seconds * 1_000_000)
    laned = runs.withColumn("lane", F.pmod(F.xxhash64("glob_key"), F.lit(LANES)).cast("int"))
    kept = laned.groupBy("lane").transformWithStateInPandas(
        LastSighting(ttl_seconds * 1_000_000), _KEPT, outputMode="append", timeMode="EventTime")
    own = F.col("glob_key").startswith(OWN)
    return kept.select(
        "value", F.when(F.col("arrived"), F.timestamp_micros("first")).alias("arrival"),
        F.when(own, F.lit("")).otherwise(F.col("glob_key")).alias("glob_key"))
