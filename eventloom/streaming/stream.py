"""Structured Streaming: the batch operators inside ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.classify import collate
from eventloom.operators.decode import decode_edge_log, expand_globs, explode_events, inflate_globs
from eventloom.operators.schemas import TableSchema
from eventloom.plans.pipeline import Lookups, Sinks, store_collated, write_sinks
from eventloom.streaming.seen import dedupe_stream
from eventloom.streaming.sink_table import SinkTable


@dataclass
class Refreshable:
    """Configuration read again for each batch; a failed read keeps the last good value."""

    load: Callable[[], object]
    value: object = None
    failures: int = 0

    def get(self):
        try:
            self.value = self.load()
        except Exception:
            self.failures += 1
            if self.value is None:
                raise
        return self.value


@dataclass
class CollateStream:
    """One streaming job from globs (or record lines) to all sinks.

    Main path without a watermark on events: late events are never dropped, their time is the time
    of receipt.  Schemas and sinks are read again for every batch; with ``sink_table`` the streams are
    those of its version for the batch.  ``dedupe_seconds`` suppresses repeated globs by keyed state;
    None takes all globs.
    """

    schemas: Refreshable
    store_path: str
    sinks: Refreshable
    lookups: Callable[[], Lookups] = Lookups
    dedupe_seconds: int | None = None
    lines: bool = False
    sink_table: SinkTable | None = None
    on_batch: list[Callable[[DataFrame, int], None]] = field(default_factory=list)

    def _events(self, batch: DataFrame) -> DataFrame:
        return decode_edge_log(batch) if self.lines else explode_events(expand_globs(batch))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schemas: dict[str, TableSchema] = self.schemas.get()
        sinks: Sinks = self.sinks.get()
        streams = self.sink_table.at(spark, batch_id) if self.sink_table else sinks.streams
        rows = collate(self._events(batch), schemas, **self.lookups().as_options())
        # Folders named by batch id make a repeated batch overwrite its own output.
        stored = store_collated(rows, f"{self.store_path}/batch_id={batch_id}")
        own = lambda path: path and f"{path}/batch_id={batch_id}"
        per_batch = replace(
            sinks, tables=own(sinks.tables), untracked=own(sinks.untracked), stream_path=own(sinks.stream_path),
            request_path=own(sinks.request_path), streams=streams)
        write_sinks(stored, per_batch, mode="overwrite")
        for hook in self.on_batch:
            hook(stored, batch_id)

    def start(
        self, stream: DataFrame, checkpoint: str, *, max_age: str | None = None
    ) -> StreamingQuery:
        """Run until stopped, flushing every ``max_age``; without it, drain what is there."""
        if self.dedupe_seconds is not None and not self.lines:
            keyed = inflate_globs(stream.select("value", "arrival")).select("value", "arrival", "glob_key")
            stream = dedupe_stream(keyed, self.dedupe_seconds)
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        writer = writer.trigger(processingTime=max_age) if max_age else writer.trigger(availableNow=True)
        return writer.start()
