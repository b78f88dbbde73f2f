"""The whole job in micro-batches.

Each micro-batch runs the batch operators, with the keyed state of the batches before it.
So a stream gives the same rows as one batch over the same uploads, large devices are cut
as in a batch, and the metadata and reference tables are read afresh each time. A batch writes
the rows of the state that it has changed, and reads the state where its buckets lie, without a shuffle.

A batch writes to folders named after its id, its part of the state too; its clock and, for tables given as `FileTable`, the files it reads are written down
first. Repeating a batch after a failure therefore gives the same outcome, whatever has been added to those
tables meanwhile. The tables a batch stages are deleted when it ends.

Uploads may come as JSON payloads. Those that cannot be decoded, and records whose time is no number, go to the
output `quarantine`, and the others go on; `dropped` counts what each batch left out, and why.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattledger.plans import daily
from wattledger.schema import CT_STATE, MISS_STATE, SLOT_STATE
from wattledger.session import exists, first_time
from wattledger.sources import sinks
from wattledger.sources.increments import Increments
from wattledger.sources.snapshots import FileTable

WRITERS = {
    "energy": sinks.write_energy,
    "partner": sinks.write_partner,
    "dead_letters": sinks.write_dead_letters,
    "quality": sinks.write_table,
    "metrics": sinks.write_table,
    "quarantine": sinks.write_table,
}

_STATES = {"slots": SLOT_STATE, "ct": CT_STATE, "misses": MISS_STATE}
#: Columns that say when a row was last of use.
_AGES = {"slots": "slot", "ct": "valid_until", "misses": "expires_at"}


@dataclass
class MicroBatchJob:
    """What one micro-batch does. `systems` and `ess` are read anew for each batch: a `FileTable` as it was when
    the batch first began, any other function as it is.

    `outputs` names the tables to write under `path`, `writers` other writers for some of them, such
    as `sinks.message_writer`. State is kept for ever unless `state_max_age` (seconds before the
    run) is given; only expired misses go by themselves. `options` go to the batch job.

    `state_buckets` is the number of files of the state's folders, and of the tasks that join it: about
    the bytes of the state over 256 MB, or `spark.sql.shuffle.partitions`.
    """

    path: str
    systems: FileTable | Callable[[SparkSession], DataFrame]
    ess: FileTable | Callable[[SparkSession], DataFrame]
    now: int | None = None
    outputs: tuple[str, ...] = tuple(WRITERS)
    state_max_age: int | None = None
    options: dict = field(default_factory=dict)
    writers: dict = field(default_factory=dict)
    state_buckets: int = 64

    def _increments(self, name: str) -> Increments:
        schema = _STATES[name]
        return Increments(f"{self.path}/state/{name}", schema, schema.names[0], self.state_buckets)

    def _keep(self, name: str, now: int | None) -> Column | None:
        """What a batch with this clock leaves to the next."""
        return None if self.state_max_age is None else F.col(_AGES[name]) >= now - self.state_max_age

    def _read_state(self, spark: SparkSession, batch_id: int) -> daily.State:
        if batch_id == 0:
            return daily.State()
        last = batch_id - 1
        now = None if self.state_max_age is None else self._clock(spark, last)
        parts = {name: self._increments(name).at(spark, last, self._keep(name, now)) for name in _STATES}
        return daily.State(parts["slots"], parts["ct"], parts["misses"].read())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._read_state(spark, batch_id)
        now = self._clock(spark, batch_id)
        options = {"share": True, **self.options}
        tables = [self._table(spark, name, batch_id) for name in ("systems", "ess")]
        result = daily.run(batch, *tables, now, before, **options)
        try:
            self._write(result, batch_id, now)
        finally:
            result.close()

    def _table(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        source = getattr(self, name)
        if isinstance(source, FileTable):
            return source.pinned(spark, f"{self.path}/inputs/{name}/batch={batch_id}")
        return source(spark)

    def _clock(self, spark: SparkSession, batch_id: int) -> int:
        """The clock of a batch, written down so that a repeated batch has the same one."""
        if self.now is not None:
            return self.now
        return int(first_time(spark, f"{self.path}/clock/batch={batch_id}").timestamp())

    def _write(self, result: daily.Outputs, batch_id: int, now: int) -> None:
        writers = {**WRITERS, **self.writers}
        for name in self.outputs:
            writers[name](
                getattr(result, name), f"{self.path}/{name}/batch_id={batch_id}", "overwrite"
            )
        spark = result._looked_up.sparkSession
        counted = spark.createDataFrame(
            sorted(result.dropped.items()), "reason string, n bigint"
        )
        sinks.write_table(counted.coalesce(1), f"{self.path}/dropped/batch_id={batch_id}", "overwrite")
        for name in _STATES:
            state = self._increments(name)
            keep = self._keep(name, now)
            if name == "misses" and result.clock is not None:
                keep = F.col("expires_at") >= result.clock
            state.put(getattr(result.changed, name), batch_id, keep)
            if batch_id:
                state.tidy(spark, batch_id - 1)


def start(
    record_sets: DataFrame, job: MicroBatchJob, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start the job on a stream. Without `every` it handles what has arrived, then stops.

    The size of a micro-batch is bounded by the source's limit per trigger. A new checkpoint
    starts with empty state, so it is refused where an earlier stream has left its output.
    """
    spark = record_sets.sparkSession
    if exists(spark, f"{job.path}/state") and not exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{job.path} holds the output of a stream with another checkpoint")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        record_sets.writeStream.queryName("energy_deltas")
        .foreachBatch(job)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
