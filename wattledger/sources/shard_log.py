"""A log of keyed messages in shards, as a Spark data source.

A write has one commit, and a repeated batch adds nothing. Messages of a shard have positions without gaps, in the order
asked for. Readers, batch and stream, work by position: a stream keeps one per shard, starts at the earliest or latest
one or at a time, and can bound the rows of a shard in a micro-batch. Columns are those of Kafka messages, so
`record_sets.from_kafka` reads them. Any URI that `pyarrow.fs` knows will do for a path. A log has one writer at a time.

Under the path, `segments` holds parquet files of one shard each and `commits` one JSON file per commit: its segments,
and for each shard the position after it. Segments that no commit names, left by failed tasks, are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "shard_log"
#: Rows of a segment, which is what a task holds in memory, and of a task that reads. Few, so that the rows of one shard in
#: a bounded batch, and the files that a stream writes from them, still keep many cores busy.
SEGMENT_ROWS = TASK_ROWS = 100_000

_TIME = pa.timestamp("us", tz="UTC")
_STORED = pa.schema([("timestamp", _TIME), ("key", pa.string()), ("value", pa.string())])
_READ = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), *_STORED])
SCHEMA = "partition int, offset bigint, timestamp timestamp, key string, value string"


@dataclass
class Segment:
    shard: int
    file: str
    rows: int
    until: int | None  # greatest time in it, in microseconds
    first: int = 0  # position of its first row


class Log:
    """Commits of a log. Each is read once."""

    def __init__(self, path: str):
        self.fs, root = fs.FileSystem.from_uri(path)
        self.segments, self.commits = f"{root}/segments", f"{root}/commits"
        self._known: dict[int, dict] = {}

    def versions(self) -> list[int]:
        found = self.fs.get_file_info(fs.FileSelector(self.commits, allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def at(self, version: int) -> dict:
        if version not in self._known:
            with self.fs.open_input_stream(f"{self.commits}/{version:020d}.json") as source:
                commit = json.loads(source.read())
            commit["segments"] = [Segment(**s) for s in commit["segments"]]
            self._known[version] = commit
        return self._known[version]

    def last(self) -> dict:
        versions = self.versions()
        return self.at(versions[-1]) if versions else {"version": -1, "shards": None, "ends": {}, "batches": {}}

    def append(self, shards: int, segments: list[Segment], writer: str | None, batch: int | None) -> bool:
        """Commit the segments in the given order; False if this batch has been committed before."""
        last = self.last()
        if last["shards"] not in (None, shards):
            raise ValueError(f"the log has {last['shards']} shards, not {shards}")
        ends, batches = dict(last["ends"]), dict(last["batches"])
        if batch is not None:
            before = batches.get(writer, -1)
            if batch == before:
                return False
            if batch < before:
                raise ValueError(f"writer {writer!r} has already written batch {before}; use another name")
            batches[writer] = batch
        for s in segments:
            s.first = ends.get(str(s.shard), 0)
            ends[str(s.shard)] = s.first + s.rows
        version = last["version"] + 1
        commit = {"version": version, "shards": shards, "ends": ends, "batches": batches}
        commit["segments"] = [vars(s) for s in segments]
        self.fs.create_dir(self.commits)
        draft = f"{self.commits}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(commit).encode())
        self.fs.move(draft, f"{self.commits}/{version:020d}.json")
        return True

    def between(self, start: dict, end: dict) -> list[tuple[Segment, int, int]]:
        """(segment, from, to) by position within the segment, oldest first. Reads back no further than `start`."""
        out = []
        for version in reversed(self.versions()):
            commit = self.at(version)
            if all(n <= start.get(shard, 0) for shard, n in commit["ends"].items()):
                break
            for s in reversed(commit["segments"]):
                low = max(start.get(str(s.shard), 0) - s.first, 0)
                high = min(end.get(str(s.shard), 0) - s.first, s.rows)
                if low < high:
                    out.append((s, low, high))
        return out[::-1]

    def since(self, moment: int) -> dict:
        """Position in each shard of the first message whose time is not before the moment, else its end."""
        found: dict[int, Segment] = {}
        for version in reversed(self.versions()):
            for s in reversed(self.at(version)["segments"]):
                if s.until is not None and s.until >= moment:
                    found[s.shard] = s
        ends = dict(self.last()["ends"])
        for shard, s in found.items():
            times = self.table(s, ["timestamp"])["timestamp"].cast(pa.int64())
            ends[str(shard)] = s.first + pc.index(pc.fill_null(pc.greater_equal(times, moment), False), True).as_py()
        return ends

    def table(self, segment: Segment, columns: list[str] | None = None) -> pa.Table:
        return pq.read_table(f"{self.segments}/{segment.file}", columns=columns, filesystem=self.fs)


class _Part(InputPartition):
    def __init__(self, pieces: list[tuple[Segment, int, int]]):
        self.pieces = pieces


def _parts(pieces: list[tuple[Segment, int, int]]) -> list[_Part]:
    """Pieces in tasks of at most about TASK_ROWS rows; a shard is read by as many tasks as it needs."""
    parts, size = [], TASK_ROWS
    for piece in pieces:
        rows = piece[2] - piece[1]
        if size + rows > TASK_ROWS:
            parts.append(_Part([]))
            size = 0
        parts[-1].pieces.append(piece)
        size += rows
    return parts


def _read(path: str, part: _Part) -> Iterator[pa.RecordBatch]:
    log = Log(path)
    for segment, low, high in part.pieces:
        rows = log.table(segment).slice(low, high - low)
        shard = pa.array([segment.shard] * len(rows), pa.int32())
        offset = pa.array(range(segment.first + low, segment.first + high), pa.int64())
        yield from pa.table([shard, offset, *rows.columns], schema=_READ).to_batches()


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        log = Log(self.path)
        return _parts(log.between({}, log.last()["ends"])) or [_Part([])]

    def read(self, partition):
        return _read(self.path, partition)


def _microseconds(moment: str) -> int:
    at = datetime.fromisoformat(moment)
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return int(at.timestamp()) * 1_000_000 + at.microsecond


class _StreamReader(DataSourceStreamReader):
    """Offsets are {shard: position}. With a bound on rows, the end of the last planned batch is noted in `progress`,
    as Spark asks for the end of a batch without giving its start."""

    def __init__(self, path: str, start: str, rows: int | None, progress: str | None):
        if rows is not None and (rows < 1 or not progress):
            raise ValueError("rowsPerShard must be positive, and needs a folder `progress` beside the checkpoint")
        self.path, self.start, self.rows = path, start, rows
        self.progress = progress if rows is not None else None
        self.position: dict | None = None

    def _log(self) -> Log:
        # Kept by the driver only; tasks get a reader without one.
        if "log" not in self.__dict__:
            self.log = Log(self.path)
        return self.log

    def _note(self) -> tuple[fs.FileSystem, str]:
        where, root = fs.FileSystem.from_uri(self.progress)
        return where, f"{root}/planned.json"

    def _planned(self) -> dict | None:
        where, name = self._note()
        if where.get_file_info(name).type == fs.FileType.NotFound:
            return None
        with where.open_input_stream(name) as source:
            return json.loads(source.read())

    def _reached(self, end: dict) -> None:
        self.position = end
        if self.progress:
            where, name = self._note()
            where.create_dir(name.rpartition("/")[0], recursive=True)
            draft = f"{name}.{uuid.uuid4().hex}"
            with where.open_output_stream(draft) as out:
                out.write(json.dumps(end).encode())
            where.move(draft, name)

    def initialOffset(self) -> dict:
        if self.start == "earliest":
            first = {}
        elif self.start == "latest":
            first = self._log().last()["ends"]
        else:
            first = self._log().since(_microseconds(self.start))
        self._reached(first)
        return first

    def latestOffset(self) -> dict:
        ends = self._log().last()["ends"]
        if self.rows is None:
            return ends
        if self.position is None:
            self.position = self._planned()
        if self.position is None:
            return self.initialOffset()
        return {shard: min(end, self.position.get(shard, 0) + self.rows) for shard, end in ends.items()}

    def partitions(self, start: dict, end: dict):
        ends = self._log().last()["ends"]
        lost = [shard for shard, n in end.items() if n > ends.get(shard, 0)]
        back = [shard for shard, n in start.items() if n > end.get(shard, 0)]
        if lost or back:
            raise ValueError(f"shards {lost or back} end before the position of the stream")
        self._reached(end)
        return _parts(self._log().between(start, end)) or [_Part([])]

    def read(self, partition):
        return _read(self.path, partition)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "log"}


@dataclass
class _Written(WriterCommitMessage):
    task: int
    segments: list[Segment]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, shards: int, writer: str | None, batch: int | None):
        if (writer is None) != (batch is None):
            raise ValueError("options `writer` and `batch` go together")
        self.path, self.shards, self.writer, self.batch = path, shards, writer, batch

    def write(self, iterator):
        log, segments, held = Log(self.path), [], []
        log.fs.create_dir(log.segments, recursive=True)

        def put() -> None:
            if not held:
                return
            rows = pa.Table.from_batches(held)
            name = f"{uuid.uuid4().hex}.parquet"
            stored = rows.select(_STORED.names).cast(_STORED)
            pq.write_table(stored, f"{log.segments}/{name}", filesystem=log.fs)
            until = pc.max(stored["timestamp"].cast(pa.int64())).as_py()
            segments.append(Segment(held[0]["partition"][0].as_py(), name, len(rows), until))
            held.clear()

        for batch in iterator:
            # A batch is cut where the shard changes or a segment is full.
            shard = batch["partition"].to_numpy(zero_copy_only=False)
            low = 0
            while low < len(shard):
                if held and (held[0]["partition"][0].as_py() != shard[low] or sum(map(len, held)) >= SEGMENT_ROWS):
                    put()
                room = SEGMENT_ROWS - sum(map(len, held))
                same = (shard[low : low + room] == shard[low]).cumprod().sum()
                held.append(batch.slice(low, int(same)))
                low += int(same)
        put()
        return _Written(TaskContext.get().partitionId(), segments)

    def _delete(self, messages) -> None:
        log = Log(self.path)
        for m in messages:
            for s in m.segments if m else ():
                log.fs.delete_file(f"{log.segments}/{s.file}")

    def commit(self, messages):
        done = sorted((m for m in messages if m), key=lambda m: m.task)
        if not Log(self.path).append(self.shards, [s for m in done for s in m.segments], self.writer, self.batch):
            self._delete(done)

    def abort(self, messages):
        self._delete(messages)


class ShardLog(DataSource):
    """Options: path; reading as a stream `start` (earliest, latest or an ISO time, UTC unless it says otherwise),
    `rowsPerShard` with `progress`; writing `shards`, and `writer` with `batch` where a batch may be repeated."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def streamReader(self, schema):
        o, rows = self.options, self.options.get("rowsPerShard")
        return _StreamReader(o["path"], o.get("start", "earliest"), None if rows is None else int(rows), o.get("progress"))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a log only takes appends")
        o, batch = self.options, self.options.get("batch")
        return _Writer(o["path"], int(o["shards"]), o.get("writer"), None if batch is None else int(batch))


def append_messages(
    messages: DataFrame,
    path: str,
    shards: int,
    order: tuple[str, ...],
    writer: str | None = None,
    batch: int | None = None,
    timestamp: Column | None = None,
) -> None:
    """Append rows with `key` and `value` to a log, within each shard in the order of the given columns.

    Rows are parted by range of (shard, order, key), so a shard or key with very many rows is written by several tasks,
    and a message's place still follows the order. Nulls come first; a null key is a key. `timestamp` is the time of the
    write unless given. The ranges are sampled first, so the messages are computed twice: stage costly ones.
    """
    messages.sparkSession.dataSource.register(ShardLog)
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("_shard")
    by = [f"_order{i}" for i in range(len(order))]
    at = F.current_timestamp() if timestamp is None else timestamp
    rows = messages.select(
        shard, *[F.col(c).alias(b) for c, b in zip(order, by)], at.cast("timestamp").alias("_at"), "key", "value"
    )
    rows = rows.repartitionByRange("_shard", *by, "key").sortWithinPartitions("_shard", *by, "key", "value")
    out = rows.select(
        F.col("_shard").alias("partition"),
        F.lit(0).cast("long").alias("offset"),  # given by the commit
        F.col("_at").alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
    out = out.write.format(FORMAT).mode("append").option("path", path).option("shards", shards)
    if batch is not None:
        out = out.option("writer", writer).option("batch", batch)
    out.save()


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages committed so far."""
    spark.dataSource.register(ShardLog)
    return spark.read.format(FORMAT).load(path)


def stream_messages(
    spark: SparkSession,
    path: str,
    start: str = "earliest",
    rows_per_shard: int | None = None,
    progress: str | None = None,
) -> DataFrame:
    """Messages as they are committed. `rows_per_shard` bounds a micro-batch, and needs a folder `progress` that
    belongs to the stream, best beside its checkpoint."""
    spark.dataSource.register(ShardLog)
    stream = spark.readStream.format(FORMAT).option("start", start)
    if rows_per_shard is not None:
        stream = stream.option("rowsPerShard", rows_per_shard).option("progress", progress)
    return stream.load(path)
