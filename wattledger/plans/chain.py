"""The job over a long history, as a chain of runs, one per day of arrival."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.operators.ct import prune_ess
from wattledger.session import children, exists
from wattledger.sources.snapshots import FileTable
from wattledger.sources.uploads import DAY
from wattledger.streaming.job import WRITERS, MicroBatchJob


@dataclass
class DayChain:
    """Days in order, each over the state that the day before has left under `path`.

    Every upload is judged by the clock of its own arrival, so the outputs of all days together are those of
    one run over all uploads with `now=F.col("processed_at")`. A run reads one folder of uploads and the reference
    readings that its records can meet. A day is marked when all its outputs are written: a chain that was interrupted goes on
    with the first day without a mark, whose outputs and state are then written anew. Numbers of arrival ascend from day to day.
    """

    path: str
    systems: FileTable | Callable[[SparkSession], DataFrame]
    ess: FileTable | Callable[[SparkSession], DataFrame]
    outputs: tuple[str, ...] = tuple(WRITERS)
    ess_date_column: str | None = None
    writers: dict = field(default_factory=dict)
    options: dict = field(default_factory=dict)

    def done(self, spark: SparkSession) -> list[date]:
        """Days that are complete."""
        days = (name.partition("=")[2] for name in children(spark, f"{self.path}/days"))
        return sorted(date.fromisoformat(d) for d in days if exists(spark, f"{self.path}/days/day={d}/_SUCCESS"))

    def _ess(self, spark: SparkSession, day: date, number: int) -> DataFrame:
        start = int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp())
        if isinstance(self.ess, FileTable):
            table = self.ess.pinned(spark, f"{self.path}/inputs/ess/batch={number}")
        else:
            table = self.ess(spark)
        return prune_ess(table, start, self.ess_date_column, start + 86_399)

    def run(self, uploads: DataFrame, first: date, last: date) -> list[date]:
        """Run the days from `first` to `last`, both included, that are not complete; returns those that ran.

        `uploads` is a table written by `write_uploads`. `first` is the same in each call. A day without uploads runs
        too, and passes the state on.
        """
        spark = uploads.sparkSession
        done = self.done(spark)
        if done and done[0] != first:
            raise ValueError(f"this chain starts on {done[0]}")
        if uploads.where(F.col(DAY).isNull()).limit(1).count():
            raise ValueError("uploads without a time of arrival belong to no day")
        ran, number = [], len(done)
        for n in range(number, (last - first).days + 1):
            day = first + timedelta(days=n)
            job = MicroBatchJob(
                self.path,
                self.systems,
                lambda s, day=day, n=n: self._ess(s, day, n),
                now=F.col("processed_at"),
                outputs=self.outputs,
                options=self.options,
                writers=self.writers,
            )
            job(uploads.where(F.col(DAY) == F.lit(day)).drop("first_ts", "last_ts", DAY), n)
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/days/day={day}")
            ran.append(day)
        return ran
