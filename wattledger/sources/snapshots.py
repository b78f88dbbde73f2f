"""Tables of files pinned to the files they had at one time."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wattledger.session import exists


@dataclass(frozen=True)
class FileTable:
    """A folder of files in one format, whose files are added and never changed.

    Called with a session it is read as it is now. `pinned` reads the files that a manifest lists; the first call
    writes the manifest. A file that has gone since then fails the read, so a compaction must keep the files that
    unfinished batches have listed.
    """

    path: str
    fmt: str = "parquet"
    schema: T.StructType | str | None = None
    options: dict = field(default_factory=dict)

    def _reader(self, spark: SparkSession):
        reader = spark.read.format(self.fmt).options(**self.options)
        return reader if self.schema is None else reader.schema(self.schema)

    def __call__(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark).load(self.path)

    def pinned(self, spark: SparkSession, manifest: str) -> DataFrame:
        """The table with the files listed in the folder `manifest`. Its schema is that of the table now."""
        now = self(spark)
        if not exists(spark, f"{manifest}/_SUCCESS"):
            files = spark.createDataFrame([(unquote(f),) for f in now.inputFiles()], "file string")
            files.coalesce(1).write.mode("overwrite").parquet(manifest)
        listed = [r.file for r in spark.read.schema("file string").parquet(manifest).collect()]
        if not listed:
            return spark.createDataFrame([], now.schema)
        # The base path keeps partition columns, which are names of folders.
        return self._reader(spark).schema(now.schema).option("basePath", self.path).load(listed)
