"""Pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.session import stage

#: White space of all operators, as a Java and Python pattern.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows per Arrow batch of text, so that a batch of very long texts still fits a Python worker.
TEXT_ROWS = 256

__all__ = ["SPACE", "TEXT_ROWS", "documents", "numbered", "one_space", "stage", "tune", "uniform", "whole"]


def tune(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(df: DataFrame) -> Column:
    """All columns of `df` as one struct, so that no name of ours can clash with one of theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def numbered(df: DataFrame, name: str, **columns: Column) -> DataFrame:
    """Stage `row` (a unique number) and `columns`.

    Written down because a number given to a row must not change when a lost executor's work is repeated.
    """
    return stage(df.select(F.monotonically_increasing_id().alias("row"), *[c.alias(n) for n, c in columns.items()]), name)


def one_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) that the keys alone decide."""
    return (F.xxhash64(*keys).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")
