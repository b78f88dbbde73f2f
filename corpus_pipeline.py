"""A training corpus from documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import mixing, ngram_join, packing, radix_dedup, toxicity
from wattledger.llm.common import documents, stage, tune
from wattledger.session import discard, recorded

#: Tables that the stage before has staged. Its result is written when the next stage begins, so they can go.
_staged: list[str] = []


def _stage_of(function):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tune(spark)
        discard(spark, _staged)
        with recorded() as paths:
            out = function(spark, docs, sf_dir)
        # Nothing says when the result of the last stage has been read, so its tables stay.
        _staged[:] = [] if function.__name__ == "packed_sequences" else paths
        return out

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    return run


@_stage_of
def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage_of
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return radix_dedup.drop_exact_duplicates(docs)


@_stage_of
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word 5-grams one stays."""
    return ngram_join.one_of_each(docs)


@_stage_of
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get their target weights; a document comes once for each pass over it."""
    return mixing.mixed_documents(docs)


@_stage_of
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence; a document repeated by the mix is packed each time."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", source_mix),
    ("packing", packed_sequences),
]

#: Training, signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), []
    for name, function in STAGES[:-1]:
        out = function(spark, docs, sf_dir)
        with recorded() as written:
            docs = stage(out, name.replace(" ", "-"))
        discard(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
