"""Bounded, repeatable samples of labelled documents to fit a classifier on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import uniform

#: Labelled rows that a classifier is fitted on, by class. Rows beyond them are not looked at in fitting.
ROWS_BY_CLASS = {0: 1_000, 1: 1_000}
#: The texts of a class's sample are whole and together hold at most this many characters for each of its rows; a text
#: that does not fit is passed over. Only if none fits, the shortest one is taken.
CHARS_PER_ROW = 4_000


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: dict[int, int]) -> pd.DataFrame:
    """text, y and weight of at most `rows` training documents by class, those of smallest hash.

    Equal texts count once. A row's weight stands for all labelled training rows of its class, so that the share of
    the classes is that of all rows.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
    known = known.select("doc_id", F.col(label).cast("int").alias("y"), uniform(F.col("doc_id")).alias("u"))
    count = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in count:
        part = known.where(F.col("y") == y).orderBy("u", "doc_id").limit(rows[y])
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return pd.DataFrame({"text": [], "y": [], "weight": []})
    # As many ids as `rows` says, so the side that is sent to all executors has a fixed bound.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = texts.join(F.broadcast(chosen), "doc_id")
    both = both.withColumn("size", F.length("text")).withColumn("hash", F.xxhash64("text"))
    # Sizes first, so that texts beyond the bound never come here.
    first = both.groupBy("y", "size", "hash").agg(F.min(F.struct("u", "doc_id")).alias("at"))
    first = first.select("at.*", "y", "size", "hash")
    place = F.row_number().over(Window.partitionBy("y").orderBy("u", "doc_id", "hash"))
    most = F.when(F.col("y") == 1, rows[1]).otherwise(rows[0])
    sizes = first.withColumn("place", place).where(F.col("place") <= most).orderBy("y", "place").collect()
    keys = []
    for y in count:
        found = [r for r in sizes if r.y == y]
        keys += [tuple(found[i])[:5] for i in fitting([r.size for r in found], rows[y] * CHARS_PER_ROW)]
    wanted = docs.sparkSession.createDataFrame(keys, "u double, doc_id long, y int, size int, hash long")
    found = both.join(F.broadcast(wanted), wanted.columns, "left_semi").select("text", "y", "u", "doc_id").toPandas()
    found = found.sort_values(["u", "doc_id", "text"], ignore_index=True)
    found = found.drop_duplicates(["text", "y"], ignore_index=True)
    n = found["y"].map(found["y"].value_counts())
    return found.assign(weight=found["y"].map(count) / n)[["text", "y", "weight"]]


def fitting(sizes: list[int], limit: int) -> list[int]:
    """Places of the sizes that fit into what is left of `limit`, in order; of the least one if none fits."""
    out, left = [], limit
    for i, size in enumerate(sizes):
        if size <= left:
            out.append(i)
            left -= size
    return out or ([min(range(len(sizes)), key=sizes.__getitem__)] if sizes else [])
