"""Exact duplicates by distributed MSD radix partitioning.

Groups of documents are split by successive bytes of the text until a group has one document or its texts have
ended. Texts that meet to the end are equal byte for byte, so no digest decides anything. A digit is a run of bytes
whose width grows eightfold from round to round, so a text of n bytes takes about log8(n) rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, one_space, stage, whole

#: Bytes of the first digit, and the growth of the next ones.
FIRST, GROWTH = 16, 8


def _rank():
    """Order in which equal texts are kept: smallest doc_id, ids before nulls, then the row number."""
    return F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """From (row, doc_id, text): (row, keep_row, keep_id, group_size) of every text that occurs more than once.

    The rows of one group are counted with partial aggregation and looked up again by a join, which Spark can split
    for a group that holds a large part of all rows; no task gathers a group.
    """
    rest = F.encode("text", "UTF-8")
    alive = rows.select("row", "doc_id", F.lit(0).cast("long").alias("grp"), rest.alias("rest"))
    width, done = FIRST, []
    while True:
        digits = alive.select("row", "doc_id", "grp", F.substring("rest", 1, width).alias("digit"))
        groups = digits.groupBy("grp", "digit").agg(F.min(_rank()).alias("first"), F.count(F.lit(1)).alias("n"))
        groups = stage(
            groups.where("n > 1").select(
                "grp", "digit", F.col("first.row").alias("keep_row"), F.col("first.doc_id").alias("keep_id"), "n"
            ),
            "groups",
        )
        if groups.isEmpty():
            break
        # Sorted and merged at every size: the groups have no bound that would let them be sent to all executors.
        split = alive.withColumn("digit", F.substring("rest", 1, width)).join(groups.hint("merge"), ["grp", "digit"])
        ended = F.length("digit") < width
        split = stage(
            split.select(
                "row",
                "doc_id",
                F.col("keep_row").alias("grp"),
                "keep_id",
                F.col("n").alias("group_size"),
                ended.alias("ended"),
                F.when(~ended, F.substring(F.col("rest"), width + 1, 1 << 30)).alias("rest"),
            ),
            "split",
        )
        done.append(split.where("ended").select("row", F.col("grp").alias("keep_row"), "keep_id", "group_size"))
        alive = split.where("not ended").select("row", "doc_id", "grp", "rest")
        width *= GROWTH
    if not done:
        return rows.sparkSession.createDataFrame([], "row long, keep_row long, keep_id long, group_size long")
    return reduce(DataFrame.unionByName, done)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white space is made one space; null counts as empty, and empty texts are
    equal to each other. Of equal texts the smallest doc_id stays, a null id only if all are null; of rows that share
    that id one stays. The digest is output only.
    """
    rows = numbered(docs, "documents", doc_id=F.col("doc_id").cast("long"), text=one_space(F.col("text")))
    groups = duplicate_groups(rows)
    narrow = rows.select("row", "doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
    return narrow.join(groups, "row", "left").select(
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = numbered(docs, "documents", doc=whole(docs))
    text = one_space(F.col("doc.text")).alias("text")
    groups = duplicate_groups(rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), text))
    gone = groups.where("keep_row <> row").select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
