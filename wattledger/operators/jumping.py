"""Greedy choice: who acts, when an action blocks others for a while.

Candidates of a key come in order (`seq`, `pos`); one acts when its time `at` has reached the limit that the last
action left, and then leaves the limit `free`, which is later than `at`. Keys with few candidates are folded over an
array, in one shuffle. The others are chosen by pointer jumping, which no key is too large for.

Whether a candidate acts depends on all actions before it, but not who would be next if it did: that is the first in order of those with a time of at least
its `free`. (None of these can have come before it: had one acted, or been blocked, the limit would exceed its time.)
So each candidate has one successor, found by a running minimum over times from the latest on, and the ones that act
are those on the path of successors that begins at the key's first. The path is marked by doubling: pointers of 1, 2,
4, ... steps, each a join on (key, candidate), which no large key can make lopsided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators.skew import HotKeys, find_hot_keys, previous_max
from wattledger.session import discard, recorded, stage

#: Candidates of a key up to which an array of them is folded.
FOLDED = 4_096

_ORDER = ("back", "late")
_POINTER, _MARK = 0, 1
_EARLIEST = -(1 << 62)


def tagged(key: Column) -> Column:
    """A key as text that is never NULL, so that NULL is a key like any other."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def untagged(key: Column) -> Column:
    return F.when(key != "", F.substr(key, F.lit(2)))


def successors(nodes: DataFrame, start: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Rows (kind, key, seq, pos, next_seq, next_pos): a pointer for each candidate that has a successor, and the first
    candidate that acts of each key as a mark.

    `nodes` is a table of key, at, seq, pos, free; `start` has key and the limit `free` that earlier runs left.
    """
    value = nodes.select(
        "key",
        (-F.col("at")).alias("back"),
        F.lit(0).alias("late"),
        # Negated, as the first in order is wanted of a running maximum.
        F.struct((-F.col("seq")).alias("seq"), (-F.col("pos")).alias("pos")).alias("best"),
    )
    asked = nodes.select(
        "key", (-F.col("free")).alias("back"), F.lit(1).alias("late"), F.struct("seq", "pos").alias("own")
    )
    keys = nodes.select("key").distinct()
    keys = keys.withColumn("free", F.lit(None).cast("long")) if start is None else keys.join(start, "key", "left")
    first = keys.select("key", (-F.coalesce("free", F.lit(_EARLIEST))).alias("back"), F.lit(1).alias("late"))
    rows = value.unionByName(asked, allowMissingColumns=True).unionByName(first, allowMissingColumns=True)
    if hot is None:
        hot = find_hot_keys(rows, "key", order=_ORDER)
    found = previous_max(rows, "key", F.col("best"), "next", hot, _ORDER).where("late = 1 and next is not null")
    is_first = F.col("own").isNull()
    next_seq, next_pos = (-F.col("next.seq")).cast("long"), (-F.col("next.pos")).cast("int")
    return found.select(
        F.when(is_first, _MARK).otherwise(_POINTER).alias("kind"),
        "key",
        F.when(is_first, next_seq).otherwise(F.col("own.seq")).alias("seq"),
        F.when(is_first, next_pos).otherwise(F.col("own.pos")).alias("pos"),
        F.when(~is_first, next_seq).alias("next_seq"),
        F.when(~is_first, next_pos).alias("next_pos"),
    )


def greedy_actions(
    candidates: Column, start: Column, acts_after, until, element: str
) -> Column:
    """Candidates that act, in order.

    `candidates` is an array in order of arrival, `element` the type of its entries.
    `acts_after(candidate, limit)` says whether the limit no longer holds, and
    `until(candidate)` is the limit an action sets; `start` is the limit before the first
    candidate, NULL for none.
    """
    empty = F.struct(
        start.cast("bigint").alias("limit"),
        F.array().cast(f"array<{element}>").alias("acted"),
    )

    def step(acc: Column, candidate: Column) -> Column:
        acts = acc["limit"].isNull() | acts_after(candidate, acc["limit"])
        return F.when(
            acts,
            F.struct(
                until(candidate).alias("limit"),
                F.array_append(acc["acted"], candidate).alias("acted"),
            ),
        ).otherwise(acc)

    return F.aggregate(candidates, empty, step, lambda acc: acc["acted"])


_NODE, _NEXT = ["key", "seq", "pos"], ["key", "next_seq", "next_pos"]


def _follow(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """Replace the end (next_seq, next_pos) of `rows` by where its pointer leads; rows that lead nowhere go."""
    onward = pointers.select(
        "key",
        F.col("seq").alias("next_seq"),
        F.col("pos").alias("next_pos"),
        F.col("next_seq").alias("far_seq"),
        F.col("next_pos").alias("far_pos"),
    )
    joined = rows.join(onward, _NEXT).drop("next_seq", "next_pos")
    return joined.withColumnsRenamed({"far_seq": "next_seq", "far_pos": "next_pos"})


def _reached(marks: DataFrame, pointers: DataFrame) -> DataFrame:
    ends = marks.join(pointers, _NODE).select("key", F.col("next_seq").alias("seq"), F.col("next_pos").alias("pos"))
    return marks.unionByName(ends)


def folded(nodes: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """key, seq, pos of the candidates that act, by a fold over an array per key."""
    candidate = "struct<seq:bigint,pos:int,at:bigint,free:bigint>"
    per_key = nodes.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "at", "free"))).alias("all"))
    if start is None:
        per_key = per_key.withColumn("limit", F.lit(None).cast("bigint"))
    else:
        per_key = per_key.join(start.select("key", F.col("free").alias("limit")), "key", "left")
    made = greedy_actions(
        F.col("all").cast(f"array<{candidate}>"),
        F.col("limit"),
        lambda c, limit: c["at"] >= limit,
        lambda c: c["free"],
        candidate,
    )
    return per_key.select("key", F.inline(made)).select(_NODE)


def acting(nodes: DataFrame, start: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """key, seq, pos of the candidates that act. `nodes` is a table, as in `successors`."""
    long = nodes.groupBy("key").count().where(F.col("count") > FOLDED).select("key")
    with recorded() as paths:
        long = stage(long, "long_keys")
    if long.isEmpty():
        discard(nodes.sparkSession, paths)
        return folded(nodes, start)
    short = folded(nodes.join(long, "key", "left_anti"), start)
    return short.unionByName(jumped(nodes.join(long, "key", "left_semi"), start, hot))


def jumped(nodes: DataFrame, start: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """key, seq, pos of the candidates that act, by pointer jumping; a table.

    The path of a key may be of any length: a job quadruples the step, so their number is its logarithm. Pointers that
    have passed the end of their path are dropped on the way.
    """
    spark = nodes.sparkSession
    with recorded() as before:
        table = stage(successors(nodes, start, hot), "steps")
    while True:
        pointers = table.where(F.col("kind") == _POINTER).drop("kind")
        marks = table.where(F.col("kind") == _MARK).select(_NODE)
        if pointers.isEmpty():
            break
        twice = _follow(pointers, pointers)
        marks = _reached(_reached(marks, pointers), twice)
        after = _follow(twice, twice).select(F.lit(_POINTER).alias("kind"), *_NODE, "next_seq", "next_pos")
        marks = marks.withColumn("kind", F.lit(_MARK))
        with recorded() as written:
            table = stage(after.unionByName(marks, allowMissingColumns=True), "steps")
        discard(spark, before)
        before = written
    return marks
