"""Running maxima per key that do not depend on any key being small.

A window partitioned by key puts all rows of a key into one task. Keys with more rows
than a task should hold are cut into chunks of consecutive arrival numbers with about
equally many rows, however bursty their arrival. Every chunk is scanned on its own,
starting from the maximum of the chunks before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.operators.readings import ARRIVAL

if TYPE_CHECKING:
    from wattledger.sources.increments import Saved

ROWS_PER_TASK = 1_000_000
# Bound on the cut points of all keys together: a table beyond this many tasks' rows gets larger chunks.
LISTED_CUTS = 50_000
# Rows looked at for each cut point; their share of a chunk's rows varies by about 1 / sqrt(64).
_POINTS = 64

_CHUNK, _GROUP = "_chunk", "_group"


@dataclass(frozen=True)
class HotKeys:
    """Keys to cut, each with its cut points: sorted numbers (of arrival) at which a chunk begins."""

    cuts: tuple[tuple[object, tuple[int, ...]], ...]

    @property
    def keys(self) -> tuple:
        return tuple(key for key, _ in self.cuts)

    def split(
        self, df: DataFrame, key: str, name: str = _CHUNK, order: tuple[str, ...] = ARRIVAL
    ) -> DataFrame:
        """Add the number of a row's chunk, -1 for keys that are not cut.

        The cut points are broadcast: there are at most `LISTED_CUTS` of them. NULL is a key
        like any other. A row finds its chunk by bisection.
        """
        if not self.cuts:
            return df.withColumn(name, F.lit(-1))
        schema = T.StructType(
            [
                T.StructField("_cut_key", df.schema[key].dataType),
                T.StructField("_cuts", T.ArrayType(T.LongType())),
            ]
        )
        table = df.sparkSession.createDataFrame([(k, list(c)) for k, c in self.cuts], schema)
        same = F.col(key).eqNullSafe(F.col("_cut_key"))
        longest = max(len(c) for _, c in self.cuts)
        steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(longest.bit_length()))])
        seq, cuts = F.col(order[0]), F.col("_cuts")
        passed = F.aggregate(
            steps,
            F.lit(0),
            lambda at, step: F.when(F.get(cuts, at + step - 1) <= seq, at + step).otherwise(at),
        )
        return (
            df.join(F.broadcast(table), same, "left")
            .withColumn(name, F.when(cuts.isNull(), -1).otherwise(passed))
            .drop("_cut_key", "_cuts")
        )


NO_HOT_KEYS = HotKeys(())

# Arrival number of state saved by earlier runs: before every new row.
SAVED_SEQ = -(1 << 62)


def find_hot_keys(
    df: DataFrame,
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    fraction: float = 1.0,
    order: tuple[str, ...] = ARRIVAL,
) -> HotKeys:
    """Count rows per key (combined before the shuffle), and cut the keys above the limit.

    `df` is read up to three times, only its key and the columns of `order`; pass a table. Cut points
    come from a hash sample of the large keys' rows, `_POINTS` rows for each, so neither a
    task nor the driver sees more than `_POINTS * LISTED_CUTS` numbers. How keys are cut never
    changes a result, so `df` may itself be a sample: `fraction` is its share of all rows.
    """
    rows = df.select(key, *order)
    n_rows = rows.count()
    limit = max(float(rows_per_task), n_rows / fraction / LISTED_CUTS)
    if n_rows / fraction <= limit:
        return NO_HOT_KEYS
    found = rows.groupBy(key).count().where(F.col("count") / F.lit(fraction) > limit)
    # Fewer than all rows / limit, hence at most LISTED_CUTS.
    large = [row[key] for row in found.collect()]
    if not large:
        return NO_HOT_KEYS
    schema = T.StructType([T.StructField("_large", df.schema[key].dataType)])
    listed = df.sparkSession.createDataFrame([(k,) for k in large], schema)
    rows_per_chunk = limit * fraction
    share = min(1.0, _POINTS / rows_per_chunk)
    every = max(1, round(share * rows_per_chunk))
    space = 1 << 40
    picked = F.pmod(F.xxhash64(*order), F.lit(space)) < F.lit(int(share * space))
    cut = (
        rows.where(picked)
        .join(F.broadcast(listed), F.col(key).eqNullSafe(F.col("_large")), "left_semi")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(order[0])).alias("points"))
        .select(key, F.filter("points", lambda _, i: (i + 1) % every == 0).alias("cuts"))
    )
    return HotKeys(tuple((row[key], tuple(row["cuts"])) for row in cut.collect() if row["cuts"]))


def previous_max(
    df: DataFrame,
    key: str,
    value: Column,
    name: str,
    hot: HotKeys = NO_HOT_KEYS,
    order: tuple[str, ...] = ARRIVAL,
    materialize: Callable[[DataFrame], DataFrame] | None = None,
    saved: Saved | None = None,
    saved_value: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add `name`: the maximum of `value` over the rows of the key that arrived earlier.

    `order` starts with the columns that the keys were cut by. With hot keys the rows are read twice, for the
    maxima of the chunks and for the scan. When that is dear, `materialize` may turn the
    scanned rows, in which `name` knows only the row's own chunk, into a table.

    `saved` is a state of earlier runs whose rows come before all others; `saved_value` makes the value of
    one of them, a struct. The state is not shuffled: rows are put where it lies, once for the window and the join,
    and keys that are cut meet it as one row per chunk.
    """
    if saved is not None:
        return _previous_or_saved(df, key, value, name, hot, order, materialize, saved, saved_value)
    if not hot.cuts:
        window = (
            Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        )
        return df.withColumn(name, F.max(value).over(window))

    chunked = hot.split(df, key, order=order)
    within_chunk = (
        Window.partitionBy(key, _CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    if materialize is not None:
        chunked = materialize(chunked.withColumn(name, F.max(value).over(within_chunk)))

    earlier_chunks = (
        Window.partitionBy(key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        chunked.where(F.col(_CHUNK) >= 0)
        .groupBy(key, _CHUNK)
        .agg(F.max(value).alias("_max"))
        .select(
            F.col(key).alias("_key"),
            F.col(_CHUNK).alias("_key_chunk"),
            F.max("_max").over(earlier_chunks).alias("_carried"),
        )
    )
    # Without a table, the join and the window share one exchange on (key, chunk). A NULL-safe
    # join would need another, so it is taken only where NULL is among the cut keys.
    same_key = F.col(key).eqNullSafe(F.col("_key")) if None in hot.keys else F.col(key) == F.col("_key")
    in_chunk = F.col(name) if materialize is not None else F.max(value).over(within_chunk)
    return (
        chunked.join(
            carried,
            same_key & (F.col(_CHUNK) == F.col("_key_chunk")),
            "left",
        )
        .withColumn(name, F.greatest("_carried", in_chunk))
        .drop(_CHUNK, "_key", "_key_chunk", "_carried")
    )


def _previous_or_saved(
    df: DataFrame,
    key: str,
    value: Column,
    name: str,
    hot: HotKeys,
    order: tuple[str, ...],
    materialize: Callable[[DataFrame], DataFrame] | None,
    saved: Saved,
    saved_value: Callable[[Column], Column],
) -> DataFrame:
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = saved_value(F.col("_carried"))
    if not hot.cuts:
        # The window leaves rows sorted by key, as the join wants them.
        rows = saved.placed(df, key, _GROUP).withColumn(name, F.max(value).over(before.partitionBy(_GROUP)))
        rows = saved.joined(rows, "_carried", _GROUP)
        return rows.withColumn(name, F.greatest(carried, F.col(name))).drop(_GROUP, "_carried")

    chunked = hot.split(df, key, order=order).withColumn(_GROUP, saved.tag(key))
    in_chunk = F.max(value).over(before.partitionBy(_GROUP, _CHUNK))
    if materialize is not None:
        chunked = materialize(chunked.withColumn(name, in_chunk))
        in_chunk = F.col(name)
    # Keys that are not cut are one chunk, with nothing before it but the state.
    chunks = chunked.groupBy(_GROUP, _CHUNK).agg(F.max(value).alias("_max"))
    earlier = Window.partitionBy(_GROUP).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.repartition(saved.buckets, _GROUP).withColumn("_max", F.max("_max").over(earlier))
    chunks = saved.joined(chunks, "_carried", _GROUP).select(
        F.col(_GROUP).alias("_of"), F.col(_CHUNK).alias("_of_chunk"), F.greatest(carried, "_max").alias("_before")
    )
    same = (F.col(_GROUP) == F.col("_of")) & (F.col(_CHUNK) == F.col("_of_chunk"))
    return (
        chunked.join(chunks, same, "left")
        .withColumn(name, F.greatest("_before", in_chunk))
        .drop(_CHUNK, _GROUP, "_of", "_of_chunk", "_before")
    )
