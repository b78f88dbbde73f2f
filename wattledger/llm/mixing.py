"""Mixing sources to target weights as a minimum-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. Tokens flow from patterns to
source quotas; each further pass over a pattern costs more (convex costs), so repetition spreads as evenly as the
quotas allow. The flow decides how many tokens each pattern gives to each source; documents are then selected in a
seeded order.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import numbered, stage, uniform, whole

#: Cost of the first, second and third pass over a document. More passes are not allowed.
PASS_COSTS = (0, 1, 3)
SEED = 20_240
#: Bins of the seeded order per pattern: sums by bin find the cut, only the bin of the cut is ordered by document.
BINS = 4096


def words(text: Column) -> Column:
    """Number of words: runs of anything but space, tab and line ends."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets_by_weight(sizes: dict, weights: dict, most: float = float(len(PASS_COSTS))) -> dict:
    """Share out the sum of `sizes` by weight; no target exceeds `most` times its source, the excess is shared again."""
    left, free, out = float(sum(sizes.values())), set(sizes), {}
    while free:
        unit = left / sum(weights[s] for s in free)
        over = [s for s in free if unit * weights[s] > most * sizes[s]]
        if not over:
            return out | {s: unit * weights[s] for s in free}
        for s in over:
            out[s] = most * float(sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def ranked_weights(sources: Sequence) -> dict:
    """Weights 1, 2, 3 and so on round, by code point order of the source, null last."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: 1 + i % 3 for i, s in enumerate(order)}


def route(capacity: dict[tuple, int], quotas: dict, costs: Sequence[int] = PASS_COSTS) -> dict[tuple, int]:
    """Minimum-cost flow: tokens by (pattern, source).

    Nodes are the patterns and the sources. A pattern has one arc per pass, each as wide as its tokens, with rising
    costs; it feeds only sources it belongs to; a source takes up to its quota. Successive cheapest paths, where a
    path may reroute flow that another source holds. The graph grows with patterns and sources, not with documents.
    """
    flow: dict[tuple, int] = {}
    used = dict.fromkeys(capacity, 0)
    need = {s: int(round(q)) for s, q in quotas.items()}
    members: dict = {}
    for pattern in capacity:
        for s in pattern:
            members.setdefault(s, []).append(pattern)
    width = len(costs)

    def price(p):  # cost of the next token of a pattern, and the tokens left at that price
        k = used[p] // capacity[p] if capacity[p] else width
        return (costs[k], (k + 1) * capacity[p] - used[p]) if k < width else (None, 0)

    ticks = itertools.count()  # so that equal entries of a heap are never compared further
    order = sorted(need, key=lambda s: (s is None, str(s)))
    open_ = {s for s in order if need[s] > 0}
    while open_:
        # Cheapest price at which each open source can be reached: from a pattern with tokens left, over
        # patterns whose flow another source can hand on in exchange. Handing on costs nothing.
        best, heap, back = {}, [], {}
        seen, missing = set(), object()  # None is a source
        for p in sorted(capacity, key=str):
            cost, left = price(p)
            if cost is not None and left > 0:
                heapq.heappush(heap, (cost, str(p), next(ticks), p, missing))
        found = missing
        while heap and found is missing:
            cost, _, _, p, via = heapq.heappop(heap)
            if p in seen:
                continue
            seen.add(p)
            back[p] = via
            for s in sorted(p, key=lambda x: (x is None, str(x))):
                if s in best:
                    continue
                best[s] = p
                if s in open_:
                    found = s
                    break
                for q in members[s]:  # s is full: it may take from p instead of from q, and q goes on
                    if q not in seen and flow.get((q, s), 0) > 0:
                        heapq.heappush(heap, (cost, str(q), next(ticks), q, s))
        if found is missing:
            break
        path, s = [], found
        while True:
            p = best[s]
            path.append((p, s))
            if back[p] is missing:
                break
            s = back[p]
            path.append((p, s))
        root = path[-1][0]
        amount = min(need[found], price(root)[1])
        for i in range(1, len(path), 2):
            amount = min(amount, flow[path[i]])
        for i, arc in enumerate(path):
            flow[arc] = flow.get(arc, 0) + (amount if i % 2 == 0 else -amount)
        used[root] += amount
        need[found] -= amount
        if need[found] == 0:
            open_.discard(found)
    return {arc: f for arc, f in flow.items() if f > 0}


def _select(rows: DataFrame, give: DataFrame, cut_last: bool) -> DataFrame:
    """Add `taken` to rows (row, key, pattern, size): as many whole passes as all get, and one more up to the rest.

    `give`: (pattern, passes, rest). Rows of a pattern stand in order of their seeded `key`. Sums by bin of the key
    find the bin in which the rest ends; only that bin's rows are ordered one by one.
    """
    binned = rows.withColumn("bin", F.floor(F.col("key") * BINS).cast("int"))
    sums = binned.groupBy("pattern", "bin").agg(F.sum("size").alias("bin_size"))
    before = F.sum("bin_size").over(
        Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    bins = stage(
        sums.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(give, "pattern")
        .select("pattern", "bin", "before", "bin_size", "passes", "rest"),
        "bins",
    )
    placed = binned.join(bins, ["pattern", "bin"])
    whole_bin = F.col("before") + F.col("bin_size") <= F.col("rest")
    none_bin = F.col("before") >= F.col("rest")
    even = placed.where(whole_bin | none_bin).withColumn("extra", F.when(whole_bin, F.col("size")).otherwise(F.lit(0)))
    inside = Window.partitionBy("pattern", "bin").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    cut = placed.where(~(whole_bin | none_bin)).withColumn("room", F.col("rest") - F.col("before"))
    cut = cut.withColumn("room", F.col("room") - F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0), F.least("size", "room"))
    if not cut_last:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    cut = cut.withColumn("extra", part)
    keep = ["row", "pattern", "size", "passes", "extra"]
    return even.select(keep).unionByName(cut.select(keep)).withColumn(
        "taken", (F.col("passes") * F.col("size") + F.col("extra")).cast("long")
    )


def mix(docs: DataFrame, membership: Column, weights=ranked_weights, cut_last: bool = True, seed: int = SEED):
    """(selected, quotas): `selected` has `doc` (all columns), `row`, `pattern`, `size` and `taken` of each document.

    `membership` is an array of source names; a null name is a source of its own, an empty array belongs nowhere and
    is never taken. With overlapping sources, a document of a pattern counts for the source the flow routes it to.
    `cut_last` lets the last document of a pattern give only the words still wanted, so that quotas are met to the
    word; without it that document is taken whole or not, whichever is nearer. Null texts have size 0; repeated rows
    are documents of their own; the same rows give the same mix.
    """
    spark = docs.sparkSession
    ordered = F.array_sort(F.array_distinct(membership))
    rows = numbered(docs, "mixing", doc=whole(docs), pattern=ordered, size=words(F.col("text")))
    rows = rows.withColumn("key", uniform(F.col("doc"), F.lit(seed)))
    # One row per distinct set of sources: as many as the corpus has combinations of sources, not documents.
    capacity = {tuple(r.pattern): r.size for r in rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()}
    sizes: dict = {}
    for pattern, size in capacity.items():
        for s in pattern:
            # A shared document offers each of its sources an equal part.
            sizes[s] = sizes.get(s, 0) + size / len(pattern)
    quotas = targets_by_weight(sizes, weights(list(sizes)))
    flow = route(capacity, quotas)
    given: dict[tuple, int] = dict.fromkeys(capacity, 0)
    for (pattern, _), tokens in flow.items():
        given[pattern] += tokens
    give = spark.createDataFrame(
        [(list(p), given[p] // max(c, 1), given[p] % max(c, 1)) for p, c in capacity.items()],
        "pattern array<string>, passes long, rest long",
    )
    taken = _select(rows.select("row", "key", "pattern", "size"), give, cut_last)
    return rows.select("row", "doc"), taken, sizes, quotas


def mix_by_source(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, for sources that do not overlap."""
    narrow = docs.select("doc_id", "text", "source")
    rows, taken, sizes, quotas = mix(narrow, F.array("source"))
    facts = docs.sparkSession.createDataFrame(
        [([s], int(sizes[s]), float(quotas[s])) for s in sizes], "pattern array<string>, source_size long, target double"
    )
    ids = rows.select("row", "doc.doc_id")
    return ids.join(taken, "row").join(facts, "pattern").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, a document once for each whole pass over it."""
    rows, taken, _, _ = mix(docs, F.array("source"), cut_last=False)
    passes = taken.where("taken > 0").select("row", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    return rows.join(passes, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")
