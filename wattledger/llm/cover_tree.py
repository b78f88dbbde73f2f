"""Embedding near-duplicates by dual traversal of cover trees.

Levels of centres are nested and their radii halve; every point has an ancestor in each level and every node knows the
true distance to its farthest descendant. Two trees are descended together, and a pair of nodes is left when the
distance of the centres, less both covering radii, exceeds the threshold: no pair of points is lost.

The top of the tree, chosen from a bounded sample, deals the vectors of a label into cells; the same bound, and the
plane between two centres, decide which vectors two cells must exchange. Below that a task has two cells' vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stage, uniform
from .components import Union, connected

THRESHOLD = 0.98
#: Vectors of a cell, and most centres that are sent to all executors; with more vectors the cells grow, and are
#: compared in blocks of CELL.
CELL, CENTRES = 1_500, 20_000
#: Points among which the next centres of a level are chosen at once.
BATCH = 128
#: Slack for rounding in bounds; the last test is exact.
SLACK = 1e-7


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


@dataclass
class Level:
    centres: np.ndarray  # points
    parents: np.ndarray  # places in the level above
    radius: np.ndarray  # distance to the farthest descendant


class CoverTree:
    def __init__(self, points: np.ndarray, smallest: float):
        n = len(points)
        self.points = points
        centres, at = [0], np.zeros(n, np.int64)  # `at`: place of each point's centre
        distance = apart(points, points[:1])[:, 0]
        levels, ancestry, radius = [(centres, [0])], [at.copy()], 2.0
        while radius > smallest:
            radius /= 2
            centres, parents, above = list(centres), list(range(len(centres))), at.copy()
            far = np.flatnonzero(distance > radius)
            while len(far):
                # The next centres: some far points, each left out if an earlier one of them covers it.
                some = far[:BATCH]
                close = apart(points[some], points[some]) <= radius
                covered, chosen = np.zeros(len(some), bool), []
                for k in range(len(some)):
                    if not covered[k]:
                        chosen.append(k)
                        covered |= close[k]
                new = some[chosen]
                d = apart(points[far], points[new])
                d[chosen, np.arange(len(new))] = 0.0
                nearest = d.argmin(axis=1)
                best = d[np.arange(len(far)), nearest]
                near = best <= radius
                at[far[near]], distance[far[near]] = len(centres) + nearest[near], best[near]
                centres += new.tolist()
                parents += above[new].tolist()
                far = far[~near]
            levels.append((centres, parents))
            ancestry.append(at.copy())
        levels.append((list(range(n)), at.tolist()))
        self.levels = []
        up = np.arange(n)
        made = []
        for centres, parents in reversed(levels):
            centres, parents = np.array(centres), np.array(parents)
            cover = np.zeros(len(centres))
            d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points, points[centres[up]])))
            np.maximum.at(cover, up, np.where(centres[up] == np.arange(n), 0.0, d))
            made.append(Level(centres, parents, cover))
            up = parents[up]
        self.levels = made[::-1]


def close_pairs(a: CoverTree, b: CoverTree, limit: float) -> np.ndarray:
    """All pairs of points (place in a, place in b) within `limit`.

    Alive pairs of nodes are a matrix; a level's distances are taken for the rows that have alive pairs.
    """
    alive = np.ones((1, 1), bool)
    for k in range(max(len(a.levels), len(b.levels))):
        one, two = a.levels[min(k, len(a.levels) - 1)], b.levels[min(k, len(b.levels) - 1)]
        last = k >= min(len(a.levels), len(b.levels)) - 1  # lists points in another order
        if k and not last and alive.shape == (len(one.centres), len(two.centres)):
            continue  # no new centres, so no bound has changed
        if 0 < k < len(a.levels):
            alive = alive[one.parents]
        if 0 < k < len(b.levels):
            alive = alive[:, two.parents]
        count = np.count_nonzero(alive)
        if not count:
            break
        x, y = a.points[one.centres], b.points[two.centres]
        if count * 8 < alive.size:
            i, j = np.nonzero(alive)
            cos = np.einsum("ij,ij->i", x[i], y[j])
            bound = limit + SLACK + one.radius[i] + two.radius[j]
            alive[i, j] = np.sqrt(np.maximum(0, 2 - 2 * cos)) <= bound
        else:
            bound = limit + SLACK + one.radius[:, None] + two.radius[None, :]
            alive &= x @ y.T >= 1 - bound * bound / 2
    return np.argwhere(alive)


LINKS = "node long, links long, parent long"


def _compare(threshold: float):
    limit = float(np.sqrt(2 - 2 * threshold))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        first = np.array(table["first"].to_pylist(), bool)
        flat = np.array(table["vector"].combine_chunks().flatten(), np.float64)
        vectors = unit(flat.reshape(len(node), -1))
        own = table["p"][0].as_py() == table["q"][0].as_py()
        left, right = np.flatnonzero(first), np.arange(len(node)) if own else np.flatnonzero(~first)
        pairs = np.zeros((0, 2), np.int64)
        if len(left) and len(right):
            tree = CoverTree(vectors[left], limit / 2)
            pairs = close_pairs(tree, tree if own else CoverTree(vectors[right], limit / 2), limit)
            pairs = np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], axis=1)
            if own:
                pairs = pairs[pairs[:, 0] < pairs[:, 1]]
            cos = np.einsum("ij,ij->i", vectors[pairs[:, 0]], vectors[pairs[:, 1]])
            pairs = pairs[cos >= threshold]
        union = Union(len(node))
        for i, j in pairs.tolist():
            union.join(i, j)
        links = np.zeros(len(node), np.int64)
        np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
        has = np.flatnonzero(links)
        parent = node[[union.find(int(i)) for i in has]] if len(has) else np.zeros(0, np.int64)
        return pa.table({"node": node[has], "links": links[has], "parent": pa.array(parent, pa.int64())})

    return run


class Cells:
    """Top of the trees of the labels that are too large for one cell."""

    def __init__(self, rows):
        by: dict[tuple, list] = {}
        for r in rows:
            by.setdefault((r.label, r.dim), []).append((r.node, r.vector))
        self.centres = {k: unit(np.array([v for _, v in sorted(x)], np.float64)) for k, x in by.items()}

    def nearest(self, key: tuple, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if key not in self.centres:
            return np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
        d = apart(vectors, self.centres[key])
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(d)), cell]


def _by_key(batch: pa.RecordBatch):
    """Rows of a batch by label and dimension, with unit vectors."""
    keys: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(batch["label"].to_pylist(), batch["dim"].to_pylist())):
        keys.setdefault(key, []).append(i)
    for key, at in keys.items():
        part = batch.take(pa.array(at))
        flat = np.array(part["vector"].flatten(), np.float64)
        yield key, part, unit(flat.reshape(len(at), key[1]))


def _found(reps: DataFrame, threshold: float) -> DataFrame:
    """(node, links, parent) as found by each task."""
    limit = float(np.sqrt(2 - 2 * threshold))
    total = reps.count()
    cell_size = max(CELL, -(-total // CENTRES))
    large = reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("u", "node")).alias("low"))
    large = stage(large.where(F.col("n") > cell_size), "large")  # at most CENTRES labels can be so large
    chosen = (F.col("u") < 1.0 / cell_size) | (F.col("node") == F.col("low.node"))
    rows = reps.join(F.broadcast(large), ["label", "dim"]).where(chosen)
    # About one vector in cell_size, so some CENTRES rows and no more.
    cells = Cells(rows.select("label", "dim", "node", "vector").collect())
    context = reps.sparkSession.sparkContext
    sent = context.broadcast(cells)
    radius_schema = "label int, dim int, cell int, reach double"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (label, dim), part, vectors in _by_key(batch):
                cell, d = sent.value.nearest((label, dim), vectors)
                n = part.num_rows
                yield pa.record_batch(
                    [part["label"], part["dim"], pa.array(cell, pa.int32()), pa.array(d)],
                    names=["label", "dim", "cell", "reach"],
                )

    narrow = reps.select("label", "dim", "node", "copies", "vector")
    reach = narrow.join(F.broadcast(large.select("label", "dim")), ["label", "dim"]).mapInArrow(place, radius_schema)
    facts = reach.groupBy("label", "dim", "cell").agg(F.max("reach").alias("reach"), F.count(F.lit(1)).alias("n")).collect()
    radii = {k: np.zeros(len(c)) for k, c in cells.centres.items()}
    blocks = {k: np.ones(len(c), np.int64) for k, c in cells.centres.items()}
    for r in facts:
        radii[r.label, r.dim][r.cell] = r.reach
        blocks[r.label, r.dim][r.cell] = -(-r.n // (2 * CELL))
    top = context.broadcast((radii, blocks))
    schema = "label int, dim int, p long, q long, first boolean, node long, copies long, vector array<double>"
    names = [c.split()[0] for c in schema.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radii, blocks = top.value
        for batch in batches:
            for key, part, vectors in _by_key(batch):
                n = part.num_rows
                if key not in radii:
                    zero = pa.array(np.zeros(n, np.int64))
                    columns = [part["label"], part["dim"], zero, zero, pa.array([True] * n), part["node"], part["copies"], part["vector"]]
                    yield pa.record_batch(columns, names=names)
                    continue
                centres, reach, parts = sent.value.centres[key], radii[key], blocks[key]
                d = apart(vectors, centres)
                cell = d.argmin(axis=1)
                own = d[np.arange(n), cell]
                gap = apart(centres, centres)
                # A vector can have a neighbour in another cell only if it is within reach of the cell, and no
                # farther than the limit from the plane halfway between the centres.
                plane = (d**2 - own[:, None] ** 2) / (2 * np.maximum(gap[cell], 1e-12))
                need = (d <= reach[None, :] + limit + SLACK) & (plane <= limit + SLACK)
                need &= gap[cell] <= reach[cell][:, None] + reach[None, :] + limit + SLACK
                need[np.arange(n), cell] = True
                row, other = np.nonzero(need)
                start = np.cumsum(parts) - parts
                mine = start[cell] + np.array(part["node"]) % parts[cell]
                times = parts[other]
                row, other = np.repeat(row, times), np.repeat(start[other], times)
                other = other + np.arange(len(other)) - np.repeat(np.cumsum(times) - times, times)
                me = mine[row]
                took = part.take(pa.array(row))
                columns = [took["label"], took["dim"], pa.array(np.minimum(me, other)), pa.array(np.maximum(me, other))]
                columns += [pa.array(me <= other), took["node"], took["copies"], took["vector"]]
                yield pa.record_batch(columns, names=names)

    return narrow.mapInArrow(deal, schema).groupBy("label", "dim", "p", "q").applyInArrow(_compare(threshold), LINKS)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label (not null) and one length are linked when their cosine is at least the threshold. Vectors that
    are null, empty, all zero, or hold a null or a number that is not finite link with nothing, and neither do vectors
    without a label. Equal vectors are compared once. A null vec_id is the component's id only where no other is
    reachable.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    usable = F.coalesce(fine & F.col("label").isNotNull(), F.lit(False))
    rows = numbered(
        vectors,
        "vectors",
        vec_id=F.col("vec_id").cast("long"),
        label=F.col("label").cast("int"),
        vector=F.when(usable, x.cast("array<double>")),
    )
    first = F.min(F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.col("row"))).alias("first")
    good = rows.where(F.col("vector").isNotNull())
    reps = good.groupBy("label", "vector").agg(first, F.count(F.lit(1)).alias("copies"))
    node = F.col("first.row")
    reps = stage(
        reps.select(
            node.alias("node"), F.col("first.vec_id").alias("copy_id"), "copies", "label", F.size("vector").alias("dim"), "vector", uniform(node).alias("u")
        ),
        "different",
    )
    found = stage(_found(reps, threshold), "found")
    roots = stage(connected(found, "node", "parent"), "roots")
    near = found.groupBy("node").agg(F.sum("links").alias("links")).join(roots, "node", "left")
    near = reps.select("node", "copy_id", "copies").join(near, "node", "left").withColumn("root", F.coalesce("root", "node"))
    near = stage(near, "near")
    least = near.groupBy("root").agg(F.min("copy_id").alias("component_id"))
    facts = near.join(least, "root").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    facts = stage(reps.select("node", "label", "vector").join(facts, "node"), "facts")
    linked = good.select("vec_id", "label", "vector").join(facts, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("vector").isNull()).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    both = linked.union(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
