"""Similarity join of documents on word 5-grams: a MinHash LSH forest, then exact verification.

Each document has one signature per tree. Sorted by signature, a tree is a trie whose common prefixes bring similar
documents together. Matching starts at full depth, and the matched prefix is shortened until documents at the threshold
meet in at least one tree with the target recall. Documents with the same words are one node. Nodes that meet form
candidate groups; a group is compared exactly, in blocks if it is large, and only counts and a spanning forest
of its links leave a task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, one_space, stage, whole
from .components import Union, connected

WORDS, THRESHOLD = 5, 0.8
#: Trees, depth of a full signature, and the recall at the threshold that ends the shortening of prefixes.
TREES, DEPTH, RECALL, SEED = 64, 16, 0.99999, 11
#: Documents of a block. A task compares two blocks at most.
BLOCK = 600
REMEMBERED = 500_000


def depth_for(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Prefix length at which two documents at the threshold share a prefix in some tree with the wanted chance."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[str], known: _Hashes, n: int = WORDS) -> np.ndarray:
    """A 32-bit hash of each run of n words."""
    if len(words) < n:
        return np.zeros(0, np.uint32)
    h = np.array(list(map(known.__getitem__, words)), np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - n + 1 + j]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (out >> np.uint64(32)).astype(np.uint32)


class Forest:
    """Signatures of all trees at a prefix length."""

    def __init__(self, depth: int, trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        n = trees * depth
        self.trees, self.depth = trees, depth
        self.factor = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        self.mix = rng.integers(0, 1 << 63, depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, (trees, 1), dtype=np.uint64)
        self.room = np.empty((256, n), np.uint32)

    def least(self, shingles: np.ndarray) -> np.ndarray:
        best = None
        for i in range(0, len(shingles), 256):
            x = shingles[i : i + 256]
            room = self.room[: len(x)]
            np.multiply(x[:, None], self.factor[None, :], out=room)
            np.add(room, self.shift[None, :], out=room)
            low = room.min(axis=0)
            best = low if best is None else np.minimum(best, low)
        return best

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """One number per tree for the prefix of the signature."""
        prefix = self.least(shingles).reshape(self.trees, self.depth).astype(np.uint64) ^ self.salt
        h = np.zeros(self.trees, np.uint64)
        for j in range(self.depth):
            h = (h ^ (h >> np.uint64(31)) ^ prefix[:, j]) * self.mix[j]
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _words(text: Column) -> Column:
    return F.trim(one_space(text))


def _digest(text: Column) -> Column:
    """128 bits that stand for the word sequence."""
    return F.unhex(F.md5(F.encode(_words(text), "UTF-8")))


def _signed(docs: DataFrame, depth: int, row: str | None) -> DataFrame:
    """(row, doc_id, seq, keys) of every document; no keys where there are too few words for a shingle.

    `row` names a column that numbers the rows; without one they are numbered here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, known = Forest(depth), _Hashes()
        for batch in batches:
            keys = []
            for text in batch.column(3).to_pylist():
                shingles = shingle_hashes(text.split(" "), known) if text else ()
                keys.append(forest.keys(shingles) if len(shingles) else np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            flat = np.concatenate([*keys, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.record_batch([*batch.columns[:3], lists], names=["row", "doc_id", "seq", "keys"])

    number = F.col(row) if row else F.lit(None)
    rows = docs.select(
        number.cast("long").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _digest(F.col("text")).alias("seq"),
        _words(F.col("text")).alias("words"),
    )
    signed = rows.mapInArrow(run, "row long, doc_id long, seq binary, keys array<long>")
    if row:
        return stage(signed, "signatures")
    return numbered(signed, "signatures", **{c: F.col(c) for c in ("doc_id", "seq", "keys")})


def _candidates(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, grp): nodes that share a prefix with another one, directly or over others."""
    nodes = signed.join(classes.select(F.col("node").alias("row")), "row")
    keys = nodes.select(F.col("row").alias("node"), F.explode("keys").alias("key"))
    met = keys.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n"))
    met = stage(met.where("n > 1").select("key", "low"), "prefixes")
    links = keys.join(met, "key").where("node <> low").select("node", "low")
    roots = stage(connected(links, "node", "low"), "groups")
    return roots.select("node", F.col("root").alias("grp")).unionByName(
        roots.select(F.col("root").alias("node"), F.col("root").alias("grp")).distinct()
    )


def _incidence(words: list[list[str]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle) pairs without repeats, and the number of different shingles by document; all exact."""
    vocabulary: dict[str, int] = {}
    codes, owners = [], []
    for i, w in enumerate(words):
        ids = np.array([vocabulary.setdefault(x, len(vocabulary)) for x in w], np.int64)
        codes.append(np.lib.stride_tricks.sliding_window_view(ids, n))
        owners.append(np.full(len(ids) - n + 1, i, np.int64))
    grid, owner, base = np.concatenate(codes), np.concatenate(owners), len(vocabulary)
    code, span = grid[:, 0], base
    for j in range(1, n):
        if span > (1 << 62) // base:  # renumber before the number would overflow
            code = np.unique(code, return_inverse=True)[1]
            span = int(code.max()) + 1
        code, span = code * base + grid[:, j], span * base
    code = np.unique(code, return_inverse=True)[1]
    pairs = np.unique(code * len(words) + owner)
    shingle, doc = pairs // len(words), pairs % len(words)
    return doc, shingle, np.bincount(doc, minlength=len(words))


def similar_pairs(words: list[list[str]], first: np.ndarray, threshold: float, n: int = WORDS) -> np.ndarray:
    """Pairs (i < j) at or above the threshold. `first` marks the first of two blocks: only pairs across them count,
    or all pairs if it marks every document."""
    doc, shingle, sizes = _incidence(words, n)
    count = len(words)
    rng = np.random.default_rng(0)
    mark = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    starts = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
    # Shingles that occur in the same documents are one column with a weight; those of one document match nothing.
    sums = np.add.reduceat(mark[doc], starts)
    width = np.diff(np.append(starts, len(doc)))
    shared = np.flatnonzero(width > 1)
    _, keep, weight = np.unique(sums[shared], return_index=True, return_counts=True)
    keep = shared[keep]
    common = np.zeros((count, count), np.float64)
    step = max(1, 8_000_000 // count)
    for i in range(0, len(keep), step):
        part = keep[i : i + step]
        x = np.zeros((count, len(part)), np.float64)
        where = np.concatenate([np.arange(starts[k], starts[k] + width[k]) for k in part])
        x[doc[where], np.repeat(np.arange(len(part)), width[part])] = 1
        common += (x * weight[i : i + step]) @ x.T
    union = sizes[:, None] + sizes[None, :] - common
    hit = np.triu(common >= threshold * union - 1e-9, 1)
    if not first.all():
        hit &= first[:, None] != first[None, :]
    return np.argwhere(hit)


LINKS = "node long, links long, parent long"


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        # One node can come more than once, if a row of its document is repeated.
        seen, rows = set(), []
        columns = (table[c].to_pylist() for c in ("grp", "node", "copies", "first", "words"))
        for grp, node, copies, first, text in zip(*columns):
            if node not in seen:
                seen.add(node)
                rows.append((grp, node, copies, first, text))
        rows.sort(key=lambda r: r[:2])
        out: list[tuple[int, int, int]] = []
        start = 0
        for end in range(1, len(rows) + 1):
            if end < len(rows) and rows[end][0] == rows[start][0]:
                continue
            part = rows[start:end]
            start = end
            if len(part) < 2:
                continue
            pairs = similar_pairs([r[4].split(" ") for r in part], np.array([r[3] for r in part]), threshold)
            union, links = Union(len(part)), [0] * len(part)
            for i, j in pairs.tolist():
                union.join(i, j)
                links[i] += part[j][2]
                links[j] += part[i][2]
            out += [(part[i][1], links[i], part[union.find(i)][1]) for i in range(len(part)) if links[i]]
        columns = list(zip(*out)) if out else [[]] * 3
        names = [c.split()[0] for c in LINKS.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _links(docs: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(node, links, parent) as found by each task, over all candidate groups."""
    groups = stage(groups, "groups")
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bins = max(1, total // BLOCK)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = groups.join(sizes, "grp").withColumn("block", block)
    # Small groups share a bin; a group of several blocks has a task for each pair of blocks.
    bin_ = F.pmod(F.xxhash64("grp"), F.lit(bins)).alias("bin")
    single = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q"), bin_))
    several = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("p"), F.greatest("block", o).alias("q"), F.col("grp").alias("bin")),
    )
    placed = placed.join(classes.select("node", "seq", "copy_id", "copies"), "node")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("copy"),
        _digest(F.col("text")).alias("seq"),
        _words(F.col("text")).alias("words"),
    )
    full = texts.join(placed, (texts["seq"] == placed["seq"]) & texts["copy"].eqNullSafe(placed["copy_id"]))
    large = F.col("blocks") > 1
    tasks = full.select(
        "grp", "node", "copies", "block", "words", large.alias("large"), F.explode(F.when(large, several).otherwise(single)).alias("t")
    )
    tasks = tasks.select(
        "grp", "node", "copies", "words", "large", (~F.col("large") | (F.col("block") == F.col("t.p"))).alias("first"), "t.*"
    )
    return tasks.groupBy("large", "bin", "p", "q").applyInArrow(_verify(threshold), LINKS)


def _joined(docs: DataFrame, threshold: float, trees: int, recall: float, row: str | None):
    """(signed, classes, near): rows with their word sequence; its node and copies; links and root of linked nodes."""
    depth = depth_for(threshold, trees, DEPTH, recall)
    signed = _signed(docs, depth, row)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first")
    classes = signed.groupBy("seq").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = stage(
        classes.select("seq", F.col("first.row").alias("node"), F.col("first.doc_id").alias("copy_id"), "copies"), "classes"
    )
    found = stage(_links(docs, classes, _candidates(signed, classes), threshold), "found")
    roots = stage(connected(found, "node", "parent"), "roots")
    near = found.groupBy("node").agg(F.sum("links").alias("links"))
    near = near.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return signed, classes, near


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    recall: float = RECALL,
    row: str | None = None,
) -> DataFrame:
    """One row per document: row, doc_id, class_id, n_links, copy_id, kept.

    Words are what white space parts; shingles are runs of five words; two documents are linked when the Jaccard
    similarity of their sets of shingles is at least the threshold, or when their words are the same, which also holds for
    documents with fewer than five words or none (null counts as empty). `n_links` counts other documents linked
    directly, copies included; `class_id` is the smallest doc_id reachable by links, `copy_id` that of the documents with
    the same words. A null id is used only where no other is reachable. One row of each class is `kept`.
    """
    signed, classes, near = _joined(docs, threshold, trees, recall, row)
    linked = stage(classes.drop("seq").join(near, "node", "left").withColumn("root", F.coalesce("root", "node")), "linked")
    first = F.min(F.struct(F.col("copy_id").isNull(), F.col("copy_id"), F.col("node"))).alias("first")
    heads = linked.groupBy("root").agg(first)
    heads = heads.select("root", F.col("first.copy_id").alias("class_id"), F.col("first.node").alias("head"))
    facts = linked.join(heads, "root").select(
        "node", "copy_id", "class_id", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    facts = stage(classes.select("seq", "node").join(facts, "node"), "facts")
    return signed.select("row", "doc_id", "seq").join(facts, "seq").select(
        "row", "doc_id", "class_id", "n_links", "copy_id", (F.col("row") == F.col("head")).alias("kept")
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """The documents without those that have a linked document of smaller id: one of each class stays, all columns."""
    rows = numbered(docs, "documents", doc=whole(docs), doc_id=F.col("doc_id").cast("long"), text=F.col("text"))
    judged = near_duplicates(rows, threshold, trees, recall, row="row")
    gone = judged.where(~F.col("kept")).select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
