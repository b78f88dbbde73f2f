"""Merkle manifest of a table by butterfly exchange.

A row's leaf hashes its fields. Leaves of one group (a language, say) form a tree, the roots of the groups form the tree
above. Leaves are numbered in their tree and cut into aligned blocks; each block hashes its own subtree. Then the
blocks exchange: in round r the `fanout` blocks whose numbers differ in digit r only swap the roots they hold, and
each of them hashes the common ancestor and notes the others as the next part of its proof. So after the last round
every block holds the root and its upper proof, and nothing has to be sent down again. Block numbers that a tree does
not reach take part as empty carriers, so that every group of an exchange is whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

FANOUT = 2
#: Leaves of a block, at most. A block is one row of some 300 bytes a leaf.
BLOCK_LEAVES = 1024
#: Rounds of the exchange in one job; each is a shuffle of one short row per block.
ROUNDS_PER_JOB = 6
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_INDEX = (1 << 33) - 1


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def framed(value: Column) -> Column:
    """A field so written that fields can be joined without mixing them up: its bytes' number, a colon, the bytes."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(F.concat(*[framed(f) for f in fields]))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(path, start, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def _div(number: Column, by: Column | int) -> Column:
    return F.floor(number / by).cast("long")


def _run(get, digit: Column, fanout: int) -> Column:
    """The other members of a run: joined digests before and after the one at `digit`."""
    member = [F.coalesce(get(t), F.lit("")) for t in range(fanout)]
    none = F.lit("")
    return F.struct(
        F.concat(*[F.when(digit > t, m).otherwise(none) for t, m in enumerate(member)]).alias("before"),
        F.concat(*[F.when(digit < t, m).otherwise(none) for t, m in enumerate(member)]).alias("after"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `place`, the number of a row in its `tree`, and the tree's `total`.

    Rows are dealt by ranges of (tree, order), so a large tree spreads over all tasks; only counts per task and tree
    are added up.
    """
    keys = ["tree", *order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = stage(sorted_.withColumn("at", F.monotonically_increasing_id()), "sorted")
    at = at.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(_INDEX)))
    counts = at.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "part",
        "tree",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"),
        F.sum("n").over(whole).alias("total"),
    )
    return at.join(starts, ["part", "tree"]).withColumn("place", F.col("at") + F.col("start")).drop("at", "part", "start")


def blocks_of(rows: DataFrame, fanout: int, leaves: int) -> DataFrame:
    """From (tree, leaf, body, place, total): one row per block, with its leaves and the levels above them."""
    height = 0
    while fanout ** (height + 1) <= leaves:
        height += 1
    size = fanout**height
    grouped = (
        rows.withColumn("block", _div(F.col("place"), size))
        .groupBy("tree", "block")
        .agg(
            F.max(F.floor((F.col("total") - 1) / size) + 1).cast("long").alias("n_blocks"),
            F.sort_array(F.collect_list(F.struct("place", "leaf", "body"))).alias("items"),
        )
    )

    def parents(level: Column) -> Column:
        count = F.floor((F.size(level) - 1) / fanout).cast("int")
        return F.transform(
            F.sequence(F.lit(0), count),
            lambda j: digest(F.concat(*[F.coalesce(F.get(level, j * fanout + t), F.lit("")) for t in range(fanout)])),
        )

    def higher(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, F.lit(-1))
        return F.when((F.size(top) > 1) | (F.col("n_blocks") > 1), F.concat(levels, F.array(parents(top)))).otherwise(
            levels
        )

    first = F.array(F.transform("items", lambda x: x["leaf"]))
    steps = F.sequence(F.lit(1), F.lit(height)) if height else F.array().cast("array<int>")
    levels = grouped.withColumn("levels", F.aggregate(steps, first, higher))
    return stage(levels.withColumn("node", F.element_at("levels", F.lit(-1))[0]), "blocks")


def exchanged(blocks: DataFrame, fanout: int) -> DataFrame:
    """From (tree, block, n_blocks, node): the root of the tree as `node`, and the block's upper proof `path`."""
    most = blocks.agg(F.max("n_blocks")).first()[0] or 1
    rounds = 0
    while fanout**rounds < most:
        rounds += 1
    none = F.array().cast("array<struct<before:string,after:string>>")
    state = blocks.select("tree", "block", "n_blocks", "node", none.alias("path"))
    # Numbers from n_blocks up to the next power are carriers without leaves, made by the blocks themselves.
    copies = F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))
    state = state.withColumn("copy", copies).withColumn("number", F.col("block") + F.col("copy") * F.col("n_blocks"))
    # The first power of the fanout that is not below n_blocks.
    reach = F.lit(fanout**rounds)
    for r in range(rounds - 1, -1, -1):
        reach = F.when(F.col("n_blocks") <= fanout**r, F.lit(fanout**r)).otherwise(reach)
    state = state.where((F.col("copy") == 0) | (F.col("number") < reach))
    state = state.select(
        "tree",
        F.col("number").alias("block"),
        "n_blocks",
        F.when(F.col("copy") == 0, F.col("node")).alias("node"),
        "path",
    )
    for r in range(rounds):
        low = fanout**r
        live = F.col("n_blocks") > low
        keyed = state.withColumn("digit", _div(F.col("block"), low) % fanout)
        group = keyed.groupBy(
            "tree", _div(F.col("block"), low * fanout).alias("high"), (F.col("block") % low).alias("low")
        ).agg(F.collect_list(F.struct("digit", "block", "n_blocks", "node", "path")).alias("members"))
        by_digit = F.map_from_entries(F.transform("members", lambda m: F.struct(m["digit"], m["node"])))
        group = group.withColumn("nodes", by_digit)
        nodes = [F.coalesce(F.try_element_at("nodes", F.lit(t).cast("long")), F.lit("")) for t in range(fanout)]
        joined = F.concat(*nodes)
        group = group.withColumn("above", F.when(joined != "", digest(joined)))
        state = group.select(
            "tree",
            "above",
            F.inline(
                F.transform(
                    "members",
                    lambda m: F.struct(
                        m["block"].alias("block"),
                        m["n_blocks"].alias("n_blocks"),
                        m["node"].alias("node"),
                        m["path"].alias("path"),
                        _run(lambda t: F.try_element_at("nodes", F.lit(t).cast("long")), m["digit"], fanout).alias("step"),
                    ),
                )
            ),
        ).select(
            "tree",
            "block",
            "n_blocks",
            F.when(live, F.col("above")).otherwise(F.col("node")).alias("node"),
            F.when(live, F.concat("path", F.array("step"))).otherwise(F.col("path")).alias("path"),
        )
        if (r + 1) % ROUNDS_PER_JOB == 0 and r + 1 < rounds:
            state = stage(state, "exchange")
    return stage(state.where(F.col("block") < F.col("n_blocks")).drop("n_blocks"), "upper")


def _expanded(blocks: DataFrame, upper: DataFrame, fanout: int, *more: str) -> DataFrame:
    """One row per leaf: body, leaf, place, its whole `path`, and the columns `more` of `upper`."""
    # 2**40 exceeds every place within a block.
    powers = F.array(*[F.lit(fanout**i) for i in range(40) if fanout**i < 1 << 40])
    both = blocks.select("tree", "block", "items", "levels").join(
        upper.withColumnRenamed("path", "upper"), ["tree", "block"]
    )
    both = both.withColumn("below", F.slice("levels", F.lit(1), F.size("levels") - 1))

    def path(at: Column) -> Column:
        def step(level: Column, i: Column) -> Column:
            own = _div(at, F.get(powers, i))
            digit = own % fanout
            return _run(lambda t: F.get(level, (own - digit + t).cast("int")), digit, fanout)

        return F.concat(F.transform("below", step), F.col("upper"))

    item = F.transform(
        "items",
        lambda x, i: F.struct(x["body"].alias("body"), x["leaf"].alias("leaf"), x["place"].alias("place"), path(i).alias("path")),
    )
    return both.select("tree", *more, F.inline(item))


def manifest(
    docs: DataFrame,
    leaf_of: Column,
    group: str = "lang",
    order: str = "doc_id",
    keep: Column | None = None,
    fanout: int = FANOUT,
    block_leaves: int = BLOCK_LEAVES,
) -> DataFrame:
    """One row per row of `docs`: `keep` (a struct of the caller's), leaf, place, path, subroot, root.

    `path` lists, from the leaf up to the root, the digests before and after the node in its run; `fold` goes up it.
    A node alone in the last run of a level is hashed alone while its level has others; a tree of one leaf has that
    leaf as root. Rows without `group` form a tree of their own, the first one; rows without `order` come first in
    theirs. Rows of equal order are sorted by their leaves, so the root depends on the rows only, not on how they are
    stored. Repeated rows are repeated leaves. An empty table gives no rows.
    """
    keep = F.struct() if keep is None else keep
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("tree")
    first = F.col(f"`{order}`").alias("first")
    # A number of its own lets equal rows, too, lie in different tasks.
    own = F.monotonically_increasing_id().alias("own")
    leaves = stage(docs.select(tree, first, leaf_of.alias("leaf"), own, keep.alias("body")), "leaves")
    low = blocks_of(placed(leaves, ["first", "leaf", "own"]).drop("first", "own"), fanout, block_leaves)
    upper = exchanged(low, fanout)
    subroots = upper.where(F.col("block") == 0).select(
        F.lit("").alias("tree"), F.col("node").alias("leaf"), F.struct(F.col("tree").alias("tree")).alias("body"), F.col("tree").alias("first")
    )
    high = blocks_of(placed(subroots, ["first"]).drop("first"), fanout, block_leaves)
    top = _expanded(high, exchanged(high, fanout), fanout, "node").select(
        F.col("body.tree").alias("tree"), F.col("node").alias("root"), F.col("path").alias("top")
    )
    whole = upper.join(top, "tree").select(
        "tree", "block", F.col("node").alias("subroot"), "root", F.concat("path", "top").alias("path")
    )
    return _expanded(low, whole, fanout, "subroot", "root").drop("tree")


def document_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and the proof itself as `path`.

    Where 7 divides the checksum of the id, the leaf that is verified is made of the row with n_chars one higher, as a
    tampered table would have it; a null n_chars stays. A row without id is never tampered.
    """
    fields = [F.col(f) for f in FIELDS]
    more = [F.col(f).cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    keep = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.when(hit, leaf(*more)).alias("tampered"))
    found = manifest(docs, leaf(*fields), keep=keep)
    shown = F.coalesce("body.tampered", "leaf")
    return found.select(
        F.col("body.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        digest(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")).alias("proof_sha256"),
        fold(shown, F.col("path")).alias("folded_root"),
        "path",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
