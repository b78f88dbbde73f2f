"""Packing documents into token sequences by multiway Karmarkar-Karp differencing.

A document is cut into full windows, which need no packing, and a remainder in pieces. Pieces are dealt over blocks
of a bounded number of tokens. In a block each piece is a partition of the windows with one piece in it; the two
partitions of largest imbalance are merged again and again, the fullest windows of one with the emptiest of the
other, until one partition is left. If a window then holds more than its capacity, the block gets one window more.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stage

WINDOW = 2048
#: Longest piece of a remainder. Shorter pieces fill windows better and cut documents more often.
PIECE = 512
#: Tokens and pieces of a block, on average.
BLOCK_TOKENS, BLOCK_PIECES = 96 * WINDOW, 8_000
#: White space runs from which on the fast encoder is not asked.
LONG_RUN = 4_096
#: Id after the last token of a document.
END_ID = 1

PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"


def encoder(vocabulary: str, ranks: str, pattern: str):
    """Function from texts to arrays of ids.

    The two files hold one vocabulary: the rank file is encoded much faster, and texts that name a special token or
    hold a very long run of white space, in which its pattern would backtrack too deep, go to the other.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as file:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    # Where no white space follows another, the branch that looks ahead splits nothing; without it matching is faster.
    single = pattern.replace(r"|\s+(?!\S)", "")
    faster = tiktoken.Encoding("single", pat_str=single, mergeable_ranks=table, special_tokens={})
    double, long = re.compile(r"\s\s"), re.compile(rf"\s{{{LONG_RUN}}}")
    whole = Tokenizer.from_file(vocabulary)
    special = re.compile("|".join(re.escape(t.content) for t in whole.get_added_tokens_decoder().values()) or "(?!)")

    def encode(text: str) -> list[int]:
        if special.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        if not double.search(text):
            return faster.encode_ordinary(text)
        if not long.search(text):
            return fast.encode_ordinary(text)
        return whole.encode(text, add_special_tokens=False).ids

    return encode


def cut(tokens: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of full windows, then of the remainder in pieces."""
    full = tokens - tokens % window
    out = [(s, window) for s in range(0, full, window)]
    return out + [(s, min(piece, tokens - s)) for s in range(full, tokens, piece)]


def public_files() -> tuple[str, str, str]:
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def pieces(rows: DataFrame, files: tuple[str, str, str] | None = None, window: int = WINDOW, piece: int = PIECE):
    """From (row, doc_id, text): one row per piece. Ids are made and summed up in one pass and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*(files or public_files()))
        schema = pa.schema([(n.split()[0], pa.int64()) for n in PIECES.split(", ")])
        for batch in batches:
            out = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array(encode(text or "") + [END_ID], "<u4")
                out += [
                    (row, doc_id, s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids))
                    for s, n in cut(len(ids), window, piece)
                ]
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return rows.select("row", "doc_id", "text").mapInArrow(run, PIECES)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size; sums of windows come out near equal."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, np.int64)
    # A window is one number: its sum in the high bits, the node that lists its pieces in the low ones. Node i up to
    # n is piece i - 1, a node above n joins two nodes, 0 is an empty window.
    low, high = (1 << 32) - 1, 32
    left, right = [0] * (n + 1), [0] * (n + 1)
    alive: dict[int, np.ndarray] = {}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)

    def open_(key: int) -> np.ndarray:
        if key in alive:
            return alive.pop(key)
        out = np.zeros(windows, np.int64)
        out[-1] = (int(sizes[key]) << high) + key + 1
        return out

    fresh = n
    while len(heap) > 1:
        a, b = open_(heapq.heappop(heap)[1]), open_(heapq.heappop(heap)[1])[::-1]
        both = np.flatnonzero((a & low) * (b & low))
        merged = a + b
        if len(both):
            new = len(left)
            left += (a[both] & low).tolist()
            right += (b[both] & low).tolist()
            merged[both] = (merged[both] >> high << high) + np.arange(new, new + len(both))
        merged.sort()
        alive[fresh] = merged
        heapq.heappush(heap, (-int((merged[-1] >> high) - (merged[0] >> high)), fresh))
        fresh += 1
    at = np.zeros(n, np.int64)
    for window, node in enumerate((open_(heap[0][1]) & low).tolist()):
        stack = [node] if node else []
        while stack:
            node = stack.pop()
            if node <= n:
                at[node - 1] = window
            else:
                stack += [left[node], right[node]]
    return at


def fill(sizes: np.ndarray, capacity: int = WINDOW) -> np.ndarray:
    """Window of each size, over as few windows as differencing keeps within capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = differencing(sizes, windows)
        if np.bincount(at, weights=sizes, minlength=1).max(initial=0) <= capacity:
            return at
        windows += 1


def _pack_block(window: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("row", "ascending"), ("start", "ascending")])
        length = block["length"].to_numpy()
        full = length == window
        at = np.zeros(len(length), np.int64)
        at[~full] = fill(length[~full], window)
        at[full] = np.arange(full.sum()) + (at[~full].max() + 1 if (~full).any() else 0)
        order = np.argsort(at, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        first = np.append(True, at[order][1:] != at[order][:-1])
        offset = np.empty_like(length)
        offset[order] = before - before[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        sequence = (block["block"][0].as_py() << 24) + at
        block = block.drop_columns(["block"])
        return block.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, files: tuple[str, str, str] | None = None, window: int = WINDOW, piece: int = PIECE):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and row).

    A null or empty text is one piece with the end id. Ids may be null or repeated: a document is a row. An empty
    table gives no rows. `window` is the capacity; sequences are padded to it unless their length is a power of two.
    """
    rows = numbered(docs, "documents", doc_id=F.col("doc_id").cast("long"), text=F.col("text"))
    cut_up = stage(pieces(rows, files, window, piece), "pieces")
    total = cut_up.where(F.col("length") < window).agg(F.sum("length"), F.count(F.lit(1))).first()
    blocks = max(1, (total[0] or 0) // BLOCK_TOKENS, total[1] // BLOCK_PIECES)
    dealt = cut_up.withColumn("block", F.pmod(F.xxhash64("row", "start"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(_pack_block(window), PLACED)


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(docs).drop("row")
