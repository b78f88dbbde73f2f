"""Alignment of two tokenizers' tokens by galloping intersection.

Both tokenizers cut the same bytes, so a token is known by the byte offset of its end. The shorter of a document's two
lists of ends drives the search: each of its ends gallops through the longer list, in doubling steps from the place
where it is expected and then by bisection, all of them side by side in numpy. Offsets found in both lists cut the
tokens into groups, and differences of ranks say which tokens of the one list a token of the other overlaps.

Links (tokens that end together) are counted over the corpus by pairs of ids. Documents are taken in blocks; a block
has one dictionary of its pairs, whose counts are summed by pair and sent back to the block, where its documents look
them up. So a pair is shuffled once per block and not once per document, and no table of pairs is sent to all.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

#: Links of a block; a block holds at least one document, whatever its length.
BLOCK_LINKS = 2_000_000
#: Bytes of text that are aligned at once; at least one document.
BYTES_AT_ONCE = 4_000_000
#: White space runs from which on the fast encoder's pattern would backtrack too deep.
LONG_RUN = 4_096

DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
STAGED = f"block long, {DOCUMENT}, places binary, times binary, pairs array<long>, links array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
ALIGNED = (
    "doc_id long, a_ids array<long>, b_ids array<long>, a_ends array<long>, b_ends array<long>, "
    "first_b array<long>, last_b array<long>"
)


@dataclass(frozen=True)
class Files:
    """Vocabularies: of A as JSON and as ranks (one vocabulary, the ranks are encoded faster), its pattern, and of B."""

    json: str
    ranks: str
    pattern: str
    pieces: str


def public_files() -> Files:
    import public_tokenizers as p

    return Files(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN, p.path("piece_bpe_32k.model"))


class Tokenizers:
    """Encoders of A and B without special tokens, and the bytes of their ids."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        with open(files.ranks, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._json, self._whole = files.json, None
        self._fast = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        # Where no white space follows another, the branch that looks ahead splits nothing; without it matching is faster.
        single = files.pattern.replace(r"|\s+(?!\S)", "")
        self._single = tiktoken.Encoding("single", pat_str=single, mergeable_ranks=ranks, special_tokens={})
        self._double, self._long = re.compile(r"\s\s"), re.compile(rf"\s{{{LONG_RUN}}}")
        self._b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def a(self, text: str) -> list[int]:
        if not self._double.search(text):
            return self._single.encode_ordinary(text)
        if not self._long.search(text):
            return self._fast.encode_ordinary(text)
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json)
            self._whole.encode_special_tokens = True
        return self._whole.encode(text, add_special_tokens=False).ids

    def both(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of a space and the text; none if either tokenizer loses a byte."""
        if not text:
            return [], []
        spaced = " " + text
        a, b = self.a(spaced), self._b.encode(text, num_threads=1)
        want = spaced.encode()
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(table.__getitem__, ids)) != want:
                return [], []
        return a, b


def gallop(keys: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each key the first place in [low, high) of the sorted `ends` that is not below it, `high` if there is none.

    Every key starts at its own place, doubles its step until the step has passed it, and bisects the last step.
    """
    at = np.clip(start, low, np.maximum(high - 1, low))
    up = np.zeros(len(keys), bool)
    some = low < high
    up[some] = ends[at[some]] < keys[some]
    # Ends up to `left` are below the key, ends from `right` on are not.
    left, right = np.where(up, at, low - 1), np.where(up, high, at)
    todo, step = np.flatnonzero(some), 1
    while len(todo):
        rise = up[todo]
        probe = at[todo] + np.where(rise, step, -step)
        inside = (probe >= low[todo]) & (probe < high[todo])
        todo, probe, rise = todo[inside], probe[inside], rise[inside]
        below = ends[probe] < keys[todo]
        left[todo[below]] = probe[below]
        right[todo[~below]] = probe[~below]
        todo = todo[below == rise]
        step *= 2
    todo = np.flatnonzero(right - left > 1)
    while len(todo):
        middle = (left[todo] + right[todo]) // 2
        below = ends[middle] < keys[todo]
        left[todo[below]] = middle[below]
        right[todo[~below]] = middle[~below]
        todo = todo[right[todo] - left[todo] > 1]
    return right


def _each(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(values, counts)


def ranks(keys: np.ndarray, n_keys: np.ndarray, ends: np.ndarray, n_ends: np.ndarray, before: int = 0) -> np.ndarray:
    """Place of each key among its document's ends, or of the key less `before`; documents lie one after another."""
    stop = np.cumsum(n_ends)
    low, high = _each(stop - n_ends, n_keys), _each(stop, n_keys)
    own = np.arange(len(keys)) - _each(np.cumsum(n_keys) - n_keys, n_keys)
    expected = low + own * _each(n_ends, n_keys) // np.maximum(_each(n_keys, n_keys), 1)
    return gallop(keys - before, ends, low, high, expected)


@dataclass
class Batch:
    """Aligned documents, one after another: ids, tokens by document, and the tokens (by place) that end together."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    n_groups: np.ndarray


def aligned(found: list[tuple[list[int], list[int]]], tokenizers: Tokenizers) -> Batch:
    n_a, n_b = (np.array([len(ids[k]) for ids in found], np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int64), *[np.array(ids[k], np.int64) for ids in found]]) for k in (0, 1))
    # Both cover the same bytes, so ends may run on from document to document.
    ends_a, ends_b = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
    partner = np.full(len(a), -1, np.int64)
    first_a, first_b = _each(n_b <= n_a, n_a), _each(n_b <= n_a, n_b)
    for driven_by_b in (True, False):
        mine_a, mine_b = np.flatnonzero(first_a == driven_by_b), np.flatnonzero(first_b == driven_by_b)
        docs = (n_b <= n_a) == driven_by_b
        x, y = (mine_b, mine_a) if driven_by_b else (mine_a, mine_b)
        short, n_short = (ends_b, n_b) if driven_by_b else (ends_a, n_a)
        long, n_long = (ends_a, n_a) if driven_by_b else (ends_b, n_b)
        keys, into = short[x], long[y]
        place = ranks(keys, n_short[docs], into, n_long[docs])
        hit = np.flatnonzero(place < len(into))
        hit = hit[into[place[hit]] == keys[hit]]
        if driven_by_b:
            partner[y[place[hit]]] = x[hit]
        else:
            partner[x[hit]] = y[place[hit]]
    at_a = np.flatnonzero(partner >= 0)
    doc = _each(np.arange(len(found)), n_a)[at_a]
    return Batch(a, b, n_a, n_b, ends_a, ends_b, at_a, partner[at_a], np.bincount(doc, minlength=len(found)))


def _slices(counts: np.ndarray) -> list[slice]:
    stop = np.cumsum(counts).tolist()
    return [slice(s, e) for s, e in zip([0, *stop], stop)]


class Groups:
    """Digests of the groups, written as `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, tokenizers: Tokenizers):
        most = max(len(tokenizers.a_size), len(tokenizers.b_size))
        self._most = most
        self._text = [f"{i}{sign}" for sign in ",|;" for i in range(most)]

    def digests(self, x: Batch) -> list[str]:
        # A group's tokens of A, then its tokens of B: a token moves by the tokens of the other kind that come before.
        a_stop, b_stop = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        a_stop[x.at_a], b_stop[x.at_b] = 1, 1
        a_group, b_group = np.cumsum(a_stop) - a_stop, np.cumsum(b_stop) - b_stop
        b_before = np.concatenate([[0], x.at_b + 1])
        a_until = x.at_a + 1
        line = np.empty(len(x.a) + len(x.b), np.int64)
        if len(x.a):
            line[np.arange(len(x.a)) + b_before[a_group]] = x.a + a_stop * self._most
            line[np.arange(len(x.b)) + a_until[b_group]] = x.b + b_stop * 2 * self._most
        out = []
        for part in _slices(x.n_a + x.n_b):
            text = "".join(map(self._text.__getitem__, line[part].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
        return out


def _batches(batches: Iterator[pa.RecordBatch], tokenizers: Tokenizers):
    """(doc ids, aligned) of some documents at a time."""
    ids: list = []
    found: list = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            ids.append(doc_id)
            found.append(tokenizers.both(text))
            size += len(text or "")
            if size >= BYTES_AT_ONCE:
                yield ids, aligned(found, tokenizers)
                ids, found, size = [], [], 0
    if ids:
        yield ids, aligned(found, tokenizers)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def alignments(docs: DataFrame, files: Files | None = None) -> DataFrame:
    """One row per document: its ids, groups (tokens of A and of B up to each group's end) and, for each token of A, the
    first and last token of B (from 0) that shares a byte with it.

    Documents without tokens (null, empty, or with bytes that a tokenizer loses) have empty lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(files or public_files())
        for ids, x in _batches(batches, tokenizers):
            begins = x.ends_a - tokenizers.a_size[x.a]
            base_b = _each(np.cumsum(x.n_b) - x.n_b, x.n_a)
            # The first end after a token's begin, and the first end not before its own end.
            first = ranks(begins + 1, x.n_a, x.ends_b, x.n_b) - base_b
            last = ranks(x.ends_a, x.n_a, x.ends_b, x.n_b) - base_b
            a, b, groups = _slices(x.n_a), _slices(x.n_b), _slices(x.n_groups)
            until_a, until_b = x.at_a + 1, x.at_b + 1
            columns = [
                [x.a[s].tolist() for s in a],
                [x.b[s].tolist() for s in b],
                [(until_a[g] - s.start).tolist() for g, s in zip(groups, a)],
                [(until_b[g] - s.start).tolist() for g, s in zip(groups, b)],
                [first[s].tolist() for s in a],
                [last[s].tolist() for s in a],
            ]
            arrays = [pa.array(ids, pa.int64()), *[pa.array(c, pa.list_(pa.int64())) for c in columns]]
            names = [n.split()[0] for n in ALIGNED.split(", ")]
            yield pa.record_batch(arrays, names=names)

    return _narrow(docs).mapInArrow(run, ALIGNED)


_PAIR_A = 32
_STAGED = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64())]
    + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary())]
    + [("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))]
)


def _block(number: int, rows: list[tuple], pairs: list[np.ndarray]) -> pa.RecordBatch:
    """A block's documents, each with the places of its pairs in the block's dictionary and how often it has them, and
    the dictionary as one more row."""
    counts = np.array([len(p) for p in pairs], np.int64)
    known, place = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]), return_inverse=True)
    of = _each(np.arange(len(rows)), counts) * max(len(known), 1) + place
    at, times = np.unique(of, return_counts=True)
    doc, at = np.divmod(at, max(len(known), 1))
    parts = _slices(np.bincount(doc, minlength=len(rows)))
    at, times = at.astype("<i4"), times.astype("<i4")
    out = [(number, *r, at[s].tobytes(), times[s].tobytes(), None, None) for r, s in zip(rows, parts)]
    all_of = np.bincount(place, minlength=len(known)).tolist()
    out.append((number, *[None] * 8, known.tolist(), all_of))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _STAGED)], schema=_STAGED)


def blocks(docs: DataFrame, files: Files | None = None, most: int = BLOCK_LINKS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers = Tokenizers(files or public_files())
        groups = Groups(tokenizers)
        number, rows, pairs, links = TaskContext.get().partitionId() << 32, [], [], 0
        for ids, x in _batches(batches, tokenizers):
            pair = (x.a[x.at_a] << _PAIR_A) + x.b[x.at_b]
            n_a, n_b, n_groups = x.n_a.tolist(), x.n_b.tolist(), x.n_groups.tolist()
            # No token is empty, so as many tokens end together as there are groups.
            rows += list(zip(ids, n_a, n_b, n_groups, n_groups, groups.digests(x)))
            pairs += [pair[s] for s in _slices(x.n_groups)]
            links += len(pair)
            if links >= most:
                yield _block(number, rows, pairs)
                number, rows, pairs, links = number + 1, [], [], 0
        if rows:
            yield _block(number, rows, pairs)

    return stage(_narrow(docs).mapInArrow(run, STAGED), "blocks")


def _looked_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
    counts = counts.sort_by("place")
    total, best = counts["total"].to_numpy(), counts["best"].to_numpy()
    sums, n_best = [], []
    for places, times in zip(docs["places"].to_pylist(), docs["times"].to_pylist()):
        at, n = np.frombuffer(places, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
        sums.append(int((total[at] * n).sum()) if len(at) else 0)
        n_best.append(int((best[at] * n).sum()) if len(at) else 0)
    columns = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    columns += [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), docs["groups_sha256"]]
    return pa.table(columns, names=[n.split()[0] for n in RESULT.split(", ")])


def pair_counts(staged: DataFrame) -> DataFrame:
    """pair, total (links over the corpus), best (1 where no other pair of the same id of B has more)."""
    entries = staged.where(F.col("pairs").isNotNull()).select(F.inline(F.arrays_zip("pairs", "links")))
    total = entries.groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("total"))
    # At most one row per id of A in a window.
    most = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << _PAIR_A) - 1))))
    return total.withColumn("best", (F.col("total") == most).cast("long"))


def align_documents(docs: DataFrame, files: Files | None = None, most: int = BLOCK_LINKS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Documents without tokens (null, empty, or with bytes that a tokenizer loses) have zeros and an empty digest. Ids
    may be null or repeated: a document is a row, and repeated rows count each time. An empty table gives no rows.
    """
    staged = blocks(docs, files, most)
    dictionary = staged.where(F.col("pairs").isNotNull())
    entries = dictionary.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    counts = entries.join(pair_counts(staged), "pair").select("of", "place", "total", "best")
    rows = staged.where(F.col("pairs").isNull()).drop("pairs", "links")
    return rows.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(_looked_up, RESULT)
