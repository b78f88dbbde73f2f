"""Document quality by random indexing and a small network.

Every token has a sparse random index vector; its context vector is the sum of the index vectors of its neighbours over
the whole corpus. A document pools the vectors of its tokens, weighted by rarity. A two-layer network on the pooled
vector is fitted on labelled documents, and its probabilities are calibrated by a temperature on rows it was not
fitted on.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import ROWS_BY_CLASS, remainder, sample

#: Tokens are kept by hash. A vector has DIMENSIONS numbers; an index vector has NONZERO of them set to 1 or -1.
TOKENS, DIMENSIONS, NONZERO, REACH = 1 << 13, 64, 2, 2
HIDDEN, EPOCHS, RATE, DECAY, SEED = 24, 60, 0.01, 1e-3, 7
#: Part of the fitted rows that is kept for choosing the epoch and the temperature.
HELD_BACK = 4
TOKENS_AT_ONCE, POOLED_AT_ONCE, REMEMBERED = 1_000_000, 50_000, 500_000

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Ids(dict):
    """Token to number: words by hash of their lower case, shouted words as one token, signs as they are.

    Number 0 stands between documents.
    """

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        key = "\x00shout" if len(token) > 1 and token.isupper() else token.lower()[:24]
        value = self[token] = 1 + zlib.crc32(key.encode()) % (TOKENS - 1)
        return value


def ids(text: str | None, known: _Ids) -> list[int]:
    return list(map(known.__getitem__, _TOKEN.findall(text or "")))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of each token's index vector; token 0 has none."""
    rng = np.random.default_rng(SEED)
    places = rng.integers(0, DIMENSIONS, (TOKENS, NONZERO))
    signs = rng.choice([-1.0, 1.0], (TOKENS, NONZERO))
    signs[0] = 0
    return places, signs


def context_sums(flat: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Sum of the neighbours' index vectors by token, for a run of tokens with zeros between documents."""
    out = np.zeros(TOKENS * DIMENSIONS)
    for shift in range(1, REACH + 1):
        for here, there in ((flat[shift:], flat[:-shift]), (flat[:-shift], flat[shift:])):
            for j in range(NONZERO):
                out += np.bincount(here * DIMENSIONS + places[there, j], weights=signs[there, j], minlength=len(out))
    return out


def corpus_statistics(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(context sums, documents with the token, documents) over all texts.

    A task adds up a table of fixed size and hands it on as one row per token, so what is shuffled depends on the number
    of tasks, and the result has one row per token whatever the corpus.
    """
    schema = "token int, documents long, total long, sums binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums, counts, known, total = np.zeros(TOKENS * DIMENSIONS), np.zeros(TOKENS, np.int64), _Ids(), 0
        waiting, size = [], 0

        def add():
            nonlocal sums
            if waiting:
                sums += context_sums(np.concatenate(waiting), places, signs)
                waiting.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = np.array(ids(text, known) + [0] * REACH, np.int64)
                counts[np.unique(found[:-REACH])] += 1
                total += 1
                waiting.append(found)
                size += len(found)
            if size > TOKENS_AT_ONCE:
                add()
                size = 0
        add()
        table = sums.reshape(TOKENS, DIMENSIONS).astype(np.float32)
        used = np.flatnonzero(counts)
        if total:
            used = np.append(used, 0)
        yield pa.record_batch(
            [
                pa.array(used, pa.int32()),
                pa.array(counts[used]),
                pa.array(np.where(used == 0, total, 0)),
                pa.array([table[t].tobytes() for t in used], pa.binary()),
            ],
            names=["token", "documents", "total", "sums"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, totals = {}, {}, {}
        for batch in batches:
            for token, n, total, part in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(part, np.float32).astype(np.float64)
                sums[token] = sums[token] + part if token in sums else part
                counts[token] = counts.get(token, 0) + n
                totals[token] = totals.get(token, 0) + total
        yield pa.record_batch(
            [
                pa.array(list(sums), pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array(list(totals.values()), pa.int64()),
                pa.array([s.astype(np.float32).tobytes() for s in sums.values()], pa.binary()),
            ],
            names=["token", "documents", "total", "sums"],
        )

    parts = docs.select("text").mapInArrow(run, schema)
    rows = parts.repartition("token").mapInArrow(merge, schema).collect()  # at most TOKENS rows
    sums, counts, total = np.zeros((TOKENS, DIMENSIONS)), np.zeros(TOKENS), 0
    for r in rows:
        sums[r.token], counts[r.token] = np.frombuffer(r.sums, np.float32), r.documents
        total += r.total
    sums[0] = counts[0] = 0
    return sums, counts, total


def word_vectors(sums: np.ndarray, counts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, rarity): a token's context direction beside its own index vector."""
    places, signs = index_vectors()
    own = np.zeros((TOKENS, DIMENSIONS))
    for j in range(NONZERO):
        np.add.at(own, (np.arange(TOKENS), places[:, j]), signs[:, j])
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    context = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    return np.hstack([context, own]), np.log1p(total / np.maximum(counts, 1.0))


def pooled(flat: np.ndarray, lengths: np.ndarray, table: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Mean row of `table` over each document's tokens, weighted by rarity; zeros for a document without tokens."""
    out = np.zeros((len(lengths), table.shape[1]))
    weighted, has = table * rarity[:, None], np.flatnonzero(lengths)
    end = np.cumsum(lengths)
    start = end - lengths
    while len(has):
        # Some documents at a time, as a row is looked up for every token.
        some = has[: max(1, np.searchsorted(end[has], start[has[0]] + POOLED_AT_ONCE))]
        has = has[len(some) :]
        first, tokens = start[some[0]], flat[start[some[0]] : end[some[-1]]]
        at = start[some] - first
        out[some] = np.add.reduceat(weighted[tokens], at, axis=0) / np.add.reduceat(rarity[tokens], at)[:, None]
    return out


@dataclass
class Network:
    """Two layers. The first is already applied to every token, as pooling is linear: `first` is by token."""

    first: np.ndarray
    rarity: np.ndarray
    bias: np.ndarray
    length: np.ndarray  # weight of the log length, by hidden unit
    second: np.ndarray
    base: float
    temperature: float

    def probability(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        hidden = pooled(flat, lengths, self.first, self.rarity) + self.bias + np.log1p(lengths)[:, None] * self.length
        z = (np.maximum(hidden, 0) @ self.second + self.base) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(rows: pd.DataFrame, sums: np.ndarray, counts: np.ndarray, total: int) -> Network:
    """Fit on rows of text, y and weight. With one class or none the share of that class is the answer."""
    vectors, rarity = word_vectors(sums, counts, total)
    known = _Ids()
    tokens = [np.array(ids(t, known), np.int64) for t in rows["text"]]
    lengths = np.array([len(t) for t in tokens], np.int64)
    y, weight = rows["y"].to_numpy(np.float64), rows["weight"].to_numpy(np.float64)
    if len(set(y.tolist())) < 2:
        rate = float(y.mean()) if len(y) else 0.5
        base = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
        zero = np.zeros(HIDDEN)
        return Network(np.zeros((TOKENS, HIDDEN)), rarity, zero, zero, zero, base, 1.0)
    x = np.hstack([pooled(np.concatenate(tokens), lengths, vectors, rarity), np.log1p(lengths)[:, None]])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x, weight = (x - mean) / spread, weight / weight.mean()
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(x))
    back = order[::HELD_BACK] if len(x) >= 8 else order
    use = np.setdiff1d(order, back) if len(x) >= 8 else order
    w1 = rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN))
    params = [w1, np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def logits(p, rows_):
        return np.maximum(rows_ @ p[0] + p[1], 0) @ p[2] + p[3][0]

    def loss(z, i):
        return float((weight[i] * (np.logaddexp(0, z) - y[i] * z)).sum() / weight[i].sum())

    best, kept, step = np.inf, params, 0
    for _ in range(EPOCHS):
        rng.shuffle(use)
        for i in np.array_split(use, max(1, len(use) // 64)):
            step += 1
            h = np.maximum(x[i] @ params[0] + params[1], 0)
            z = h @ params[2] + params[3][0]
            d = weight[i] * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[i]) / len(i)
            dh = np.outer(d, params[2]) * (h > 0)
            for k, g in enumerate((x[i].T @ dh, dh.sum(axis=0), h.T @ d, np.array([d.sum()]))):
                g = g + DECAY * params[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                params[k] = params[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        now = loss(logits(params, x[back]), back)
        if now < best:
            best, kept = now, [p.copy() for p in params]
    z = logits(kept, x[back])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    temperature = float(grid[np.argmin([loss(z / t, back) for t in grid])])
    scaled = kept[0] / spread[:, None]
    return Network(
        first=vectors @ scaled[:-1],
        rarity=rarity,
        bias=kept[1] - mean @ scaled,
        length=scaled[-1],
        second=kept[2],
        base=float(kept[3][0]),
        temperature=temperature,
    )


def train(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = ROWS_BY_CLASS) -> Network:
    return fit(sample(docs, labels, "quality", remainder(3) != 1, rows), *corpus_statistics(docs))


def score_documents(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = ROWS_BY_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score (that label 1 holds), predicted.

    Word vectors come from all texts, the network from at most `rows` labelled rows by class. Null and empty
    texts pool to zeros and are scored like that.
    """
    net = train(docs, labels, rows)
    values = (net.first.astype(np.float32), net.rarity, net.bias, net.length, net.second, net.base, net.temperature)
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = Network(*pickle.loads(packed.value)), _Ids()
        for batch in batches:
            tokens = [np.array(ids(t, known), np.int64) for t in batch.column(2).to_pylist()]
            lengths = np.array([len(t) for t in tokens], np.int64)
            p = model.probability(np.concatenate([*tokens, np.zeros(0, np.int64)]), lengths)
            yield pa.record_batch([*batch.columns[:2], pa.array(p)], names=["doc_id", "held_out", "score"])

    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text")
    scored = narrow.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
