"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Document labels become token labels: words that occur in toxic documents far more often than chance allows are toxic
tokens there, all other tokens are clean. The field is fitted on these token labels; forward-backward marginals give
each token's probability, whose combination over a document is calibrated to the document label.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole
from .labelled import remainder, sample

WORD = re.compile(r"\w+")
#: Labelled rows that are looked at, by class: clean ones are needed to tell rare words from toxic ones.
ROWS_BY_CLASS = {0: 5_000, 1: 1_500}
#: Of these, rows by class whose tokens the field is fitted on; all of them calibrate it.
FIELD_ROWS = {0: 500, 1: 1_000}
#: Texts that share so much of their runs of SHINGLE words are near copies; MINIMA hashes estimate it.
NEAR, SHINGLE, MINIMA = 0.8, 5, 64
#: Weights are kept by hash.
WEIGHTS = 1 << 18
STEPS, RATE, DECAY = 40, 0.3, 1e-4
#: Tokens whose recursions run together.
TOKENS_AT_ONCE = 2_000_000
#: Scores by word are forgotten beyond so many words.
REMEMBERED = 500_000
#: Log odds below even ones at which a document without evidence stays.
UNDECIDED = 1e-3


def tokens(text: str) -> list[str]:
    """Lower-cased one by one, as lower case may change the length of a text and so the offsets."""
    return [w.lower() for w in WORD.findall(text)]


def features(word: str) -> tuple[int, int, int]:
    return tuple(zlib.crc32(x.encode()) % WEIGHTS for x in (word, "^" + word[:4], word[-4:] + "$"))


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of the runs of five words, each once; of the whole text if it is shorter."""
    h = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(len(h), SHINGLE)):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 1 << 62, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(found), 10_000):
        mixed = (found[None, i : i + 10_000] * odd[:, None]) >> np.uint64(32)
        out = np.minimum(out, mixed.min(axis=1).astype(np.uint32))
    return out


def families(words: Iterable[list[str]]) -> list[int]:
    """Number of the family of each text: that of the first text it is a near copy of, or one of its own.

    Near copies share `NEAR` of the shingles of both whole texts. Minima of hashes choose what is compared.
    """
    out, firsts, known = [], [], np.empty((64, MINIMA), np.uint32)
    for text in words:
        found = shingles(text)
        mark = signature(found)
        alike = np.count_nonzero(known[: len(firsts)] == mark, axis=1)
        for k in np.flatnonzero(alike >= (NEAR - 0.2) * MINIMA).tolist():
            common = len(np.intersect1d(found, firsts[k], assume_unique=True))
            if common >= NEAR * (len(found) + len(firsts[k]) - common):
                out.append(k)
                break
        else:
            if len(firsts) == len(known):
                known = np.concatenate([known, np.empty_like(known)])
            known[len(firsts)] = mark
            out.append(len(firsts))
            firsts.append(found)
    return out


def toxic_words(texts: list[str], y: np.ndarray, least: int = 4) -> set[str]:
    """Words that mark toxic documents beyond chance.

    Counted once per family of near copies, as these are no further evidence. The chance that a word falls into toxic
    documents so often must be below one in the number of words, and most of its documents must be toxic.
    """
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    sizes = {}
    for label in seen:
        own = [t for t, of in zip(texts, y) if of == label]
        groups: dict[int, list[int]] = {}
        for i, k in enumerate(families(map(tokens, own))):
            groups.setdefault(k, []).append(i)
        for group in groups.values():
            seen[label].update({w for i in group for w in tokens(own[i])})
        sizes[label] = len(groups)
    share = sizes[1] / max(1, sizes[0] + sizes[1])
    limit = math.log(1e-2 / max(1, len(seen[0].keys() | seen[1].keys())))
    out = set()
    for w, k in seen[1].items():
        n = k + seen[0][w]
        rate = k / n
        if k >= least and rate >= max(0.75, share + (1 - share) / 2):
            # Chernoff bound of the binomial tail.
            rest = (1 - rate) * math.log((1 - share) / (1 - rate)) if rate < 1 else 0
            if n * (rate * math.log(share / rate) + rest) < limit:
                out.add(w)
    return out


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Probability of the toxic state of each token, and expected transitions if asked for.

    `scores` holds, document after document, by how much the toxic state is preferred at a token; `transitions` the
    log weights from state to state. Documents run side by side, longest first, so that step t works on all that have
    a token t. Messages are ratios of the toxic to the clean state.
    """
    start = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    start, length = start[order], lengths[order]
    a = np.exp(transitions)
    s = np.exp(np.clip(scores, -60, 60))
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # documents with more than t tokens
    forward, backward = np.empty_like(s), np.ones_like(s)
    ratio = np.ones(len(length))
    for t in range(longest):
        k = active[t]
        at = start[:k] + t
        if t:
            r = ratio[:k]
            r = (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)
        else:
            r = a[0, 1] / a[0, 0]
        ratio[:k] = forward[at] = s[at] * r
    last = np.ones(len(length))
    for t in range(longest - 2, -1, -1):
        k = active[t + 1]
        at = start[:k] + t
        r = s[at + 1] * last[:k]
        last[:k] = backward[at] = (a[1, 0] + a[1, 1] * r) / (a[0, 0] + a[0, 1] * r)
        last[k : active[t]] = 1.0
    odds = forward * backward
    p = odds / (1 + odds)
    if not pairs:
        return p, None
    inner = np.ones(len(s), bool)
    inner[start[length > 0]] = False
    i = np.flatnonzero(inner)
    f, b = forward[i - 1], s[i] * backward[i]
    every = a[0, 0] + a[0, 1] * b + a[1, 0] * f + a[1, 1] * f * b
    expected = [a[0, 0] / every, a[0, 1] * b / every, a[1, 0] * f / every, a[1, 1] * f * b / every]
    return p, np.array([x.sum() for x in expected])


def evidence(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log odds that at least one token of a document is toxic; very low for a document without tokens."""
    clean = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
    end = np.cumsum(lengths)
    none = np.minimum(clean[end] - clean[end - lengths], -1e-9)
    return np.log(-np.expm1(none)) - none


#: (start, end, probability) of a stretch of toxic tokens, in characters of the text.
Span = tuple[int, int, float]


def stretches(text: str, p: np.ndarray, least: float = 0.5) -> list[Span]:
    """Stretches of neighbouring tokens of probability `least` or more; `p` holds that of each token."""
    toxic = np.flatnonzero(p >= least)
    if not len(toxic):
        return []
    places = [m.span() for m in WORD.finditer(text)]
    out: list[Span] = []
    for i in toxic.tolist():
        if out and i and p[i - 1] >= least:
            out[-1] = (out[-1][0], places[i][1], max(out[-1][2], float(p[i])))
        else:
            out.append((*places[i], float(p[i])))
    return out


class _Scores(dict):
    """Score of each word met so far, in any case."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = self[word] = float(sum(self.weights[i] for i in features(word.lower())))
        return value


@dataclass
class Field:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    base: float

    def __post_init__(self):
        self._known = _Scores(self.weights)

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self._known) > REMEMBERED:
            self._known.clear()
        return np.array(list(map(self._known.__getitem__, words)), np.float64)

    def evidence(self, scores: list[np.ndarray]) -> np.ndarray:
        return evidence(*self._marginals(scores))

    def _marginals(self, scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(s) for s in scores], np.int64)
        return marginals(np.concatenate([*scores, np.zeros(0)]), lengths, self.transitions)[0], lengths

    def _calibrated(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * np.clip(x, -20, 20) + self.base
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def documents(self, scores: list[np.ndarray]) -> np.ndarray:
        return self._calibrated(self.evidence(scores))

    def judged(self, texts: list[str], scores: list[np.ndarray]) -> tuple[np.ndarray, list[list[Span]]]:
        """Document scores, and the toxic stretches of each text."""
        p, lengths = self._marginals(scores)
        end = np.cumsum(lengths)
        parts = (p[e - n : e] for e, n in zip(end, lengths))
        return self._calibrated(evidence(p, lengths)), [stretches(t, x) for t, x in zip(texts, parts)]

    def spans(self, text: str) -> list[Span]:
        return self.judged([text], [self.scores(WORD.findall(text))])[1][0]


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve, by Newton's method with a light pull to slope 1."""
    x = np.clip(x, -20, 20)
    w, design = np.zeros(2), np.stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        gradient = design @ (weight * (p - y)) + 1e-2 * w
        hessian = (design * (weight * p * (1 - p))) @ design.T + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(rows: pd.DataFrame) -> Field:
    """Fit on rows of text, y and weight. Without rows of both classes, or words that mark one, every token is clean.

    What bears no evidence is never called toxic, whatever the share of toxic labels: without toxic words all
    documents get that share as score, but less than 0.5.
    """
    texts, y = rows["text"].tolist(), rows["y"].to_numpy(np.int64)
    weight = rows["weight"].to_numpy(np.float64)
    bad = toxic_words(texts, y) if len(set(y.tolist())) == 2 else set()
    weights, transitions = np.zeros(WEIGHTS), np.log(np.array([[0.9, 0.1], [0.5, 0.5]]))
    bias = features("")[0]
    if not bad:
        weights[bias] = -30.0
        rate = float(np.average(y, weights=weight)) if len(y) else 0.0
        return Field(weights, transitions, 0.0, min(math.log((rate + 1e-3) / (1 - rate + 1e-3)), -UNDECIDED))
    used = np.concatenate([np.flatnonzero(y == label)[:n] for label, n in FIELD_ROWS.items()])
    docs = [list(map(sys.intern, tokens(texts[i]))) for i in used]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    flat = np.fromiter((vocabulary[w] for d in docs for w in d), np.int32)
    lengths = np.array([len(d) for d in docs], np.int64)
    del docs
    is_bad = np.array([w in bad for w in vocabulary], bool)
    gold = (is_bad[flat] & np.repeat(y[used] == 1, lengths)).astype(np.float64)
    index = np.array([features(w) for w in vocabulary], np.int64)
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    inner = np.ones(len(flat), bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    pairs = np.bincount((gold[i - 1] * 2 + gold[i]).astype(np.int64), minlength=4).astype(float)
    observed = np.concatenate([np.bincount(flat, weights=gold, minlength=len(vocabulary)), pairs])
    scale, links = max(1.0, gold.sum()), WEIGHTS + np.arange(4)
    theta = np.concatenate([weights, np.log((pairs + 1) / (pairs.reshape(2, 2).sum(axis=1).repeat(2) + 2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        scores = theta[index].sum(axis=1)
        p, expected = marginals(scores[flat], lengths, theta[links].reshape(2, 2), pairs=True)
        by = np.concatenate([np.bincount(flat, weights=p, minlength=len(vocabulary)), expected]) - observed
        gradient = np.bincount(index.ravel(), weights=np.repeat(by[:-4], 3), minlength=WEIGHTS + 4)
        gradient[links] = by[-4:]
        gradient = gradient / scale + DECAY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights, transitions = theta[:WEIGHTS], theta[links].reshape(2, 2)
    model = Field(weights, transitions, 1.0, 0.0)
    seen = [model.evidence([model.scores(tokens(t)) for t in texts[i : i + 500]]) for i in range(0, len(texts), 500)]
    slope, base = _calibrate(np.concatenate(seen), y, weight / weight.mean())
    if base - 20 * slope >= 0:
        # So many toxic labels lack evidence that a text without any would be called toxic: ask for even odds.
        slope, base = max(slope, UNDECIDED), -UNDECIDED
    return Field(weights, transitions, slope, base)


def train(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = ROWS_BY_CLASS) -> Field:
    return fit(sample(docs, labels, "toxic", remainder(5) != 0, rows))


SPANS = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("probability", "double"))


def _scored(docs: DataFrame, field: Field) -> DataFrame:
    """Columns of `docs` (text last) with `score` and `spans` in place of the text; one pass, no shuffle."""
    import pickle

    # Kept as bytes until a worker needs it.
    model = (field.weights.astype(np.float32), field.transitions, field.slope, field.base)
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    schema = docs.drop("text").schema.add("score", "double").add("spans", SPANS)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(*pickle.loads(packed.value))
        waiting, texts, held, size = [], [], [], 0

        def flush():
            (p, found), i = model.judged(texts, held), 0
            for b in waiting:
                spans = [[dict(zip(("start", "end", "probability"), s)) for s in x] for x in found[i : i + b.num_rows]]
                columns = [*b.columns[:-1], pa.array(p[i : i + b.num_rows]), pa.array(spans, pa.list_(span))]
                yield pa.record_batch(columns, names=[*b.schema.names[:-1], "score", "spans"])
                i += b.num_rows

        for batch in batches:
            for text in batch.column(batch.num_columns - 1).to_pylist():
                texts.append(text or "")
                held.append(model.scores(WORD.findall(texts[-1])))
                size += len(held[-1])
            waiting.append(batch)
            if size > TOKENS_AT_ONCE:
                yield from flush()
                waiting, texts, held, size = [], [], [], 0
        if waiting:
            yield from flush()

    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = ROWS_BY_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, spans, predicted.

    `spans` holds start, end (exclusive, both in code points) and greatest probability of each stretch of tokens that
    are toxic by their marginals. Null and empty texts have no tokens, no spans and get the score of a text without
    evidence. Fitted on at most `rows` rows by class, scored on all.
    """
    field = train(docs, labels, rows)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text")
    scored = _scored(narrow, field)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = ROWS_BY_CLASS) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    field = train(docs, labels, rows)
    scored = _scored(docs.select(whole(docs).alias("doc"), "text"), field)
    return scored.where("score < 0.5").select("doc.*")
