"""Language of documents by interpolated Kneser-Ney character models.

Each language has a model of `ORDER` characters over lower-case letters, with a space for whatever lies between them.
A model is four arrays: sorted hashes of its n-grams beside their interpolated log probabilities, and sorted hashes of
its contexts beside the log weight that a context leaves to the next lower order. An n-gram that is not found costs
its context's weight and is looked up one character shorter. A document gets the language of the lowest cross-entropy
per character; temperature and limits of rejection are set on documents that the models have not seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import uniform
from .labelled import fitting, remainder

ORDER = 4
#: Bounds of the training sample: documents over all languages, and characters for each of a language's documents
#: together. Every learned language gets an equal share, one document at least.
SAMPLE_ROWS, CHARS_PER_ROW = 4_000, 1_000
#: Every such document of a language's sample sets temperature and limits instead of counts.
HELD_BACK = 5
#: Share of documents of a language that its limit rejects.
REJECTED = 0.01
#: Characters that are scored at once; at least one document.
CHARS_AT_ONCE = 2_000_000
UNKNOWN = "und"

SCORED = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"


def letters(text: Column) -> Column:
    """Lower-case letters and marks, one space for each run of anything else; null without a letter."""
    spaced = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")
    return F.when(text.rlike(r"\p{L}"), F.trim(spaced))


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of an n-gram by its code points; n-grams of different lengths differ too."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15 * (len(columns) + 1) & (1 << 64) - 1, np.uint64)
    for c in columns:
        h = (h ^ c) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, n-grams by text): each text after ORDER - 1 spaces and before one, the last closing its last word."""
    pad = " " * (ORDER - 1)
    flat = np.frombuffer("".join(f"{pad}{t} " for t in texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    return flat, np.array([len(t) + 1 for t in texts], np.int64)


def grams(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The characters of each n-gram, by place."""
    ends = np.ones(len(flat), bool)
    starts = np.cumsum(counts + ORDER - 1) - counts - ORDER + 1
    for k in range(ORDER - 1):
        ends[starts + k] = False
    at = np.flatnonzero(ends)
    return [flat[at - ORDER + 1 + k] for k in range(ORDER)]


@dataclass
class Model:
    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray
    floor: float

    def log_probabilities(self, chars: list[np.ndarray]) -> np.ndarray:
        """Log probability of the last character of each n-gram after the others."""
        out = np.zeros(len(chars[0]))
        todo = np.arange(len(chars[0]))
        for k in range(ORDER):
            part = [c[todo] for c in chars[k:]]
            found, place = _find(self.keys, hashed(part))
            out[todo[found]] += self.logs[place[found]]
            todo, part = todo[~found], [c[~found] for c in part]
            if not len(todo):
                return out
            if k < ORDER - 1:
                known, place = _find(self.contexts, hashed(part[:-1]))
                out[todo[known]] += self.weights[place[known]]
        out[todo] += self.floor
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.searchsorted(keys, wanted)
    place[place == len(keys)] = 0
    return (keys[place] == wanted) if len(keys) else np.zeros(len(wanted), bool), place


def discount(counts: np.ndarray) -> float:
    """Share of a count that goes to the lower order, from the numbers of n-grams seen once and twice."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def estimate(texts: list[str], alphabet: int) -> Model:
    """Interpolated Kneser-Ney model; `alphabet` is the number of characters the lowest order spreads over."""
    chars = grams(*codes(texts))
    _, first, counts = np.unique(hashed(chars), return_index=True, return_counts=True)
    by_order = []
    chars = [c[first] for c in chars]
    for n in range(ORDER, 0, -1):
        by_order.append((chars, counts))
        if n > 1:
            # How many different characters come before the shorter n-gram.
            _, first, counts = np.unique(hashed(chars[1:]), return_index=True, return_counts=True)
            chars = [c[first] for c in chars[1:]]
    keys, logs, contexts, weights = [], [], [], []
    floor = lower = None
    for chars, counts in reversed(by_order):
        d = discount(counts)
        n = len(chars)
        if n == 1:
            total = counts.sum()
            floor = d * len(counts) / total / alphabet
            p = (counts - d) / total + floor
        else:
            context, of = np.unique(hashed(chars[:-1]), return_inverse=True)
            total = np.bincount(of, weights=counts)
            left = d * np.bincount(of) / total
            found, place = _find(lower[0], hashed(chars[1:]))
            p = (counts - d) / total[of] + left[of] * lower[1][place]
            contexts.append(context)
            weights.append(np.log(left))
        key = hashed(chars)
        order = np.argsort(key)
        lower = key[order], p[order]
        keys.append(lower[0])
        logs.append(np.log(lower[1]))
    # The weight of the empty context is in the floor.
    keys, contexts = np.concatenate(keys), np.concatenate(contexts)
    by_key, by_context = np.argsort(keys), np.argsort(contexts)
    return Model(
        keys[by_key],
        np.concatenate(logs)[by_key].astype(np.float32),
        contexts[by_context],
        np.concatenate(weights)[by_context].astype(np.float32),
        float(np.log(floor)),
    )


@dataclass
class Languages:
    names: list[str]  # by code point
    models: list[Model]
    temperature: float
    #: Chance that neither entropies nor temperature tell anything, as where a document's label is wrong.
    doubt: float
    #: By language: mean of a document's cross-entropy, its variance between documents and by character, and the limit
    #: of a document's standardised distance from the mean.
    limits: np.ndarray

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy by text and language, characters); each different n-gram is looked up once."""
        flat, counts = codes(texts)
        chars = grams(flat, counts)
        _, first, of = np.unique(hashed(chars), return_index=True, return_inverse=True)
        some = [c[first] for c in chars]
        start = np.cumsum(counts) - counts
        sums = [np.add.reduceat(m.log_probabilities(some)[of], start) for m in self.models]
        return -np.stack(sums, axis=1) / counts[:, None], counts

    def distance(self, entropy: np.ndarray, count: np.ndarray, best: np.ndarray) -> np.ndarray:
        mean, between, within, _ = self.limits[best].T
        return (entropy - mean) / np.sqrt(between + within / count + 1e-12)

    def classify(self, texts: list[str]):
        """(place of the language, its probability, cross-entropy, rejected), the first of equal languages."""
        entropy, count = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(best)), best]
        far = self.distance(least, count, best) > self.limits[best, 3]
        return best, self.probabilities(entropy)[np.arange(len(best)), best], least, far

    def probabilities(self, entropy: np.ndarray) -> np.ndarray:
        p = np.exp((entropy.min(axis=1, keepdims=True) - entropy) / self.temperature)
        return (1 - self.doubt) * p / p.sum(axis=1, keepdims=True) + self.doubt / entropy.shape[1]


def fit(rows: pd.DataFrame) -> Languages:
    """Fit on rows of text (as `letters` leaves it) and lang, in an order that does not depend on either."""
    names = sorted(rows["lang"].unique())
    by = {n: rows["text"][rows["lang"] == n].tolist() for n in names}
    back = {n: t[::HELD_BACK] if len(t) >= HELD_BACK else [] for n, t in by.items()}
    front = {n: [x for i, x in enumerate(t) if i % HELD_BACK or not back[n]] for n, t in by.items()}
    alphabet = len(set().union(*map(set, rows["text"]))) + 2 if names else 2
    models = [estimate(front[n], alphabet) for n in names]
    known = Languages(names, models, 1.0, 0.0, np.zeros((len(names), 4)))
    known.limits[:, 3] = np.inf
    measured = {i: known.entropies(back[n]) for i, n in enumerate(names) if back[n]}
    if measured:
        entropy = np.vstack([e for e, _ in measured.values()])
        right = np.concatenate([np.full(len(e), i) for i, (e, _) in measured.items()])
        known.doubt = float((entropy.argmin(axis=1) != right).sum() + 1) / (len(right) + 2)

        def loss(t: float) -> float:
            known.temperature = t
            return -float(np.log(known.probabilities(entropy)[np.arange(len(right)), right]).mean())

        known.temperature = min(np.exp(np.linspace(np.log(0.01), np.log(2), 61)).tolist(), key=loss)
    for i, (entropy, count) in measured.items():
        own = entropy[:, i]
        # Characters of a document vary about as much as the squares of its sum's deviation per character.
        within = float(np.average((own - own.mean()) ** 2, weights=count) * np.median(count))
        known.limits[i, :3] = own.mean(), own.var(), within
        z = known.distance(own, count, np.full(len(own), i))
        known.limits[i, 3] = max(3.0, float(np.quantile(z, 1 - REJECTED)))
    return known


def sample(docs: DataFrame, train: Column, rows: int = SAMPLE_ROWS, chars: int = CHARS_PER_ROW) -> pd.DataFrame:
    """text (as `letters` leaves it) and lang of a bounded number of training documents, those of smallest hash.

    Equal rows count once. A text that does not fit into what is left of its language's characters is passed over; only
    if none fits, the shortest is taken.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & train & (F.length("text") > 0))
    known = known.select("lang", "doc_id", F.xxhash64("text").alias("hash"), letters(F.col("text")).alias("text"))
    known = known.where(F.length("text") > 0)
    keys = known.groupBy("lang", "doc_id", "hash").agg(F.max(F.length("text")).alias("size"))
    keys = keys.withColumn("u", uniform(F.col("doc_id"), F.col("hash")))
    count = {r.lang: r.n for r in keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return pd.DataFrame({"text": [], "lang": []})
    each = max(1, rows // len(count))
    # The smallest hashes lie below this share of them; the margin makes too few of them all but impossible.
    share = [(k, min(1.0, (2 * each + 40) / n)) for k, n in count.items()]
    low = keys.join(F.broadcast(docs.sparkSession.createDataFrame(share, "lang string, share double")), "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", "doc_id", "hash"))
    low = low.where(F.col("u") <= F.col("share")).withColumn("place", place).where(F.col("place") <= each)
    found: dict[str, list] = {}
    for r in low.orderBy("lang", "place").collect():
        found.setdefault(r.lang, []).append(r)
    wanted = [
        (k, v[i].doc_id, v[i].hash, v[i].place)
        for k, v in found.items()
        for i in fitting([r.size for r in v], each * chars)
    ]
    wanted = docs.sparkSession.createDataFrame(wanted, "lang string, doc_id long, hash long, place int")
    texts = known.join(F.broadcast(wanted), ["lang", "doc_id", "hash"]).select("lang", "place", "text").toPandas()
    texts = texts.drop_duplicates(["lang", "place"]).sort_values(["lang", "place"], ignore_index=True)
    return texts[["text", "lang"]]


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = CHARS_PER_ROW) -> Languages:
    return fit(sample(docs, remainder(5) != 0, rows, chars))


def identify(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = CHARS_PER_ROW) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    `score` is the calibrated probability of the language among the learned ones; `rejected` says that the text is
    unlikely in that language too. A text that is null or has no letter is `und` with score 0, and so is every text if
    no document has a language to learn from. Rows without an id are scored and never learned from.
    """
    known = train(docs, rows, chars)
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(known))

    def some(model: Languages, texts: list) -> tuple[list, list, list, list]:
        out = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)
        at = [i for i, t in enumerate(texts) if t]
        if at and model.names:
            for i, best, p, entropy, far in zip(at, *map(np.ndarray.tolist, model.classify([texts[i] for i in at]))):
                out[0][i], out[1][i], out[2][i], out[3][i] = model.names[best], p, entropy, far
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(packed.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            parts, size, start = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= CHARS_AT_ONCE:
                    parts.append(some(model, texts[start : i + 1]))
                    size, start = 0, i + 1
            parts.append(some(model, texts[start:]))
            columns = [sum((p[k] for p in parts), []) for k in range(4)]
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            arrays = [*batch.columns[:2], *[pa.array(c, t) for c, t in zip(columns, types)]]
            yield pa.record_batch(arrays, names=[n.split()[0] for n in SCORED.split(", ")])

    held_out = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, letters(F.col("text")).alias("text"))
    return narrow.mapInArrow(run, SCORED)
