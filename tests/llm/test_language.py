from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.llm import language as L

SF = "/root/testdata/sf0.001"


class Plain:
    """The same model, with dictionaries of strings and probabilities by the recursive rule."""

    def __init__(self, texts, alphabet):
        self.alphabet = alphabet
        raw = Counter()
        for t in texts:
            padded = " " * (L.ORDER - 1) + t + " "
            raw.update(padded[i : i + L.ORDER] for i in range(len(padded) - L.ORDER + 1))
        self.counts = {L.ORDER: raw}
        for n in range(L.ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.after = {n: defaultdict(list) for n in self.counts}
        for n, counts in self.counts.items():
            for g, c in counts.items():
                self.after[n][g[:-1]].append(c)
        self.discount = {n: L.discount(np.array(list(c.values()))) for n, c in self.counts.items()}

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / self.alphabet
        follow = self.after[n].get(gram[:-1])
        if not follow:
            return self.p(gram[1:])
        d, total = self.discount[n], sum(follow)
        own = self.counts[n].get(gram, 0)
        return max(own - d, 0) / total + d * len(follow) / total * self.p(gram[1:])

    def entropy(self, text):
        padded = " " * (L.ORDER - 1) + text + " "
        grams = [padded[i : i + L.ORDER] for i in range(len(padded) - L.ORDER + 1)]
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


TEXTS = ["the cat sat on the mat", "a cat and a hat", "the end", "mat", "other things that the cat did"]


def test_model_equals_plain_rule():
    model, plain = L.estimate(TEXTS, 30), Plain(TEXTS, 30)
    known = L.Languages(["x"], [model], 1.0, 0.0, np.zeros((1, 4)))
    tried = ["the cat", "zebra", "ünknown", "a", "mat the hat", "theend"]
    entropy, counts = known.entropies(tried)
    assert counts.tolist() == [len(t) + 1 for t in tried]
    assert entropy[:, 0] == pytest.approx([plain.entropy(t) for t in tried], rel=1e-5)


def test_probabilities_sum_to_one():
    model = L.estimate(TEXTS, 30)
    seen = sorted(set("".join(TEXTS)) | {" "})
    for context in ("the", "  t", "zzz", "cat"):
        grams = [np.array([ord(c)] * len(seen), np.uint64) for c in context] + [np.array([ord(c) for c in seen], np.uint64)]
        p = np.exp(model.log_probabilities(grams)).sum()
        unseen = math.exp(model.log_probabilities([g[:1] for g in grams[:-1]] + [np.array([ord("Ω")], np.uint64)])[0])
        assert p + unseen * (30 - len(seen)) == pytest.approx(1, abs=1e-4)


def test_query_against_plain_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = L.sample(docs, L.remainder(5) != 0)
    assert all(t == t.lower() for t in rows["text"])
    known = L.fit(rows)
    alphabet = len(set("".join(rows["text"]))) + 2
    plain = {}
    for n in known.names:
        mine = rows["text"][rows["lang"] == n].tolist()
        plain[n] = Plain([t for i, t in enumerate(mine) if i % L.HELD_BACK], alphabet)
    letters = {r.doc_id: r.t for r in docs.select("doc_id", L.letters(F.col("text")).alias("t")).collect()}
    found = {r.doc_id: r for r in L.identify(docs).collect()}
    assert len(found) == docs.count()
    for i in sorted(letters, key=lambda i: len(letters[i] or ""))[:60]:
        entropy = {n: m.entropy(letters[i]) for n, m in plain.items()}
        best = min(entropy, key=lambda n: (entropy[n], n))
        assert found[i].lang_pred == best
        assert found[i].cross_entropy == pytest.approx(entropy[best], rel=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.05 * len(rows)


def test_foreign_text_is_rejected_and_does_not_sway_the_fit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**9 + i, "щука и рак " * 20, None, None, 1) for i in range(5)], docs.schema)
    found = L.identify(docs.unionByName(odd)).where(F.col("doc_id") >= 10**9).collect()
    assert len(found) == 5 and all(r.rejected for r in found)


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows, extra=True)
    docs = docs.withColumn("lang", F.when(F.col("doc_id").isin(5, 7, 8), "long").when(F.col("doc_id") == 4, "b"))
    found = L.identify(docs).collect()
    assert len(found) == len(odd_rows)
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in found if r.doc_id in (4, 5, 7, 8, 9)} <= {"long", "b"}


def test_no_letters_no_labels_empty_table(docs_of):
    digits = docs_of([(1, "12 ½ ² —", "a"), (2, "Ⅷ", "a"), (3, "word", "a")])
    assert {r.doc_id: (r.lang_pred, r.score) for r in L.identify(digits).collect()} == dict.fromkeys((1, 2, 3), ("und", 0.0))
    assert L.identify(docs_of([])).collect() == []


def test_sample_is_bounded_and_ignores_copies(docs_of):
    rows = [(i, f"word{'abcdefghij'[i % 10]} " * (i % 50 + 1), "s") for i in range(3000)] + [(1, "same text here", "s")] * 2000
    docs = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") % 10 == 0, "rare").otherwise("hot"))
    found = L.sample(docs, F.lit(True), rows=100, chars=200)
    assert found["lang"].value_counts().max() <= 50
    assert found.groupby("lang")["text"].apply(lambda t: t.str.len().sum()).max() <= 50 * 200
    assert (found["text"] == "same text here").sum() <= 1
    again = L.sample(docs.repartition(7), F.lit(True), rows=100, chars=200)
    assert again.equals(found)


def test_one_long_text_is_scored_whole(docs_of):
    docs = docs_of([(i, "alpha beta gamma " * 5, "s") for i in range(40)] + [(99, "alpha beta gamma " * 200_000, "s")])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 40, "x"))
    r = L.identify(docs).where("doc_id = 99").first()
    assert r.lang_pred == "x" and r.cross_entropy < 0.5
