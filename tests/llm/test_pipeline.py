from __future__ import annotations

import re

import corpus_pipeline
from wattledger.llm import toxicity
from wattledger.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, function in corpus_pipeline.STAGES:
        seen.append(stage(function(spark, seen[-1], SF), name.replace(" ", "-")))
    ids = [[r.doc_id for r in df.select("doc_id").collect()] for df in seen]
    assert all(df.columns == columns for df in seen[:-1])
    field = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    scores = dict(zip(text, field.documents([field.scores(toxicity.tokens(t)) for t in text.values()])))
    assert sorted(ids[1]) == sorted(i for i in text if scores[i] < 0.5)
    first: dict[str, int] = {}
    for i in sorted(ids[1]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text[i]), i)
    assert sorted(ids[2]) == sorted(first.values())
    sets = {i: (lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)})(text[i].split()) for i in ids[2]}
    up = {i: i for i in ids[2]}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0 or text[i].split() == text[j].split():
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    assert sorted(ids[3]) == sorted({find(i) for i in up})
    assert set(ids[4]) <= set(ids[3])
    assert set(ids[5]) == set(ids[4])
    tokens = sum(r.length for r in seen[5].select("length").collect())
    assert tokens >= len(ids[4])
    assert corpus_pipeline.run(spark, SF).count() == len(ids[5])
