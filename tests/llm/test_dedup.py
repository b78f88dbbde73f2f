from __future__ import annotations

import hashlib
import re

import pytest

from compare import differences, duckdb_over
from wattledger.llm import ngram_join as N
from wattledger.llm import queries as Q
from wattledger.llm import radix_dedup as R


def test_exact_groups_against_equality(docs_of, odd_rows):
    # Equal up to any byte, so that groups split in every round.
    base = "é" * 700 + "z" * 1500
    more = [(100 + i, base[:i] + "|" + base[i:], "s") for i in (0, 7, 8, 15, 16, 17, 127, 143, 144, 145, 1167, 1168, 1169)]
    more += [(200 + i, base[:n], "s") for i, n in enumerate((0, 16, 8, 144, 72, 1168, 2000, 2000, 2200))]
    rows = odd_rows + more
    found = R.exact_duplicates(docs_of(rows, extra=True)).collect()
    assert len(found) == len(rows)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    want: dict[str, list] = {}
    for (i, _, _), t in zip(rows, norm):
        want.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(i)
    got: dict[str, list] = {}
    for r in found:
        got.setdefault(r.text_sha256, []).append(r)
    assert got.keys() == want.keys()
    for key, ids in want.items():
        group = got[key]
        low = min((i for i in ids if i is not None), default=None)
        assert all(r.group_size == len(ids) and r.keep_id == low for r in group)
        assert [r.doc_id for r in group if r.kept] == [low]


def test_exact_drop_keeps_one_with_its_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows, extra=True)
    kept = R.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7, 8, 9]
    assert R.drop_exact_duplicates(docs_of([])).count() == 0
    assert R.exact_duplicates(docs_of([])).count() == 0


def _brute(rows, threshold=0.8):
    words = [(t or "").split() for _, t, _ in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in words]
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = sets[i] | sets[j]
            if words[i] == words[j] or (union and len(sets[i] & sets[j]) / len(union) >= threshold):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    classes: dict[int, list] = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(rows[i][0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in classes.items()}
    return [(rows[i][0], low[find(i)], links[i]) for i in range(len(rows))]


def _near(rng_rows):
    """Families of texts with some words exchanged, at similarities on both sides of the threshold."""
    import random

    rng = random.Random(5)
    out, n = [], 1000
    for _ in range(rng_rows):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((6, 30, 120, 400)))]
        for _ in range(rng.choice((1, 2, 5, 9))):
            text = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 4))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            out.append((n, " ".join(text), "s"))
            n += 1
    return out


@pytest.mark.parametrize("block", [600, 7])
def test_near_links_against_all_pairs(docs_of, odd_rows, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = odd_rows + _near(40)
    found = N.near_duplicates(docs_of(rows, extra=True).drop("row")).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in found), key=key)
    assert got == sorted(_brute(rows), key=key)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.class_id for r in found if r.class_id is not None})
    assert all(r.doc_id == r.class_id for r in kept)


def test_one_of_each_class_stays(docs_of, odd_rows):
    rows = odd_rows + _near(10)
    docs = docs_of(rows, extra=True)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in _brute(rows)})
    assert N.one_of_each(docs_of([])).count() == 0


def test_prefixes_shorten_to_the_recall():
    d = N.depth_for()
    chance = lambda n: 1 - (1 - N.THRESHOLD**n) ** N.TREES
    assert chance(d) >= N.RECALL > chance(d + 1)
    assert N.depth_for(recall=0.5) > d > N.depth_for(recall=1 - 1e-12)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name):
    sf = "/root/testdata/sf0.001"
    assert differences(Q.QUERIES[name](spark, sf), duckdb_over(sf), Q.ORACLES[name]) == []
