from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattledger.llm import mixing as M
from wattledger.llm import packing as P


def test_targets_share_and_stop():
    sizes = {"a": 10, "b": 1000, None: 100}
    weights = M.ranked_weights(list(sizes))
    assert weights == {"a": 1, "b": 2, None: 3}
    got = M.targets_by_weight(sizes, weights)
    assert got == pytest.approx({"a": 30, None: 300, "b": 780})
    assert M.targets_by_weight({}, {}) == {} and M.targets_by_weight({"a": 0}, {"a": 1}) == {"a": 0}


def _cheapest(capacity, quotas):
    """All ways to give tokens one by one, by exhaustion: (tokens given, least cost for that many)."""
    patterns, best = list(capacity), {}
    for used in itertools.product(*(range(3 * capacity[p] + 1) for p in patterns)):
        cost = sum(M.PASS_COSTS[k // capacity[p]] for p, u in zip(patterns, used) for k in range(u))
        need = dict(quotas)

        def fits(i):  # patterns may split over their sources
            if i == len(patterns):
                return True
            options = [range(min(used[i], need[s]) + 1) for s in patterns[i]]
            for split in itertools.product(*options):
                if sum(split) == used[i]:
                    for s, k in zip(patterns[i], split):
                        need[s] -= k
                    if fits(i + 1):
                        return True
                    for s, k in zip(patterns[i], split):
                        need[s] += k
            return False

        if fits(0):
            total = sum(used)
            best[total] = min(cost, best.get(total, cost))
    return max(best), best[max(best)]


@pytest.mark.parametrize(
    "capacity, quotas",
    [
        ({("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 3, "b": 4}),
        ({("a", "b"): 3, ("b", "c"): 2}, {"a": 4, "b": 3, "c": 3}),
        ({("a",): 1, ("b",): 1, ("a", "b", "c"): 2}, {"a": 2, "b": 2, "c": 2}),
        ({("a",): 2}, {"a": 9}),
    ],
)
def test_flow_is_largest_and_cheapest(capacity, quotas):
    flow = M.route(capacity, quotas)
    used, got = Counter(), Counter()
    for (pattern, source), tokens in flow.items():
        assert source in pattern
        used[pattern] += tokens
        got[source] += tokens
    assert all(got[s] <= quotas[s] for s in got) and all(used[p] <= 3 * capacity[p] for p in used)
    cost = sum(M.PASS_COSTS[k // capacity[p]] for p, u in used.items() for k in range(u))
    assert (sum(used.values()), cost) == _cheapest(capacity, quotas)


def test_mix_meets_targets_and_repeats(docs_of, odd_rows):
    rows = odd_rows + [(i, "w " * (i % 90), f"src{i % 7}" if i % 3 else "hot") for i in range(20, 900)]
    docs = docs_of(rows, extra=True)
    got = M.mix_by_source(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    targets = M.targets_by_weight(sizes, M.ranked_weights(list(sizes)))
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.target, r.source_size] += r.taken
    assert sorted(t for t, _ in taken) == pytest.approx(sorted(targets.values()))
    assert [(t, n) for (t, _), n in taken.items() if abs(n - t) > 1] == []
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, M.mix_by_source(docs).collect()), key=key)
    assert M.mix_by_source(docs_of([])).count() == 0


def test_overlapping_sources_and_whole_documents(spark, docs_of, odd_rows):
    docs = docs_of([(i, "w " * (10 + i % 5), f"s{i % 3}") for i in range(300)])
    member = F.when(F.col("doc_id") % 2 == 0, F.array("source", F.lit("all"))).otherwise(F.array("source"))
    _, taken, _, quotas = M.mix(docs, member)
    assert abs(taken.agg(F.sum("taken")).first()[0] - sum(quotas.values())) <= len(quotas)
    mixed = M.mixed_documents(docs_of(odd_rows, extra=True))
    assert mixed.columns == docs_of(odd_rows, extra=True).columns
    assert max(Counter(r.doc_id for r in mixed.collect() if r.doc_id not in (5, None)).values()) <= 3


def test_differencing_balances_and_never_overfills():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 400):
        sizes = rng.integers(1, 513, n)
        at = P.fill(sizes)
        load = np.bincount(at, weights=sizes, minlength=1)
        assert load.max(initial=0) <= P.WINDOW
        assert len(load) <= max(1, -(-int(sizes.sum()) // P.WINDOW) + 2)
    sizes = np.array([8, 7, 6, 5, 4])
    assert sorted(np.bincount(P.differencing(sizes, 2), weights=sizes)) == [14, 16]


def test_packing_is_an_exact_round_trip(spark, docs_of, odd_rows):
    from tokenizers import Tokenizer

    rows = [*odd_rows, (50, "a  b\n\n c <|endoftext|> d", "s"), (51, "Grüße, naïve œuvre 你好 \U0001f600" * 300, "s")]
    whole = Tokenizer.from_file(P.public_files()[0])
    want = Counter()
    for i, t, _ in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, P.END_ID]
        want[i, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)] += 1
    pieces = P.pack(docs_of(rows, extra=True)).collect()
    by_row, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_row[p.row].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.WINDOW
    texts = {}
    for i, t, _ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, P.END_ID], "<u4")
        texts[i, len(ids)] = ids
    got = Counter()
    for parts in by_row.values():
        parts.sort(key=lambda p: p.start)
        ids = texts[parts[0].doc_id, parts[0].doc_tokens]
        at = 0
        for p in parts:
            assert p.start == at and zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == parts[0].doc_tokens
        got[parts[0].doc_id, zlib.crc32(ids.tobytes()), at] += 1
    assert got == want
    assert P.pack_documents(docs_of([])).count() == 0


def test_very_long_runs_of_white_space(docs_of):
    texts = {1: " " * 1_000_001 + "x", 2: "a\n" + "\t" * 4_096, 3: "b" + " " * 4_095 + "c"}
    whole = Tokenizer.from_file(P.public_files()[0])
    found: dict[int, int] = {}
    for r in P.pack_documents(docs_of([(i, t, "s") for i, t in texts.items()])).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
