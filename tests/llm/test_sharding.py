from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from wattledger.llm import sharding as S


def _rows(df):
    return df.collect()


def _check(rows, shards):
    places, load = {}, Counter()
    for r in rows:
        places.setdefault(r.shard, []).append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert set(places) <= set(range(shards))
    return load


def test_sizes_near_equal_and_places_gapless(docs_of):
    docs = docs_of([(i, "é" * (i * 37 % 400), "s") for i in range(3000)])
    rows = _rows(S.shard_documents(docs))
    load = _check(rows, 16)
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 16
    text = {i: "é" * (i * 37 % 400) for i in range(3000)}
    assert all(r.size == 2 * len(text[r.doc_id]) + 1 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows)


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    rows = _rows(S.shard_documents(docs_of(odd_rows, extra=True), 4))
    assert len(rows) == len(odd_rows)
    _check(rows, 4)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 1} == {(1, 0)}
    assert _rows(S.shard_documents(docs_of([]))) == []


def test_rebalancing_moves_few_slots_and_growing_fills_new_shards():
    size = np.random.default_rng(3).integers(1, 2000, S.SLOTS)
    first = S.initial_map(16)
    second = S.rebalance(first, size)
    moved = sum(a != b for a, b in zip(first.shards, second.shards))
    assert 0 < moved < S.SLOTS // 8 and second.version == 1
    load = np.bincount(second.shards, weights=size)
    assert load.max() - load.min() <= S.TOLERANCE * load.mean() + 1
    grown = S.rebalance(second, size, 17)
    load = np.bincount(grown.shards, weights=size, minlength=17)
    assert load.max() - load.min() <= 0.001 * load.mean()
    fewer = S.rebalance(grown, size, 10)
    assert max(fewer.shards) == 9


def test_map_versions_are_stored_and_edited(spark, docs_of, tmp_path):
    docs = docs_of([(i, "a" * (i % 50), "s") for i in range(500)])
    path = str(tmp_path / "map")
    S.shard_documents(docs, 4, path).count()
    assert S.load_map(spark, path, 0) == S.initial_map(4)
    assert S.load_map(spark, path).version == 1
    again = _rows(S.shard_documents(docs, 4, path))
    assert {r.map_version for r in again} == {2}
    assert S.load_map(spark, path).shards == S.load_map(spark, path, 1).shards


def test_copies_without_an_id_do_not_fill_one_shard(docs_of):
    rows = [(None, "the same text of some length", "s")] * 7_000 + [(i, "t" * (i % 60), "s") for i in range(13_000)]
    found = _rows(S.shard_documents(docs_of(rows)))
    assert len(found) == len(rows)
    load = _check(found, 16)
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 16
    by_slot = Counter(r.virtual_slot for r in found)
    assert max(by_slot.values()) < 100


def test_records_keep_their_virtual_slot(docs_of):
    rows = [(i, f"text {i}", "s") for i in range(2_000)]
    first = {r.doc_id: r.virtual_slot for r in _rows(S.shard_documents(docs_of(rows)))}
    again = {r.doc_id: r.virtual_slot for r in _rows(S.shard_documents(docs_of(rows[::-1][:1_500]), 5))}
    assert all(first[i] == slot for i, slot in again.items())
