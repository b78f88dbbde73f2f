from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wattledger.llm import merkle as M
from wattledger.llm.queries import ORACLES

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n, r.text)])


def _climb(nodes, fanout):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            s = p - p % fanout
            run = nodes[s : s + fanout]
            paths[i].append(("".join(run[: p - s]), "".join(run[p - s + 1 :])))
            at[i] = p // fanout
        nodes = [_hash(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0] if nodes else None, paths


def _brute(rows, fanout=2):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        mine = sorted(by[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r)))
        trees[lang] = mine, *_climb([_leaf(r) for r in mine], fanout)
    root, tops = _climb([trees[lang][1] for lang in order], fanout)
    out = []
    for lang, top in zip(order, tops):
        mine, subroot, paths = trees[lang]
        for r, path in zip(mine, paths):
            path = path + top
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node = _leaf(r, int(hit))
            for before, after in path:
                node = _hash(before, node, after)
            proof = _hash(*[b + a for b, a in path])
            out.append((r.doc_id, _leaf(r), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = _got(M.document_proofs(docs))
    assert got == _brute(docs.collect())
    assert {g[-1] for g in got} == {True, False}


@pytest.mark.parametrize(("fanout", "leaves"), [(2, 1), (2, 4), (3, 9), (4, 4)])
def test_exchange_over_many_blocks(spark, docs_of, fanout, leaves):
    pick = random.Random(leaves)
    docs = docs_of([(i, "t" * (i % 7), "s") for i in range(150)])
    lang = F.when(F.col("doc_id") < 90, "x").when(F.col("doc_id") < 101, "é").when(F.col("doc_id") < 102, "solo")
    docs = docs.withColumn("lang", lang).repartition(pick.randint(2, 5))
    found = M.manifest(docs, M.leaf(*[F.col(f) for f in M.FIELDS]), keep=F.struct("doc_id"), fanout=fanout, block_leaves=leaves)
    want = {w[0]: w for w in _brute(docs.collect(), fanout)}
    rows = found.withColumn("up", M.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(rows) == 150
    for r in rows:
        w = want[r.body.doc_id]
        assert (r.leaf, r.subroot, r.root, r.up) == (w[1], w[2], w[3], w[3])
        assert _hash(*[s.before + s.after for s in r.path]) == w[4]


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    docs = docs_of(odd_rows, extra=True).withColumn("n_chars", F.when(F.col("doc_id") != 7, F.col("n_chars")))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 4, F.lit("a")))
    got = _got(M.document_proofs(docs.unionByName(docs)))
    assert got == _brute(docs.collect() * 2)
    assert M.document_proofs(docs_of([])).collect() == []


def test_one_document_is_its_own_root(docs_of):
    r = M.document_proofs(docs_of([(3, "x", "s")])).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == _hash("") and r.path == []


def test_largest_size_does_not_overflow(docs_of):
    docs = docs_of([(i, "x", "s") for i in range(20)]).withColumn("n_chars", F.lit((1 << 63) - 1))
    assert _got(M.document_proofs(docs)) == _brute(docs.collect())


def test_sql_form_on_odd_rows(spark, docs_of, odd_rows):
    duckdb = pytest.importorskip("duckdb")
    docs = docs_of([r for r in odd_rows if r[0] is not None])
    rows = docs.withColumn("lang", F.when(F.col("doc_id") > 4, "a")).toPandas()
    con = duckdb.connect()
    con.register("documents", rows.astype({"doc_id": "int64", "n_chars": "int64"}))
    found = con.execute(ORACLES["op12_merkle"]).df()[NAMES]
    again = spark.createDataFrame(rows.astype(object).where(rows.notna(), None), docs.schema)
    want = sorted((tuple(r) for r in found.itertuples(index=False)), key=str)
    assert [str(x) for x in _got(M.document_proofs(again))] == [str(x) for x in want]
