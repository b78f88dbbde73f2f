from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wattledger.llm import alignment as A


def _byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@pytest.fixture(scope="module")
def plain():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = _byte_letters()

    def tokens(text):
        a, b = whole.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        x = [bytes(letters[c] for c in whole.id_to_token(i)) for i in a]
        y = [
            bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        same = b"".join(x) == b"".join(y) == (" " + text).encode()
        return (list(zip(a, x)), list(zip(b, y))) if same else ([], [])

    return tokens


def _brute(rows, tokens):
    out, count = [], Counter()
    for doc_id, text in rows:
        ends = []
        a, b = tokens(text) if text else ([], [])
        for side in (a, b):
            size, at = 0, {}
            for place, (_, piece) in enumerate(side):
                size += len(piece)
                at[size] = place
            ends.append(at)
        both = sorted(ends[0].keys() & ends[1].keys())
        written, before = [], (0, 0)
        for e in both:
            until = ends[0][e] + 1, ends[1][e] + 1
            sides = (s[f:t] for s, f, t in zip((a, b), before, until))
            written.append("|".join(",".join(str(i) for i, _ in side) for side in sides))
            before = until
        links = [(a[ends[0][e]][0], b[ends[1][e]][0]) for e in both]
        count.update(links)
        digest = hashlib.sha256(";".join(written).encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(both), links, digest))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (i, na, nb, n, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), digest)
            for i, na, nb, n, links, digest in out
        ),
        key=str,
    )


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SPECIAL = [
    (11, "a▁b"),
    (12, "<s>x</s><|endoftext|> y <0x41>"),
    (13, "😀é ﬁ\r\n\0\t"),
    (14, " " * 9000 + "x " * 5),
    (15, "a" * 40_000),
    (16, "日本語 текст"),
]


def test_given_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert _got(A.align_documents(docs)) == _brute([(r.doc_id, r.text) for r in docs.collect()], plain)


@pytest.mark.parametrize("most", [1, 50, A.BLOCK_LINKS])
def test_odd_rows_in_blocks(docs_of, odd_rows, plain, most):
    rows = odd_rows + [(i, t, None) for i, t in SPECIAL] * 2
    want = _brute([r[:2] for r in rows], plain)
    assert _got(A.align_documents(docs_of(rows, extra=True).repartition(3), most=most)) == want
    assert {w[-1] for w in want if w[0] in (1, 2, 11)} == {""}


def test_empty_table(docs_of):
    assert A.align_documents(docs_of([])).collect() == []
    assert A.alignments(docs_of([])).collect() == []


def test_groups_and_overlaps(docs_of, odd_rows, plain):
    rows = [r for r in odd_rows if r[1] and len(r[1]) < 1000] + [(i, t, None) for i, t in SPECIAL if len(t) < 100]
    texts = {r[0]: r[1] for r in rows}
    for r in A.alignments(docs_of(rows)).collect():
        a, b = plain(texts[r.doc_id])
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b]
        ends = [np.cumsum([len(p) for _, p in side]).tolist() for side in (a, b)]
        assert [ends[0][k - 1] for k in r.a_ends] == sorted(set(ends[0]) & set(ends[1]))
        assert [ends[1][k - 1] for k in r.b_ends] == sorted(set(ends[0]) & set(ends[1]))
        spans = [list(zip([0, *e], e)) for e in ends]
        for (start, end), first, last in zip(spans[0], r.first_b, r.last_b):
            assert list(range(first, last + 1)) == [k for k, (s, e) in enumerate(spans[1]) if s < end and start < e]


def test_galloping_equals_bisection():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 7, 1000):
        ends = np.sort(rng.choice(5000, n, replace=False))
        keys = np.sort(rng.integers(-5, 5010, 300))
        low, high = np.zeros(300, np.int64), np.full(300, n)
        for start in (low, np.full(300, n // 2), high, rng.integers(0, n + 1, 300)):
            assert (A.gallop(keys, ends, low, high, start) == np.searchsorted(ends, keys)).all()
