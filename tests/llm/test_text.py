from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from wattledger.llm import html_text as H
from wattledger.llm import pii
from wattledger.llm import quality as Q
from wattledger.llm import toxicity as T

# The patterns of the contract, as they stand.
NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _naive(text):
    out = []
    for k, (kind, pattern) in enumerate(NAIVE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_against_the_patterns():
    rng = np.random.default_rng(8)
    parts = ["a@b.c_d@e.f", "x@y", "@@", "1.2.3.4.5.6.7.8", "999.1.1.1", "010.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112"]
    parts += ["+1 (555) 123-4567", "+1", "++49 30 12345678 9", "12345678901234567890123", "é", " ", ".", "-", "+", "@", "7", "a.b-c%d@e-f.g-", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 12)))
        assert pii.detect(text) == _naive(text), text
    assert pii.detect("1" * 50_000) == [] and pii.detect("a" * 50_000 + "@") == []


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("write jane [at] foo (dot) org now", "email", "jane [at] foo (dot) org"),
        ("bob at mail dot example dot com", "email", "bob at mail dot example dot com"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("host １０．０．０．２ up", "ip", "１０．０．０．２"),
        ("call plus four nine three zero one two three four five six", "phone", "plus four nine three zero one two three four five six"),
    ],
)
def test_disguises_map_back(text, kind, span):
    base, spans = pii.find(text)
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in spans if (s, k, e) not in base] == [(kind, span)]


def test_many_spans_and_a_disguise():
    text = "a@b.co +1 555 123 4567 1.2.3.4 " * 20_000 + "jane [at] foo (dot) org"
    base, spans = pii.find(text)
    assert len(base) == 60_000 and sorted(set(spans) - set(base)) == [(len(text) - 23, 0, len(text))]


def test_personal_data_rows(docs_of, odd_rows):
    rows = [*odd_rows, (60, "é a@b.co 1.2.3.4", "s")]
    got = pii.personal_data(docs_of(rows, extra=True)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    r = next(r for r in got if r.doc_id == 60)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)
    assert r.spans == "email:2:8,ip:9:16" and r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert pii.personal_data(docs_of([])).count() == 0
    out = {r.doc_id: r.redacted for r in pii.redact(docs_of(rows)).collect()}
    assert out[60] == "é <email> <ip>" and out[1] is None


ARTICLE = "<article><h1>T &amp; U</h1><p>One  two\n three.<br><p>Four <b>five</b> &lt;six&gt;<ul><li>seven</ul></article>"
TEXT = "T & U\nOne two three.\nFour five <six>\nseven"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body><nav><a href=/>x</a></nav><footer>f</footer></body>", ""),
        (f"<nav>menu</nav><div class='ad'>buy</div>{ARTICLE}<footer>&copy;</footer>", TEXT),
        (f"<div id=sidebar>never closed {ARTICLE} <script>var a = '</p>';</script>", TEXT),
        (f"<header><h2>Site</h2></header><main>{ARTICLE}<section class=comments><article>bad</article></section></main>", TEXT),
        (ARTICLE.replace("<p>Four", "<form>mail <input></form><aside>more</aside><!-- <p>x</p> --><p>Four"), TEXT),
        ("<p>" + "Plain words here. " * 9 + "<p>short<div class=notice>cookies</div><p>" + "More text follows. " * 9, None),
    ],
)
def test_main_text(page, text):
    if text is None:
        text = "\n".join([("Plain words here. " * 9).strip(), "short", ("More text follows. " * 9).strip()])
    assert H.main_text(page) == text


PLAIN = "".join(f"<p>Paragraph number {i} of plain text, long enough to weigh something.</p>" for i in range(8))
READ = "\n".join(f"Paragraph number {i} of plain text, long enough to weigh something." for i in range(8))


@pytest.mark.parametrize(
    "container",
    [
        "<div class='layout has-sidebar'>{}</div>",
        "<div class='post tags-news'>{}</div>",
        "<section class='social-science'>{}</section>",
        "<div class='search-result-page'>{}</div>",
        "<article class='story ad-free'>{}</article>",
        "<div class='wide menu-open'><div class='no-ads'>{}</div></div>",
    ],
)
def test_a_class_word_does_not_empty_a_page(container):
    beside = "<nav>menu</nav><div class='sidebar'>some words <a href=/>and many more words of a link</a></div>"
    assert H.main_text(f"<body>{beside}{container.format(PLAIN)}<footer>f</footer></body>") == READ


def test_light_containers_and_comments_stay_out():
    page = f"<div class=promo>buy this now</div>{PLAIN}<div class=comments>{PLAIN * 3}</div>"
    assert H.main_text(page) == READ
    assert H.main_text(f"<article>{PLAIN}</article><div class=sidebar>{PLAIN * 3}</div>") == READ


@pytest.mark.parametrize("piece", ["<a ", "<p class=\"x", "<script>", "<!--", "</script ", "<", "<p class='ad'>", "&amp"])
@pytest.mark.parametrize("end", ["", ">"])
def test_time_grows_with_the_page(piece, end):
    import time

    page = "<p>start</p>" + piece * (1_000_000 // len(piece)) + end
    began = time.perf_counter()
    H.main_text(page)
    assert time.perf_counter() - began < 10


def test_surge_and_dive():
    assert H.stretches([0, 0, 90, 5, 0, 70, 0, 0, 0, 4, 0, 0], 80) == [(2, 6)]
    assert H.stretches([], 0) == []


def test_extract_rows(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    rows = [(1, "u", ARTICLE, 7), (None, None, None, 7), (1, "u", ARTICLE, 7)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", TEXT, len(TEXT)), (None, None, "", 0), (1, "u", TEXT, len(TEXT))], key=str)


def _paths(scores, transitions):
    """Marginals by summing over all tag sequences."""
    import itertools

    n, total, hit = len(scores), 0.0, np.zeros(len(scores))
    for tags in itertools.product((0, 1), repeat=n):
        w, before = 0.0, 0
        for s, t in zip(scores, tags):
            w += transitions[before, t] + s * t
            before = t
        p = np.exp(w)
        total += p
        hit += p * np.array(tags)
    return hit / total


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    transitions = rng.normal(size=(2, 2))
    lengths = np.array([4, 0, 7, 1, 2])
    scores = rng.normal(size=lengths.sum()) * 2
    p, _ = T.marginals(scores, lengths, transitions)
    at = 0
    for n in lengths:
        assert p[at : at + n] == pytest.approx(_paths(scores[at : at + n], transitions)) if n else True
        at += n


def _labelled(spark, docs_of, bad):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(700):
        words = list(rng.choice(vocabulary, rng.integers(8, 60)))
        y = int(rng.random() < 0.3)
        if y:
            for _ in range(3):
                words[rng.integers(3, len(words))] = bad[rng.integers(len(bad))]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1 - y, y))
    labels += [(None, None, None), (1, None, None)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, docs_of, odd_rows):
    rows, labels = _labelled(spark, docs_of, ["vile", "foul", "nasty"])
    docs = docs_of(rows + odd_rows[1:4] + [(None, None, None)], extra=True)
    got = T.score_documents(docs.drop("doc", "row"), labels).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id > 4]
    assert held and all(r.predicted == (r.doc_id in toxic) for r in held)
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and not toxic & {r.doc_id for r in kept.where("doc_id > 4").collect()}
    field = T.train(docs, labels)
    assert [(s, e) for s, e, _ in field.spans("w1 w2 Vile foul w3 w4 nasty")] == [(6, 15), (22, 27)]
    assert field.spans("") == []
    # Offsets hold where lower case is longer than the text, and whatever else is judged beside it.
    assert [(s, e) for s, e, _ in field.spans("İİ w1 w2 VILE w3")] == [(9, 13)]
    text = dict((i, t) for i, t, _ in rows)
    for r in held:
        assert [(s.start, s.end) for s in r.spans] == [(s, e) for s, e, _ in field.spans(text[r.doc_id])]
    assert any(r.spans for r in held)


def test_classifiers_without_rows_or_classes(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    for module in (T, Q):
        got = module.score_documents(docs_of(odd_rows), labels).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
        assert module.score_documents(docs_of([]), labels.limit(0)).count() == 0


def test_quality_on_held_out_rows(spark, docs_of):
    rows, labels = _labelled(spark, docs_of, ["$$$", "BUY!!", "|"])
    got = Q.score_documents(docs_of(rows, extra=True), labels).collect()
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == (r.doc_id in good) for r in held]) > 0.95


def test_pooling_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = np.array([0, 5, 0, 9, 1, 40, 0])
    flat, table, rarity = rng.integers(1, 50, lengths.sum()), rng.normal(size=(50, 4)), rng.random(50) + 0.1
    ends = np.cumsum(lengths)
    want = [np.average(table[flat[e - n : e]], axis=0, weights=rarity[flat[e - n : e]]) if n else np.zeros(4) for e, n in zip(ends, lengths)]
    for size in (1, 10, 1000):
        monkeypatch.setattr(Q, "POOLED_AT_ONCE", size)
        assert np.allclose(Q.pooled(flat, lengths, table, rarity), want)


def test_context_sums_against_neighbours():
    places, signs = Q.index_vectors()
    flat = np.array([5, 9, 5, 7, 0, 0, 3, 5, 0, 0])
    want = np.zeros((Q.TOKENS, Q.DIMENSIONS))
    for i, t in enumerate(flat):
        for j in range(max(0, i - Q.REACH), min(len(flat), i + Q.REACH + 1)):
            if i != j:
                for k in range(Q.NONZERO):
                    want[t, places[flat[j], k]] += signs[flat[j], k]
    assert np.allclose(Q.context_sums(flat, places, signs).reshape(want.shape), want)


@pytest.mark.parametrize("seed, share", [(1, 0.55), (2, 1.0), (3, 0.9)])
def test_without_evidence_everything_is_kept(spark, docs_of, seed, share):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, 30)) for _ in range(200)]
    docs = docs_of([(i, t, "s") for i, t in enumerate(texts)] + [(900, None, "s"), (901, "", None)])
    marks = [(i, 0, int(rng.random() < share)) for i in range(200)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert T.drop_toxic(docs, labels).count() == 202
    assert T.drop_toxic(docs_of([]), labels).count() == 0


def test_toxic_words_of_texts_with_one_header():
    rng = np.random.default_rng(4)
    header, vocabulary = "licensed under the same terms as before ", [f"w{i}" for i in range(400)]
    y = np.arange(300) % 3 == 0
    texts = [header + " ".join([*rng.choice(vocabulary, 60), *["vile"] * int(t)]) for t in y]
    assert T.toxic_words(texts, y.astype(int)) == {"vile"}
    # Near copies are one text, however many there are.
    copies = ["rare " + " ".join(vocabulary[:100]) + f" x{i}" for i in range(50)]
    assert "rare" not in T.toxic_words(texts + copies, np.concatenate([y, np.ones(50)]).astype(int))
    assert T.families(t.split() for t in [copies[0], texts[0], copies[1], "", "a", "", "a b"]) == [0, 1, 0, 2, 3, 2, 4]


def test_line_blocks_decide_beside_a_declared_article():
    long = "Plain words of the article here. " * 9
    p = f"<p>{long}"
    links = "".join(f"<p><a href=/{i}>Another story to read next, number {i}</a>" for i in range(6))
    want = "\n".join([long.strip()] * 3)
    # A block as heavy as the declared one stays; a short line beside it, or a list of links inside it, does not.
    assert H.main_text(f"<div>{p}{p}</div><article>{p}</article>") == want
    assert H.main_text(f"<p>short<main>{p}{p}{p}</main><p>All rights reserved") == want
    assert H.main_text(f"<main>{p}{p}{p}{links}</main>") == want
    assert H.main_text(f"<article>Loading</article><div>{p}{p}{p}</div>") == want
    # A linked title, and a link or two between paragraphs, are the article's.
    page = f"<article><h1><a href=/>T</a></h1><p>By me{p}<p><a href=/>See this</a>{p}</article>"
    assert H.main_text(page) == "\n".join(["T", "By me", long.strip(), "See this", long.strip()])


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("to jane (at) example dot com now", "email", "jane (at) example dot com"),
        ("to jane at example (dot) com now", "email", "jane at example (dot) com"),
        ("to jane@example dot com now", "email", "jane@example dot com"),
        ("to jane at example.com now", "email", "jane at example.com"),
        ("a at b\ndot\ncom", "email", "a at b\ndot\ncom"),
        ("call +1 202 555 01 four seven now", "phone", "+1 202 555 01 four seven"),
    ],
)
def test_mixed_disguises(text, kind, span):
    base, spans = pii.find(text)
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in spans if (s, k, e) not in base] == [(kind, span)]


def test_prose_beside_at_and_digits_is_no_disguise():
    for text in ("look at e.g. this", "3.5 at 2.5 x", "we met at noon.Then left", "one at a time", "host 10.0.0.1 one of"):
        base, spans = pii.find(text)
        assert spans == base


@pytest.mark.parametrize(
    "text, kind",
    [("jоhn@example.com", "email"), ("alice@example.cоm", "email"), ("10.0.0.1２", "ip"), ("1.2.3.4@exаmple.com", "email")],
)
def test_fragment_of_a_disguise(spark, docs_of, text, kind):
    base, spans = pii.find(f"to {text} now")
    whole = (3, pii.KINDS.index(kind), 3 + len(text))
    assert len(base) == 1 and whole not in base and sorted([*base, whole]) == spans
    assert pii.redact(docs_of([(1, f"to {text} now", "s")])).first().redacted == f"to <{kind}> now"


def test_a_text_beyond_the_bound_costs_only_itself(spark, docs_of, monkeypatch):
    from wattledger.llm import labelled as L

    monkeypatch.setattr(L, "CHARS_PER_ROW", 100)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(99, 0, 1)], "doc_id long, quality int, toxic int")
    first = labels.where("doc_id < 40").orderBy(L.uniform(L.F.col("doc_id"))).first().doc_id
    rows = [(i, "x" * 5000 if i == first else f"text {i}", "s") for i in range(40)] + [(99, "y" * 9000, "s")]
    docs = docs_of([*rows, rows[1], rows[2]])
    got = L.sample(docs, labels, "toxic", L.F.lit(True), {0: 40, 1: 40})
    assert sorted(got.text) == sorted([t for i, t, _ in rows if i != first])
    assert got.weight.tolist() == pytest.approx([40 / 39 if y == 0 else 1 for y in got.y])
    assert L.fitting([9, 5, 7], 8) == [1] and L.fitting([9, 12], 8) == [0] and L.fitting([], 8) == []
