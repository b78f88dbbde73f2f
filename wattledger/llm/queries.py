"""One query per operator with its contract's columns, and their DuckDB forms where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    cover_tree,
    html_text,
    language,
    merkle,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    radix_dedup,
    sharding,
    toxicity,
)
from .common import documents, tune


def op1_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op2_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_duplicates(documents(spark, sf_dir))


def op3_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(documents(spark, sf_dir))


def op4_kk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    places = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return scored.withColumn("spans", F.array_join(places, ","))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir)).drop("row")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(documents(spark, sf_dir)).drop("path")


def op13_galloping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir))


def _query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_slots,
        op2_radix_dedup,
        op3_flow_mix,
        op4_kk_pack,
        op5_cover_tree,
        op6_quality,
        op7_line_blocks,
        op8_toxic_spans,
        op9_ngram_join,
        op10_pii,
        op11_kneser_ney,
        op12_merkle,
        op13_galloping,
    )
}

ORACLES = {
    "op5_cover_tree": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
              AND len(list_filter(embedding, lambda e: e <> 0)) > 0
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_cosine_similarity(a.x, b.x) >= 0.98
        ), reach AS (
            SELECT a AS start, b AS node FROM link
            UNION
            SELECT r.start, l.b FROM reach r JOIN link l ON r.node = l.a
        ), comp AS (
            SELECT start, min(node) AS low FROM reach GROUP BY start
        ), n AS (
            SELECT a, count(*) AS n_links FROM link GROUP BY a
        )
        SELECT e.vec_id, coalesce(n_links, 0) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
               e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
        FROM embeddings e LEFT JOIN comp ON comp.start = e.vec_id LEFT JOIN n ON n.a = e.vec_id
    """,
    "op2_radix_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op9_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS t FROM documents
        ), same AS (
            SELECT t, min(doc_id) AS node, count(*) AS copies, string_split(t, ' ') AS w FROM d GROUP BY t
        ), shingle AS (
            SELECT DISTINCT node, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS g
            FROM same WHERE len(w) >= 5
        ), size AS (
            SELECT node, count(*) AS n FROM shingle GROUP BY node
        ), common AS (
            SELECT a.node AS a, b.node AS b, count(*) AS n
            FROM shingle a JOIN shingle b ON a.g = b.g AND a.node <> b.node GROUP BY a.node, b.node
        ), link AS (
            SELECT c.a, c.b FROM common c JOIN size x ON x.node = c.a JOIN size y ON y.node = c.b
            WHERE c.n >= 0.8 * (x.n + y.n - c.n)
        ), reach AS (
            SELECT a AS start, b AS node FROM link
            UNION
            SELECT r.start, l.b FROM reach r JOIN link l ON r.node = l.a
        ), comp AS (
            SELECT start, min(node) AS low FROM reach GROUP BY start
        ), near AS (
            SELECT l.a, sum(s.copies) AS n FROM link l JOIN same s ON s.node = l.b GROUP BY l.a
        )
        SELECT d.doc_id, least(s.node, coalesce(c.low, s.node)) AS class_id,
               CAST(coalesce(near.n, 0) + s.copies - 1 AS BIGINT) AS n_links, s.node AS copy_id,
               d.doc_id = least(s.node, coalesce(c.low, s.node)) AS kept
        FROM d JOIN same s ON s.t = d.t LEFT JOIN comp c ON c.start = s.node LEFT JOIN near ON near.a = s.node
    """,
    "op12_merkle": r"""
        WITH RECURSIVE framed AS (
            SELECT doc_id, lang, n_chars, text, source,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM documents
        ), leaf AS (
            SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   CASE WHEN xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda a, c: list_reduce(
                           [xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda x, z: xor(x >> 1, 3988292384 * (x & 1))
                       )
                   )) % 7 = 0
                   THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS tampered
            FROM framed
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf
        ), low AS (
            SELECT lang, 0 AS level, pos AS idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM numbered
            UNION ALL
            SELECT lang, max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2
            FROM low WHERE n > 1 GROUP BY lang, idx // 2
        ), subs AS (
            SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos
            FROM low WHERE n = 1
        ), high AS (
            SELECT 0 AS level, pos AS idx, subroot AS h, count(*) OVER () AS n FROM subs
            UNION ALL
            SELECT max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2
            FROM high WHERE n > 1 GROUP BY idx // 2
        ), step AS (
            SELECT l.lang, l.pos, s.level, (l.pos >> s.level) & 1 AS side, o.h
            FROM numbered l JOIN low s ON s.lang IS NOT DISTINCT FROM l.lang AND s.idx = l.pos >> s.level AND s.n > 1
            LEFT JOIN low o ON o.lang IS NOT DISTINCT FROM s.lang AND o.level = s.level AND o.idx = xor(s.idx, 1)
            UNION ALL
            SELECT l.lang, l.pos, 100 + s.level, (u.pos >> s.level) & 1, o.h
            FROM numbered l JOIN subs u ON u.lang IS NOT DISTINCT FROM l.lang
            JOIN high s ON s.idx = u.pos >> s.level AND s.n > 1
            LEFT JOIN high o ON o.level = s.level AND o.idx = xor(s.idx, 1)
        ), proof AS (
            SELECT lang, pos, list(struct_pack(side := side, h := coalesce(h, '')) ORDER BY level) AS steps,
                   string_agg(coalesce(h, ''), '' ORDER BY level) AS joined
            FROM step GROUP BY lang, pos
        ), climbed AS (
            SELECT lang, pos, coalesce(tampered, leaf) AS h, 1 AS i FROM numbered
            UNION ALL
            SELECT c.lang, c.pos, CASE WHEN p.steps[c.i].side = 1 THEN sha256(p.steps[c.i].h || c.h) ELSE sha256(c.h || p.steps[c.i].h) END, c.i + 1
            FROM climbed c JOIN proof p ON p.lang IS NOT DISTINCT FROM c.lang AND p.pos = c.pos WHERE c.i <= len(p.steps)
        ), ends AS (
            SELECT lang, pos, arg_max(h, i) AS folded_root FROM climbed GROUP BY lang, pos
        )
        SELECT l.doc_id, l.leaf, u.subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(p.joined, '')) AS proof_sha256, e.folded_root,
               e.folded_root = (SELECT h FROM high WHERE n = 1) AS verified
        FROM numbered l JOIN subs u ON u.lang IS NOT DISTINCT FROM l.lang
        JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.pos = l.pos
        LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
    """,
}
