"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, imatch, language_id, line_dedup, near_dup, packing, pii, substring_dedup, topk, warc
from ._common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.records_of_pages(table(spark, sf_dir, "pages"))
    return warc.audit(records, warc.damaged_copy(records))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learn_and_identify(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_warc_audit": op2_warc_audit,
    "op3_near_dup": op3_near_dup,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_imatch": op8_imatch,
    "op9_line_dedup": op9_line_dedup,
    "op10_pii": op10_pii,
}

ORACLES: dict[str, str] = {
    "op1_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op2_warc_audit": """
        WITH r AS (
            SELECT page_id, 'pages-' || CAST(page_id // 256 AS VARCHAR) AS archive,
                   'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>'
                   || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8'
                   || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                   || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
            FROM pages
        ), o AS (
            SELECT *, sha256(record) AS digest, strlen(record) AS length,
                   sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id) - strlen(record) AS place
            FROM r
        )
        SELECT archive, CAST(place AS BIGINT) AS "offset", CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'corrupt' END AS status,
               CAST(length AS BIGINT) AS expected_length, CASE WHEN page_id % 211 <> 5 THEN CAST(length AS BIGINT) END AS found_length, digest AS expected_digest,
               CASE WHEN page_id % 211 <> 5 THEN sha256(record[1:4] || '~' || record[6:]) END AS found_digest
        FROM o WHERE page_id % 97 = 13 OR page_id % 211 = 5
    """,
    "op5_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        x AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
        k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM x),
        f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM k),
        g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE r > 1),
        p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
        a AS (
            SELECT p.doc_id, count(*) AS n, count(g.j) AS gone, sha256(coalesce(string_agg(word, ' ' ORDER BY p.j) FILTER (g.j IS NULL), '')) AS kept
            FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.j = g.j GROUP BY p.doc_id
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, coalesce(kept, sha256('')) AS kept_sha256 FROM d LEFT JOIN a ON d.doc_id = a.doc_id
    """,
    "op9_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
        l AS (SELECT doc_id, unnest(w) AS line, unnest(range(1, len(w) + 1)) AS j FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        m AS (SELECT k.*, coalesce(h.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN h ON k.key = h.key),
        i AS (SELECT doc_id, gone, j, j - row_number() OVER (PARTITION BY doc_id, gone ORDER BY j) AS island FROM m),
        r AS (SELECT doc_id, gone, min(j) AS start, count(*) AS n FROM i GROUP BY doc_id, gone, island),
        b AS (SELECT doc_id, CASE WHEN arg_min(gone, start) THEN '0,' ELSE '' END || string_agg(n, ',' ORDER BY start) AS keep_bitmap FROM r GROUP BY doc_id)
        SELECT m.doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, any_value(keep_bitmap) AS keep_bitmap,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (NOT gone), '')) AS kept_sha256 FROM m JOIN b ON m.doc_id = b.doc_id GROUP BY m.doc_id
    """,
    "op3_near_dup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END AS sh FROM w WHERE len(w) > 0),
        c AS (SELECT doc_id, unnest(sh) AS x FROM s),
        m AS (SELECT doc_id, x, count(*) AS n FROM c GROUP BY doc_id, x),
        t AS (SELECT doc_id, sum(n) AS total FROM m GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS low FROM m a JOIN m b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT a, b FROM p JOIN t ta ON ta.doc_id = a JOIN t tb ON tb.doc_id = b WHERE low / (ta.total + tb.total - low) >= 0.8::DOUBLE),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r(node, reach) AS (SELECT a, b FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
        k AS (SELECT node, min(reach) AS low FROM r GROUP BY node)
        SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, least(doc_id, coalesce(low, doc_id)) = doc_id AS is_first FROM documents LEFT JOIN k ON node = doc_id
    """,
}
