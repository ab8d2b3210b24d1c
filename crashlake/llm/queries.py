"""The registered queries of this subpackage, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotrain, exact_dedup, filter_audit, html_text, maxent_lm, ngram_join, packing, pii, sentencepiece_fst, spelling, suffix_dedup, topk, urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_read(spark, sf_dir, "documents")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_read(spark, sf_dir, "documents"), width=3, percent=90)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=1024)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_read(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.round_trip(_read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(_read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_html_text": op5_html_text,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_topk_search": op8_topk_search,
    "op9_lm_score": op9_lm_score,
    "op10_url_filter": op10_url_filter,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling": op12_spelling,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' '))) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= 90 * (x.n + y.n - shared)
        ), reach AS (
            SELECT a AS doc_id, a AS other FROM links UNION SELECT doc_id, b FROM reach JOIN links ON a = other
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
        degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
               coalesce(n_links, 0) AS n_links
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id) LEFT JOIN degree USING (doc_id)
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256,
               CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_filter_audit": """
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), masks AS (
            SELECT doc_id, part,
                   CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
            FROM words
        ), said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        weighted AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM masks LEFT JOIN said USING (doc_id) GROUP BY part, mask
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
            JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
        ), steps AS (
            SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
                   CAST(coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0) AS BIGINT) AS earlier
            FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ), counted AS (
            SELECT part, filter_order, step, bit,
                   coalesce(sum(n) FILTER (mask & (bit | earlier) = 0), 0) AS kept,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS removed,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0) AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS toxic_lost
            FROM steps, weighted GROUP BY part, filter_order, step, bit
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM counted
    """,
    "op12_spelling": """
        WITH RECURSIVE crc AS (
            SELECT list(c ORDER BY i) AS tab FROM (
                SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM (SELECT unnest(range(0, 256)) AS i)
            )
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY ALL
        ), hashed AS (
            SELECT run, n, xor(list_reduce(
                list_prepend(4294967295, flatten(list_transform(regexp_extract_all(concat(doc_id, ':', run), '.'),
                    lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] ELSE [192 + (ord(ch) >> 6), 128 + (ord(ch) & 63)] END))),
                lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
            FROM runs, crc
        ), spelled AS (
            SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
        ), words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        shorter AS (
            SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
        ), near AS (
            SELECT s.word AS a, w.word AS b FROM shorter s JOIN words w ON w.word = s.rest
            UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
            UNION SELECT x.word, y.word FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
        ), tops AS (
            SELECT a, b, w.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r
            FROM near JOIN words w ON w.word = b
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 10 * n THEN b END AS form, CASE WHEN b_n >= 10 * n THEN b_n END AS form_n
            FROM words LEFT JOIN tops ON a = word AND r = 1
        ), chain AS (
            SELECT word, word AS reached, form AS further FROM formed
            UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.further
        )
        SELECT word, form, reached AS root, n, n_near, form_n FROM formed JOIN chain USING (word) WHERE further IS NULL
    """,
    "op13_suffix_dedup": """
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        sized AS (SELECT r, doc_id, x, CAST(length(x) // 2 AS BIGINT) AS n_bytes FROM texts),
        starts AS (SELECT r, x, unnest(range(0, n_bytes - 199)) AS s FROM sized WHERE n_bytes >= 200),
        hashed AS (SELECT r, s, md5(substr(x, 2 * s + 1, 400)) AS h FROM starts),
        again AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY h) AS c FROM hashed) WHERE c > 1),
        opened AS (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 0 ELSE 1 END AS new FROM again),
        runs AS (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s) AS k FROM opened),
        spans AS (SELECT r, k, min(s) AS a, max(s) + 200 AS b FROM runs GROUP BY r, k),
        gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
        kept AS (
            SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                   string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
            FROM gaps JOIN sized USING (r) GROUP BY r
        )
        SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(front || substr(x, 2 * last + 1), x))) AS kept_sha256
        FROM sized LEFT JOIN kept USING (r)
    """,
}
