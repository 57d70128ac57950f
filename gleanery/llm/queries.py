"""The registered queries of the operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .collocations import collocations
from .contamination import contamination
from .exact import exact_duplicates
from .licences import licences_sql, recognise_licences
from .lines import near_duplicate_lines
from .near import near_duplicates
from .neighbours import nearest
from .packing import pack_documents
from .periodic import periodic_runs
from .quality import fit_quality, score_quality
from .sharding import shard_rows
from .substring import remove_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_lines(_table(spark, sf_dir, "documents"))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise_licences(_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = "file://" + public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).drop("row")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), "file://" + public_tokenizers.path("word_bpe_49k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_quality_crf,
        op3_nearest,
        op4_licences,
        op5_byte_bpe,
        op6_near_dedup,
        op7_best_fit_packing,
        op8_sharding,
        op9_substring_dedup,
        op10_exact_dedup,
        op11_decontamination,
        op12_periodic_runs,
        op13_collocations,
    )
}

_OP6 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), grams AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_have
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common WHERE 100 * both_have >= 75 * (na + nb - both_have)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""

_OP9 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20
), ranked AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS k FROM windows
), gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM ranked, range(0, 20) t(j) WHERE k > 1
), each_word AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), counted AS (
    SELECT e.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
        string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS kept
    FROM each_word e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id
"""

_OP10 = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
    doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""

_OP11 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, w[s:s + least(len(w), 10) - 1] AS p
    FROM b, range(1, len(b.w) - least(len(b.w), 10) + 2) t(s) WHERE len(b.w) > 0
), lens AS (
    SELECT DISTINCT len(p) AS n FROM win
), pos AS (
    SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d
), ahead AS (
    SELECT doc_id, i, list(t) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS nxt FROM pos
), occ AS (
    SELECT a.doc_id, a.i, lens.n, win.item_id
    FROM ahead a, lens JOIN win ON len(win.p) = lens.n AND win.p = a.nxt[1:lens.n]
    WHERE len(a.nxt) >= lens.n
), hit AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM occ, range(0, n) r(j) GROUP BY doc_id
), items AS (
    SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM occ WHERE item_id IS NOT NULL GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit,
    CAST(coalesce(len(items.l), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(items.l, ','), '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

_OP13 = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d
), words AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM words, range(1, 4) t(k), range(1, len(w) - k + 2) s(i)
), f AS (
    SELECT lang, g, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, g
), c AS (
    SELECT lang, g, k, f AS a, string_split(g, ' ') AS w FROM f WHERE k >= 2 AND f >= 10
), cuts AS (
    SELECT c.lang, c.g, c.k, c.a, j, fl.f AS l, fr.f AS r,
        (CAST(c.a AS HUGEINT) * c.a * 1000000) // (CAST(fl.f AS HUGEINT) * fr.f) AS score
    FROM c, range(1, c.k) t(j)
    JOIN f fl ON fl.lang = c.lang AND fl.g = array_to_string(c.w[1:j], ' ')
    JOIN f fr ON fr.lang = c.lang AND fr.g = array_to_string(c.w[j + 1:c.k], ' ')
), best AS (
    SELECT lang, g, k, a, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r, min(score) AS score
    FROM cuts GROUP BY lang, g, k, a
), kept AS (
    SELECT * FROM best b WHERE b.k = 3 OR NOT EXISTS (
        SELECT 1 FROM c x WHERE x.lang = b.lang AND x.k = 3 AND 100 * x.a >= 50 * b.a
            AND (array_to_string(x.w[1:2], ' ') = b.g OR array_to_string(x.w[2:3], ' ') = b.g))
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g ASC) AS rank, g AS phrase, a, l, r, score
    FROM kept
)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
    CAST(score AS BIGINT) AS score
FROM ranked r JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op4_licences": licences_sql(),
    "op6_near_dedup": _OP6,
    "op9_substring_dedup": _OP9,
    "op10_exact_dedup": _OP10,
    "op11_decontamination": _OP11,
    "op13_collocations": _OP13,
}
