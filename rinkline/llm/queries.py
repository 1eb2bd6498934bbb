"""The registered queries of the subpackage, each over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkline.llm import _oracle_merkle, alignment, decontaminate, exact_dedup, language_id, merkle, ngram_join, packing, sharding, spotsigs, substring_dedup, suffix_dedup, toxicity, warc
from rinkline.llm._shared import new_path, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.write_shards(table(spark, sf_dir, "documents"), new_path(spark, "shards"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, language_id.fit_documents(docs))
    return out.select("doc_id", language_id.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    apart = language_id.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(
        docs.where(~apart).select(F.col("doc_id").alias("id"), "text"),
        labels.where(~apart).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")),
    )
    out = toxicity.score(docs, model)
    return out.select("doc_id", apart.alias("held_out"), "score", "predicted")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), width=13, with_text=False)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), revisit_from=0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), width=50, with_bytes=False)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampering(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"])


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = alignment.Alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.scores().select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edits(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_sharding, op3_language_id, op4_toxicity, op5_substring_dedup, op6_warc, op7_packing, op8_ngram_join, op9_decontaminate, op10_suffix_dedup, op11_merkle_manifest, op12_alignment, op13_fingerprints)}

ORACLE = {
    "op11_merkle_manifest": _oracle_merkle.SQL,
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS kept,
               sha256(norm) AS text_sha256
        FROM n""",
    "op5_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        win AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
        firsts AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (g) WHERE doc_id > m),
        words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_ngram_join": r"""
        WITH RECURSIVE
        w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
        reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(least.y, w.doc_id)) AS component_id
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.x = w.doc_id""",
    "op6_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        n AS (SELECT page_id, h, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS last FROM p)
        SELECT page_id, strlen(h) AS payload_bytes,
               array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda s:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((cast('0x' || substr(hex, cast(5 * k + 1 AS integer), 5) AS integer) >> s) & 31) + 1 AS integer), 1)), '')), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
        FROM n""",
    "op10_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
        f AS (SELECT g, min(doc_id) AS m FROM w GROUP BY g),
        late AS (SELECT doc_id, i FROM w JOIN f USING (g) WHERE doc_id > m),
        gaps AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM late),
        runs AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM gaps),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, r),
        cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM spans),
        kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS head, max(b) AS last, sum(b - a) AS removed, count(*) AS n
            FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(h) // 2 AS n_bytes, cast(coalesce(removed, 0) AS bigint) AS n_removed, coalesce(n, 0) AS n_spans,
               sha256(unhex(CASE WHEN n IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
}
