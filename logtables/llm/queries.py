"""The operators as registered queries over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.llm import (bpe, hardneg, jaccardjoin, langid, orderhash, packing, sharding, spelling,
                           streamdedup, suffixes, topk, toxicity, urlrules)

#: The rules that `op9_url_filters` judges by: action, host, path. Fixed values.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, sf_dir), labels)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamdedup.duplicates(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), shards=8)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label, positives=5,
                                  negatives=10, least=30, most=90, scale=256.0)


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.jaccard_classes(documents(spark, sf_dir), width=3, percent=90)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), least=7, count=2, more=10)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urlrules.judge_urls(pages, urlrules.rule_table(spark, URL_RULES))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.near_copies(documents(spark, sf_dir))


QUERIES = {q.__name__: q for q in (
    op1_best_fit_packing, op2_language_id, op3_toxicity, op4_exact_top_k,
    op5_suffix_array_dedup, op6_bpe_round_trip, op7_exact_dedup, op8_sharding,
    op9_url_filters, op10_minhash_near_dedup, op11_hard_negatives,
    op12_ngram_jaccard_join, op13_spelling_variants)}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op4_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                     embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT query_id, cast(row_number() OVER (PARTITION BY query_id
                     ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                     embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                     list_inner_product(a.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
              FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                     cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                          ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
                           AND 30 * positive_score <= 100 * score
                           AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10""",
    "op12_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) AS w
              FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
              FROM w),
        flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
        links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.t = b.t AND a.doc_id <> b.doc_id
                  AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
                  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
                  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
        FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id""",
    # crc32 by its table; near words by wildcards (replaced) and deletions (inserted).
    "op13_spelling_variants": f"""
        WITH RECURSIVE bits AS (SELECT i, list_reduce(range(0, 8), lambda c, k:
              CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
            FROM range(0, 256) t(i)),
        crc AS (SELECT list(c ORDER BY i) AS t FROM bits),
        runs AS (SELECT doc_id, {LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} AS run
                 FROM documents),
        many AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
        raw AS (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM many),
        summed AS (SELECT run, n, xor(4294967295, list_reduce(
              list_transform(range(0, octet_length(b)), lambda i: ('0x' || hex(b)[2 * i + 1 : 2 * i + 2])::BIGINT),
              lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h FROM raw, crc),
        put AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word, n FROM summed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM put WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        places AS (SELECT word, n, unnest(range(0, length(word))) AS j FROM words),
        cut AS (SELECT word, n, left(word, j) || '*' || substr(word, j + 2) AS wild,
                       left(word, j) || substr(word, j + 2) AS short FROM places),
        near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.wild = b.wild AND a.word <> b.word
                 UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.short
                 UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.short),
        best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n
                 FROM near GROUP BY word),
        known AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                         CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                         CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
                  FROM words w LEFT JOIN best ON best.word = w.word),
        walk AS (SELECT word, word AS here, form AS further FROM known
                 UNION ALL SELECT k.word, k.further, f.form FROM walk k JOIN known f ON f.word = k.further)
        SELECT known.word, form, here AS root, n, n_near, form_n
        FROM known JOIN walk ON walk.word = known.word AND walk.further IS NULL""",
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op9_url_filters": f"""
        WITH rules(action, host, path) AS (VALUES
          ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'),
          ('allow','com','/fr/'), ('block','com','/de/')),
        p AS (SELECT page_id, coalesce({LOWER.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') AS host,
                     coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
        fits AS (SELECT p.page_id, r.action, r.host || r.path AS rule,
                        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS n
                 FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
                                     AND starts_with(p.path, r.path))
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
        FROM p LEFT JOIN fits f ON f.page_id = p.page_id AND f.n = 1""",
}
