"""One registered query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import ann, audit, chunks, hmm, langid, mixing, packing, secrets, simhash, substrings, toxicity, urls, variants
from quern.llm.common import fold_of, table

TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return os.path.join(os.environ.get("QUERN_TOKENIZERS", TOKENIZERS), name)


def op1_hmm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf, "documents"), fold_of("doc_id", 5) == 1)


def op2_chunk_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.compare_edits(table(spark, sf, "documents"))


# The rules that the query judges by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf, "pages"), rules)


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer_path(), room=4096, end_id=1)


def op5_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents"))


def op6_simhash_groups(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), words=4, errors=4, seed=42)


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = fold_of("doc_id", 4) == 2
    found = langid.identify(docs, langid.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = fold_of("doc_id", 5) == 0
    found = toxicity.score_texts(docs, toxicity.train(docs, table(spark, sf, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)


def op11_repeated_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents"), length=200).drop("kept")


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf, "documents"))


def with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Workers of a local session find the package where the driver found it; a cluster is sent it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in found.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, found]))
        return query(spark, sf)

    return run


QUERIES = {
    f.__name__: with_package(f)
    for f in (
        op1_hmm_scores, op2_chunk_fingerprints, op3_url_filters, op4_best_fit_packing, op5_secret_scans,
        op6_simhash_groups, op7_language_id, op8_toxicity, op9_nearest_vectors, op10_source_mix,
        op11_repeated_substrings, op12_filter_audit, op13_spelling_variants,
    )
}

ORACLES = {
    "op3_url_filters": """
        WITH parts AS (
            SELECT page_id,
                coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
                row_number() OVER () AS n
            FROM pages
        ), rules(rule_host, rule_path, rule_verdict) AS (VALUES
            ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), best AS (
            SELECT n, max(struct_pack(size := length(rule_host || rule_path), hosted := length(rule_host),
                rule := rule_host || rule_path, verdict := rule_verdict)) AS best
            FROM parts JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY n
        )
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM parts LEFT JOIN best USING (n)
    """,
    "op12_filter_audit": """
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy
            FROM documents
        ), marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), failed AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
                CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 10 * length(body) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN copy THEN 'E' ELSE '' END) AS fails
            FROM words LEFT JOIN marks USING (doc_id)
        ), weights AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
        ), l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), removal AS (
            SELECT weights.*, filter_order, (SELECT min(instr(filter_order, f)) FROM unnest(string_split(fails, '')) t(f) WHERE f <> '') AS gone
            FROM weights, orders
        ), steps AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS INTEGER), 1) AS f,
                CAST(coalesce(sum(n) FILTER (gone IS NULL OR gone > step), 0) AS BIGINT) AS kept,
                CAST(coalesce(sum(n) FILTER (gone = step), 0) AS BIGINT) AS removed,
                CAST(coalesce(sum(n) FILTER (gone < step AND contains(fails, substr(filter_order, CAST(step AS INTEGER), 1))), 0) AS BIGINT) AS redundant,
                CAST(coalesce(sum(n) FILTER (fails = substr(filter_order, CAST(step AS INTEGER), 1)), 0) AS BIGINT) AS unique_fails,
                CAST(coalesce(sum(good) FILTER (gone = step), 0) AS BIGINT) AS good_lost,
                CAST(coalesce(sum(toxic) FILTER (gone = step), 0) AS BIGINT) AS toxic_lost
            FROM removal, range(1, 6) s(step) GROUP BY part, filter_order, step
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM steps
    """,
}
