"""The queries of the operators of this package, by their contracts, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonguemill.llm import decontamination, divergence, html_text, licenses, mixing, near_dedup, pieces, ranked, repeats, secrets, token_counts, topk, toxicity
from tonguemill.llm.common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    drawn = F.transform("draws", lambda d: F.concat_ws(":", *[d[part].cast("string") for part in ("shard", "pass", "words")]))
    return mixed.withColumn("draws", F.array_join(drawn, ","))


def op3_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_lengths(spark, sf_dir)


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents")).drop("text_key")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"), passage=repeats.PASSAGE)


def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("notices", F.to_json("notices"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_text, op2_source_mix, op3_token_lengths, op4_secret_spans, op5_near_duplicates, op6_exact_top_k,
        op7_long_repeats, op8_license_notices, op9_toxicity, op10_decontamination, op11_source_divergence, op12_ranked_search,
        op13_piece_tokens,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op11_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
            FROM documents
        ), t AS (SELECT r, lang, source, unnest({_LETTERS}) AS term FROM d
        ), c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL
        ), k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
        ), v AS (SELECT lang, count(*) AS v, sum(total) AS n_lang FROM k GROUP BY lang
        ), g AS (SELECT DISTINCT lang, source FROM d
        ), f AS (
            SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS n_source
            FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), p AS (
            SELECT f.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (n_source + v) AS p,
                   1 + (1000000000::HUGEINT * (total + 1)) // (n_lang + v) AS q
            FROM f JOIN v ON v.lang = f.lang
        ), pairs AS (
            SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0) AS value
            FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source
            LEFT JOIN (
                SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
            ) x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
        ), found AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 200
    """,
    "op12_ranked_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
        ), s AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_words FROM d
        ), t AS (SELECT r, unnest(words) AS term FROM d
        ), tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY ALL
        ), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
        ), w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, s
        ), m AS (SELECT r, doc_id, 100 - 50 + (50 * len(words) * n_docs) // n_words AS m FROM d, s WHERE len(words) > 0
        ), q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark
        ), scored AS (
            SELECT item_id, m.r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
            FROM q JOIN w ON w.term = q.term JOIN tf ON tf.term = q.term JOIN m ON m.r = tf.r GROUP BY item_id, m.r, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 50
    """,
    "op6_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(x::DOUBLE * 256)::BIGINT for x in embedding] AS e FROM embeddings
            WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum([z[1] * z[2] for z in list_zip(q.e, c.e)])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
