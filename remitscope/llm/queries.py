"""The registered corpus queries, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope.llm import (
    chat,
    divergence,
    exact_dedup,
    filter_audit,
    html_extract,
    licenses,
    near_dedup,
    packing,
    quality,
    sentence_pieces,
    substring_dedup,
    topk,
    toxicity,
)
from remitscope.llm.common import table


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.piece_digests(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, model)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model, threshold=0.3)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), size=3, percent=85)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_documents=30, most_terms=50)


# Fixed value: what both rows of the additional conversation say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema
    )
    return chat.digests(chat.format_conversations(turns.unionByName(control)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_toxicity": op2_toxicity,
    "op3_license_scan": op3_license_scan,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_html_extract": op7_html_extract,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_topk": op9_topk,
    "op10_near_dedup": op10_near_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_chat_format": op12_chat_format,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op5_substring_dedup": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS passage
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)
        ), numbered AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS place FROM windows
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM numbered WHERE place > 1
        ), words AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op10_near_dedup": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM docs)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                FROM shingles AS x JOIN shingles AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
                GROUP BY ALL
            ) AS s JOIN sizes AS a ON a.doc_id = s.a JOIN sizes AS b ON b.doc_id = s.b
            WHERE 100 * shared >= 85 * (a.n + b.n - shared)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM docs
            UNION SELECT r.doc_id, l.b FROM reached AS r JOIN links AS l ON r.other = l.a
        )
        SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
               min(other) = d.doc_id AS kept
        FROM docs AS d JOIN reached AS r ON r.doc_id = d.doc_id LEFT JOIN sizes AS s ON s.doc_id = d.doc_id
        GROUP BY d.doc_id
    """,
    "op11_source_divergence": r"""
        WITH given AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d,
                   regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
            FROM documents
        ), words AS (
            SELECT lang, source, d,
                   translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM given
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), groups AS (
            SELECT g.lang, g.source, coalesce(c.total, 0) AS total, coalesce(l.v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM given) AS g
            LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) AS c USING (lang, source)
            LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY ALL) AS l USING (lang)
        ), langs AS (
            SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + 1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT // (g.total + 5 * g.v) AS p
            FROM groups AS g JOIN kept AS k USING (lang) LEFT JOIN counts AS c USING (lang, source, term)
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
            FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
                FROM shares AS x JOIN shares AS y USING (lang, term) GROUP BY ALL
            ) AS f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
        ), terms AS (
            SELECT s.lang, s.source, 'term' AS part, s.term AS item,
                   s.p - (1 + 1000000000 * (k.n + 5)::HUGEINT // (l.total + 5 * l.v)) AS value
            FROM shares AS s JOIN kept AS k USING (lang, term) JOIN langs AS l USING (lang)
            WHERE s.n > 0
        )
        SELECT lang, source, part, item, value::BIGINT AS value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms WHERE value > 0)
        QUALIFY part = 'pair' OR rank <= 50
    """,
    "op12_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), written AS (
            SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS name,
                   '(<\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|SYS>>|/SYS>>)|(\[\\*)(INST\]|/INST\])' AS control
            FROM turns
        ), formatted AS (
            SELECT conv_id, turn, role, text,
                   '<|im_start|>' || regexp_replace(name, control, '\1\3\\\2\4', 'g') || chr(10)
                   || regexp_replace(text, control, '\1\3\\\2\4', 'g') || '<|im_end|>' || chr(10) AS whole
            FROM written
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(length(whole))::BIGINT AS formatted_chars
        FROM formatted GROUP BY conv_id
    """,
    "op13_filter_audit": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), known AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(words) < 50)::INTEGER
                   + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INTEGER
                   + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INTEGER
                   + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
                   + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER AS mask
            FROM docs LEFT JOIN known USING (doc_id)
        ), counts AS (
            SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
            FROM failed GROUP BY ALL
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS b
        ), orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                   [a.b, b.b, c.b, d.b, e.b] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5
        ), steps AS (
            SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[:step - 1]), 0)::INTEGER AS before
            FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
        ), counted AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost
            FROM counts, steps GROUP BY ALL
        )
        SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM counted
    """,
}
