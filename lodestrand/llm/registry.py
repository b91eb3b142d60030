"""The queries of this package: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, html_text, mixture, pieces, quality_model, quality_rules, resampling, sanitising, sharding, simhash, tokenfile, topk, toxicity
from .scratch import new_path

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return tokenfile.read_tokens(spark, path, digest=True)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_sentencepiece_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op10_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % hard_negatives.EVERY == 0, hard_negatives.relabelled())


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitising.find(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_simhash_near_dedup, op2_exact_top_k, op3_token_file, op4_quality_classifier, op5_toxicity,
        op6_html_main_text, op7_sentencepiece_n_best, op8_source_mixture, op9_quality_rules, op10_stratified_sharding,
        op11_hard_negatives, op12_personal_data, op13_importance_resampling,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_top_k": OP2_SQL, "op9_quality_rules": OP9_SQL, "op10_stratified_sharding": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_personal_data": OP12_SQL, "op13_importance_resampling": OP13_SQL}


OP2_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_PHRASES = quality_rules.PHRASES.replace("'", "''")
OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, i, ws[i] AS w FROM (SELECT r, ws, unnest(generate_series(1, len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d))),
v AS (SELECT r, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS times FROM v WHERE w3 IS NOT NULL),
rep AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM g WHERE times > 1) GROUP BY r),
n AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r),
l AS (SELECT r, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM (SELECT r, ls[i] AS line, i FROM (SELECT r, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d)))),
j AS (SELECT r, len(ws) AS size, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
    10 * len(list_filter(ws, lambda x: regexp_matches(x, '(!!|[#*$%&<>~^=_][#*$%&<>~^=_])$'))) > 3 * len(ws) OR NOT regexp_matches(line, '[\p{{L}}\p{{N}}]')
    OR len(list_filter(ws, lambda x: regexp_full_match(x, '[|>»·•/\\:]|::|>>|->|=>'))) >= 3 AND 5 * len(list_filter(ws, lambda x: regexp_full_match(x, '[|>»·•/\\:]|::|>>|->|=>'))) >= len(ws)
    OR len(ws) <= 40 AND regexp_matches(line, '{_PHRASES}', 'i') AS fails FROM l WHERE len(ws) > 0),
m AS (SELECT r, CAST(sum(again::INT) AS BIGINT) AS n_dup_lines, CAST(sum(CASE WHEN again OR fails THEN size ELSE 0 END) AS BIGINT) AS lost_words, CAST(sum((again OR fails)::INT) AS BIGINT) AS failed_lines FROM j GROUP BY r),
s AS (SELECT d.r, doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_words, 0) AS lost_words, coalesce(failed_lines, 0) AS failed_lines
    FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN rep ON rep.r = d.r LEFT JOIN m ON m.r = d.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 40 * n_words AS kept, lost_words, failed_lines FROM s
"""

#: crc32 byte by byte, with its table made by its rule.
OP10_SQL = f"""
WITH t AS (
    SELECT list_transform(generate_series(0, 255), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab
), d AS (
    SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)), lambda a, x: xor(a >> 8, tab[1 + (xor(a, x) & 255)])), 4294967295) AS crc
    FROM documents, t
), h AS (
    SELECT *, ('0x' || substr(md5(concat('{sharding.SEED}/', doc_id, '/', crc)), 1, 15))::BIGINT AS h, (('0x' || substr(md5(concat('{sharding.SEED + 1}/', source)), 1, 7))::BIGINT % 1000003 + 0.5::DOUBLE) / 1000003 AS u FROM d
), r AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size) AS rank, count(*) OVER (PARTITION BY source) AS cnt, count(*) OVER () AS n FROM h
), p AS (
    SELECT *, row_number() OVER (ORDER BY (rank - u) / cnt, source NULLS FIRST, h, doc_id NULLS FIRST) - 1 AS place FROM r
)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(place * 40 // n AS INT) AS shard, place - (place * 40 // n * n + 39) // 40 AS slot, CAST(NULL AS INT) AS grown_shard, source FROM p
"""

OP13_SQL = f"""
WITH t AS (
    SELECT list_transform(generate_series(0, 255), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab
), d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{resampling._UPPER}', '{resampling._LOWER}'), '{resampling.WORD}') AS ws FROM documents
), f AS (SELECT r, unnest(ws) AS w FROM d),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{resampling._UPPER}', '{resampling._LOWER}'), '{resampling.WORD}')) AS w FROM benchmark),
v AS (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda a, x: xor(a >> 8, tab[1 + (xor(a, x) & 255)])), 4294967295) % {resampling.BUCKETS} AS k
    FROM (SELECT w FROM f UNION SELECT w FROM b), t
), s AS (SELECT k, count(*) AS s FROM f JOIN v USING (w) GROUP BY k), u AS (SELECT k, count(*) AS t FROM b JOIN v USING (w) GROUP BY k),
g AS (
    SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM f) + {resampling.BUCKETS}) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * ((SELECT count(*) FROM b) + {resampling.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
    FROM (SELECT DISTINCT k FROM v) LEFT JOIN s USING (k) LEFT JOIN u USING (k)
), e AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN v USING (w) JOIN g USING (k) GROUP BY r),
w AS (
    SELECT d.r, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
        CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256(concat('{resampling.SEED}:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
    FROM d LEFT JOIN e ON d.r = e.r
), z AS (
    SELECT doc_id, n_features, weight, weight + noise AS score, n_features >= {resampling.LEAST_WORDS} AS fit FROM w
), o AS (
    SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, sum(fit::INT) OVER () AS n FROM z
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= {resampling.PERCENT} * n // 100 THEN place END AS rank FROM o
"""

OP11_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, * FROM (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    )
), s AS (
    SELECT a.r, a.vec_id AS anchor_id, a.label = d.label AS same, d.vec_id AS vec_id, CAST(list_inner_product(a.v, d.v) AS BIGINT) AS score
    FROM v a JOIN v d ON a.vec_id <> d.vec_id AND len(a.v) = len(d.v)
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT * FROM (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
    SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.r, place ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON s.r = p.r AND NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_FINDS = [_EMAIL, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
_MATCHES = " UNION ALL ".join(f"SELECT r, {n} AS kind, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS gs FROM d" for n, p in enumerate(_FINDS))
_A_TO_Z = f"'{sanitising._UPPER}', '{sanitising._LOWER}'"


def _near_sql(fragment: str) -> str:
    return f"list_filter(regexp_extract_all(translate(regexp_replace({fragment}, '{_EMAIL}', ' ', 'g'), {_A_TO_Z}), '{sanitising.WORD}'), lambda x: length(x) >= {sanitising.MIN_LETTERS})"


_LEFT = rf"CASE WHEN length(a) > {sanitising.NEAR_CHARS} THEN regexp_replace(right(a, {sanitising.NEAR_CHARS}), '^[^\x20\x09-\x0D]*', '') ELSE a END"
_RIGHT = rf"CASE WHEN length(b) > {sanitising.NEAR_CHARS} THEN regexp_replace(left(b, {sanitising.NEAR_CHARS}), '[^\x20\x09-\x0D]*\z', '') ELSE b END"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({_MATCHES}),
m AS (
    SELECT r, kind, ms[i] AS value, gs[i] AS a, gs[i + 1] AS b, sum(length(gs[i]) + length(ms[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e
    FROM (SELECT r, kind, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM raw)
), v AS (
    SELECT r, kind, CAST(e - length(value) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, a, b, CASE kind WHEN 0 THEN translate(value, {_A_TO_Z}) WHEN 1 THEN value ELSE regexp_replace(value, '[^0-9]', '', 'g') END AS value FROM m
), ok AS (
    SELECT * FROM v WHERE CASE kind WHEN 0 THEN true
        WHEN 1 THEN len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR TRY_CAST(p AS HUGEINT) > 255)) = 0
        WHEN 2 THEN length(value) BETWEEN 12 AND 19 AND list_sum(list_transform(generate_series(1, length(value)), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(value), i, 1) AS INT)
            ELSE 2 * CAST(substr(reverse(value), i, 1) AS INT) // 10 + 2 * CAST(substr(reverse(value), i, 1) AS INT) % 10 END)) % 10 = 0
        ELSE length(value) BETWEEN 9 AND 15 END
), near AS (
    SELECT r, kind, value, list_concat(list_reverse({_near_sql(_LEFT)})[:{sanitising.NEAR}], ({_near_sql(_RIGHT)})[:{sanitising.NEAR}]) AS ws FROM ok
), p AS (
    SELECT r, kind, value, t, min(md5(array_to_string(list_filter(ws, lambda x: x <> t), ' '))) AS context FROM (SELECT r, kind, value, ws, unnest(list_distinct(ws)) AS t FROM near) GROUP BY ALL
), j AS (SELECT kind, value, t, count(*) AS n_both FROM p GROUP BY ALL HAVING count(DISTINCT context) >= {sanitising.MIN_CONTEXTS}),
ne AS (SELECT kind, value, count(DISTINCT r) AS n_entity FROM ok GROUP BY ALL),
w AS (SELECT DISTINCT r, unnest({_near_sql("text")}) AS t FROM d),
nt AS (SELECT t, count(*) AS n_term FROM w GROUP BY t),
told AS (
    SELECT kind, value, t FROM j JOIN ne USING (kind, value) JOIN nt USING (t), (SELECT count(*) AS n_all FROM d)
    WHERE n_entity < n_all AND round(ln(n_both::DOUBLE * n_all / (n_entity::DOUBLE * n_term)) / ln(n_all::DOUBLE / n_entity), 9) >= {sanitising.GENERALISE}
), hit AS (SELECT DISTINCT r, t FROM p JOIN told USING (kind, value, t)),
tok AS (SELECT r, regexp_extract_all(translate(text, {_A_TO_Z}), '{_EMAIL}|{sanitising.WORD}') AS ms, string_split_regex(translate(text, {_A_TO_Z}), '{_EMAIL}|{sanitising.WORD}') AS gs FROM d WHERE r IN (SELECT r FROM hit)),
found AS (SELECT r, ms[i] AS t, sum(length(gs[i]) + length(ms[i])) OVER (PARTITION BY r ORDER BY i) AS e FROM (SELECT r, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM tok)),
spans AS (SELECT r, kind, s, e FROM ok UNION ALL SELECT r, 4, CAST(e - length(t) AS BIGINT), CAST(e AS BIGINT) FROM found JOIN hit USING (r, t)),
named AS (SELECT r, kind, s, concat(['email', 'ip', 'card', 'phone', 'term'][kind + 1], ':', s, ':', e) AS x FROM spans),
g AS (
    SELECT r, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone, count(*) FILTER (kind = 4) AS n_term,
        string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 4) AS base, string_agg(x, ',' ORDER BY s, kind) AS spans FROM named GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, coalesce(n_term, 0) AS n_term, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
