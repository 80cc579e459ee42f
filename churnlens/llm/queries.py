"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import (
    ann, dedup, lexical, mixing, packing, quality, simhash, spelling, tokenfile, topk, toxicity, urlfilter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block"))

QUERIES: dict[str, Query] = {
    "op1_exact_top_k": lambda s, d: topk.exact_top_k(_table(s, d, "embeddings")),
    "op2_token_files": lambda s, d: tokenfile.token_output(_table(s, d, "documents")),
    "op3_packing": lambda s, d: packing.pack_documents(_table(s, d, "documents"), with_ids=False),
    "op4_mixing": lambda s, d: mixing.mix(_table(s, d, "documents")).drop("content"),
    "op5_quality": lambda s, d: quality.quality_scores(_table(s, d, "documents"), _table(s, d, "labels")),
    "op6_warc": lambda s, d: warc.archived_pages(_table(s, d, "pages")).drop("target"),
    "op7_toxicity": lambda s, d: toxicity.toxicity_scores(_table(s, d, "documents"), _table(s, d, "labels")),
    "op8_nearest": lambda s, d: ann.nearest(_table(s, d, "embeddings")),
    "op9_url_filter": lambda s, d: urlfilter.judge_urls(_table(s, d, "pages"), URL_RULES).drop("trust", "distrust"),
    "op10_simhash": lambda s, d: simhash.near_duplicates(_table(s, d, "documents")),
    "op11_spelling": lambda s, d: spelling.variants(_table(s, d, "documents"), change=spelling.with_slips),
    "op12_exact_dedup": lambda s, d: dedup.deduplicate(s, f"{d}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    "op13_ranked_search": lambda s, d: lexical.ranked_search(_table(s, d, "documents"), _table(s, d, "benchmark")),
}


def top_k_sql(every: int = 100, k: int = 10, scale: int = 1024) -> str:
    return f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= {k}"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages
), held AS (
  SELECT payload, max(page_id) AS response FROM p WHERE n >= 1000 GROUP BY payload
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN held ON p.n >= 1000 AND p.payload = held.payload"""


def url_sql(rules=URL_RULES, rounds: int = 400, damping: float = 0.85, block_ratio: float = 2.0, tolerance: float = 1e-6) -> str:
    """The same verdicts with the propagation as a recursive sum of what flows in each round."""
    rows = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in rules)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")
    return f"""
WITH RECURSIVE rules(rule_host, rule_path, rule, verdict) AS (VALUES {rows}), parts AS (
  SELECT page_id, {host} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, html
  FROM pages
), ruled AS (
  SELECT page_id, host, path, (
    SELECT max_by({{'rule': rule, 'verdict': verdict}}, length(rule)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS fit
  FROM parts
), links AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS link FROM parts
), ends AS (
  SELECT src, {lower.format("regexp_extract(CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END, '(?s)^.*?://([^/?#]*)', 1)")} AS dst
  FROM links WHERE regexp_matches(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//')
), edges AS (
  SELECT src, dst, count(*)::DOUBLE AS weight FROM ends WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), both_ways AS (
  SELECT 'trust' AS kind, src AS host, dst, weight FROM edges
  UNION ALL SELECT 'distrust', dst, src, weight FROM edges
), steps AS (
  SELECT kind, host, dst, weight / sum(weight) OVER (PARTITION BY kind, host) AS share FROM both_ways
), r0 AS (
  SELECT CASE fit.verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*)::DOUBLE * {1 - damping} AS rank
  FROM ruled WHERE fit IS NOT NULL AND host <> '' GROUP BY ALL
), flow(kind, host, amount, k) AS (
  SELECT kind, host, rank, 0 FROM r0
  UNION ALL
  SELECT f.kind, s.dst, sum(f.amount * s.share * {damping}), max(f.k) + 1 FROM flow f JOIN steps s ON s.kind = f.kind AND s.host = f.host
  WHERE f.k < {rounds} GROUP BY f.kind, s.dst
), verdicts AS (
  SELECT host, coalesce(sum(amount) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(amount) FILTER (kind = 'distrust'), 0) AS distrust
  FROM flow GROUP BY host
)
SELECT page_id, ruled.host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN distrust > 0 AND distrust >= {block_ratio * (1 - tolerance)} * trust THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN verdicts ON verdicts.host = ruled.host"""


DEDUP_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm)::BIGINT AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST)"""

SPELLING_SQL = """
WITH RECURSIVE tables AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS marked, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(marked, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)),
    lambda h, b: xor(crc[(xor(h, b) & 255) + 1], h >> 8))) AS h
  FROM counted, tables
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), less AS (
  SELECT word, n, i, left(word, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL
), roots AS (
  SELECT s.word, s.at AS root FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

RANKED_SQL = r"""
WITH terms AS (
  SELECT d.row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents) d
), tfs AS (
  SELECT row, doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY row)::HUGEINT AS n FROM terms GROUP BY row, doc_id, term
), sums AS (SELECT count(DISTINCT row)::HUGEINT AS total, sum(tf)::HUGEINT AS length FROM tfs
), dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)
), weighed AS (
  SELECT item_id, term, count(*) * floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM asked JOIN dfs USING (term), sums GROUP BY item_id, term, total, df
), scores AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * total) // length))))::BIGINT AS score
  FROM weighed JOIN tfs USING (term), sums GROUP BY item_id, row, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""

ORACLE: dict[str, str] = {"op1_exact_top_k": top_k_sql(), "op6_warc": WARC_SQL, "op9_url_filter": url_sql(),
                          "op11_spelling": lambda s, d: spelling.variants(_table(s, d, "documents"), change=spelling.with_slips),
    "op11_spelling": SPELLING_SQL, "op12_exact_dedup": DEDUP_SQL,
                          "op13_ranked_search": RANKED_SQL}
