"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import align, bpe, lines, lm, mixing, phrases, pii, quality, simhash, topk, toxicity, urls, windows
from playlens.llm.common import documents, table

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary_path() -> str:
    """The tokenizer file, on every executor: ``PLAYLENS_TOKENIZER``, else that of the installed public_tokenizers."""
    if own := os.environ.get("PLAYLENS_TOKENIZER"):
        return own
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces_path() -> str:
    """The sentencepiece model, on every executor: ``PLAYLENS_PIECES``, else that of the installed public_tokenizers."""
    if own := os.environ.get("PLAYLENS_PIECES"):
        return own
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", simhash.print_hex(F.col("f")).alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir).select("doc_id", "text"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "labels"))
    shown = F.transform(F.slice("evidence", 1, 5), lambda e: F.concat_ws(":", e["doc_id"], F.round(e["cosine"], 4), e["label"]))
    return out.select("doc_id", "held_out", "score", "predicted", F.array_join(shown, " ").alias("evidence"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(documents(spark, sf_dir).select("doc_id", "text"), vocabulary_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 50 = 0"), k=5)


def quality_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of the mixture: ``labels.quality`` as a domain."""
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "prime").when(F.col("quality") == 0, "rough").alias("domain"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(documents(spark, sf_dir).select("doc_id", "text"), quality_domains(spark, sf_dir))
    return out.select("doc_id", "n_tokens", F.col("posterior")[0].alias("p_prime"), F.col("posterior")[1].alias("p_rough"), "rate", "copies")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.align(documents(spark, sf_dir).select("doc_id", "text"), vocabulary_path(), pieces_path())
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    judged = align.judge_links(out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_overlaps", sha, "pairs", "times"))
    return judged.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir).select("lang", "text"))


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_repeats": op7_repeats,
    "op8_url_filter": op8_url_filter,
    "op9_top_k": op9_top_k,
    "op10_mixing": op10_mixing,
    "op11_align": op11_align,
    "op12_phrases": op12_phrases,
    "op13_lm": op13_lm,
}

_TRIM = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op12_phrases": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), s AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
v AS (SELECT lang, piece, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM s),
t AS (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM v WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (
  SELECT lang, 1 AS words, x AS phrase FROM t
  UNION ALL SELECT lang, 2, x || ' ' || y FROM t WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM t WHERE z IS NOT NULL
), f AS (SELECT lang, words, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND a >= 10),
cut AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(w, k + 1, c.words), ' ')
), best AS (SELECT lang, phrase, a, min(struct_pack(score := score, k := k, l := l, r := r)) AS c FROM cut GROUP BY ALL),
held AS (SELECT lang, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase, a FROM c WHERE words = 3),
over_ AS (SELECT lang, phrase, max(a) AS most FROM held GROUP BY ALL),
r AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY c.score DESC, a DESC, CAST(encode(phrase) AS BLOB)) AS rank
  FROM best b LEFT JOIN over_ o USING (lang, phrase) WHERE o.most IS NULL OR 100 * o.most < 50 * b.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(c.l AS BIGINT) AS l, CAST(c.r AS BIGINT) AS r, n, CAST(c.score AS BIGINT) AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000""",
    "op3_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
rows_ AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM split),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_TRIM})")} AS k FROM rows_),
bad AS (SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT d.*, b.k IS NOT NULL AND d.doc_id <> b.keep AS gone FROM keyed d LEFT JOIN bad b ON d.k = b.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), x AS (SELECT vec_id, generate_subscripts(e, 1) AS d, unnest(e) AS x FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM x q JOIN x c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_url_filter": r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS q
  FROM pages
), r AS (
  SELECT *, host || regexp_replace(path, '(?i)(/|\.html?)+$', '') || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS k,
    CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM p
), v AS (SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own FROM r),
a AS (SELECT k, bool_or(own = 'allow') AS allow, bool_or(own = 'block') AS block FROM v WHERE contains(url, '://') GROUP BY k)
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN allow THEN 'allow' WHEN block THEN 'block' END, 'allow') AS verdict
FROM v LEFT JOIN a ON v.k = a.k AND contains(v.url, '://')""",
}
