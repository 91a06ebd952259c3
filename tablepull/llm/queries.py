"""The registered queries of the package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.llm.clusters import clustered
from tablepull.llm.decontaminate import contaminated
from tablepull.llm.extraction import extract_text
from tablepull.llm.license_rules import MAX_WORDS, RULES, STEMS
from tablepull.llm.licenses import PHRASE_WEIGHT, scan_licenses
from tablepull.llm.lines import dedup_lines
from tablepull.llm.minhash import near_duplicates
from tablepull.llm.negatives import hard_negatives
from tablepull.llm.neighbours import nearest
from tablepull.llm.packing import near_clusters, pack_documents
from tablepull.llm.quality import held_out, score_quality, train_quality
from tablepull.llm.repeats import remove_repeats
from tablepull.llm.token_files import read_token_documents, write_token_files
from tablepull.llm.url_filter import filter_urls
from tablepull.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, clusters=near_clusters(docs))


# Texts with a lower score are rejected.
QUALITY_BAR = 0.7


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_quality(docs, _table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"))


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_table(spark, sf_dir, "documents"), counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return filter_urls(_table(spark, sf_dir, "pages"), rules)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_documents(spark, path)


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(_table(spark, sf_dir, "embeddings"))


LICENSE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"), LICENSE_PHRASES)
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are moved by one where the id is divisible by 7, so that labels and nearness disagree in places."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filter": op8_url_filter,
    "op9_html_extraction": op9_html_extraction,
    "op10_token_files": op10_token_files,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}

# Every line of three words or more against all earlier ones: equal, or from eight words on one
# word replaced (same length, one place differs) or dropped (equal without one place).
_OP1 = """
WITH lines AS (
  SELECT doc_id, no - 1 AS no, line, list_filter(regexp_split_to_array(lower(line), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no FROM documents)),
firsts AS (SELECT w, min((doc_id, no)) AS p FROM lines WHERE len(w) >= 3 GROUP BY w),
long AS (SELECT w, p, len(w) AS n FROM firsts WHERE len(w) >= 8),
without AS (SELECT p, n, unnest(range(1, n + 1)) AS i, w FROM long),
cut AS (SELECT p, n, i, w[1:i-1] || w[i+1:] AS v FROM without),
near AS (
  SELECT p FROM (SELECT p, min(p) OVER (PARTITION BY n, i, v) AS q FROM cut) WHERE q < p
  UNION SELECT long.p FROM long JOIN cut ON long.w = cut.v WHERE cut.p < long.p
  UNION SELECT cut.p FROM long JOIN cut ON long.w = cut.v WHERE long.p < cut.p),
judged AS (
  SELECT l.doc_id, l.no, l.line, len(l.w) >= 3 AND ((l.doc_id, l.no) <> f.p OR f.p IN (SELECT p FROM near)) AS gone
  FROM lines l LEFT JOIN firsts f ON f.w = l.w)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(j.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(j.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY no) FILTER (NOT coalesce(gone, false)) AS kept
  FROM judged GROUP BY doc_id) j ON j.doc_id = d.doc_id
"""

# All links by shared shingles, then the smallest id that can be reached along them.
_OP4 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 75 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(id, seen) AS (
  SELECT a, a FROM both_ways
  UNION
  SELECT b.b, r.seen FROM reached r JOIN both_ways b ON b.a = r.id WHERE r.seen < b.b),
lowest AS (SELECT id, min(seen) AS low FROM reached GROUP BY id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept
FROM sets LEFT JOIN lowest ON id = doc_id
"""

_OP8 = """
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (
  SELECT page_id, host, path,
    (SELECT max({'n': length(h || p), 'rule': h || p, 'action': action}) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM parts)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM ruled
"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"


def _op11(rounds: int = 5, k: int = 40) -> str:
    """Rounds one after the other: components as rows, distances by (vector, centroid), exact sums."""
    parts = [
        f"""x AS MATERIALIZED (
  SELECT vec_id, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM x) QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, i, x FROM x JOIN seeds USING (vec_id))"""
    ]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (SELECT vec_id, c, sum((x.x - c{r}.x) * (x.x - c{r}.x))::BIGINT AS d FROM x JOIN c{r} USING (i) GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT vec_id, min((d, c)) AS best FROM d{r} GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT a.best[2] AS c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} a JOIN x USING (vec_id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, c{r}.i, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} LEFT JOIN m{r} m ON m.c = c{r}.c AND m.i = c{r}.i)""")
    last = f"a{rounds}"
    return f"""
WITH {", ".join(parts)},
digests AS (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY c)
SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance, sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia,
  sum(best[1]) OVER ()::BIGINT AS inertia, sha AS centroid_sha256
FROM {last} JOIN digests ON c = best[2]
"""


def _op12() -> str:
    """Every rule at every word of the texts that hold its keyword; nested detections settled by rank."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rules = ",\n".join(f"({i}, {quoted(r.label)}, {quoted(r.keyword)}, {quoted(f'^({r.pattern}) ')}, {r.priority}, {r.weight})" for i, r in enumerate(RULES))
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)})" for p, label in LICENSE_PHRASES)
    stems = " OR ".join(f"contains(norm, {quoted(s)})" for s in STEMS)
    return f"""
WITH rules(place, label, keyword, pattern, priority, weight) AS (VALUES {rules}),
phrases(phrase, label) AS (VALUES {phrases}),
listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS norm FROM listed),
spots AS MATERIALIZED (
  SELECT r, i, array_to_string(w[i + 1:i + {MAX_WORDS}], ' ') || ' ' AS here
  FROM (SELECT r, w, unnest(range(len(w))) AS i FROM texts WHERE {stems})),
base AS (
  SELECT r, i, label FROM (SELECT r, w, unnest(range(len(w))) AS i FROM texts), phrases
  WHERE array_to_string(w[i + 1:i + len(string_split(phrase, ' '))], ' ') = phrase),
tried AS MATERIALIZED (
  SELECT r, place, rules.label, pattern, priority, weight
  FROM texts JOIN rules ON contains(norm, keyword)),
hits AS MATERIALIZED (
  SELECT r, place, label, priority, weight, i, len(string_split(regexp_extract(here, pattern, 1), ' ')) AS n
  FROM tried JOIN spots USING (r) WHERE regexp_matches(here, pattern)),
kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (
    SELECT 1 FROM hits o WHERE o.r = h.r AND ((h.i >= o.i AND h.i + h.n <= o.i + o.n) OR (h.i <= o.i AND h.i + h.n >= o.i + o.n))
      AND (h.priority, h.n, -h.place) < (o.priority, o.n, -o.place))),
said AS (SELECT r, label, {PHRASE_WEIGHT} AS weight FROM base UNION ALL SELECT r, label, weight FROM kept),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight)::DOUBLE AS score FROM said GROUP BY r),
placed AS (SELECT r, count(*) AS n, min(i) AS first, max(i) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first::BIGINT AS first_word, last::BIGINT AS last_word,
  coalesce(p.labels, '') AS base_labels, coalesce(m.labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM texts t LEFT JOIN named m ON m.r = t.r LEFT JOIN placed p ON p.r = t.r
"""


# All scores of each anchor.
_OP13 = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND {_FINITE}),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": _OP1,
    "op4_minhash_dedup": _OP4,
    "op8_url_filter": _OP8,
    "op11_centroid_clusters": _op11(),
    "op12_license_scan": _op12(),
    "op13_hard_negatives": _OP13,
}
