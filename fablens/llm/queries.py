"""Registered queries of this subpackage, with DuckDB checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.llm import (
    alignment,
    bpe,
    decontamination,
    gnat,
    line_dedup,
    near_dedup,
    quality,
    sharding,
    token_counts,
    topk,
    toxicity,
    url_filter,
    vp_tree,
)
from fablens.llm.shipping import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op7_sharding")
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.i AS i, u.line AS line,
         translate(regexp_replace(u.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_zip(range(len(l)), l)) AS z FROM (
          SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)) t,
       LATERAL (SELECT z[1] AS i, z[2] AS line) u),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.i, l.line, (r.key IS NOT NULL AND l.doc_id <> r.keeper) AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def _landing_sql(url: str) -> str:
    """The address that ``url_filter.landing_url`` gives, in DuckDB's dialect."""
    host = f"translate(regexp_extract({url}, '://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    bare = f"regexp_replace({host}, ':(?:80|443)$', '')"
    stripped = rf"regexp_replace({bare}, '^(?:(?:{'|'.join(url_filter.MIRRORS)})\.)+([^.]+\.)', '\1')"
    registry = rf"regexp_matches({stripped}, '^(?:{'|'.join(url_filter.REGISTRY_LABELS)})\.[a-z][a-z]$')"
    site = f"CASE WHEN {registry} THEN {bare} ELSE {stripped} END"
    own = f"translate(regexp_extract({url}, '^([^:/?#]*)://', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    scheme = f"CASE WHEN {own} IN ('', 'http', 'https') THEN 'https' ELSE {own} END"
    path = rf"regexp_replace(rtrim(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '/'), '(?:/index)?(?:\.html?)?$', '')"
    asked = rf"string_split(regexp_extract({url}, '\?([^#]*)', 1), '&')"
    names = ", ".join(f"'{n}'" for n in url_filter.TRACKING)
    kept = f"array_to_string(list_sort(list_filter({asked}, lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ({names}))), '&')"
    return f"{scheme} || '://' || {site} || {path} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"


def _rule_sql(host: str, path: str, value) -> str:
    cases = [
        f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{value(v, h, p)}'"
        for v, h, p in sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    ]
    return f"CASE {' '.join(cases)} END"


def _op5_sql() -> str:
    host = "translate(regexp_extract({0}, '://([^/?#]*)', 1), '%s', '%s')" % (url_filter.UPPER, url_filter.LOWER)
    path = "regexp_extract({0}, '://[^/?#]*([^?#]*)', 1)"
    link = r"regexp_extract(html, '(?i)(<link\b[^>]*\brel\s*=\s*[\"\x27]?canonical\b[^>]*>)', 1)"
    named = (
        rf"regexp_extract({link}, '(?i)\bhref\s*=\s*[\"\x27]?([^\"\x27\s>]+)', 1)",
        r"regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"\x27]?refresh\b[^>]*\burl\s*=\s*[\"\x27]?([^\"\x27\s>]+)', 1)",
    )
    scheme = "regexp_extract(url, '^([^:/?#]*)://', 1)"
    targets = " UNION ALL ".join(
        f"""SELECT landing AS a, CASE
              WHEN regexp_matches(f, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN f
              WHEN starts_with(f, '//') THEN {scheme} || ':' || f
              WHEN starts_with(f, '/') THEN {scheme} || '://' || {host.format('url')} || f END AS t
            FROM (SELECT url, landing, {f} AS f FROM seen) z WHERE f <> ''"""
        for f in named
    )
    return f"""
WITH RECURSIVE seen AS (
  SELECT DISTINCT url, coalesce(html, '') AS html, {_landing_sql('url')} AS landing FROM pages WHERE contains(url, '://')),
links AS (
  SELECT url AS a, landing AS b FROM seen
  UNION SELECT a, {_landing_sql('t')} FROM ({targets}) y WHERE t IS NOT NULL),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT a, a FROM links UNION SELECT b, b FROM links),
reach AS (SELECT a AS node, a AS root FROM edges UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
members AS (SELECT node, min(root) AS component FROM reach GROUP BY node),
ruled AS (SELECT node, component, {_rule_sql(host.format('node'), path.format('node'), lambda v, h, p: v)} AS verdict FROM members),
classes AS (
  SELECT component FROM ruled GROUP BY component
  HAVING bool_or(coalesce(verdict = 'block', false)) AND NOT bool_or(coalesce(verdict = 'allow', false))),
judged AS (
  SELECT page_id, url, coalesce({host.format('url')}, '') AS host, coalesce({path.format('url')}, '') AS path FROM pages)
SELECT j.page_id, j.host, j.path, {_rule_sql('j.host', 'j.path', lambda v, h, p: h + p)} AS rule,
       coalesce({_rule_sql('j.host', 'j.path', lambda v, h, p: v)},
                CASE WHEN c.component IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN members m ON m.node = j.url LEFT JOIN classes c ON c.component = m.component
"""


@query("op5_url_filters", _op5_sql())
def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op4_exact_top_k", OP4_SQL)
def op4_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", 256)
    return topk.top_products(vectors, F.col("id") % 50 == 0, topk.K)


OP6_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM sizes UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.root) AS component_id, s.doc_id = min(r.root) AS kept
FROM sizes s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.n
"""


@query("op6_minhash_near_dedup", OP6_SQL)
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op3_bpe_lexicon")
def op3_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_toxicity_chain")
def op2_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_quality_bayes")
def op9_quality_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


VALID_SQL = """embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

# Exact search. The registered factor prunes nothing that counts on vectors without clusters, such as the given ones; see the README.
OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE {VALID_SQL} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_reduce(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]), lambda x, y: x + y) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_vantage_point_trees", OP11_SQL)
def op11_vantage_point_trees(spark: SparkSession, folder: str) -> DataFrame:
    return vp_tree.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % {gnat.LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE label IS NOT NULL AND {VALID_SQL}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, alike ORDER BY score DESC, vec_id) AS place FROM scored),
positives AS (SELECT * FROM ordered WHERE alike AND place <= {gnat.POSITIVES}),
found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN ordered n ON n.anchor_id = p.anchor_id AND NOT n.alike
    AND {gnat.LOW} * p.score <= 100 * n.score AND 100 * n.score <= {gnat.HIGH} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= {gnat.NEGATIVES}
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % gnat.LABELS).otherwise(F.col("label"))
    return gnat.hard_negatives(gnat.labelled_vectors(rows.withColumn("label", label)), F.col("id") % 50 == 0)


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.cross_alignment(table(spark, folder, "documents"))
