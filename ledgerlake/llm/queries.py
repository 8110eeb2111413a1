"""The operators of this package applied to the whole tables: one query each,
with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroids, decontamination, filter_audit, html_extract, license_scan, mixing, nearest, ngram_join, quality,
               secret_scan, sentencepiece_codec, substring_dedup, url_filter)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql.strip()
        return function
    return register


# --- 1 ---------------------------------------------------------------------------------------

@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "labels", "doc_id", "quality"))


# --- 2 ---------------------------------------------------------------------------------------

@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and whether they decode to it exactly."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sentencepiece_codec.encode(docs, sentencepiece_codec.load(), check=True)


# --- 3 ---------------------------------------------------------------------------------------

def _quoted(text: str) -> str:
    return "'" + " ".join(text.split()).replace("'", "''") + "'"


_NORMAL = "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


@query(f"""
WITH template(k, license, text) AS (VALUES {', '.join(f"({k}, '{n}', {_quoted(t)})" for k, (n, t) in enumerate(license_scan.TEMPLATES))}),
unit AS (
  SELECT DISTINCT doc_id, {_NORMAL.format('u')} AS unit
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents
        UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\n[ \t\r]*\n')) FROM documents)),
word AS (SELECT doc_id, unit, string_split(unit, ' ') AS w FROM unit),
pair AS (
  SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS b
  FROM (SELECT doc_id, unit, w, unnest(range(1, len(w))) AS i FROM word)),
wanted AS (
  SELECT DISTINCT k, license, w[i] || ' ' || w[i + 1] AS b
  FROM (SELECT k, license, w, unnest(range(1, len(w))) AS i
        FROM (SELECT k, license, string_split({_NORMAL.format('text')}, ' ') AS w FROM template))),
n AS (SELECT doc_id, unit, count(*) AS n FROM pair GROUP BY ALL),
m AS (SELECT k, count(*) AS m FROM wanted GROUP BY ALL),
dice AS (
  SELECT doc_id, unit, license, k, count(*) AS common FROM pair JOIN wanted USING (b) GROUP BY ALL),
found AS (
  SELECT doc_id, unit, license, max(2.0::DOUBLE * common / (n + m)) AS dice
  FROM dice JOIN n USING (doc_id, unit) JOIN m USING (k) WHERE 2.0::DOUBLE * common / (n + m) >= 0.8 GROUP BY ALL),
per_doc AS (
  SELECT doc_id, count(DISTINCT unit) AS n_units, max(dice) AS best_dice,
         (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT unnest(list(license)) AS x)) AS licenses
  FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, coalesce(licenses, '') AS licenses, best_dice
FROM documents d LEFT JOIN per_doc USING (doc_id)""")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that lines and blocks of every document match."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = (license_scan.scan(docs).groupBy("doc_id")
             .agg(F.countDistinct("unit").alias("n_units"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
                  F.max("dice").alias("best_dice")))
    return (docs.select("doc_id").join(found, "doc_id", "left")
            .select("doc_id", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
                    F.coalesce("licenses", F.lit("")).alias("licenses"), "best_dice"))


# --- 4 ---------------------------------------------------------------------------------------

@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) m USING (doc_id)""")
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their word 5-grams."""
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


# --- 5 ---------------------------------------------------------------------------------------

#: The rules of the query.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(action, h, p) AS (VALUES {', '.join(str(r) for r in URL_RULES)})
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
       (SELECT arg_max(h || p, length(h || p)) FROM rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT arg_max(action, length(h || p)) FROM rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM cut""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules)


# --- 6 ---------------------------------------------------------------------------------------

@query()
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors to each whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


# --- 7 ---------------------------------------------------------------------------------------

@query(r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, i, g.n, item FROM g JOIN p ON g.k = p.k AND g.n = p.n),
per_word AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
             FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
             FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)""")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of the benchmark."""
    found = decontamination.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                                          table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


# --- 8 ---------------------------------------------------------------------------------------

@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
first AS (SELECT k, min(doc_id) AS m FROM g GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN first USING (k) WHERE m < doc_id),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.pos) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d) x
  ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.pos = x.pos GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay once passages of earlier documents are taken out."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


# --- 9 ---------------------------------------------------------------------------------------

@query()
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


# --- 10 --------------------------------------------------------------------------------------

@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text: counts, digest of the base kinds, all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = [r.kind for r in secret_scan.RULES if r.base]

    def of(kinds: list[str]):
        return F.filter("spans", lambda span: span["kind"].isin(kinds))

    return found.select("doc_id", *(F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in base),
                        F.sha2(secret_scan.listed(of(base)), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


# --- 11 --------------------------------------------------------------------------------------

#: Weights of the sources, in turn.
MIX_WEIGHTS = (5, 2, 1)


@query(rf"""
WITH RECURSIVE row AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest
  FROM documents),
unit AS (
  SELECT *, md5(concat_ws(':', '11', coalesce(CAST(doc_id AS VARCHAR), ''), key, digest, CAST(copy AS VARCHAR))) AS uid
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key, digest) AS copy FROM row)),
src AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS s, count(*) FILTER (size > 0) AS n,
         {list(MIX_WEIGHTS)}[(row_number() OVER (ORDER BY key) - 1) % {len(MIX_WEIGHTS)} + 1] AS w FROM unit GROUP BY key),
place AS (
  SELECT *, CAST(sum(s) OVER () AS BIGINT) AS total,
         CAST(coalesce(sum(3 * s) OVER (ORDER BY 3.0 * s / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS capped,
         CAST(sum(w) OVER (ORDER BY 3.0 * s / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share,
         row_number() OVER (ORDER BY 3.0 * s / w, key) AS k FROM src),
cut AS (SELECT total - capped AS words, share FROM place WHERE 3 * s * share >= w * (total - capped) ORDER BY k LIMIT 1),
wanted AS (
  SELECT key, s, n, CASE WHEN 3 * s * share < w * words THEN CAST(3 * s AS DOUBLE) ELSE CAST(w * words AS DOUBLE) / CAST(share AS DOUBLE) END AS target
  FROM src, cut),
stream AS (
  SELECT uid, key, size, s, n, target, CAST(sum(size) OVER (PARTITION BY key ORDER BY uid) AS BIGINT) - size AS start,
         row_number() OVER (PARTITION BY key ORDER BY uid) - 1 AS pos FROM unit JOIN wanted USING (key) WHERE size > 0),
begun AS (
  SELECT *, CAST(start + size <= target AS INTEGER) + CAST(start + s + size <= target AS INTEGER) + CAST(start + 2 * s + size <= target AS INTEGER) AS copies
  FROM stream),
following AS (
  SELECT uid, key, size, target - (start + copies * s) AS gap, row_number() OVER (PARTITION BY key ORDER BY copies * n + pos) AS k
  FROM begun WHERE copies < 3 QUALIFY k <= {mixing.FILL + 1}),
fill AS (
  SELECT key, k, uid, gap, size AS size1, CAST(0 AS BIGINT) AS filled, false AS took FROM following WHERE k = 1
  UNION ALL
  SELECT f.key, f.k, f.uid, p.gap, p.size1, p.filled + CASE WHEN f.size <= p.gap - p.filled THEN f.size ELSE 0 END, f.size <= p.gap - p.filled
  FROM fill p JOIN following f ON f.key = p.key AND f.k = p.k + 1),
extra AS (
  SELECT uid FROM (SELECT *, size1 - gap < gap - max(filled) OVER (PARTITION BY key) AS whole FROM fill)
  WHERE CASE WHEN whole THEN k = 1 ELSE took END)
SELECT unit.doc_id, unit.size, wanted.s AS source_size, wanted.target,
       CAST(unit.size * (coalesce(copies, 0) + CASE WHEN extra.uid IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM unit JOIN wanted ON wanted.key = unit.key LEFT JOIN begun ON begun.uid = unit.uid LEFT JOIN extra ON extra.uid = unit.uid""")
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes of every document, added up over its shards."""
    taken, shards = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"), MIX_WEIGHTS, seed="11")
    drawn = shards.groupBy("uid").agg(F.sum("size").alias("taken"))
    return (taken.join(drawn, "uid", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


# --- 12 --------------------------------------------------------------------------------------

_LETTERS = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"


@query(rf"""
WITH seen AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS m FROM seen GROUP BY t),
masked AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END ||
         CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END ||
         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END ||
         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
         CASE WHEN doc_id > m THEN 'E' ELSE '' END AS fails
  FROM seen JOIN first USING (t)),
label AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masked LEFT JOIN label USING (doc_id) GROUP BY ALL),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM {_LETTERS} a(x), {_LETTERS} b(x), {_LETTERS} c(x), {_LETTERS} d(x), {_LETTERS} e(x)
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
grid AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f FROM orders, (SELECT unnest(range(1, 6)) AS step)),
fate AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS failing, fails = f AS alone,
         len(fails) > 0 AND regexp_matches(left(filter_order, step), '[' || fails || 'x]') AS gone,
         len(fails) > 0 AND regexp_matches(left(filter_order, step - 1), '[' || fails || 'x]') AS before
  FROM counts, grid),
per_step AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone) AS kept, sum(n) FILTER (gone AND NOT before) AS removed,
         sum(n) FILTER (failing AND before) AS redundant, sum(n) FILTER (alone) AS unique_fails,
         sum(good) FILTER (gone AND NOT before) AS good_lost, sum(toxic) FILTER (gone AND NOT before) AS toxic_lost
  FROM fate GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in 'kept removed redundant unique_fails good_lost toxic_lost'.split())},
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM per_step""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters take from every part, in each of their 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                              table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


# --- 13 --------------------------------------------------------------------------------------

CENTROIDS, ROUNDS = 40, 5


def _centroid_sql() -> str:
    """The rounds written out: c0 holds the first centroids, c1 to cN those after each round."""
    nearest = """a{k} AS (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT row, cluster, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v, c)])::BIGINT AS d
        FROM kept, c{k}) GROUP BY row)"""
    update = """s{k} AS (
  SELECT cluster, j, sum(v[j])::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM a{b} JOIN kept USING (row), (SELECT unnest(range(1, 65)) AS j) GROUP BY ALL),
m{k} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS c FROM s{k} GROUP BY cluster),
c{k} AS MATERIALIZED (SELECT cluster, coalesce(m{k}.c, c{b}.c) AS c FROM c{b} LEFT JOIN m{k} USING (cluster))"""
    rounds = ",\n".join(nearest.format(k=k) + ",\n" + update.format(k=k + 1, b=k) for k in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c
  FROM (SELECT * FROM kept ORDER BY sha256('2:' || vec_id), v LIMIT {CENTROIDS})),
{rounds},
{nearest.format(k=ROUNDS)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (row) JOIN c{ROUNDS} USING (cluster)"""


@query(_centroid_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors around 40 centroids, after five rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), CENTROIDS, ROUNDS, "2")
