"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.llm.staging import table
from stockroute.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


# ------------------------------------------------------------ 1: top-k search
TOPK_SQL = r"""
WITH fit AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM fit q JOIN fit c ON q.id % 50 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


@register("op1_topk_search", TOPK_SQL)
def op1(spark, sf_dir):
    from stockroute.llm.staging import stage
    from stockroute.llm.topk import integer_vectors, top_k
    vectors = stage(integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


# ------------------------------------------------------------ 2: license scans
LICENSE_SQL = r"""
WITH t AS (
  SELECT license, regexp_extract_all({lower}, '{word}') AS w FROM (VALUES {rows}) v(license, text)),
shaped AS (      -- a template of under five words is one shingle
  SELECT license, w, len(w) AS n, greatest(1, len(w) // 4) AS s, least(5, len(w)) AS k FROM t WHERE len(w) > 0),
ts AS (
  SELECT DISTINCT license, n, s, k, array_to_string(w[i:i + k - 1], ' ') AS sh
  FROM shaped, unnest(range(1, n - k + 2)) u(i)),
tm AS (SELECT license, n, s, k, count(*) AS m FROM ts GROUP BY ALL),
d AS (SELECT doc_id, regexp_extract_all({lower}, '{word}') AS w FROM documents),
ds AS (
  SELECT doc_id, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS sh
  FROM d, (SELECT DISTINCT k FROM shaped) x, unnest(range(1, len(w) - k + 2)) u(i)),
hit AS (SELECT doc_id, license, n, s, k, ts.sh, pos FROM ds JOIN ts USING (k, sh)),
win AS (
  SELECT doc_id, license, j * s AS start, count(DISTINCT sh) AS c
  FROM (SELECT *, unnest(range(greatest(0, CAST(ceil((pos + k - n - s) / s) AS BIGINT)), pos // s + 1)) AS j FROM hit)
  GROUP BY ALL)
SELECT doc_id, license, max(c / m) AS containment, CAST(min(start) AS INTEGER) AS first_word
FROM win JOIN tm USING (license) WHERE c / m >= 0.8 GROUP BY doc_id, license
"""


def _license_sql() -> str:
    from stockroute.llm import licenses as lc
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in lc.ALL_TEMPLATES)
    lower = f"translate(text, '{lc.UPPER}', '{lc.LOWER}')"
    return (LICENSE_SQL.replace("{rows}", rows).replace("{lower}", lower)
            .replace("{word}", lc.WORD.replace("'", "''")))


@register("op2_license_scan", _license_sql())
def op2(spark, sf_dir):
    from stockroute.llm.licenses import scan
    return scan(table(spark, sf_dir, "documents"))


# ------------------------------------------------------- 3: mixing of sources
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS u,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
levels AS (      -- sources by the level at which they reach their cap
  SELECT *, sum(source_size) OVER () * 150 / 100.0
            - 2 * coalesce(sum(source_size) OVER (ORDER BY 2.0 * source_size / w, source
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY 2.0 * source_size / w, source
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest
  FROM src),
water AS (
  SELECT CAST(arg_min(rest, 2.0 * source_size / w) AS DOUBLE) AS rest,
         CAST(arg_min(wrest, 2.0 * source_size / w) AS DOUBLE) AS wrest
  FROM levels WHERE w * rest / wrest < 2 * source_size),
goal AS (
  SELECT source, source_size,
         coalesce(least(w * water.rest / water.wrest, 2.0 * source_size), 2.0 * source_size) AS target
  FROM src LEFT JOIN water ON true),
need AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
placed AS (
  SELECT s.doc_id, s.size, n.source_size, n.target, n.whole,
         CAST(floor(n.target) AS BIGINT) - n.whole * n.source_size AS extra,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN need n ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       whole * size + least(greatest(extra - before, 0), size) AS taken, whole,
       least(greatest(extra - before, 0), size) AS part
FROM placed
"""


@register("op3_source_mix", MIX_SQL)
def op3(spark, sf_dir):
    from stockroute.llm.mixture import mix_plan
    return mix_plan(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- 4: url filters
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]

URL_SQL = r"""
WITH RECURSIVE rules AS (
  SELECT split_part(rule, '/', 1) AS rhost, '/' || substr(rule, strpos(rule, '/') + 1) AS rpath, rule, action
  FROM (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
               ('net/es/', 'block'), ('net/fr/', 'block')) t(rule, action)),
p AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (
  SELECT host, path, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0),
                   '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0),
                   '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)]) AS t
  FROM p WHERE host <> '' AND regexp_matches(html, '(?i)canonical|refresh')),
links AS (
  SELECT host || chr(10) || path AS u,
    CASE WHEN contains(t, '://') OR starts_with(t, '//') THEN
           translate(regexp_extract(f, '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           || chr(10) || regexp_extract(f, '(?s)^.*?://[^/?#]*([^?#]*)', 1)
         WHEN starts_with(t, '/') THEN host || chr(10) || bare
         WHEN bare = '' THEN host || chr(10) || path
         ELSE host || chr(10) || regexp_extract(path, '(?s)^(.*/)', 1) || bare END AS v
  FROM (SELECT *, CASE WHEN contains(t, '://') THEN t ELSE 'x:' || t END AS f,
               regexp_extract(t, '(?s)^([^?#]*)', 1) AS bare FROM named WHERE t <> '')),
edge AS (
  SELECT u, v FROM links WHERE u <> v AND NOT starts_with(v, chr(10))
  UNION SELECT v, u FROM links WHERE u <> v AND NOT starts_with(v, chr(10))),
bad AS (
  SELECT DISTINCT u FROM edge WHERE (
    SELECT arg_max(action, length(rhost) * 100000 + length(rule)) FROM rules
    WHERE (split_part(u, chr(10), 1) = rhost OR ends_with(split_part(u, chr(10), 1), '.' || rhost))
      AND starts_with(split_part(u, chr(10), 2), rpath)) = 'block'),
reach(u) AS (
  SELECT u FROM bad UNION SELECT e.v FROM reach r JOIN edge e ON e.u = r.u),
fit AS (
  SELECT page_id, host, path, arg_max(rule, length(rhost) * 100000 + length(rule)) AS rule,
         arg_max(action, length(rhost) * 100000 + length(rule)) AS action
  FROM (SELECT row_number() OVER () AS i, page_id, host, path FROM p) p LEFT JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY i, page_id, host, path)
SELECT page_id, host, path, rule,
       CASE WHEN action IS NOT NULL THEN action WHEN r.u IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN action IS NOT NULL THEN 'rule' WHEN r.u IS NOT NULL THEN 'alias' ELSE 'none' END AS via
FROM fit LEFT JOIN reach r ON r.u = host || chr(10) || path
"""


@register("op4_url_filter", URL_SQL)
def op4(spark, sf_dir):
    from stockroute.llm.redirects import judge
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


# ------------------------------------------------------------- 5: toxicity
@register("op5_toxicity_nnpu")
def op5(spark, sf_dir):
    from stockroute.llm import toxicity as tx
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tx.fit(docs, table(spark, sf_dir, "labels"))
    return tx.score(docs, model, ["doc_id"]).select(
        "doc_id", tx.held_out(F.col("doc_id")).alias("held_out"), F.col("pu_score").alias("score"),
        (F.col("pu_score") >= tx.THRESHOLD).cast("int").alias("predicted"))


# ------------------------------------------------------------- 6: packing
@register("op6_bestfit_packing")
def op6(spark, sf_dir):
    from stockroute.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- 8: fingerprints
MERKLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id NULLS FIRST),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id NULLS FIRST)) AS next_text
  FROM documents),
texts AS (
  SELECT doc_id, n, 0 AS which, text AS t FROM docs
  UNION ALL SELECT doc_id, n, 1, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) FROM docs
  UNION ALL SELECT doc_id, n, 2, next_text FROM docs),
levels AS (
  SELECT doc_id, n, which, t,
    list_transform(regexp_extract_all(t, '(?s).*?\n\n|(?s).+'), lambda s:
      list_transform(regexp_extract_all(s, '[^\n]*\n|[^\n]+'), lambda p:
        list_transform(regexp_extract_all(p, '{clause}'), lambda c: md5(c)))) AS lv
  FROM texts),
prints AS (
  SELECT doc_id, n, which, t,
    sha256(array_to_string(list_transform(lv, lambda s: md5(array_to_string(
      list_transform(s, lambda p: md5(array_to_string(p, ''))), ''))), '')) AS root,
    list_transform(flatten(flatten(lv)), lambda d: substr(d, 1, 8)) AS leaves
  FROM levels)
SELECT a.doc_id, a.n AS n_chars, sha256(e.t) AS edited_sha256,
  a.root || ':' || array_to_string(a.leaves, '') AS fingerprint,
  e.root || ':' || array_to_string(e.leaves, '') AS edited_fingerprint,
  {near_e} AS near_edited, {near_x} AS near_next
FROM prints a JOIN prints e ON a.doc_id = e.doc_id AND a.which = 0 AND e.which = 1
JOIN prints x ON a.doc_id = x.doc_id AND x.which = 2
"""


def _near(b: str) -> str:
    n = f"(len(list_distinct(a.leaves)) + len(list_distinct({b}.leaves)))"
    return (f"CASE WHEN a.root = {b}.root THEN 1.0::DOUBLE WHEN {n} = 0 THEN 0.0::DOUBLE"
            f" ELSE greatest(2.0::DOUBLE * len(list_intersect(a.leaves, {b}.leaves)) / {n},"
            f" 1.0::DOUBLE * len(list_filter(list_zip(a.leaves, {b}.leaves), lambda p: coalesce(p[1] = p[2], false)))"
            f" / greatest(len(a.leaves), len({b}.leaves))) END")


def _merkle_sql() -> str:
    from stockroute.llm import merkle as mk
    return (MERKLE_SQL.replace("{clause}", mk.CLAUSE)
            .replace("{near_e}", _near("e")).replace("{near_x}", _near("x")))


@register("op8_merkle_fingerprints", _merkle_sql())
def op8(spark, sf_dir):
    from stockroute.llm.merkle import compare
    return compare(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- 7: substring dedup
@register("op7_suffix_dedup")
def op7(spark, sf_dir):
    from stockroute.llm.suffixtrees import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("sf_n_words").alias("n_words"), F.col("sf_n_removed").alias("n_removed"),
                      F.sha2("sf_kept", 256).alias("kept_sha256"))


# ------------------------------------------------------------- 10: n-gram Jaccard join
@register("op10_ngram_jaccard_join")
def op10(spark, sf_dir):
    from stockroute.llm.prefixjoin import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


# ------------------------------------------------------------- 9: language-model scores
@register("op9_katz_scores")
def op9(spark, sf_dir):
    from stockroute.llm.katz import score
    return score(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- 11: conversation structure repair
@register("op11_conversation_repair")
def op11(spark, sf_dir):
    from stockroute.llm.conversations import damaged, repair_report
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


# ------------------------------------------------------------- 12: WARC
WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, h, min(page_id) OVER (PARTITION BY h) AS first_id, sha1(h) AS x FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(x, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
                AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d
"""


@register("op12_warc_archive", WARC_SQL)
def op12(spark, sf_dir):
    from stockroute.llm.warc import read_records, write_archive
    archive = write_archive(table(spark, sf_dir, "pages"), least_bytes=0)
    return read_records(spark, archive).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to")


# ------------------------------------------------------------- 13: spelling variants
@register("op13_spelling_variants")
def op13(spark, sf_dir):
    from stockroute.llm.spelling import variants
    return variants(table(spark, sf_dir, "documents"))
