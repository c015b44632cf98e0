"""The registered queries of this subpackage, ``opN_<name>``, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import alignment, ann, bpe, fingerprint, line_dedup, minhash, mixing, packing, quality, sharding, url_filter, warc, whitening
from lexspark.operators.relational import spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(spread(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(spread(_table(spark, sf_dir, "documents").select("doc_id", "text")), tokenizer_path())


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), capacity=8192)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.classify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), trusted)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edited(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=40)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).taken()


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16)


# The tables' pages have no other entities than these, and no quotes but double ones around links.
_TEXT = "replace(replace(replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_UUID = "'<urn:uuid:' || {0}[1:8] || '-' || {0}[9:12] || '-8' || {0}[14:16] || '-' || '89ab'[(instr('0123456789abcdef', {0}[17:17]) - 1) % 4 + 1] || {0}[18:20] || '-' || {0}[21:32] || '>'"
_BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
SQL_OP1 = rf"""
WITH source AS (
  SELECT page_id, coalesce(url, '') AS target_uri, '2026-01-01T00:00:00Z' AS warc_date, coalesce(html, '') AS body,
    'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=UTF-8' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) AS source_headers
  FROM pages),
named AS (
  SELECT *, 'sha256:' || sha256(body) AS payload_digest,
    sha256('response' || chr(0) || target_uri || chr(0) || warc_date || chr(0) || source_headers || chr(0) || 'sha256:' || sha256(body)) AS h,
    regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g') AS bare,
    list_transform(regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"', 1), lambda x: {_TEXT.format('x')}) AS links
  FROM source),
marked AS (
  SELECT *, {_UUID.format('h')} AS refers_to,
    {_TEXT.format("regexp_replace(regexp_replace(bare, '(?i)</?(" + _BLOCKS + r")\b[^>]*>', chr(10), 'g'), '<[!?][^>]*>|</?[a-zA-Z][a-zA-Z0-9]*\b[^>]*>', '', 'g')")} AS plain,
    trim(regexp_replace({_TEXT.format(r"regexp_replace(regexp_extract(body, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '<[^>]*>', '', 'g')")}, '\s+', ' ', 'g')) AS title
  FROM named),
records AS (
  SELECT *, 'conversion' AS record_type, 'text/plain; charset=UTF-8' AS content_type,
    array_to_string(list_filter(list_transform(string_split(plain, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\f\x0b]+', ' ', 'g'), ' ')), lambda x: x <> ''), chr(10)) AS block
  FROM marked
  UNION ALL
  SELECT *, 'metadata', 'application/warc-fields',
    (CASE WHEN title <> '' THEN 'title: ' || title || chr(13) || chr(10) ELSE '' END) || 'http-content-type: text/html; charset=UTF-8' || chr(13) || chr(10) || 'http-content-length: ' || octet_length(encode(body)) || chr(13) || chr(10)
      || array_to_string(list_transform(list_filter(links, lambda x, i: x <> '' AND list_position(links, x) = i), lambda x: 'outlink: ' || x || chr(13) || chr(10)), '')
  FROM marked)
SELECT page_id, record_type, {_UUID.format("sha256(record_type || chr(0) || refers_to)")} AS record_id, refers_to, target_uri, warc_date, content_type,
  octet_length(encode(block)) AS content_length, 'sha256:' || sha256(block) AS block_digest, payload_digest, source_headers, block
FROM records
"""

SQL_OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (SELECT doc_id, doc_id AS c FROM sets UNION SELECT links.b, reached.c FROM reached JOIN links ON links.a = reached.doc_id),
least_of AS (SELECT doc_id, min(c) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_of USING (doc_id)
"""

SQL_OP6 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_HOST = "translate(regexp_extract(substr({0}, instr({0}, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Pages come from a relation ``source`` (page_id, url, html). The rounds stop where no score has changed by more than 1e-9.
#: D is the damping.
_SQL_URLS = rf"""
parts AS (
  SELECT page_id, html,
    CASE WHEN contains(url, '://') THEN {_HOST.format('url')} ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM source),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (
  SELECT p.*, r.rule, r.verdict FROM parts p LEFT JOIN LATERAL (
    SELECT rhost || rpath AS rule, verdict FROM rules
    WHERE (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
    ORDER BY length(rhost || rpath) DESC LIMIT 1) r ON true),
links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<a\s[^<>]*?href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"''<>]*)', 1)) AS link FROM parts),
edges AS (SELECT src, dst, count(*) AS n FROM (SELECT src, {_HOST.format('link')} AS dst FROM links) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
flows AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS of_out, n / sum(n) OVER (PARTITION BY dst) AS of_in FROM edges),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad FROM ruled WHERE host <> '' GROUP BY host),
seeds AS (SELECT host, round((1 - D) * CASE WHEN good * 2 > n THEN good / n ELSE 0 END, 12) AS t, round((1 - D) * CASE WHEN bad * 2 > n THEN bad / n ELSE 0 END, 12) AS d FROM hosts WHERE good * 2 > n OR bad * 2 > n),
rounds AS (
  SELECT 0 AS nth, host, t AS trust, d AS distrust, t AS backing, d AS exposure, 1.0::DOUBLE AS change FROM seeds
  UNION ALL
  SELECT nth, host, trust, distrust, backing, exposure, max(moved) OVER () AS change FROM (
    SELECT max(n.nth) AS nth, n.host, round(sum(n.t), 12) AS trust, round(sum(n.d), 12) AS distrust, round(sum(n.b), 12) AS backing, round(sum(n.e), 12) AS exposure,
      greatest(abs(round(sum(n.t), 12) - sum(n.t0)), abs(round(sum(n.d), 12) - sum(n.d0)), abs(round(sum(n.b), 12) - sum(n.b0)), abs(round(sum(n.e), 12) - sum(n.e0))) AS moved
    FROM (
      SELECT r.nth + 1 AS nth, s.host, s.t, s.d, s.t AS b, s.d AS e, 0.0 AS t0, 0.0 AS d0, 0.0 AS b0, 0.0 AS e0 FROM seeds s, (SELECT DISTINCT nth FROM rounds WHERE change > 1e-9) r
      UNION ALL SELECT nth + 1, dst, D * of_out * trust, 0, D * of_in * backing, 0, 0, 0, 0, 0 FROM rounds JOIN flows ON host = src WHERE change > 1e-9
      UNION ALL SELECT nth + 1, src, 0, D * of_in * distrust, 0, D * of_out * exposure, 0, 0, 0, 0 FROM rounds JOIN flows ON host = dst WHERE change > 1e-9
      UNION ALL SELECT nth + 1, host, 0, 0, 0, 0, trust, distrust, backing, exposure FROM rounds WHERE change > 1e-9) n
    GROUP BY n.host)),
scores AS (SELECT host, trust, distrust, backing, exposure FROM rounds WHERE nth = (SELECT max(nth) FROM rounds))
SELECT page_id, r.host, path, rule,
  CASE WHEN rule IS NOT NULL THEN verdict WHEN exposure >= 1e-6 AND exposure > backing THEN 'block' ELSE 'allow' END AS verdict,
  round(coalesce(trust, 0.0), 9) AS trust, round(coalesce(distrust, 0.0), 9) AS distrust, CASE WHEN rule IS NULL THEN 'links' ELSE 'rule' END AS "by"
FROM ruled r LEFT JOIN scores s ON r.host = s.host
"""
SQL_OP7 = f"WITH RECURSIVE source AS (SELECT page_id, url, html FROM pages), {_SQL_URLS.replace('D * of_', '0.85 * of_').replace('(1 - D)', '0.15')}"


def linked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL filter over pages that link to other hosts, which those of the tables do not: a hundred hosts, of which
    the one numbered 0 is in a third of all links."""
    k = F.col("page_id")
    name = lambda n: F.concat(F.lit("h"), n.cast("string"), F.element_at(F.array(*map(F.lit, (".org", ".com", ".net"))), (n % 3 + 1).cast("int")))
    path = F.concat(F.element_at(F.array(*map(F.lit, ("/es/", "/fr/", "/en/", "/es/"))), (F.floor(k / 100) % 4 + 1).cast("int")), k.cast("string"))
    own = k % 100
    link = lambda n: F.concat(F.lit('<a class="x" HREF = "//'), name(n), F.lit("/a?b=1\">x</a>"))
    html = F.concat(F.col("html"), link((own * 7 + F.floor(k / 100)) % 100), F.when(k % 3 == 0, link(F.lit(0))).otherwise(link((own * own + 1) % 100)))
    pages = _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("http://"), name(own), path).alias("url"), html.alias("html"))
    return url_filter.judge_urls(pages, damping=0.5)


_NAME = "('h' || {0} || ['.org', '.com', '.net'][({0}) % 3 + 1])"
_LINK = "'<a class=\"x\" HREF = \"//' || " + _NAME + " || '/a?b=1\">x</a>'"
SQL_LINKED_URLS = f"""WITH RECURSIVE source AS (
  SELECT page_id, 'http://' || {_NAME.format('(page_id % 100)')} || ['/es/', '/fr/', '/en/', '/es/'][(page_id // 100) % 4 + 1] || page_id AS url,
    html || {_LINK.format('((page_id % 100) * 7 + page_id // 100) % 100')} || CASE WHEN page_id % 3 = 0 THEN {_LINK.format('0')} ELSE {_LINK.format('((page_id % 100) * (page_id % 100) + 1) % 100')} END AS html
  FROM pages), {_SQL_URLS.replace('D * of_', '0.5 * of_').replace('(1 - D)', '0.5')}"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_bpe": op2_bpe,
        "op3_ann": op3_ann,
        "op4_packing": op4_packing,
        "op5_minhash": op5_minhash,
        "op6_line_dedup": op6_line_dedup,
        "op7_url_filter": op7_url_filter,
        "op8_quality": op8_quality,
        "op9_fingerprint": op9_fingerprint,
        "op10_sharding": op10_sharding,
        "op11_alignment": op11_alignment,
        "op12_mixing": op12_mixing,
        "op13_whitening": op13_whitening,
        "linked_urls": linked_urls,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": SQL_OP1, "op5_minhash": SQL_OP5, "op6_line_dedup": SQL_OP6, "op7_url_filter": SQL_OP7, "linked_urls": SQL_LINKED_URLS}
