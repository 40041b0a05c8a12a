"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm import bpe, fingerprints, forest, licenses, merkle, mixing, packing, periodic, quality, rabitq, rlz, suffixes, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(_table(spark, sf_dir, "documents"))


def near_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of op1: signature bands joined, Jaccard similarities of 0.8 and more verified."""
    return fingerprints.linked_rows(_table(spark, sf_dir, "documents"))


#: near_links in DuckDB SQL: all pairs of sets that share a shingle.
LINKS_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), g AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END)) AS g FROM w WHERE len(w) > 0
), c AS (
  SELECT min(doc_id) AS id, g FROM g GROUP BY g
), s AS (
  SELECT id, len(g) AS n, unnest(g) AS x FROM c
), p AS (
  SELECT a.id AS a, b.id AS b, a.n + b.n AS t, count(*) AS m FROM s a JOIN s b ON a.x = b.x AND a.id <> b.id GROUP BY 1, 2, 3
), l AS (
  SELECT a AS id, count(*) AS n_links FROM p WHERE 10 * m >= 8 * (t - m) GROUP BY 1
)
SELECT d.doc_id, coalesce(c.id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN c ON g.g = c.g LEFT JOIN l ON c.id = l.id
"""


def op2_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.search(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op3_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.remove_repeats(_table(spark, sf_dir, "documents"), digest=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(_table(spark, sf_dir, "documents"))


def _dated_list(pages: DataFrame) -> DataFrame:
    """A dated list for the hosts of the pages, from their digests: each host and each parent may be listed and taken off again."""
    hosts = pages.select(F.explode(urlfilter.domains(urlfilter.host(F.col("url")))).alias("domain")).distinct()
    digit = [F.conv(F.substring(F.md5("domain"), 1 + 2 * k, 2), 16, 10).cast("int") for k in range(4)]
    first = F.date_add(F.lit("2024-01-01").cast("date"), digit[1]).cast("timestamp")
    second = F.date_add(F.lit("2024-01-01").cast("date"), digit[1] + digit[2] % 60).cast("timestamp")
    listed = hosts.where(digit[0] % 3 == 0)
    return listed.select("domain", first.alias("listed_at"), F.lit("block").alias("action")).union(listed.where(digit[3] % 2 == 0).select("domain", second.alias("listed_at"), F.lit("allow").alias("action")))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day that follows from page_id."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")).cast("timestamp")
    return urlfilter.judge(pages.withColumn("fetched_at", fetched), _dated_list(pages))


#: op7 in DuckDB SQL.
URLFILTER_SQL = r"""
WITH captures AS (
  SELECT page_id, TIMESTAMP '2024-01-01' + to_days(CAST((page_id * 37) % 366 AS INTEGER)) AS fetched_at,
         regexp_replace(lower(regexp_extract(coalesce(url, ''), '(?i)^[a-z][a-z0-9+.-]*://([^/?#@]*@)?([^/?#:]+)', 2)), '\.+$', '') AS host FROM pages
), parts AS (
  SELECT DISTINCT host, string_split(host, '.') AS p FROM captures WHERE host <> ''
), looked AS (
  SELECT host, array_to_string(p[k:], '.') AS domain FROM (SELECT host, p, unnest(range(1, len(p) + 1)) AS k FROM parts)
), hosts AS (
  SELECT domain, ('0x' || substr(md5(domain), 1, 2))::INT AS a, ('0x' || substr(md5(domain), 3, 2))::INT AS b, ('0x' || substr(md5(domain), 5, 2))::INT AS c, ('0x' || substr(md5(domain), 7, 2))::INT AS d FROM (SELECT DISTINCT domain FROM looked)
), entries AS (
  SELECT domain, TIMESTAMP '2024-01-01' + to_days(b) AS valid_from, true AS blocked FROM hosts WHERE a % 3 = 0
  UNION ALL SELECT domain, TIMESTAMP '2024-01-01' + to_days(b + c % 60), false FROM hosts WHERE a % 3 = 0 AND d % 2 = 0
), held AS (
  SELECT domain, valid_from, bool_or(blocked) AS blocked, lead(valid_from) OVER (PARTITION BY domain ORDER BY valid_from) AS valid_to FROM entries GROUP BY domain, valid_from
), met AS (
  SELECT c.page_id, h.domain, h.blocked, h.valid_from, row_number() OVER (PARTITION BY c.page_id ORDER BY length(h.domain) DESC) AS r
  FROM captures c JOIN looked l ON c.host = l.host JOIN held h ON l.domain = h.domain AND c.fetched_at >= h.valid_from AND (h.valid_to IS NULL OR c.fetched_at < h.valid_to)
)
SELECT c.page_id, c.host, c.fetched_at, coalesce(NOT m.blocked, true) AS allowed, m.domain AS matched_domain, m.valid_from AS since
FROM captures c LEFT JOIN met m ON c.page_id = m.page_id AND m.r = 1
"""

#: op9 in DuckDB SQL.
FOREST_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)
), both_ways AS (
  SELECT a, b FROM e UNION SELECT b, a FROM e
), r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, b FROM r JOIN both_ways ON a = root
), c AS (
  SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1
)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept FROM c LEFT JOIN n ON c.doc_id = n.doc_id
"""

#: op3 in DuckDB SQL: windows by start, with the smallest document of each.
RLZ_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)
), m AS (
  SELECT h, min(doc_id) AS first FROM g GROUP BY 1
), x AS (
  SELECT DISTINCT g.doc_id, i + unnest(range(0, 50)) AS i FROM g JOIN m ON g.h = m.h WHERE first < g.doc_id
), l AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), k AS (
  SELECT l.doc_id, count(x.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY l.i) FILTER (WHERE x.i IS NULL), '') AS kept FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i GROUP BY 1
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

#: op6 in DuckDB SQL: bytes as hex digits, cut in overlapping pieces so that substrings stay short.
SUFFIX_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), c AS (
  SELECT doc_id, length(x) // 2 AS n, unnest(range(0, greatest(length(x) // 2, 1), 500)) AS o, x FROM d
), p AS (
  SELECT doc_id, n, o, substr(x, 2 * o + 1, 1098) AS s FROM c
), g AS (
  SELECT doc_id, i + o AS i, substr(s, 2 * i + 1, 100) AS w FROM (SELECT doc_id, n, o, s, unnest(range(0, least(500, n - o - 49))) AS i FROM p WHERE n - o >= 50)
), m AS (
  SELECT w, min(doc_id) AS first FROM g GROUP BY 1
), x AS (
  SELECT DISTINCT g.doc_id, i + unnest(range(0, 50)) AS i FROM g JOIN m ON g.w = m.w WHERE first < g.doc_id
), l AS (
  SELECT doc_id, i + o AS i, substr(s, 2 * i + 1, 2) AS b FROM (SELECT doc_id, o, s, unnest(range(0, least(500, n - o))) AS i FROM p)
), k AS (
  SELECT l.doc_id, count(x.i) AS n_removed, count(*) FILTER (WHERE x.i IS NOT NULL AND y.i IS NULL) AS n_spans, coalesce(string_agg(b, '' ORDER BY l.i) FILTER (WHERE x.i IS NULL), '') AS kept
  FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i LEFT JOIN x y ON l.doc_id = y.doc_id AND l.i = y.i + 1 GROUP BY 1
)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op9_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_components(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), vocabulary())


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


#: op11 in DuckDB SQL: equal grams a period apart, in islands.
PERIODIC_SQL = r"""
WITH RECURSIVE checksums AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM (SELECT DISTINCT doc_id FROM documents)
), read AS (
  SELECT d.doc_id, h, h // 10 AS g, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents d LEFT JOIN checksums c ON d.doc_id = c.doc_id
), loops AS (
  SELECT doc_id, w, g % len(w) AS a, 1 + (len(w) - g % len(w)) // (3 + g % 8) AS p FROM read WHERE h % 10 = 0 AND len(w) > 0
), texts AS (
  SELECT doc_id, w FROM read WHERE NOT (coalesce(h % 10 = 0, false) AND len(w) > 0)
  UNION ALL SELECT doc_id, list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) FROM loops
), grams AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 5], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM texts)
), again AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS island FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.h = b.h AND a.i < b.i
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM again GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), found AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         arg_min({'start': start, 'length': length, 'period': period}, (-length, start, period)) AS best FROM found GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found
), words AS (
  SELECT doc_id, i, w[i + 1] AS word FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM texts)
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS kept FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i WHERE gone.i IS NULL GROUP BY 1
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts t LEFT JOIN told ON t.doc_id = told.doc_id LEFT JOIN kept ON t.doc_id = kept.doc_id
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_fingerprints": op1_fingerprints, "op2_rabitq": op2_rabitq, "op3_rlz": op3_rlz, "op4_mixing": op4_mixing, "op5_licenses": op5_licenses, "op6_suffixes": op6_suffixes, "op7_urlfilter": op7_urlfilter, "op8_quality": op8_quality, "op9_forest": op9_forest, "op10_bpe": op10_bpe, "op11_periodic": op11_periodic, "op12_merkle": op12_merkle, "op13_packing": op13_packing, "pipeline": pipeline, "near_links": near_links}


def oracle_sql() -> dict[str, str]:
    return {"op3_rlz": RLZ_SQL, "op4_mixing": mixing.ORACLE_SQL, "op5_licenses": licenses.oracle_sql(), "op6_suffixes": SUFFIX_SQL, "op7_urlfilter": URLFILTER_SQL, "op9_forest": FOREST_SQL, "op11_periodic": PERIODIC_SQL, "op12_merkle": merkle.ORACLE_SQL, "near_links": LINKS_SQL}
