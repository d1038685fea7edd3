"""What the queries return, told again in DuckDB SQL, where SQL can tell it."""

from __future__ import annotations

from chorale.llm.mixing import MOST, WEIGHTS
from chorale.llm.sharding import SHARDS
from chorale.llm.substring_dedup import WINDOW
from chorale.llm.url_filter import RULES

_WORD = r"[^\x20\x09-\x0D]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every window of words as text, those that occur again, and the words they cover.
SUBSTRING_DEDUP = f"""WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM docs),
windows AS (SELECT r, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h FROM starts JOIN docs USING (r)),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT r, unnest(range(s, s + {WINDOW})) AS i FROM windows WHERE h IN (SELECT h FROM again)),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
marked AS (SELECT words.*, covered.i IS NOT NULL AS gone FROM words LEFT JOIN covered USING (r, i)),
sums AS (
    SELECT r, count(*) AS n, count(*) FILTER (WHERE gone) AS removed,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM marked GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN sums USING (r)"""

# Sets of shingles, the numbers that two sets share by way of an inverted index, and the smallest id each reaches.
JACCARD_JOIN = f"""WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT r, array_to_string(w[s:s + 4], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT r AS a, r AS b FROM sizes UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a),
lowest AS (SELECT reached.a AS r, min(docs.doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.b GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN lowest USING (r)"""

# Ids are unique here, so they alone give the order.
SHARD_SLOTS = f"""WITH sized AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size FROM documents),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, least({SHARDS - 1}, (2 * before + size) * {SHARDS} // (2 * total)) AS shard FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""

_FITS = " ".join(
    f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{start}') THEN '{domain}{start}'"
    for _, domain, start in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
)
URL_RULES = f"""WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE rule {" ".join(f"WHEN '{domain}{start}' THEN '{kind}'" for kind, domain, start in RULES)} END AS ruled_verdict
FROM ruled"""

_WEIGHT = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {} {} END".format(
    len(WEIGHTS), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS)))
# Sources fill up in the order of size by weight; the first that does not sets the level of the rest.
MIX_TARGETS = f"""WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS DOUBLE) AS s, CAST({_WEIGHT} AS DOUBLE) AS w FROM sized GROUP BY source),
filled AS (
    SELECT *, row_number() OVER (ORDER BY s / w, source) AS k,
           coalesce(sum({MOST} * s) OVER (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
           sum(w) OVER (ORDER BY s / w DESC, source DESC) AS w_left, sum(s) OVER () AS total FROM sources),
levels AS (
    SELECT arg_min((total - full_before) / w_left, k) FILTER (WHERE (total - full_before) / w_left * w <= {MOST} * s) AS level FROM filled)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size,
       round(least({MOST} * s, w * (SELECT level FROM levels)), 6) AS target
FROM sized JOIN filled ON sized.source IS NOT DISTINCT FROM filled.source"""

EDITED_TEXTS = """WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
beside AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS following FROM docs)
SELECT doc_id, length(text) AS n_chars,
       sha256(left(text, length(text) - length(text) // 2) || left(following, length(text) // 2)) AS edited_sha256
FROM beside"""
