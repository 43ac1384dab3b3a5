"""The registered queries of this subpackage and the SQL that DuckDB can check them with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, divergence, html, linededup, packing, pii, prefixtrie, quality, sharding, simhash, substring, urlfilter
from .shared import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SHARDS = 40


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"))


def bpe_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of bpe.encode_decode's ids and texts."""
    return bpe.encode_decode(docs, VOCABULARY).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("q_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"),
        F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"),
        F.col("q_lost").alias("n_lost"),
    )


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("l_lines").alias("n_lines"), F.col("l_removed").alias("n_removed"), F.sha2("text", 256).alias("text_sha256")
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest stands in for the ids before packing, so that the exchange carries no ids."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_sharding": op3_sharding,
    "op4_simhash": op4_simhash,
    "op5_substring": op5_substring,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_lines": op8_lines,
    "op9_html": op9_html,
    "op10_urls": op10_urls,
    "op11_divergence": op11_divergence,
    "op12_packing": op12_packing,
    "op13_trie": op13_trie,
}

_WORD, _SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
_SYMBOLS = quality.SYMBOLS


def _failing_line(x: str) -> str:
    """quality.line_fails as SQL over a line x."""

    def count(pattern: str) -> str:
        return f"len(regexp_extract_all({x}, '{pattern}'))"

    n = f"greatest({count(_WORD)}, 1)"
    capitals, small, separators, symbols = count(r"\p{Lu}"), count(r"\p{Ll}"), count("[|»›·]"), count(_SYMBOLS)
    return (
        f"(({n} >= 8 AND NOT regexp_matches({x}, '{quality.PUNCTUATION}'))"
        f" OR ({n} >= 3 AND {capitals} > 2 * {small} AND {capitals} >= 10) OR ({count('!!')} * 3 >= {n} AND {n} >= 3)"
        f" OR ({separators} >= 3 AND {separators} * 4 >= {n}) OR ({n} <= 30 AND regexp_matches({x}, '{quality.BOILERPLATE}'))"
        f" OR ({symbols} * 5 > {n} AND {symbols} >= 3))"
    )


OP7_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w, string_split(text, chr(10)) AS lines FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM s)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(text) - len(regexp_extract_all(text, '{_SPACE}')) AS word_chars,
  len(regexp_extract_all(text, '{_SYMBOLS}')) AS n_symbols,
  list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS spoken,
  len(w) - len(regexp_extract_all(array_to_string(list_filter(lines, lambda x: NOT {_failing_line("x")}), chr(10)), '{_WORD}')) AS n_lost
  FROM s),
n AS (SELECT m.doc_id, n_words, word_chars, n_symbols, len(spoken) - len(list_distinct(spoken)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, n_lost,
  n_words < {quality.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM m LEFT JOIN c ON m.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_lost <= {quality.MAX_LOST} * n_words AS kept, n_lost FROM n
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urlfilter.RULES)
    hosts = ", ".join(f"('{h}')" for h in urlfilter.BLOCKED_HOSTS)
    return f"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urlfilter._UPPER}', '{urlfilter._LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(v, rh, rp) AS (VALUES {rules}), hosts(b) AS (VALUES {hosts}),
f AS (SELECT page_id, v, rh || rp AS rule FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) = 1)
SELECT h.page_id, host, path, rule, coalesce(v, CASE WHEN EXISTS (SELECT 1 FROM hosts WHERE host = b OR ends_with(host, '.' || b))
  THEN 'block' ELSE 'allow' END) AS verdict FROM h LEFT JOIN f ON h.page_id = f.page_id
"""


OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '{_WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
k AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
dg AS (SELECT doc_id, k, len(w) - k + 1 AS size, p, array_to_string(w[p + 1 : p + k], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, k)),
bg AS (SELECT item_id, k, m, g, count(*) AS c FROM (SELECT item_id, k, len(w) - k + 1 AS m, array_to_string(w[p + 1 : p + k], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM b JOIN k ON k = least(len(w), 5))) GROUP BY ALL),
h AS (SELECT doc_id, item_id, size, m, p, bg.g, c FROM dg JOIN bg ON dg.g = bg.g AND dg.k = bg.k),
s AS (SELECT doc_id, item_id, size, m, unnest(range(0, greatest(size - m, 0) + 1)) AS s
  FROM (SELECT doc_id, item_id, size, m FROM h GROUP BY ALL HAVING count(*) >= m * 0.8 - 1e-9)),
o AS (SELECT doc_id, item_id, size, m, s, sum(least(n, c)) AS o FROM (SELECT h.doc_id, h.item_id, h.size, h.m, s, g, c, count(*) AS n
  FROM s JOIN h ON s.doc_id = h.doc_id AND s.item_id = h.item_id AND p >= s AND p < s + h.m GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id, round(max(o / (m + least(m, size) - o)), 6) AS similarity FROM o
WHERE o / (m + least(m, size) - o) >= 0.8 - 1e-9 GROUP BY doc_id, item_id
"""

OP5_SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t)),
f AS (SELECT h, min(doc_id) AS d FROM g GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f ON g.h = f.h WHERE d < doc_id),
k AS (SELECT x.doc_id, string_agg(v, ' ' ORDER BY x.p) AS kept, count(*) AS n FROM (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM t) x
  ANTI JOIN r ON r.doc_id = x.doc_id AND r.p = x.p GROUP BY x.doc_id)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN k ON k.doc_id = t.doc_id
"""

OP8_SQL = f"""
WITH l AS (SELECT doc_id, no, lines[no] AS line, list_sort(list_distinct(regexp_extract_all(lines[no], '{_WORD}'))) AS s
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS no FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
f AS (SELECT *, row_number() OVER (ORDER BY doc_id, no) AS sid FROM (SELECT doc_id, no, s FROM l WHERE len(s) > 0 QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, no) = 1)),
t AS (SELECT sid, len(s) AS n, unnest(s) AS token FROM f),
p AS (SELECT sid, n, token FROM (SELECT *, count(*) OVER (PARTITION BY token) AS c FROM t) QUALIFY row_number() OVER (PARTITION BY sid ORDER BY c, token) <= n - ceil(n * 0.8 - 1e-9) + 1),
c AS (SELECT DISTINCT a.sid AS early, b.sid AS late FROM p a JOIN p b ON a.token = b.token AND a.sid < b.sid AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
m AS (SELECT DISTINCT late FROM (SELECT late, a.s AS x, b.s AS y, len(list_intersect(a.s, b.s)) AS o FROM c JOIN f a ON a.sid = early JOIN f b ON b.sid = late) WHERE o >= 0.8 * (len(x) + len(y) - o) - 1e-9),
k AS (SELECT l.doc_id, l.no, l.line FROM l LEFT JOIN (SELECT * FROM f ANTI JOIN m ON late = sid) g ON g.doc_id = l.doc_id AND g.no = l.no WHERE len(l.s) = 0 OR g.sid IS NOT NULL),
o AS (SELECT doc_id, count(*) AS kept, string_agg(line, chr(10) ORDER BY no) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(len(string_split(d.text, chr(10))) - coalesce(kept, 0), 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(o.text, '')) END AS text_sha256 FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id
"""

OP11_SQL = f"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
t AS (SELECT lang, source, r, unnest(regexp_extract_all(translate(text, '{urlfilter._UPPER}', '{urlfilter._LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0) AS n FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (SELECT *, 1 + ({divergence.SCALE} * (n + 1)::HUGEINT) // (sum(n) OVER w + count(*) OVER w)::HUGEINT AS p,
  1 + ({divergence.SCALE} * (lang_n + 1)::HUGEINT) // (sum(lang_n) OVER w + count(*) OVER w)::HUGEINT AS q FROM c WINDOW w AS (PARTITION BY lang, source)),
v AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o) WHERE part = 'pair' OR rank <= {divergence.TERM_RANKS}
"""

OP13_SQL = """
WITH RECURSIVE z(i, k, v) AS (SELECT i, 0, i FROM (SELECT unnest(range(0, 256))::BIGINT AS i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM z WHERE k < 8),
y AS MATERIALIZED (SELECT list(v ORDER BY i) AS crc FROM z WHERE k = 8),
t AS (SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, md5(length(x.role)::VARCHAR || ':' || x.role || x.text)) AS own FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda a: ascii(a)::BIGINT)),
  lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295::BIGINT) % 6 AS h FROM o, y),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1 : h.h], h.own[h.h + 1 :]) AS path FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, len(path) AS l, d AS depth, path[1 : d] AS path FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM r)),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = depth), '')) AS ends,
  CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(path[depth].text) END AS text FROM p GROUP BY path, depth),
c AS (SELECT path[1 : depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
s AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.path = n.path),
u AS (SELECT path[1 : d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(text) AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM s) GROUP BY ALL)
SELECT s.conv_id, s.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved::BIGINT AS saved_tokens, s.ends AS ends_sha256
FROM s JOIN u ON u.path = s.path LEFT JOIN s m ON s.depth > 0 AND m.path = s.path[1 : s.depth - 1]
"""

ORACLES: dict[str, str] = {"op2_decontaminate": OP2_SQL, "op5_substring": OP5_SQL, "op8_lines": OP8_SQL, "op7_quality": OP7_SQL, "op10_urls": _url_sql(), "op11_divergence": OP11_SQL, "op13_trie": OP13_SQL}
