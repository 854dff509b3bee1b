"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscope.llm.common import id_remainder
from sparkscope.llm.conversations import repair_conversations
from sparkscope.llm.decontaminate import contamination
from sparkscope.llm.exact_dedup import exact_duplicates
from sparkscope.llm.importance import importance_sample
from sparkscope.llm.jaccard_join import jaccard_components
from sparkscope.llm.license_scan import LICENSES, NOTICES, license_matches
from sparkscope.llm.lm_score import lm_scores
from sparkscope.llm.mixing import mix_sources
from sparkscope.llm.pii import personal_data, span_digest
from sparkscope.llm.source_audit import source_divergence
from sparkscope.llm.token_scan import document_tokens, write_token_files
from sparkscope.llm.toxicity import toxicity_scores
from sparkscope.llm.url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A-Z to lower case, nothing else.
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op4_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, sha256({ASCII_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)"""


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


WORD_SETS = r"""
w AS (SELECT doc_id, list_filter(string_split_regex({lower}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - {n} + 1),
                                          lambda i: array_to_string(w[i:i + {n} - 1], ' '))) END AS s FROM w)"""

SQL["op9_jaccard_join"] = f"""
WITH RECURSIVE {WORD_SETS.format(lower=ASCII_LOWER.format("coalesce(text, '')"), n=3)},
p AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b)
SELECT s.doc_id, len(s.s) AS n_shingles, m.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = s.doc_id"""


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def _number(text: str, start: int) -> str:
    return f"('0x' || substr(md5({text}), {start}, 8))::BIGINT"


SQL["op10_mix_sources"] = rf"""
WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
             len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
             {_number("coalesce(doc_id::VARCHAR, '')", 1)} AS pick, {_number("coalesce(doc_id::VARCHAR, '')", 9)} AS place
           FROM documents),
s AS (SELECT source, k, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM d GROUP BY source, k),
v AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - (2 * (sum(source_size) OVER r - source_size))::DOUBLE)
        / (sum(w) OVER () - sum(w) OVER r + w)::DOUBLE AS level
      FROM s WINDOW r AS (ORDER BY source_size * (10 // w), k ROWS UNBOUNDED PRECEDING)),
t AS (SELECT *, least(w * max(level) OVER (), (2 * source_size)::DOUBLE) AS target FROM v),
q AS (SELECT k, count(*) FILTER (WHERE won) AS quota FROM (
        SELECT t.k, row_number() OVER (ORDER BY t.target / (2 * seat - 1) DESC, t.k)
                 <= (SELECT round(sum(target) / 32) FROM t) AND t.target > 0 AS won
        FROM t, LATERAL (SELECT unnest(generate_series(1, (t.target / 32)::BIGINT + 25)) AS seat)) GROUP BY k),
g AS (SELECT d.*, t.source_size, t.target, q.quota,
        d.pick % greatest(1, ceil(t.source_size / 2097152))::BIGINT AS shard FROM d JOIN t USING (k) JOIN q USING (k)),
h AS (SELECT k, shard, any_value(quota) AS quota, sum(size)::BIGINT AS shard_size FROM g GROUP BY k, shard),
o AS (SELECT k, shard, count(*) FILTER (WHERE won) AS quota, any_value(shard_size) AS shard_size FROM (
        SELECT h.*, row_number() OVER (PARTITION BY k ORDER BY shard_size / (2 * seat - 1) DESC, shard) <= quota
                 AND shard_size > 0 AS won
        FROM h, LATERAL (SELECT unnest(generate_series(1, (shard_size / 16)::BIGINT + 25)) AS seat)) GROUP BY k, shard),
b AS (SELECT k, shard, greatest(1, ceil(shard_size / 32))::BIGINT AS n, quota,
        {_number("'mix/' || k || '/' || shard", 1)} AS seed FROM o),
p AS (SELECT g.*, b.n, least(b.quota, 2 * b.n) AS r, b.seed % b.n AS u,
        sum(size) OVER (PARTITION BY k, shard ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
      FROM g JOIN b USING (k, shard)),
x AS (SELECT *, stop - size AS start FROM p)
SELECT doc_id, size, source_size, target, source, shard,
  ((r // n) * size
   + 32 * (((stop // 32) * (r % n) + u) // n) + (stop % 32) * (((stop // 32 + 1) * (r % n) + u) // n - ((stop // 32) * (r % n) + u) // n)
   - 32 * (((start // 32) * (r % n) + u) // n) - (start % 32) * (((start // 32 + 1) * (r % n) + u) // n - ((start // 32) * (r % n) + u) // n)
  )::BIGINT AS taken
FROM x"""


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


WINDOW_SQL = ("CASE WHEN len(w) >= 10 THEN list_transform(generate_series(1, len(w) - 9), "
              "lambda i: array_to_string(w[i:i + 9], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END")

SQL["op6_decontaminate"] = rf"""
WITH {{words}},
i AS (SELECT item_id, unnest({WINDOW_SQL}) AS g FROM iw),
lengths AS (SELECT DISTINCT g, len(string_split(g, ' ')) AS n FROM i),
spots AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM dw),
hits AS (SELECT doc_id, p, n, g FROM (SELECT spots.*, l.n FROM spots, (SELECT DISTINCT n FROM lengths) l WHERE p + l.n - 1 <= len(w)) c
         JOIN lengths USING (n) WHERE g = array_to_string(w[p:p + n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
            SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
          SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS item FROM hits JOIN i USING (g)) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)""".replace("{words}", ", ".join(
    rf"{name} AS (SELECT {key}, list_filter(string_split_regex({ASCII_LOWER.format("coalesce(text, '')")}, "
    rf"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM {source})"
    for name, key, source in (("dw", "doc_id", "documents"), ("iw", "item_id", "benchmark"))))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(personal_data(table(spark, sf_dir, "documents")))


@query
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & (id_remainder("doc_id", 3) != 1))
    return importance_sample(table(spark, sf_dir, "documents"), good)


@query
def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(write_token_files(table(spark, sf_dir, "documents")))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"), NOTICES + LICENSES)


@query
def op1_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _smoothed(k: int) -> str:
    """Probability of order ``k`` from that of the order below."""
    return rf"""
p{k} AS (SELECT e.page_id, e.row, e.i, e.h, e.accepted, CASE WHEN t.kinds IS NULL OR t.kinds = 0 THEN e.p
           ELSE (coalesce(g.n, 0) + (t.all_n - t.kept_n + t.kinds) * e.p) / (t.all_n + t.kinds) END AS p
         FROM p{k - 1 if k else '_uniform'} e
         LEFT JOIN totals t ON t.k = {k} AND t.accepted = e.accepted AND t.c = substr(e.h, 2 * (e.i + 5 - {k}) - 1, {2 * k})
         LEFT JOIN (SELECT * FROM marked WHERE kept) g
           ON g.k = {k} AND g.accepted = e.accepted AND g.g = substr(e.h, 2 * (e.i + 5 - {k}) - 1, {2 * k + 2}))"""


# A URL is written in hexadecimal, two letters a byte, with 5 fillings '^^' before it and an end '$$' behind it.
SQL["op11_url_filter"] = rf"""
WITH v AS (SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
w AS (SELECT row, page_id, url, {ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM v),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT row, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) = 'allow' AS accepted
         FROM w JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row),
u AS (SELECT w.*, rule, accepted, ('0x' || substr(md5(url), 1, 8))::BIGINT % 4 = 0 AS held_out,
        repeat('^^', 5) || hex(encode(url)) || '$$' AS h, octet_length(encode(url)) + 1 AS m FROM w LEFT JOIN fits USING (row)),
counts AS (SELECT accepted, k, substr(h, 2 * (i + 5 - k) - 1, 2 * k + 2) AS g, count(*) AS n
           FROM (SELECT accepted, h, unnest(range(1, m + 1)) AS i FROM u WHERE accepted IS NOT NULL AND NOT held_out),
                (SELECT unnest(range(6)) AS k) GROUP BY ALL),
size AS (SELECT sum(n) AS n, count(DISTINCT accepted) AS kinds FROM counts WHERE k = 0),
strings AS (SELECT k, g FROM counts GROUP BY k, g HAVING sum(n) >= 0.00001::DOUBLE * (SELECT n FROM size)),
marked AS (SELECT counts.*, strings.g IS NOT NULL AS kept, substr(counts.g, 1, 2 * k) AS c FROM counts LEFT JOIN strings USING (k, g)),
totals AS (SELECT accepted, k, c, sum(n)::BIGINT AS all_n, coalesce(sum(n) FILTER (kept), 0)::BIGINT AS kept_n,
             count(*) FILTER (kept) AS kinds FROM marked GROUP BY accepted, k, c),
p_ AS (SELECT page_id, row, h, unnest(range(1, m + 1)) AS i FROM u),
p_uniform AS (SELECT p_.*, accepted, 1 / 257::DOUBLE AS p FROM p_, (SELECT unnest([true, false]) AS accepted)),
{",".join(_smoothed(k) for k in range(6))},
s AS (SELECT row, round((sum(ln(p)) FILTER (accepted) - sum(ln(p)) FILTER (NOT accepted)) / count(*) * 2, 6) + 0 AS score
      FROM p5 GROUP BY row),
r AS (SELECT u.*, CASE WHEN (SELECT kinds FROM size) = 2 THEN s.score ELSE 0 END AS score FROM u JOIN s USING (row)),
b AS (SELECT *, floor(score * 1000)::BIGINT AS bin FROM r),
known AS (SELECT * FROM b WHERE accepted IS NOT NULL AND held_out),
bins AS (SELECT DISTINCT bin FROM known),
edges AS (SELECT least(coalesce(greatest(0, lag(bin) OVER (ORDER BY bin) + 1), 0), bin) AS bin FROM bins
          UNION SELECT greatest(0, max(bin) + 1) FROM bins),
wrong AS (SELECT e.bin, count(*) FILTER (accepted AND k.bin < e.bin) AS missed, count(*) FILTER (NOT accepted AND k.bin >= e.bin) AS passed
          FROM edges e, known k GROUP BY e.bin),
cut AS (SELECT CASE WHEN (SELECT count(DISTINCT accepted) FROM known) < 2 THEN 0 ELSE (
          SELECT bin FROM wrong, (SELECT count(*) FILTER (accepted) AS a, count(*) FILTER (NOT accepted) AS r FROM known)
          ORDER BY missed * r + passed * a, abs(bin), bin LIMIT 1) END AS cut)
SELECT page_id, host, path, rule, CASE WHEN coalesce(accepted, bin >= cut) THEN 'allow' ELSE 'block' END AS verdict,
  round(score - cut / 1000, 6) AS score FROM b, cut"""


@query
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


SQL["op12_source_audit"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             unnest(list_filter(string_split_regex({ASCII_LOWER.format("coalesce(text, '')")}, '[\x00-\x60\x7B-\x7F]+'),
                                lambda x: x <> '')) AS term FROM documents),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM d GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM d SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (k.n + 2) // (v.n + 2 * v.v) AS q,
           1 + 1000000000 * (coalesce(c.n, 0) + 2) // (coalesce(total, 0) + 2 * v.v) AS p
         FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN total USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                    FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) s
           ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM cell WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10"""


@query
def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


SQL["op13_repair_conversations"] = r"""
WITH RECURSIVE h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([ord(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
      lambda c, b: list_reduce(range(8), lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
      4294967295), 4294967295) % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM d),
f AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
        CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated'
             ELSE '' END AS fault FROM o),
gap(s, t, n, lines) AS (VALUES (0, 0, 0, ''), (0, 2, 1, chr(10) || 'user:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, ''), (1, 2, 1, chr(10) || 'user:'), (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, ''), (2, 3, 1, chr(10) || 'assistant:'), (3, 3, 0, ''), (3, 2, 1, chr(10) || 'user:')),
edit(letter, s, t, initial, role, cost) AS (VALUES ('D', 0, 0, NULL, NULL, 4), ('D', 1, 1, NULL, NULL, 4), ('D', 2, 2, NULL, NULL, 4),
  ('D', 3, 3, NULL, NULL, 4), ('K', 0, 1, 's', NULL, 0), ('K', 0, 2, 'u', NULL, 0), ('K', 1, 2, 'u', NULL, 0), ('K', 2, 3, 'a', NULL, 0),
  ('K', 3, 2, 'u', NULL, 0), ('R', 0, 2, NULL, 'user', 3), ('R', 1, 2, NULL, 'user', 3), ('R', 2, 3, NULL, 'assistant', 3),
  ('R', 3, 2, NULL, 'user', 3)),
best(conv_id, i, s, p) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} FROM conversations
  UNION ALL
  SELECT b.conv_id, b.i + 1, e.t, min({'cost': b.p.cost + 3 * g.n + e.cost + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': b.p.audit || repeat('I', g.n) || e.letter,
    'lines': b.p.lines || g.lines || CASE e.letter WHEN 'D' THEN '' ELSE chr(10) || coalesce(e.role, f.role) || ':' || f.text END})
  FROM best b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 JOIN gap g ON g.s = b.s
    JOIN edit e ON e.s = g.t AND (e.letter = 'D' OR f.fault IN ('', 'truncated')) AND (e.letter <> 'K' OR e.initial = f.initial)
  GROUP BY b.conv_id, b.i, e.t),
ends AS (SELECT b.conv_id, b.i, min({'cost': b.p.cost + 3 * g.n, 'audit': b.p.audit || repeat('I', g.n), 'lines': b.p.lines || g.lines}) AS p
         FROM best b JOIN gap g ON g.s = b.s WHERE g.t IN (0, 3) GROUP BY b.conv_id, b.i),
faults AS (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.p.cost AS cost, e.p.audit AS audit,
  sha256(substr(e.p.lines, 2)) AS repaired_sha256
FROM ends e LEFT JOIN faults n ON n.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(n.n, 0)"""
