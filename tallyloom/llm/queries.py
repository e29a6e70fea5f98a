"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, divergence, fingerprint, language, lines, mixing, packing, quality, sharding, similar, spelling, substrings
from tallyloom.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@register
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLES["op2_decontaminate"] = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
known AS (
    SELECT DISTINCT item, least(10, len(words)) AS length, array_to_string(words[pos:pos + least(10, len(words)) - 1], ' ') AS run
    FROM i, unnest(range(1, greatest(2, len(words) - 8))) AS u(pos) WHERE len(words) > 0),
lengths AS (SELECT DISTINCT length FROM known),
runs AS (
    SELECT doc_id, pos, length, array_to_string(words[pos:pos + length - 1], ' ') AS run
    FROM w, lengths, unnest(range(1, greatest(1, len(words) - length + 2))) AS u(pos)),
hits AS (SELECT doc_id, pos, runs.length, item FROM runs JOIN known ON runs.run = known.run AND runs.length = known.length),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n_hit FROM hits, unnest(range(0, length)) AS u(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS found FROM hits GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(found, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id LEFT JOIN items ON w.doc_id = items.doc_id
"""


@register
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


@register
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


ORACLES["op9_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, coalesce('s' || source, 'z') AS skey, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT skey, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1, 2),
w AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS most,
           CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
v AS (
    SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY most / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
pick AS (SELECT level FROM v WHERE level * weight <= most ORDER BY most / weight, skey LIMIT 1),
g AS (SELECT skey, source_size, least(pick.level * weight, most::DOUBLE) AS target, least(source_size, 4096) AS blocks FROM v, pick),
edges AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(CAST(round(target * blocks / source_size) AS BIGINT), 3 * blocks) ELSE 0 END AS slots FROM g),
uses AS (
    SELECT skey, nb, (nb * source_size) // blocks AS first, ((nb + 1) * source_size) // blocks AS stop,
           slots // blocks + CASE WHEN nb < slots % blocks THEN 1 ELSE 0 END AS uses
    FROM edges, unnest(range(0, blocks)) AS u(nb) WHERE source_size > 0),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY skey ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d),
t AS (
    SELECT doc_id, sum((least(start + size, stop) - greatest(start, first)) * uses) AS taken
    FROM placed JOIN uses ON placed.skey = uses.skey AND first < start + size AND stop > start GROUP BY 1)
SELECT d.doc_id, d.source, d.size, e.source_size, e.target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM d JOIN edges e ON d.skey = e.skey LEFT JOIN t ON d.doc_id = t.doc_id
"""


@register
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


@register
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.similar_documents(read_table(spark, sf_dir, "documents"))


ORACLES["op6_ngram_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS gram
    FROM w, unnest(range(1, greatest(2, len(words) - 3))) AS u(pos) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * common >= 75 * (p.n + q.n - common)),
reached(doc_id, node) AS (
    SELECT doc_id, doc_id FROM w
    UNION
    SELECT reached.doc_id, y FROM reached JOIN links ON node = x)
SELECT w.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(node) AS component_id
FROM w JOIN reached ON w.doc_id = reached.doc_id LEFT JOIN sizes ON w.doc_id = sizes.doc_id GROUP BY w.doc_id
"""


@register
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(read_table(spark, sf_dir, "documents"))


@register
def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(read_table(spark, sf_dir, "documents"))


@register
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_repeats(read_table(spark, sf_dir, "documents"))


@register
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(read_table(spark, sf_dir, "documents"))


@register
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "curve")


@register
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


ORACLES["op12_spelling"] = r"""
WITH RECURSIVE bits AS (
    SELECT list(v ORDER BY i) AS crc
    FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
          FROM range(256) AS r(i))),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, count(*) AS copies,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents GROUP BY doc_id, text),
keyed AS (SELECT id, run, sum(copies) AS times, hex(encode(id || ':' || run)) AS body FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (
    SELECT run, times, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(0, length(body) // 2), lambda i: CAST('0x' || substr(body, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
        lambda c, b: xor(c // 256, crc[CAST(xor(c % 256, b) + 1 AS INT)]))) AS h
    FROM keyed, bits),
results AS (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
holes AS (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS hole FROM words, unnest(range(0, length(word))) AS u(i)),
near AS (
    SELECT DISTINCT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.hole = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.hole = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(other)) AS nth FROM near),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN other END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND nth = 1),
chain(word, root, form) AS (
    SELECT word, word, form FROM forms
    UNION ALL
    SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.form = forms.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.form IS NULL
"""


@register
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"))


ORACLES["op13_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
    SELECT g.lang, g.source, k.term, CAST(coalesce(c, 0) AS HUGEINT) AS c
    FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counted x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
shares AS (
    SELECT lang, source, term, c, 1 + 1000000000 * (c + 2) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p,
           1 + 1000000000 * (sum(c) OVER (PARTITION BY lang, term) + 2) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM cells JOIN v USING (lang)),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


LINES_SQL = r"""
WITH l AS (
    SELECT doc_id, source, i, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start,
           regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
u AS (SELECT *, array_to_string(words, ' ') AS unit, len(words) AS n FROM l),
@marked@
SELECT d.doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(line) AS BIGINT), ',' ORDER BY i) FILTER (gone), '') AS removed_spans,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id
"""
ORACLES["op1_lines"] = LINES_SQL.replace(
    "@marked@",
    """b AS (SELECT unit FROM u WHERE n > 0 GROUP BY unit HAVING count(DISTINCT coalesce('s' || source, 'z')) >= 10),
m AS (SELECT u.*, n > 0 AND unit IN (SELECT unit FROM b) AS gone FROM u)""",
)
ORACLES["op10_repeats"] = r"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?][\x20\x09-\x0D]|\n)', concat('\1', chr(1)), 'g'), chr(1)) AS parts FROM documents),
l AS (
    SELECT doc_id, i, part, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) - length(part) AS start,
           regexp_extract_all(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM s)),
u AS (
    SELECT *, len(words) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS nth,
           row_number() OVER (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, i) > 1 AS repeated
    FROM l WHERE len(words) > 0),
g AS (SELECT *, nth - row_number() OVER (PARTITION BY doc_id, repeated ORDER BY nth) AS run FROM u),
m AS (SELECT doc_id, i, repeated AND sum(n) OVER (PARTITION BY doc_id, repeated, run) >= 16 AS gone FROM g)
SELECT d.doc_id, count(*) FILTER (gone) AS n_removed, count(m.i) AS n_units,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(part) AS BIGINT), ',' ORDER BY l.i) FILTER (gone), '') AS removed_spans,
       sha256(coalesce(string_agg(part, '' ORDER BY l.i) FILTER (gone IS NULL OR NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN m ON l.doc_id = m.doc_id AND l.i = m.i GROUP BY d.doc_id
"""
