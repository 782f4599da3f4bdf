"""One query per operator over the whole of its table, and the same answers as SQL where SQL can give them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import (
    divergence, exact_dedup, fingerprints, language, mixing, packing, pii, quality, repetition, resampling, sharding, simhash, token_files,
)
from fieldlens.llm.common import documents
from fieldlens.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


@query
def op1_personal_data(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return pii.digest(pii.find(docs, pii.fit(docs)))


@query
def op2_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.rate(docs, quality.fit(docs))


@query
def op3_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir))


@query
def op4_mixing(spark, sf_dir):
    return mixing.taken(documents(spark, sf_dir))


@query
def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(documents(spark, sf_dir))


@query
def op6_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


@query
def op7_token_files(spark, sf_dir):
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    return token_files.token_digests(spark, path)


@query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op10_sharding(spark, sf_dir):
    return sharding.shard(documents(spark, sf_dir))


@query
def op11_repetition(spark, sf_dir):
    return repetition.rules(documents(spark, sf_dir)).drop("n_repeats", "longest_repeat")


@query
def op12_importance(spark, sf_dir):
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_divergence(spark, sf_dir):
    return divergence.audit(documents(spark, sf_dir))


ORACLES["op4_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR || ':1') AS shuffled,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM sources),
filled AS (
  SELECT *, cap / weight AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)::DOUBLE)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT min_by(level, (ratio, place)) AS common FROM filled WHERE level <= ratio),
targets AS (SELECT source, source_size, least(cap::DOUBLE, weight * common) AS target FROM filled, level),
queues AS (
  SELECT d.*, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY shuffled, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS queued
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
timed AS (
  SELECT *, (turn * source_size + queued + size)::DOUBLE / target AS finish,
         least(size, floor(target) - (turn * source_size + queued))::BIGINT AS words
  FROM queues, (VALUES (0), (1)) AS turns(turn) WHERE size > 0 AND target > 0),
mixed AS (
  SELECT doc_id, words,
         coalesce(sum(words) OVER (ORDER BY finish, source NULLS LAST, turn, shuffled, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
  FROM timed WHERE words > 0),
summed AS (SELECT doc_id, sum(words) AS taken, min(position) AS first_position FROM mixed GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_position::BIGINT AS first_position
FROM queues LEFT JOIN summed USING (doc_id)
"""

ORACLES["op8_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(content) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY content ORDER BY chars DESC, doc_id)
"""

# A repeat of at least k words is what windows of k words that occur twice cover, so windows suffice here.
ORACLES["op11_repetition"] = r"""
WITH texts AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
windows AS (
  SELECT doc_id, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: {'place': i, 'content': md5(array_to_string(words[i:i + k - 1], ' '))}), recursive := true)
  FROM texts, (VALUES (3), (10), (101)) AS sizes(k)),
repeated AS (SELECT doc_id, k, place, lead(place) OVER (PARTITION BY doc_id, k ORDER BY place) AS next
             FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k, content) AS n FROM windows) WHERE n > 1),
spans AS (SELECT doc_id, k, sum(least(k, coalesce(next - place, k)))::BIGINT AS n FROM repeated GROUP BY doc_id, k),
summed AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce((SELECT n FROM spans s WHERE s.doc_id = t.doc_id AND k = 3), 0) AS n_repeat_words,
         coalesce((SELECT n FROM spans s WHERE s.doc_id = t.doc_id AND k = 10), 0) AS n_covered,
         coalesce((SELECT n FROM spans s WHERE s.doc_id = t.doc_id AND k = 101), 0) AS n_long
  FROM texts t)
SELECT * EXCLUDE (n_long), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered <= 30 * n_words AND n_long = 0 AS kept
FROM summed
"""

ORACLES["op12_importance"] = r"""
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT range AS i FROM range(256))),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts),
distinct_words AS (SELECT word, hex(encode(word)) AS digits, octet_length(encode(word)) AS size FROM (SELECT DISTINCT word FROM words)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size), lambda k: ('0x' || substr(digits, 2 * k + 1, 2))::BIGINT)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words, steps),
placed AS (SELECT side, id, bucket FROM words JOIN hashed USING (word)),
buckets AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (SELECT sum(s) + 10000 FROM buckets)::DOUBLE
                                 / ((s + 1)::DOUBLE * (SELECT sum(t) + 10000 FROM buckets)::DOUBLE)))::BIGINT AS gain
  FROM buckets),
weights AS (SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN fit USING (doc_id)
"""

ORACLES["op13_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
occurring AS (SELECT DISTINCT lang, source FROM docs),
used AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(found) AS term FROM docs) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM used GROUP BY lang, term HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
every AS (
  SELECT o.lang, o.source, k.term, coalesce(u.n, 0)::HUGEINT AS n
  FROM occurring o JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM used GROUP BY ALL) u USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS total FROM every GROUP BY lang, source),
shares AS (
  SELECT e.lang, e.source, e.term, e.n, (1 + (1000000000 * (e.n + 5)) // (t.total + 5 * s.v))::BIGINT AS p,
         (1 + (1000000000 * (k.n + 5)) // (s.total + 5 * s.v))::BIGINT AS q
  FROM every e JOIN totals t USING (lang, source) JOIN sizes s USING (lang) JOIN kept k USING (lang, term)),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
every_part AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every_part)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
