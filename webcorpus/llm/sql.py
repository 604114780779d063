"""DuckDB SQL with the same rows as the operators' queries, where SQL can express them."""

from webcorpus.llm import fixity
from webcorpus.llm import quality as q
from webcorpus.llm import resample as r

ORACLES: dict[str, str] = {}

ORACLES["op6_quality_rules"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs)),
hashed AS (
  SELECT doc_id, i, w, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS h FROM words),
next AS (
  SELECT doc_id, i, w, h, lead(h) OVER d AS h2, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3
  FROM hashed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
grams AS (
  SELECT doc_id, h % {q.BUCKETS} AS b FROM next
  UNION ALL
  SELECT doc_id, {q.BUCKETS} + (h * 31 + h2) % {q.BUCKETS} FROM next WHERE h2 IS NOT NULL),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
counts AS (
  SELECT b, count(*) AS raw, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM good)) AS trusted
  FROM grams GROUP BY b),
total AS (
  SELECT sum(raw) + {q.SMOOTHING} * {2 * q.BUCKETS} AS raws,
         sum(trusted) + {q.SMOOTHING} * {2 * q.BUCKETS} AS trusteds FROM counts),
ratio AS (
  SELECT b, CAST(round({q.SCALE} * ln(((trusted + {q.SMOOTHING}) / trusteds)
                                     / ((raw + {q.SMOOTHING}) / raws))) AS BIGINT) AS r
  FROM counts, total),
score AS (
  SELECT doc_id, sum(r) AS llr, count(*) AS n FROM grams JOIN ratio USING (b) GROUP BY doc_id),
triples AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n
  FROM next WHERE w3 IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat
  FROM triples, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
sizes AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id),
stats AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    coalesce(llr, 0) AS llr, coalesce(n, 0) AS n
  FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN lines USING (doc_id)
    LEFT JOIN repeated USING (doc_id) LEFT JOIN score USING (doc_id)),
judged AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEATED} * n_words AS failed
  FROM stats)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed AS base_failed,
  NOT failed AND llr >= CAST({q.THRESHOLD * q.SCALE} AS DOUBLE) * n AS kept,
  CAST(llr AS BIGINT) AS llr_sum, CAST(n AS BIGINT) AS n_ngrams
FROM judged
"""

_CRLF = "chr(13) || chr(10)"
ORACLES["op7_merkle_audit"] = f"""
WITH records AS (
  SELECT page_id AS record_id, encode(
    'WARC/1.1' || {_CRLF} || 'WARC-Type: response' || {_CRLF}
    || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), 'none') || '>' || {_CRLF}
    || 'WARC-Target-URI: ' || coalesce(url, '') || {_CRLF}
    || 'Content-Length: ' || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR)
    || {_CRLF} || {_CRLF} || coalesce(html, '') || {_CRLF} || chr(13)) AS start
  FROM pages),
laid AS (
  SELECT format('{{:08d}}.warc', record_id // {fixity.FILE_RECORDS}) AS file, record_id,
    octet_length(start) + 1 AS length, sha256(start || encode(chr(10))) AS hash,
    sha256(start || '\x00'::BLOB) AS rotten
  FROM records),
placed AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY record_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins FROM laid)
SELECT file, begins AS file_offset, record_id, CAST(length AS BIGINT) AS first_length,
  CASE WHEN record_id % 101 = 7 THEN NULL ELSE CAST(length AS BIGINT) END AS second_length,
  hash AS first_hash,
  CASE WHEN record_id % 101 = 7 THEN NULL ELSE rotten END AS second_hash
FROM placed WHERE record_id % 97 = 13 OR record_id % 101 = 7
"""


def _crc_table() -> list[int]:
    """Remainders of the 256 bytes for the reflected polynomial of CRC-32."""
    table = list(range(256))
    for _ in range(8):
        table = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


ORACLES["op11_resampling"] = rf"""
WITH raw AS (
  SELECT false AS target, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT true, row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT target, row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM raw),
per_word AS (SELECT target, row, w, count(*) AS n FROM words GROUP BY ALL),
coded AS (
  SELECT w, CAST(xor(list_reduce(
    list_transform(range(1, 2 * octet_length(encode(w)), 2),
      lambda i: CAST('0x' || substr(hex(w), i, 2) AS BIGINT)),
    lambda c, byte: xor(c >> 8, list_extract({_crc_table()}::BIGINT[], 1 + (xor(c, byte) & 255))),
    4294967295::BIGINT), 4294967295::BIGINT) % {r.BUCKETS} AS BIGINT) AS b
  FROM (SELECT DISTINCT w FROM per_word)),
features AS (SELECT target, row, b, n FROM per_word JOIN coded USING (w)),
counts AS (
  SELECT b, sum(n) FILTER (WHERE NOT target) AS s, sum(n) FILTER (WHERE target) AS t
  FROM features GROUP BY b),
filled AS (SELECT b, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t FROM counts),
gains AS (
  SELECT b, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + {r.BUCKETS})
    / ((s + 1) * (sum(t) OVER () + {r.BUCKETS})))) AS BIGINT) AS g FROM filled),
weights AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * g) / sum(n)) AS BIGINT) AS weight
  FROM features JOIN gains USING (b) WHERE NOT target GROUP BY row),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
      '{r.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM raw LEFT JOIN weights USING (row) WHERE NOT target),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {r.MIN_WORDS}
      ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
    count(*) FILTER (WHERE n_features >= {r.MIN_WORDS}) OVER () AS able
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= {r.MIN_WORDS} AND place <= able * {r.PERCENT} // 100 THEN place END AS rank
FROM ordered
"""
