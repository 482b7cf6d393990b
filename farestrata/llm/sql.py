"""DuckDB SQL for the corpus queries that SQL can express; values are written out, not taken from the operators."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

# CRC-32 byte by byte: a table of 256 remainders, then one step per byte of the text
OP2 = """
WITH remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), sized AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
         CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) END AS text_crc32
  FROM documents, remainders
), keyed AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, 'null'), text_crc32, size)), 1, 15))::BIGINT AS mixed FROM sized
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY mixed, doc_id NULLS FIRST, text_crc32, size) AS nth,
         count(*) OVER (PARTITION BY source) AS of_source, count(*) OVER () AS total
  FROM keyed
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY (2 * nth - 1)::DOUBLE / (2 * of_source)::DOUBLE, source NULLS FIRST, mixed,
                               doc_id NULLS FIRST, text_crc32, size) - 1 AS position
  FROM ranked
), cut AS (
  SELECT *, CASE WHEN position < total % 16 * (total // 16 + 1) THEN position // (total // 16 + 1)
                 ELSE (position - total % 16 * (total // 16 + 1)) // greatest(total // 16, 1) + total % 16 END::INT AS shard
  FROM ordered
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY position) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS mixed
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), running AS (
  SELECT *,
    sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS remaining,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
  FROM per
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_max(remaining, weights) AS remaining, max(weights) AS weights
  FROM running WHERE remaining * weight <= 3 * source_size * weights
), wanted AS (
  SELECT r.source, source_size,
         CASE WHEN r.weights <= l.weights THEN (l.remaining * weight)::DOUBLE / l.weights::DOUBLE
              ELSE (3 * source_size)::DOUBLE END AS target
  FROM running r, level l
), copied AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END AS copies FROM wanted
), cumulated AS (
  SELECT s.*, w.source_size, w.target, w.copies, w.target - w.copies * w.source_size AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY mixed RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(size) OVER (PARTITION BY s.source, mixed) AS own
  FROM sized s JOIN copied w ON s.source IS NOT DISTINCT FROM w.source
), edged AS (
  SELECT *, max(CASE WHEN before <= budget THEN mixed END) OVER (PARTITION BY source) AS edge FROM cumulated
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN budget <= 0 THEN 0 WHEN mixed < edge THEN 1
                              WHEN mixed = edge AND 2 * (budget - before) > own THEN 1 ELSE 0 END))::BIGINT AS taken
FROM edged
"""

OP5 = """
WITH digested AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM digested
WINDOW same AS (PARTITION BY text_sha256)
"""

OP6 = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i + 2] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measured AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM split s LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars > 20 * n_words OR word_chars < 2 * n_words) THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_upper > word_chars THEN 32 ELSE 0 END AS failed_rules
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_rules % 4 > 0 AS base_failed,
       failed_rules = 0 AS kept, failed_rules::BIGINT AS failed_rules
FROM judged
"""


_RULES = ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting")
_POLICIES = ", ".join(
    f"('{policy}', '{rule}', {1 << i}, {(1 << n) - 1})"
    for policy, n in (("base", 2), ("v1", 4), ("v2", 6)) for i, rule in enumerate(_RULES[:n])
)
ABLATIONS = f"""
SELECT policy, rule, count(*) FILTER (WHERE (failed_rules & bit) > 0) AS failed,
       count(*) FILTER (WHERE (failed_rules & whole) = bit) AS alone,
       count(*) FILTER (WHERE (failed_rules & (whole - bit)) = 0) AS kept_without
FROM ({OP6}) judged, (VALUES {_POLICIES}) p(policy, rule, bit, whole) GROUP BY policy, rule
"""

# bytes as two hex digits each, as a BLOB can't be cut; long texts in overlapping stretches, as cutting walks from the start
OP7 = """
WITH bytes AS (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h FROM documents
), bases AS (
  SELECT doc_id, row, h, unnest(range(0, length(h) // 2 - 49, 250)) AS base FROM bytes WHERE length(h) >= 100
), stretches AS (
  SELECT doc_id, row, base, substr(h, 2 * base + 1, 2 * (250 + 49)) AS stretch FROM bases
), starts AS (
  SELECT *, unnest(range(length(stretch) // 2 - 49)) AS place FROM stretches
), strings AS (
  SELECT doc_id, row, base + place AS p, substr(stretch, 2 * place + 1, 100) AS s FROM starts
), firsts AS (
  SELECT s, min(doc_id) AS first_doc FROM strings GROUP BY s HAVING count(*) > 1
), gone AS (
  SELECT row, p, p > lag(p) OVER (PARTITION BY row ORDER BY p) + 50 IS NOT FALSE AS opens
  FROM strings JOIN firsts USING (s) WHERE doc_id > first_doc
), numbered AS (
  SELECT row, p, count(*) FILTER (WHERE opens) OVER (PARTITION BY row ORDER BY p) AS span FROM gone
), spans AS (
  SELECT row, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY row, span
), pieces AS (
  SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS from_byte FROM spans
), cut AS (
  SELECT row, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS before
  FROM pieces JOIN bytes USING (row) GROUP BY row
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (row)
"""

OP12 = rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS row FROM documents
), one AS (
  SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM one
), judged AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""

OP13 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM worded, range(1, 4) r(m) WHERE len(w) >= m
), counts AS MATERIALIZED (
  SELECT lang, m, phrase, concat(lang, chr(9), phrase) AS key, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10
), cuts AS MATERIALIZED (
  SELECT lang, m, phrase, a, 1 AS k, concat(lang, chr(9), w[1]) AS front, concat(lang, chr(9), array_to_string(w[2:], ' ')) AS back FROM candidates
  UNION ALL
  SELECT lang, m, phrase, a, 2, concat(lang, chr(9), array_to_string(w[:2], ' ')), concat(lang, chr(9), w[3]) FROM candidates WHERE m = 3
), valued AS (
  SELECT c.*, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score
  FROM cuts c JOIN counts l ON l.key = front JOIN counts r ON r.key = back
), scored AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inside, a AS longest FROM candidates WHERE m = 3
), covered AS (
  SELECT lang, inside, max(longest) AS longest FROM longer GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN covered v ON s.lang = v.lang AND s.phrase = v.inside
  WHERE longest IS NULL OR 100 * longest < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": OP1,
        "op2_sharding": OP2,
        "op3_mixing": OP3,
        "op5_exact_dedup": OP5,
        "op6_quality_rules": OP6,
        "quality_rule_ablations": ABLATIONS,
        "op7_suffix_dedup": OP7,
        "op12_line_dedup": OP12,
        "op13_collocations": OP13,
    }
