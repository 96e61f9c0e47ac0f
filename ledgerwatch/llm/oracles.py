"""DuckDB statements for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from ledgerwatch.llm.line_dedup import CHARACTERS, DOCUMENTS, LOWER, UPPER
from ledgerwatch.llm.lookup_sharding import SHARDS, SLOTS, fill
from ledgerwatch.llm.mixing import MOST_COPIES, SHARE, WEIGHTS
from ledgerwatch.llm.quality_rules import HOST_LIMIT, MAX_PRIOR, MAX_REPEAT_PERCENT, MIN_WORDS
from ledgerwatch.llm.ranked_search import BEST
from ledgerwatch.llm.warc import REVISIT_BYTES

WORD = r"[^\x20\x09-\x0D]+"

WARC = f"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), marked AS (
    SELECT *, payload_bytes >= {REVISIT_BYTES} AS large, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response
    FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN large AND page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN large AND page_id < response THEN response END AS refers_to
FROM marked
"""

#: The filled table is one list, from slot 0 on; md5 and the step into it are SQL.
SHARDING = f"""
WITH placed AS (
    SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents
), shards AS (
    SELECT {list(fill())} AS numbers, {list(SHARDS)} AS names
)
SELECT doc_id, slot, names[numbers[slot + 1] + 1] AS shard FROM placed, shards
"""

QUALITY = rf"""
WITH read AS (
    SELECT row_number() OVER () AS place, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT place, doc_id, source, text, regexp_extract_all(text, '{WORD}') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM read
), windows AS (
    SELECT place, i, list_slice(words, i, i + 4) AS five
    FROM (SELECT place, words, unnest(range(1, len(words) - 3)) AS i FROM split)
), twice AS (
    SELECT place, unnest(list(i)) AS i FROM windows GROUP BY place, five HAVING count(*) > 1
), covered AS (
    SELECT place, count(DISTINCT i + k) AS n FROM twice, range(5) AS steps(k) GROUP BY place
), counted AS (
    SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN covered USING (place)
), judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted
), hosts AS (
    SELECT source AS host, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM judged GROUP BY source
), moments AS (
    SELECT avg(failed / n) AS m, greatest(var_pop(failed / n) - avg(failed / n) * (1 - avg(failed / n)) * avg(1 / n), 0) AS spread FROM hosts
), prior AS (
    SELECT m, greatest(1.0, CASE WHEN spread > 0 THEN least(m * (1 - m) / spread - 1, {MAX_PRIOR}) ELSE {MAX_PRIOR} END) AS strength FROM moments
), verdicts AS (
    SELECT host, (failed + m * strength) / (n + strength) <= {HOST_LIMIT} AS good FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, good AND NOT base_failed AS kept
FROM judged JOIN verdicts ON source IS NOT DISTINCT FROM host
"""

#: A source that is full leaves its excess to those with more room per weight.
MIXING = f"""
WITH drawn AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
           (('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', md5(coalesce(text, '')))), 1, 12))::BIGINT + 0.5::DOUBLE)
           / 281474976710656::DOUBLE AS u
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM drawn GROUP BY source
), weighed AS (
    SELECT *, {list(WEIGHTS)}[CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS weight,
           CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE}::DOUBLE AS goal, CAST(source_size * {MOST_COPIES} AS DOUBLE) AS most
    FROM sources
), filled AS (
    SELECT *, CAST(weight AS DOUBLE) * (goal - coalesce(sum(most) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / CAST(sum(weight) OVER (room ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) > most AS is_full
    FROM weighed WINDOW room AS (ORDER BY most / weight, encode(source) NULLS LAST)
), aims AS (
    SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * ((goal - coalesce(sum(most) FILTER (is_full) OVER (), 0))
           / CAST(sum(weight) FILTER (NOT is_full) OVER () AS DOUBLE)) END AS target
    FROM filled
), expected AS (
    SELECT d.*, source_size, target, least({MOST_COPIES}::DOUBLE, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS e
    FROM drawn d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
), ranked AS (
    SELECT *, CAST(floor(e) AS BIGINT) AS whole, CASE WHEN e > floor(e) THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS odds
    FROM expected
), ordered AS (
    SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS want,
           sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds) NULLS LAST) AS upto,
           sum(size) OVER (PARTITION BY source, odds / (1 + odds)) AS together
    FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN odds IS NOT NULL AND 2 * upto - together <= 2 * want THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(words, i, i + 4) AS five
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0)
), numbers AS (
    SELECT five, row_number() OVER () AS s FROM (SELECT five FROM shingles GROUP BY five HAVING count(*) > 1)
), common AS (
    SELECT doc_id, s FROM shingles JOIN numbers USING (five)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS shared
    FROM common a JOIN common b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT one, other FROM met JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = other
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), edges AS (
    SELECT one AS a, other AS b FROM links UNION ALL SELECT other, one FROM links
), reached(doc_id, first) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT b, first FROM reached JOIN edges ON a = doc_id WHERE first < b
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(first) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

#: A null id is one document, smaller than all others.
LINE_DEDUP = f"""
WITH given AS (
    SELECT row_number() OVER () AS place, doc_id, coalesce(doc_id, -9223372036854775808) AS own, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), every AS (
    SELECT place, own, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM given
), keyed AS (
    SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{UPPER}', '{LOWER}') AS key FROM every
), often AS (
    SELECT key, max(own) AS top FROM keyed WHERE length(key) >= {CHARACTERS} GROUP BY key HAVING count(DISTINCT own) >= {DOCUMENTS}
), judged AS (
    SELECT place, pos, line, top IS NOT NULL AND own <> top AS gone FROM keyed LEFT JOIN often USING (key)
), left_over AS (
    SELECT place, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
    FROM judged GROUP BY place
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM given JOIN left_over USING (place)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED_SEARCH = f"""
WITH given AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS words FROM documents
), totals AS (
    SELECT count(*) FILTER (len(words) > 0) AS every, CAST(sum(len(words)) AS BIGINT) AS total FROM given
), held AS (
    SELECT place, word, count(*) AS tf FROM (SELECT place, unnest(words) AS word FROM given) GROUP BY place, word
), weights AS (
    SELECT word, CAST(floor(1000 * ln((2 * every + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT word, count(*) AS df FROM held GROUP BY word), totals
), lengths AS (
    SELECT place, doc_id, CAST(100 - 90 + (90 * len(words) * every) // total AS BIGINT) AS m FROM given, totals WHERE len(words) > 0
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS word FROM benchmark
), scores AS (
    SELECT item_id, place, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (word) JOIN weights USING (word) JOIN lengths USING (place) GROUP BY item_id, place, doc_id
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ordered WHERE rank <= {BEST}
"""

ORACLES = {
    "op1_warc": WARC,
    "op4_sharding": SHARDING,
    "op7_quality_rules": QUALITY,
    "op8_mixing": MIXING,
    "op9_ngram_join": NGRAM_JOIN,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_line_dedup": LINE_DEDUP,
}
