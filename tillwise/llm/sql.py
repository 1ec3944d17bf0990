"""SQL twins for DuckDB."""

LINES = r"""
WITH lines AS (
    SELECT doc_id, list_position - 1 AS pos, line FROM (
        SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS list_position
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.key IS NOT NULL AND k.doc_id <> s.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
              FILTER (WHERE s.key IS NULL OR k.doc_id = s.keeper), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s USING (key) GROUP BY k.doc_id
"""

_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * part + 1}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), owned AS (
    SELECT *, max(page_id) OVER (PARTITION BY body) AS own FROM hashed
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = own THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> own THEN own END AS refers_to
FROM owned
"""

_RATIOS = {
    "word_length": ("word_chars", "n_words", 1.5),
    "symbols": ("n_symbols", "n_words", 0.05),
    "dup_lines": ("n_dup_lines", "n_lines", 0.1),
    "repeats": ("n_repeat_words", "n_words", 0.05),
}
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{name}' AS rule, {over} / greatest({under}, 1) AS value FROM failing WHERE NOT base_failed"
    for name, (over, under, _) in _RATIOS.items()
)
_SPREADS = ", ".join(f"('{name}', {spread})" for name, (_, _, spread) in _RATIOS.items())


def _quartiles(level: int, keys: str) -> str:
    part = f"{keys}rule"
    return f"""q{level} AS (
    SELECT {part}, max(every) AS n, min(middle) FILTER (WHERE upto >= every * 0.25) AS low,
           min(middle) FILTER (WHERE upto >= every * 0.75) AS high
    FROM (SELECT {part}, middle, sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto,
                 sum(n) OVER (PARTITION BY {part}) AS every
          FROM (SELECT {part}, bucket, middle, count(*) AS n FROM bucketed GROUP BY ALL))
    GROUP BY ALL{' HAVING max(every) >= 100' if keys else ''})"""


QUALITY_RULES = f"""
WITH words AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
), windows AS (
    SELECT doc_id, i, n, count(*) OVER (PARTITION BY doc_id, w, w2, w3, w4, w5) AS times FROM (
        SELECT *, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3, lead(w, 3) OVER s AS w4, lead(w, 4) OVER s AS w5
        FROM words WINDOW s AS (PARTITION BY doc_id ORDER BY i))
    WHERE i <= n - 4
), covered AS (
    SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
    FROM windows, (SELECT unnest([0, 1, 2, 3, 4]) AS o) WHERE times > 1 GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n_lines, sum(n - 1) FILTER (WHERE n > 1 AND regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS dups
    FROM (SELECT doc_id, line, count(*) AS n FROM (
              SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY ALL)
    GROUP BY doc_id
), counted AS (SELECT doc_id, sum(n) AS n_lines FROM (
        SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents) GROUP BY doc_id
), failing AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM (
        SELECT d.doc_id, d.lang, d.source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_words,
               length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
               c.n_lines::BIGINT AS n_lines, coalesce(l.dups, 0)::BIGINT AS n_dup_lines,
               coalesce(v.n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM documents d JOIN lines l USING (doc_id) JOIN counted c USING (doc_id) LEFT JOIN covered v USING (doc_id))
), vals AS ({_VALUES}
), bucketed AS (
    SELECT *, CASE WHEN bucket = -2147483648 THEN 0.0::DOUBLE ELSE pow(1.02::DOUBLE, bucket) * (2 / 2.02::DOUBLE) END AS middle
    FROM (SELECT *, CASE WHEN value > 0 THEN ceil(ln(value) / ln(1.02::DOUBLE))::BIGINT ELSE -2147483648 END AS bucket FROM vals)
), {_quartiles(0, 'lang, source, ')}, {_quartiles(1, 'lang, ')}, {_quartiles(2, '')},
spreads AS (SELECT * FROM (VALUES {_SPREADS}) AS t(rule, spread)),
judged AS (
    SELECT v.doc_id, bool_and(
        value <= coalesce(a.high, b.high, c.high) + 3 * greatest(coalesce(a.high, b.high, c.high) - coalesce(a.low, b.low, c.low), spread)
        AND (v.rule <> 'word_length' OR
             value >= coalesce(a.low, b.low, c.low) - 3 * greatest(coalesce(a.high, b.high, c.high) - coalesce(a.low, b.low, c.low), spread))) AS ok
    FROM vals v JOIN spreads USING (rule)
    LEFT JOIN q0 a ON v.rule = a.rule AND v.lang IS NOT DISTINCT FROM a.lang AND v.source IS NOT DISTINCT FROM a.source
    LEFT JOIN q1 b ON v.rule = b.rule AND v.lang IS NOT DISTINCT FROM b.lang
    LEFT JOIN q2 c ON v.rule = c.rule GROUP BY v.doc_id
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, FALSE) AS kept
FROM failing f LEFT JOIN judged USING (doc_id)
"""

#: A CRC-32 by its rule: eight steps for each byte value, then a table walk over the bytes.
SPELLING = r"""
WITH RECURSIVE steps(byte, crc, step) AS (
    SELECT range, range::BIGINT, 0 FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM steps WHERE step < 8
), crcs AS (SELECT list(crc ORDER BY byte) AS t FROM steps WHERE step = 8),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS c FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               range(strlen(k)), lambda i: ('0x' || substr(hex(k), 2 * i::INT + 1, 2))::BIGINT)),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
    FROM counted, crcs
), words AS MATERIALIZED (
    SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                  ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), gaps AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near
), formed AS MATERIALIZED (
    SELECT w.word, CASE WHEN near_n >= 10 * w.n THEN near END AS form, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1
), chains(word, reached, step) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN formed f ON c.reached = f.word WHERE f.form IS NOT NULL
), roots AS (SELECT word, max_by(reached, step) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

SUFFIXES = """
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
    SELECT rid, i, md5(b[i + 1 : i + 200]) AS v
    FROM (SELECT rid, b, unnest(range(greatest(octet_length(b) - 199, 0))) AS i FROM texts)
), repeated AS (
    SELECT rid, i, i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 200, -1) AS opens
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY v) AS times FROM windows) WHERE times > 1
), spans AS (
    SELECT rid, min(i) AS a, max(i) + 200 AS z
    FROM (SELECT rid, i, sum(opens::INT) OVER (PARTITION BY rid ORDER BY i) AS span FROM repeated) GROUP BY rid, span
), kept AS (
    SELECT rid, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS a, a AS z
    FROM (SELECT * FROM spans UNION ALL SELECT rid, octet_length(b), octet_length(b) FROM texts)
)
SELECT doc_id, any_value(octet_length(b)) AS n_bytes, any_value(octet_length(b)) - sum(z - k.a)::BIGINT AS n_removed,
       any_value(coalesce(n, 0)) AS n_spans,
       sha256(unhex(string_agg(hex(b[k.a + 1 : z]), '' ORDER BY k.a, z))) AS kept_sha256
FROM texts JOIN kept k USING (rid) LEFT JOIN (SELECT rid, count(*) AS n FROM spans GROUP BY rid) USING (rid)
GROUP BY rid, doc_id
"""

ORACLE = {
    "op4_quality_rules": QUALITY_RULES, "op9_line_dedup": LINES, "op10_warc": WARC, "op11_spelling": SPELLING,
    "op13_suffix_dedup": SUFFIXES,
}
