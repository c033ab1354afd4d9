"""DuckDB SQL for the document queries that it can express.

Everything here is written from the definitions of the results: strings are
compared whole where the operators compare hashes, near words are found by
deleting each code point in turn, and checksums are computed byte by byte.
"""

from __future__ import annotations

from gapscan.llm.conversations import DELETE, INSERT, REROLE, TRUNCATED
from gapscan.llm.quality import GRAM, MAX_REPEAT_PERCENT, MEASURES, MIN_WORDS, SPREAD, SYMBOLS, TOP
from gapscan.llm.spelling import ALTERED, LOWER, MIN_COUNT, MIN_LENGTH, RATIO, UPPER

WORDS = r"[^\x20\x09-\x0D]+"


def _op3() -> str:
    value = {m: f"least(coalesce(({scale} * {num}) // nullif({den}, 0), 0), {TOP})"
             for m, (num, den, scale, _) in MEASURES.items()}
    limits = ", ".join(
        f"list_sort(list({value[m]})) AS l_{m}, {slack} AS s_{m}" for m, (_, _, _, slack) in MEASURES.items())
    q = lambda m, k: f"l_{m}[({k} * len(l_{m}) + 3) // 4]"
    inside = " AND ".join(f"{value[m]} <= {q(m, 3)} + {SPREAD} * greatest({q(m, 3)} - {q(m, 1)}, s_{m})"
                          for m in MEASURES)
    gram = " || ' ' || ".join(f"ws[i + {k}]" for k in range(GRAM))
    return rf"""WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '{WORDS}') AS ws,
        [l for l in string_split(x, chr(10)) if regexp_matches(l, '{WORDS}')] AS ls FROM t),
gram AS (SELECT rid, i, {gram} AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - {GRAM} + 2)) AS i FROM w)),
again AS (SELECT rid, i FROM gram QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeats AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range({GRAM}) r(k) GROUP BY rid),
stats AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum([length(s) for s in ws]), 0) AS BIGINT) AS word_chars,
    CAST(length(x) - length(translate(x, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeats r ON r.rid = w.rid),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
           FROM stats),
fences AS (SELECT lang, source, {limits} FROM judged WHERE NOT base_failed GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({inside}, false) AS kept
FROM judged j LEFT JOIN fences f
  ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source"""


# 20 bits of the SHA-1, five hexadecimal digits, are four base32 digits.
OP9_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex,
        row_number() OVER (PARTITION BY payload ORDER BY page_id DESC) AS nth,
        max(page_id) OVER (PARTITION BY payload) AS latest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31) + 1, 1)
    for i in range(32)], '') AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth > 1 THEN CAST(latest AS BIGINT) END AS refers_to, true AS has_request, true AS has_metadata
FROM d"""

# CRC-32 of ``s`` of every row (id, s) of the table ``hashed``, as (id, h).
CRC = """bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT i, c FROM bits WHERE k = 8),
bytes AS (SELECT id, hex(encode(s)) AS b FROM hashed),
sums(id, b, k, c) AS (
  SELECT id, b, 0, CAST(4294967295 AS BIGINT) FROM bytes UNION ALL
  SELECT s.id, s.b, k + 1, xor(s.c >> 8, t.c)
  FROM sums s JOIN crc_table t ON t.i = xor(s.c, CAST('0x' || substr(s.b, 2 * k + 1, 2) AS BIGINT)) & 255
  WHERE 2 * k < length(s.b)),
crc AS MATERIALIZED (SELECT id, xor(c, 4294967295) AS h FROM sums WHERE 2 * k = length(b))"""

OP11_SQL = f"""WITH RECURSIVE run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
    translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]{{{MIN_LENGTH},}}')) AS w FROM documents),
counted AS (SELECT doc, w, count(*) AS n, row_number() OVER () AS id FROM run GROUP BY doc, w),
hashed AS (SELECT id, doc || ':' || w AS s FROM counted),
{CRC},
altered AS (
  SELECT CASE WHEN h % {ALTERED} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n
  FROM counted JOIN crc USING (id)),
word AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM altered WHERE length(word) >= {MIN_LENGTH}
         GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.rest = b.word),
best AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
    CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
  FROM word w LEFT JOIN best b ON b.word = w.word),
ways(word, here, step) AS (
  SELECT word, word, 0 FROM forms UNION ALL
  SELECT v.word, f.form, step + 1 FROM ways v JOIN forms f ON f.word = v.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, step) AS root FROM ways GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word"""


def _op13() -> str:
    """Least (cost, audit) from each place to the end, turn by turn from the
    last: nine digits of cost before the letters, so that the least string is
    the answer. States 0 to 3: nothing yet, after system, user, assistant."""
    new = [2, 2, 3, 2]
    keeps = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]

    def plus(x: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST(substr({x}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({x}, 10)"

    def step(q: int) -> str:
        keep = " ".join(f"WHEN ini = '{i}' THEN {plus(f'a{to}', 'extra', 'K')}" for i, to in keeps[q].items())
        return (f"least({plus(f'a{q}', str(DELETE), 'D')}, CASE WHEN must THEN NULL {keep} END, "
                f"CASE WHEN NOT must THEN {plus(f'a{new[q]}', f'{REROLE} + extra', 'R')} END) AS s{q}")

    def inserted(q: int) -> str:
        once = plus(f"s{new[q]}", str(INSERT), "I")
        twice = plus("(" + plus(f"s{new[new[q]]}", str(INSERT), "I") + ")", str(INSERT), "I")
        return f"least(s{q}, {once}, {twice}) AS a{q}"
    inserts = ", ".join(inserted(q) for q in range(4))
    steps = ", ".join(step(q) for q in range(4))
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS id, dense_rank() OVER (ORDER BY conv_id) AS cid, conv_id, turn,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
hashed AS (SELECT id, s FROM given),
{CRC},
harmed AS (
  SELECT cid, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE h % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given JOIN crc USING (id)),
placed AS (
  SELECT cid, turn, role, text, substr(role, 1, 1) AS ini, right(rtrim(text, {space}), 1) AS last,
    row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, md5(text)) AS p FROM harmed),
typed AS MATERIALIZED (
  SELECT *, CASE WHEN last = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY p) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY cid ORDER BY p) AS before FROM placed),
turns AS (SELECT cid, p, ini, fault IN ('blank', 'duplicate') AS must,
            CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra FROM typed),
back(cid, p, a0, a1, a2, a3) AS (
  SELECT cid, p, {inserts} FROM (
    SELECT cid, max(p) + 1 AS p, '000000000' AS s0, '900000000' AS s1, '900000000' AS s2, '000000000' AS s3
    FROM turns GROUP BY cid)
  UNION ALL
  SELECT cid, p, {inserts} FROM (
    SELECT b.cid, t.p, {steps} FROM back b JOIN turns t ON t.cid = b.cid AND t.p = b.p - 1)),
solved AS (SELECT cid, CAST(substr(a0, 1, 9) AS BIGINT) AS cost, substr(a0, 10) AS audit FROM back WHERE p = 1),
edits AS (SELECT cid, k, substr(audit, k, 1) AS e
          FROM (SELECT cid, audit, unnest(range(1, length(audit) + 1)) AS k FROM solved)),
counted AS (
  SELECT *, count(*) FILTER (WHERE e <> 'I') OVER (PARTITION BY cid ORDER BY k) AS p,
    count(*) FILTER (WHERE e <> 'D') OVER (PARTITION BY cid ORDER BY k) AS m FROM edits),
pieces AS (
  SELECT c.cid, k, m, e, role, text, max(CASE WHEN m = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END)
    OVER (PARTITION BY c.cid) AS led
  FROM counted c LEFT JOIN typed t ON t.cid = c.cid AND t.p = c.p AND e <> 'I' WHERE e <> 'D'),
texts AS (
  SELECT cid, string_agg(CASE WHEN e = 'K' THEN role WHEN (m - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole FROM pieces GROUP BY cid),
faults AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM typed GROUP BY cid)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT cid, conv_id FROM given) c LEFT JOIN faults f ON f.cid = c.cid
  LEFT JOIN solved s ON s.cid = c.cid LEFT JOIN texts t ON t.cid = c.cid"""


OP3_SQL = _op3()
OP13_SQL = _op13()
