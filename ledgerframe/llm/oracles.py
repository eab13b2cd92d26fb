"""SQL counterparts of the queries, where SQL can express them."""

from . import pii, rules

OP6 = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
"""

# the fixed phrases are the operator's own parameter
OP3 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), toks AS (
    SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT r, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM docs)
), runs AS (
    SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS run
    FROM toks WINDOW o AS (PARTITION BY r ORDER BY i)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs WHERE run IS NOT NULL) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY r
), lines AS (
    SELECT r, l, len(list_filter(string_split_regex(l, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs)
    WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')
), judged AS (
    SELECT r, l, length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars,
        (n > 1 AND 2 * length(regexp_replace(l, '[^#*$%&<>]+', '', 'g')) >= n)
        OR (n > 1 AND 2 * length(regexp_replace(l, '[^!]+', '', 'g')) >= n)
        OR (n >= {rules.LONG_LINE_WORDS} AND NOT regexp_matches(l, '[.!?…。؟।]'))
        OR (length(regexp_replace(l, '[^|»›•·]+', '', 'g')) >= 2
            AND 4 * length(regexp_replace(l, '[^|»›•·]+', '', 'g')) >= n)
        OR (n <= {rules.BOILERPLATE_WORDS} AND regexp_matches(l, '(?i){rules.BOILERPLATE}')) AS fails
    FROM lines
), by_line AS (
    SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines,
        count(*) FILTER (fails) AS n_failed_lines, coalesce(sum(chars) FILTER (NOT fails), 0) AS cleaned_chars
    FROM judged GROUP BY r
), by_word AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM toks GROUP BY r),
counted AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
        coalesce(cleaned_chars, 0)::BIGINT AS cleaned_chars
    FROM docs LEFT JOIN by_word USING (r) LEFT JOIN covered USING (r) LEFT JOIN by_line USING (r)
), base AS (
    SELECT *, n_words < {rules.MIN_WORDS}
        OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM counted
)
SELECT *, NOT base_failed
    AND 100 * (word_chars - cleaned_chars) <= {rules.MAX_LOST_PERCENT} * word_chars AS kept
FROM base
"""

OP10 = """
WITH RECURSIVE rows AS (
    SELECT DISTINCT conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS body FROM conversations
), msgs AS (
    SELECT *, coalesce('=' || conv_id, '') AS c, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(1) || body)) - 1 AS n
    FROM rows
), cut AS (
    SELECT c, n, l, i, length(regexp_replace(regexp_extract(l, '^((?:[\\x20\\t]*>)*)', 1), '[^>]', '', 'g')) AS level
    FROM (SELECT c, n, unnest(string_split(body, chr(10))) AS l, generate_subscripts(string_split(body, chr(10)), 1) AS i FROM msgs)
), said AS (
    SELECT c, n, i, level, trim(regexp_replace(lower(regexp_replace(l, '^(?:[\\x20\\t]*>)+\\x20?', '')), '[\\x02\\x03\\x20\\x09-\\x0D]+', ' ', 'g')) AS s
    FROM cut
), runs AS (
    -- own lines are one run, neighbouring quoted lines of one level are another
    SELECT c, n, i, level, s, CASE WHEN level > 0 THEN sum(begins) OVER (PARTITION BY c, n ORDER BY i) ELSE 0 END AS p
    FROM (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY c, n ORDER BY i) THEN 0 ELSE 1 END AS begins FROM said)
), passages AS (
    SELECT c, n, p, level, list_filter(string_split(string_agg(s, ' ' ORDER BY i), ' '), lambda x: x <> '') AS w
    FROM runs GROUP BY c, n, p, level
), pieces AS (
    SELECT c, n, level, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
    FROM passages WHERE len(w) > 0
), own_pieces AS (
    SELECT c, n, s FROM pieces WHERE level = 0
    UNION SELECT c, n, s FROM said WHERE level = 0 AND s <> '' AND len(string_split(s, ' ')) < 5
), hits AS (
    SELECT q.c, q.n, q.level, max(o.n) AS parent, any_value(q.times) AS times
    FROM (SELECT c, n, level, s, count(*) AS times FROM pieces WHERE level > 0 GROUP BY ALL) q
        JOIN own_pieces o ON o.c = q.c AND o.s = q.s AND o.n < q.n
    GROUP BY q.c, q.n, q.level, q.s
), links AS (
    SELECT c, n, arg_max(parent, [-level, hits, parent]) AS parent
    FROM (SELECT c, n, level, parent, sum(times)::BIGINT AS hits FROM hits GROUP BY ALL) GROUP BY c, n
), tree AS (
    SELECT m.c, m.n, coalesce(l.parent, CASE WHEN m.n > 0 THEN m.n - 1 END) AS parent FROM msgs m LEFT JOIN links l USING (c, n)
), ranked AS (
    SELECT *, parent IS NOT NULL AND row_number() OVER (PARTITION BY c, parent ORDER BY n) = 1 AS goes_on FROM tree
), threads AS (
    SELECT c, n, n AS thread FROM ranked WHERE NOT goes_on
    UNION ALL
    SELECT r.c, r.n, t.thread FROM threads t JOIN ranked r ON r.c = t.c AND r.parent = t.n AND r.goes_on
), own AS (
    SELECT m.c, m.n, trim(regexp_replace(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (level = 0), ''), '^\\n+|\\n+$', '', 'g')) AS text
    FROM msgs m JOIN cut USING (c, n) GROUP BY m.c, m.n
)
SELECT m.conv_id, m.turn, m.role, p.turn AS reply_to, t.thread,
    row_number() OVER (PARTITION BY m.c, t.thread ORDER BY m.n) - 1 AS position,
    (SELECT count(*) FROM said q WHERE q.c = m.c AND q.n = m.n AND q.level > 0 AND q.s <> '') AS n_quoted,
    own.text, '<|' || coalesce(m.role, 'user') || '|>' || chr(10) || own.text || '<|end|>' || chr(10) AS formatted
FROM msgs m JOIN tree r USING (c, n) JOIN threads t USING (c, n) JOIN own USING (c, n)
LEFT JOIN msgs p ON p.c = r.c AND p.n = r.parent
"""

_KINDS = ("email", "ip", "card", "phone", "cand")
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "cand": r"[0-9](?:[\x20().-]{0,2}[0-9])*",
}


def _matches(kind: str) -> str:
    """Matches of a kind with their places, from what stands between them."""
    return f"""SELECT r, '{kind}' AS kind, i, m, gap FROM (
  SELECT r, unnest(regexp_extract_all(t, '{_PATTERNS[kind]}')) AS m,
    unnest(list_transform(string_split_regex(t, '{_PATTERNS[kind]}')[:-2], lambda p: length(p))) AS gap,
    generate_subscripts(regexp_extract_all(t, '{_PATTERNS[kind]}'), 1) AS i
  FROM docs)"""


def _round(name: str, given: str) -> str:
    """A pattern's trust in a kind, from its seeds and the scores of its candidates."""
    return f"""{name} AS (
  SELECT pattern, kind, trust FROM (
    SELECT pattern, kind, round((f + c) / ((f + c) + (n_seeds - f + {pii.UNKNOWN}::DOUBLE * (n_open - c)) + 1), 3) AS trust
    FROM (SELECT pattern, kind, sum(f)::BIGINT AS f, sum(s)::BIGINT::DOUBLE / 1e6 AS c
          FROM (SELECT pattern, kind, f, 0 AS s FROM fixed UNION ALL {given}) GROUP BY pattern, kind)
      JOIN sizes USING (pattern))
  WHERE trust >= {pii.WEAK})"""


def _given(trust: str) -> str:
    """The scores, in millionths, that trusted patterns give the candidates."""
    return f"""SELECT pattern, g.kind, 0 AS f, g.s FROM open_edges JOIN (
    SELECT value, kind,
      round((1 - exp(sum(round(ln(1.000001::DOUBLE - trust) * 1e6)::BIGINT)::DOUBLE / 1e6)) * 1e6)::BIGINT AS s
    FROM open_edges JOIN {trust} USING (pattern) GROUP BY value, kind) g USING (value)"""


_ROUNDS = ",\n".join(
    _round("trusted" if n == pii.ROUNDS else f"t{n}", _given(f"t{n - 1}")) for n in range(2, pii.ROUNDS + 1)
)
OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(_matches(k) for k in _KINDS)}),
placed AS (
  SELECT r, kind, m, (sum(gap + length(m)) OVER w - length(m))::BIGINT AS s
  FROM found WINDOW w AS (PARTITION BY r, kind ORDER BY i)
), runs AS (  -- a run behind a letter starts at its next group of digits
  SELECT r, kind, t, CASE WHEN behind THEN regexp_replace(m, '^[0-9]+[\x20().-]{{1,2}}', '') ELSE m END AS m,
    CASE WHEN behind THEN s + length(regexp_extract(m, '^[0-9]+[\x20().-]{{1,2}}')) ELSE s END AS s,
    behind AND NOT regexp_matches(m, '^[0-9]+[\x20().-]') AS none
  FROM (SELECT *, kind = 'cand' AND s > 0 AND regexp_matches(substr(t, s::BIGINT, 1), '[0-9A-Za-z]') AS behind
        FROM placed JOIN docs USING (r))
), wide AS (
  SELECT r, kind, t, m, s, s + length(m) AS e, regexp_replace(m, '[^0-9]+', '', 'g') AS digits
  FROM runs WHERE NOT none
), alone AS (
  SELECT *, coalesce(lag(e) OVER w, 0) AS lo, coalesce(lead(s) OVER w, length(t)) AS hi
  FROM wide
  WHERE (kind <> 'card' OR length(digits) >= 16)
    AND (kind <> 'cand' OR length(digits) >= 7 AND NOT regexp_matches(substr(t, (e + 1)::BIGINT, 1), '[0-9A-Za-z]'))
  WINDOW w AS (PARTITION BY r, kind ORDER BY s)
), words AS (
  SELECT r, kind, m, s, e, digits,
    lower(regexp_extract(substr(t, (lo + 1)::BIGINT, (s - lo)::BIGINT), '([^ \t\n\x0b\f\r]+)[ \t\n\x0b\f\r(+]*$', 1)) AS l,
    lower(regexp_extract(substr(t, (e + 1)::BIGINT, (hi - e)::BIGINT), '^[ \t\n\x0b\f\r)]*([^ \t\n\x0b\f\r]+)', 1)) AS rw
  FROM alone
), base AS (
  SELECT * FROM words WHERE kind = 'email'
    OR kind = 'ip' AND len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
        OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0
    OR kind = 'phone' AND length(digits) BETWEEN 8 AND 15
    OR kind = 'card' AND length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
        lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INTEGER
            ELSE 2 * substr(reverse(digits), i, 1)::INTEGER
                - CASE WHEN substr(reverse(digits), i, 1)::INTEGER > 4 THEN 9 ELSE 0 END END)) % 10 = 0
), cand AS (
  SELECT * FROM words c WHERE kind = 'cand'
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = c.r AND b.s < c.e AND c.s < b.e)
), occ AS (
  SELECT r, s, e, kind, CASE WHEN kind = 'cand' THEN '?' ELSE kind END || ':' || m AS value,
    unnest(CASE WHEN l = '' THEN [] WHEN rw = '' THEN [l || ' _'] ELSE [l || ' _', l || ' _ ' || rw] END) AS pattern
  FROM (SELECT * FROM base UNION ALL SELECT * FROM cand)
), edges AS (SELECT DISTINCT pattern, value, kind FROM occ),
sizes AS (SELECT pattern, count(*) FILTER (kind <> 'cand') AS n_seeds, count(*) FILTER (kind = 'cand') AS n_open
  FROM edges GROUP BY pattern),
fixed AS (SELECT pattern, kind, count(*) AS f FROM edges WHERE kind <> 'cand' GROUP BY pattern, kind),
open_edges AS (SELECT pattern, value FROM edges WHERE kind = 'cand'),
{_round('t1', 'SELECT pattern, kind, 0, 0 FROM fixed')},
{_ROUNDS},
extra AS (
  SELECT r, s, e, arg_max(kind, [trust::VARCHAR, kind]) AS kind
  FROM (SELECT o.r, o.s, o.e, trusted.kind, printf('%.6f', trusted.trust) AS trust
        FROM occ o JOIN trusted USING (pattern) WHERE o.kind = 'cand' AND trusted.trust >= {pii.TRUST})
  GROUP BY r, s, e
), spans AS (
  SELECT r, kind, s, e, true AS is_base FROM base UNION ALL SELECT r, kind, s, e, false FROM extra
), listed AS (
  SELECT r, list_position(['email', 'ip', 'card', 'phone'], kind) AS k, s, e, is_base,
    kind || ':' || s::BIGINT || ':' || e::BIGINT AS x FROM spans
), joined AS (
  SELECT r, string_agg(x, ',' ORDER BY k, s, e) AS spans, string_agg(x, ',' ORDER BY k, s, e) FILTER (is_base) AS base,
    count(*) FILTER (is_base AND k = 1) AS n_email, count(*) FILTER (is_base AND k = 2) AS n_ip,
    count(*) FILTER (is_base AND k = 3) AS n_card, count(*) FILTER (is_base AND k = 4) AS n_phone
  FROM listed GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""

# a byte of the CRC32 is eight steps
OP12 = """
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
), hexed AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM runs),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, k: xor(d >> 1, 3988292384 * (d & 1))))) AS h
    FROM hexed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
        FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)
), near AS (
    SELECT DISTINCT a.word, a.n, b.word AS form, b.n AS form_n FROM less a JOIN less b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY form_n DESC, form) AS k FROM near
), told AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.form_n >= 2 * w.n THEN r.form END AS form,
        CASE WHEN r.form_n >= 2 * w.n THEN r.form_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r USING (word)
), steps AS (
    SELECT word, form AS root FROM told WHERE form IS NOT NULL
    UNION ALL SELECT s.word, t.form FROM steps s JOIN told t ON t.word = s.root WHERE t.form IS NOT NULL
), last AS (SELECT s.word, s.root FROM steps s JOIN told t ON t.word = s.root WHERE t.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM told LEFT JOIN last USING (word)
"""

OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
), toks AS (
    SELECT r, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w
    FROM docs
), counts AS (
    SELECT lang, source, w, count(*) AS c, count(DISTINCT r) AS df FROM toks GROUP BY ALL
), kept AS (
    SELECT lang, w, sum(c)::BIGINT AS c FROM counts GROUP BY ALL HAVING sum(df) >= 3
), langs AS (
    SELECT lang, count(w) AS v, coalesce(sum(c), 0)::BIGINT AS n FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang)
    GROUP BY lang
), occurring AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
    SELECT o.lang, o.source, k.w, coalesce(x.c, 0) AS c, k.c AS all_c
    FROM occurring o JOIN kept k USING (lang) LEFT JOIN counts x USING (lang, source, w)
), groups AS (
    SELECT o.lang, o.source, coalesce(sum(c), 0)::BIGINT AS n FROM occurring o LEFT JOIN cells USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT c.lang, c.source, c.w, c.c,
        1 + 1000000000::HUGEINT * (c.c + 1) // (g.n + l.v) AS p, 1 + 1000000000::HUGEINT * (c.all_c + 1) // (l.n + l.v) AS q
    FROM cells c JOIN groups g USING (lang, source) JOIN langs l USING (lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.w = b.w AND a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', w, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES = {
    "op7_pii": OP7,
    "op10_chat_formatting": OP10,
    "op3_quality_rules": OP3,
    "op6_exact_dedup": OP6,
    "op12_spelling": OP12,
    "op13_divergence": OP13,
}
