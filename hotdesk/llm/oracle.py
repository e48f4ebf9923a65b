"""SQL twins of the text queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

N_GRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 90 * (x.n + y.n - common.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
"""

_KEYWORD = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
_SECRET_KINDS = (
    ("assign", 0, _KEYWORD + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", 1, "AKIA[A-Z0-9]{16,}"),
    ("hex", 2, "[0-9a-f]{24,}"),
    ("live", 3, "[A-Za-z0-9+/_-]{20,}={0,2}"),
)


def _hits(kind: str, rank: int, pattern: str) -> str:
    value = f"regexp_extract(hit, '{pattern}', 2)" if kind == "assign" else "hit"
    return f"""
  SELECT doc_id, owner, '{kind}' AS kind, {rank} AS rank, hit, {value} AS value,
         coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, owner, h, p, unnest(range(1, len(h) + 1)) AS i, unnest(h) AS hit
        FROM (SELECT doc_id, owner, regexp_extract_all(body, '{pattern}', 0) AS h,
                     string_split_regex(body, '{pattern}') AS p FROM docs))"""


SECRETS = (
    """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(source, '') AS owner FROM documents),
hits AS ("""
    + "\n  UNION ALL".join(_hits(*kind) for kind in _SECRET_KINDS)
    + """),
found AS (
  SELECT doc_id, owner, kind, rank, value, start, start + length(hit) AS stop FROM hits
  WHERE CASE kind
    WHEN 'assign' THEN length(value) >= 6
    WHEN 'access' THEN true
    WHEN 'hex' THEN true
    ELSE len(regexp_extract_all(hit, '[0-9]')) >= 4
         AND len(regexp_extract_all(hit, '[A-Za-z]')) >= 4 AND len(list_distinct(string_split(hit, ''))) >= 10 END),
known AS (
  SELECT value, count(DISTINCT owner) <= 1 AS live
  FROM found GROUP BY value),
base AS (SELECT * FROM found WHERE kind <> 'live'),
shown AS (
  SELECT doc_id, kind, rank, start, stop FROM base
  UNION ALL
  SELECT doc_id, kind, rank, start, stop FROM found f JOIN known USING (value)
  WHERE kind = 'live' AND live AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = f.doc_id AND b.start < f.stop AND f.start < b.stop)),
per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'live') AS b,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS s
  FROM shown GROUP BY doc_id),
valued AS (
  SELECT doc_id, count(DISTINCT value) FILTER (live) AS live_values,
         count(DISTINCT value) FILTER (NOT live) AS example_values
  FROM found JOIN known USING (value) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans,
       coalesce(live_values, 0) AS live_values, coalesce(example_values, 0) AS example_values
FROM docs d LEFT JOIN per_doc USING (doc_id) LEFT JOIN valued USING (doc_id)
"""
)

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

#: The 16 values of the checksum's half-byte table (fixed values, CRC-32 of IEEE 802.3).
_CRC_TABLE = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
  3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""


def crc32(text: str) -> str:
    """DuckDB's expression for the unsigned CRC-32 of a text's UTF-8 bytes."""
    digits = f"hex(encode({text}))"
    half = f"strpos('0123456789ABCDEF', substr({digits}, i, 1)) - 1"
    # Of every byte the lower half comes first.
    halves = f"list_transform(range(1, length({digits}) + 1), lambda i: CAST({half.replace('i, 1', 'i + 2 * (i % 2) - 1, 1')} AS BIGINT))"
    step = f"xor(c >> 4, ({_CRC_TABLE})[CAST(xor(c & 15, b) AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {halves}), lambda c, b: {step}), 4294967295)"


def _edited(state: str, cost: str, edit: str) -> str:
    """A weight as text (cost in eight digits, then audit) with one more edit."""
    return f"printf('%08d', CAST(substr({state}, 1, 8) AS INTEGER) + {cost}) || substr({state}, 9) || '{edit}'"


REPAIRS = (
    r"""
WITH RECURSIVE hit AS (
  SELECT *, """
    + crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    + r""" % 20 AS fate FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
         ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit),
placed AS (
  SELECT *, row_number() OVER w AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au') AS odd
  FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
judged AS (
  SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
steps AS (SELECT *, fault IN ('blank', 'duplicate') AS bad, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
agenda AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '00000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '00000003I' AS s2,
    '00000006II' AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, t0, t1, t2, least(t3, """
    + _edited("t2", "3", "I")
    + """)
  FROM (
    SELECT conv_id, i, t0, t1, t3, least(u2, """
    + ", ".join(_edited(state, "3", "I") for state in ("t0", "t1", "t3"))
    + """) AS t2
    FROM (
      SELECT a.conv_id, n.i, {D0} AS t0,
        least({D1}, CASE WHEN NOT bad AND r = 's' THEN {K0} END) AS t1,
        least({D2}, CASE WHEN NOT bad THEN least({R0}, {R1}, {R3}) END,
              CASE WHEN NOT bad AND r = 'u' THEN least({K0}, {K1}, {K3}) END) AS u2,
        least({D3}, CASE WHEN NOT bad THEN {R2} END, CASE WHEN NOT bad AND r = 'a' THEN {K2} END) AS t3
      FROM agenda a JOIN steps n ON a.conv_id IS NOT DISTINCT FROM n.conv_id AND n.i = a.i + 1))),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal, max(i) AS n
  FROM steps GROUP BY conv_id),
solved AS (
  SELECT a.conv_id, t.* EXCLUDE (conv_id), least(s0, s3) AS best
  FROM agenda a LEFT JOIN totals t ON a.conv_id IS NOT DISTINCT FROM t.conv_id
  WHERE a.i = coalesce(t.n, 0)),
edits AS (
  SELECT conv_id, substr(best, 9) AS audit, unnest(range(1, length(best) - 7)) AS k FROM solved),
letters AS (
  SELECT conv_id, k, audit[k] AS edit,
    length(replace(audit[:k], 'I', '')) AS i, length(replace(audit[:k - 1], 'D', '')) AS place,
    length(replace(audit, 'D', '')) AS n FROM edits),
turns AS (
  SELECT l.conv_id, k,
    CASE WHEN edit = 'K' THEN s.role
         WHEN (n - place) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
    CASE WHEN edit = 'I' THEN '' ELSE s.text END AS text
  FROM letters l LEFT JOIN steps s ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND l.i = s.i WHERE edit <> 'D'),
texts AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY k) AS body FROM turns GROUP BY conv_id)
SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(best, 8) AS BIGINT) AS cost,
  substr(best, 9) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM solved s LEFT JOIN texts t ON s.conv_id IS NOT DISTINCT FROM t.conv_id
"""
)
for _edit, _cost in (("D", "4"), ("R", "3 + extra"), ("K", "extra")):
    for _state in "0123":
        REPAIRS = REPAIRS.replace(f"{{{_edit}{_state}}}", _edited(f"s{_state}", _cost, _edit))

def _written(text: str) -> str:
    return f"replace(replace(replace({text}, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>')"


CHATS = (
    r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
parts AS (
  SELECT *, coalesce(role, '') AS said,
    CASE WHEN turn IS NULL THEN '1' ELSE '0' || turn END AS p, CASE WHEN role IS NULL THEN '1' ELSE '0' || role END AS q
  FROM rows),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
    md5(length(p) || ',' || length(q) || ',' || p || q || text)) AS place FROM parts)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(said || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (said = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (said = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(replace("""
    + _written("said")
    + ", ':', '\\:')) + length("
    + _written("text")
    + """)) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
)

SPELLINGS = (
    r"""
WITH RECURSIVE found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM found GROUP BY id, run),
hashed AS (SELECT run, n, """
    + crc32("id || ':' || run")
    + r""" AS h FROM counted),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5),
own AS (SELECT word, word[:i] || '?' || word[i + 2:] AS l
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
asked AS (SELECT word, word[:i] || '?' || word[i + 1:] AS l
  FROM (SELECT word, unnest(range(0, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT asked.word AS a, own.word AS b FROM asked JOIN own USING (l)),
near AS (
  SELECT DISTINCT x.word AS a, y.word AS b FROM own x JOIN own y USING (l) WHERE x.word <> y.word
  UNION ALL SELECT a, b FROM longer UNION ALL SELECT b, a FROM longer),
best AS (
  SELECT a AS word, count(*) AS n_near, min({'least': -w.n, 'word': b}) AS best
  FROM near JOIN words w ON w.word = b GROUP BY a),
forms AS (
  SELECT w.word, CASE WHEN -best.least >= 2 * w.n THEN best.word END AS form, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.least >= 2 * w.n THEN -best.least END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
follow AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT f.word, g.form FROM follow f JOIN forms g ON g.word = f.root WHERE g.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(root, m) AS root FROM (
  SELECT follow.*, forms.n AS m FROM follow JOIN forms ON forms.word = follow.root) GROUP BY word) r USING (word)
"""
)

ORACLE = {
    "op2_ngram_jaccard_join": N_GRAM_JOIN,
    "op3_secret_ownership": SECRETS,
    "op10_exact_top_k": TOP_K,
    "op11_conversation_repair": REPAIRS,
    "op12_reply_trees": CHATS,
    "op13_spelling_variants": SPELLINGS,
}
