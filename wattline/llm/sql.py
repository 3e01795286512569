"""DuckDB SQL that states the results of the queries which SQL can express."""

from __future__ import annotations

_WORDS = r"""regexp_extract_all(
    translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(text="text")} AS w FROM benchmark),
c AS (SELECT item, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
b AS (SELECT DISTINCT item, n, w[s:s + n - 1] AS win
      FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM c)),
lens AS (SELECT DISTINCT n FROM b),
p AS (SELECT r, n, s, w[s:s + n - 1] AS win
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
h AS (SELECT r, s, p.n, item FROM p JOIN b ON p.n = b.n AND p.win = b.win),
cov AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM h) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r)
"""

OP3 = """
WITH RECURSIVE n AS (
  SELECT source, count(*) AS n, sqrt(count(*)) AS t, CAST(ceil(count(*) / 16.0) AS BIGINT) AS b,
         row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM documents GROUP BY source),
a AS (SELECT source, i, b, greatest(1, CAST(floor(1099511627776 * t / sum(t) OVER () + 0.5) AS BIGINT)) AS m FROM n),
l AS (SELECT list(m ORDER BY i) AS m, list(b ORDER BY i) AS b FROM a),
sched AS (
  SELECT CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS t0, list_transform(b, lambda x: CAST(0 AS BIGINT)) AS ks,
         list_transform(b, lambda x: CAST(0 AS BIGINT)) AS base, CAST(NULL AS BIGINT) AS pick, m, b FROM l
  UNION ALL
  SELECT t + 1, CASE WHEN over THEN t + 1 ELSE t0 END, ks2, CASE WHEN over THEN ks2 ELSE base END, pick2, m, b
  FROM (SELECT *, ks2[pick2] = b[pick2] AS over
    FROM (SELECT *, list_transform(ks, lambda k, j: CASE WHEN j = pick2 THEN k + 1 ELSE k END) AS ks2
      FROM (SELECT *, CAST(list_min(list_filter(list_transform(range(1, len(m) + 1), lambda j:
              CASE WHEN ks[j] < b[j] AND (ks[j] - base[j]) * whole // m[j] <= t - t0
                   THEN ((ks[j] - base[j] + 1) * whole + m[j] - 1) // m[j] * 100000 + j END),
              lambda y: y IS NOT NULL)) % 100000 AS BIGINT) AS pick2
        FROM (SELECT *, CAST(list_sum(list_transform(m, lambda x, j: CASE WHEN ks[j] < b[j] THEN x ELSE 0 END)) AS HUGEINT)
                     AS whole FROM sched WHERE t < list_sum(b)))))),
slots AS (SELECT pick AS i, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k
          FROM sched WHERE t > 0),
r AS (SELECT doc_id, d.source, a.i, a.m,
             row_number() OVER (PARTITION BY a.i ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS nth
      FROM documents d JOIN a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, source, m / (SELECT CAST(sum(m) AS DOUBLE) FROM a) AS mix_share, CAST(nth // 16 AS BIGINT) AS mix_block,
       CAST(slot AS BIGINT) AS mix_slot, CAST(nth % 16 AS BIGINT) AS mix_pos
FROM r JOIN slots s ON s.i = r.i AND s.k = r.nth // 16
"""

OP10 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents),
g AS (SELECT DISTINCT r, w[s:s + least(5, len(w)) - 1] AS gram
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.r <> y.r GROUP BY 1, 2),
e AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least_id AS (SELECT a, min(doc_id) AS class_id FROM reach JOIN d ON d.r = b GROUP BY a),
links AS (SELECT a, count(*) AS k FROM e GROUP BY a)
SELECT doc_id, class_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links
FROM d JOIN least_id l ON l.a = d.r LEFT JOIN links k ON k.a = d.r
"""

OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS k,
             length('<|im_start|>') + length(role) + length(regexp_replace(role, '[^\\\n]', '', 'g'))
               + len(regexp_extract_all(role, '<\\*\|')) + 1
               + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1 AS size
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS upto FROM n)
SELECT conv_id, CAST(any_value(k) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = k) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""



def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's bytes, by half bytes."""
    steps = []
    for half in range(16):
        for _ in range(4):
            half = half >> 1 ^ (0xEDB88320 if half & 1 else 0)
        steps.append(str(half))
    halves = f"string_split(regexp_replace(hex({text}), '(.)(.)', '\\2\\1', 'g'), '')"
    return f"""CASE WHEN {text} = '' THEN 0 ELSE xor(4294967295, list_reduce(
        list_transform({halves}, lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT)),
        lambda crc, h: xor(CAST([{", ".join(steps)}][1 + (xor(crc, h) & 15)] AS BIGINT), crc >> 4), 4294967295)) END"""


def _edit(prefix: str, cost: str, edit: str, when: str = "true") -> str:
    """SQL for an audit prefix, written as its cost in ten digits and its edits, after one more edit."""
    return f"""CASE WHEN {when} THEN lpad(CAST(CAST({prefix}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0')
                 || {prefix}[11:] || '{edit}' END"""


def _audit_steps() -> tuple[str, str]:
    """SQL lists of the four states' best prefixes (nothing, system, user, assistant) after a turn, then after inserts."""
    n, s, u, a = (f"p[{i}]" for i in range(1, 5))
    live = "NOT must"
    kept = lambda role: f"{live} AND ini = '{role}'"
    after_u = [_edit(x, "2 + cut", "R", live) for x in (n, s, a)] + [_edit(x, "cut", "K", kept("u")) for x in (n, s, a)]
    turn = [
        _edit(n, "3", "D"),
        f"least({_edit(s, '3', 'D')}, {_edit(n, 'cut', 'K', kept('s'))})",
        f"least({_edit(u, '3', 'D')}, {', '.join(after_u)})",
        f"least({_edit(a, '3', 'D')}, {_edit(u, '2 + cut', 'R', live)}, {_edit(u, 'cut', 'K', kept('a'))})",
    ]
    to_u = f"least({u}, {', '.join(_edit(x, '2', 'I') for x in (n, s, a))})"
    inserted = [n, s, to_u, f"least({a}, {_edit(to_u, '2', 'I')})"]
    return f"[{', '.join(turn)}]", f"[{', '.join(inserted)}]"


_TURN, _INSERTED = _audit_steps()

OP11 = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, {_crc32("k")} % 20 AS h FROM c),
d AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM h WHERE h <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM d),
g AS (SELECT conv_id, turn, role, text, i, role[1:1] AS ini, tail = '' AS blank, tail <> '' AND nth > 1 AS dup,
             tail <> '' AND nth = 1 AND tail NOT IN ('.', '!', '?') AS trunc,
             lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair FROM f),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
                count(*) FILTER (trunc) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
                max(i) AS n FROM g GROUP BY conv_id),
walk AS (
  SELECT conv_id, n, CAST(0 AS BIGINT) AS i, p FROM (SELECT conv_id, n, {_INSERTED} AS p
    FROM (SELECT conv_id, n, ['0000000000', NULL, NULL, NULL] AS p FROM sums))
  UNION ALL
  SELECT conv_id, n, i, {_INSERTED} AS p
  FROM (SELECT w.conv_id, w.n, w.i + 1 AS i, {_TURN} AS p
        FROM (SELECT walk.*, ini, blank OR dup AS must, CAST(trunc AS BIGINT) AS cut
              FROM walk JOIN g ON walk.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i = walk.i + 1) w)),
done AS (SELECT conv_id, CAST(least(p[1], p[4])[1:10] AS BIGINT) AS cost, least(p[1], p[4])[11:] AS audit
         FROM walk WHERE i = n),
e AS (SELECT conv_id, k, audit[k] AS edit, length(replace(audit[1:k], 'I', '')) AS i,
             length(replace(audit[1:k], 'D', '')) AS place
      FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM done)),
r AS (SELECT e.conv_id, e.k, place, edit, text, role,
             max(CASE WHEN place = 1 AND edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
      FROM e LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id AND g.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'),
said AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role WHEN 'I' THEN own ELSE own END || ':'
                                    || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS said
         FROM (SELECT *, CASE WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END AS own FROM r)
         GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size,
         md5(coalesce(text, ''))[1:16] AS key, md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:16] AS tie FROM documents),
o AS (SELECT *, row_number() OVER (ORDER BY key, tie) - 1 AS nth,
             CAST(sum(size) OVER (ORDER BY key, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
             CAST(sum(size) OVER () AS BIGINT) AS total FROM d),
g AS (SELECT key, min(upto - size) AS g_start, max(upto) AS g_end, min(nth) AS g_first, max(nth) AS g_last FROM o GROUP BY key),
b AS (SELECT s, g.*, o.nth, o.upto - o.size AS start, o.upto, total,
             100 * 8 * (g_end - g_start) <= total AS whole
      FROM range(1, 8) t(s), o JOIN g USING (key) WHERE 8 * (upto - size) < s * total AND s * total <= 8 * upto),
c AS (SELECT s, CASE WHEN whole AND 16 * CAST(s AS BIGINT) * total < 64 * (g_start + g_end) THEN g_first
                     WHEN whole THEN g_last + 1
                     WHEN 16 * CAST(s AS BIGINT) * total < 64 * (start + upto) THEN nth ELSE nth + 1 END AS cut_at FROM b),
e AS (SELECT list(cut_at ORDER BY s) AS ats FROM (SELECT s, max(cut_at) OVER (ORDER BY s) AS cut_at FROM c)),
p AS (SELECT o.*, len(list_filter(ats, lambda x: x <= nth)) AS shard FROM o, e)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST({_crc32("text")} AS BIGINT) AS text_crc32, 'bytes' AS law,
       CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY nth) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""

OP13 = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
o AS (SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS g
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM p, range(1, 4) t(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND f >= 10),
h AS (SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail FROM c),
s AS MATERIALIZED (
  SELECT h.*, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM h JOIN f x ON x.lang = h.lang AND x.g = h.head JOIN f y ON y.lang = h.lang AND y.g = h.tail
  QUALIFY row_number() OVER (PARTITION BY h.lang, h.g ORDER BY score, cut) = 1),
inside AS (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM s WHERE k = 3),
most AS (SELECT lang, part, max(a) AS most FROM inside GROUP BY lang, part),
kept AS (SELECT s.* FROM s LEFT JOIN most m ON m.lang = s.lang AND m.part = s.g WHERE 100 * coalesce(most, 0) < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT kept.lang, CAST(row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, g) AS BIGINT) AS rank,
         g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM kept JOIN n ON n.lang = kept.lang)
WHERE rank <= 2000
"""

SQL = {
    "op6_chat_format": OP6,
    "op1_decontaminate": OP1,
    "op3_mix_sources": OP3,
    "op10_ngram_jaccard": OP10,
    "op11_conversation_repair": OP11,
    "op12_sampled_splitters": OP12,
    "op13_collocations": OP13,
}
