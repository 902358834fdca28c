"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


from millrace.llm.chat import CONTROL, MARK_TOKENS
from millrace.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, template_sets

WORD_GAP = r"[\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP2 = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM (SELECT unnest(range(256)) AS b))),
sized AS (
  SELECT doc_id, source, coalesce(text, '') AS body, octet_length(encode(coalesce(text, ''))) + 16 AS size FROM documents),
summed AS (
  SELECT doc_id, source, size,
    CASE WHEN size = 16 THEN 0 ELSE xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, (size - 15)::BIGINT), lambda i: ('0x' || hex_text[2 * i - 1 : 2 * i])::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) END AS text_crc32
  FROM (SELECT *, hex(encode(body)) AS hex_text FROM sized), crc_table),
keyed AS (
  SELECT *, coalesce('s' || source, 'n') AS sk, sha256('0:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || size) AS k FROM summed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sk ORDER BY k, doc_id) - 1 AS r, count(*) OVER (PARTITION BY sk) AS n FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n)::DOUBLE, sk, doc_id, text_crc32, size) - 1 AS pos, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, pos * 40 // total AS s FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, s::INTEGER AS shard,
  (pos - (s * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


def op3() -> str:
    between = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    sets = template_sets(TEMPLATES, THRESHOLD)
    listed = ", ".join(f"({k}, {quoted(label)}, [{', '.join(map(quoted, found))}], {need}, {reach})" for k, (label, found, need, reach) in enumerate(sets))
    here = " OR ".join("(" + " AND ".join(f"w[i + {k + 1}] = {quoted(x)}" for k, x in enumerate(p.split())) + ")" for p in PHRASES)
    label = "CASE " + " ".join(f"WHEN w[i + 1] = {quoted(p.split()[0])} THEN {quoted(name)}" for p, name in PHRASES.items()) + " END"
    return rf"""
WITH templates(t, label, tokens, need, reach) AS (VALUES {listed}),
texts AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
spelled AS (SELECT t, label, len(tokens) AS n, need, reach, unnest(tokens) AS word FROM templates),
said AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM (SELECT doc_id, list_filter(string_split_regex(t, '{between}'), lambda x: x <> '') AS w FROM texts)),
hits AS (SELECT * FROM said JOIN spelled USING (word)),
found AS (
  SELECT a.doc_id, a.label, count(DISTINCT b.word) / any_value(a.n) AS score
  FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND a.t = b.t AND b.i >= a.i AND b.i < a.i + a.reach
  GROUP BY a.doc_id, a.t, a.label, a.i HAVING count(DISTINCT b.word) >= any_value(a.need)),
best AS (SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score FROM found GROUP BY doc_id),
words AS (SELECT doc_id, list_filter(string_split_regex(t, '{between}'), lambda x: x <> '') AS w FROM texts),
placed AS (SELECT doc_id, w, list_filter(range(len(w)), lambda i: coalesce({here}, false)) AS starts FROM words),
labelled AS (SELECT *, list_distinct(list_transform(starts, lambda i: {label})) AS base FROM placed)
SELECT doc_id, len(w)::BIGINT AS n_words, len(starts)::BIGINT AS n_base, list_min(starts)::BIGINT AS first_word, list_max(starts)::BIGINT AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM labelled LEFT JOIN best USING (doc_id)
"""


def op6(budget: int = 1024, history: int = 256) -> str:
    history_turns = 2  # as the two lags below
    escaped = "replace(X, '\\', '\\\\')"
    for c in CONTROL:
        escaped = f"replace({escaped}, {quoted(c)}, {quoted(c[0] + chr(92) + c[1:])})"
    role = f"replace({escaped.replace('X', 'role')}, chr(10), '<\\N>')"
    return rf"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
counted AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {MARK_TOKENS} AS tokens,
    13 + length({role}) + 1 + length({escaped.replace("X", "text")}) + 10 AS chars,
    row_number() OVER o AS rn FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
before AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM counted),
ruled AS (
  SELECT *, min(rn) FILTER (role = 'system') OVER (PARTITION BY conv_id) AS srn,
    coalesce(lag(tokens, 1) OVER (PARTITION BY conv_id ORDER BY rn), 0) AS l1, coalesce(lag(tokens, 2) OVER (PARTITION BY conv_id ORDER BY rn), 0) AS l2 FROM before),
allowed AS (
  SELECT *, coalesce(max(tokens) FILTER (rn = srn) OVER (PARTITION BY conv_id), 0) AS stok FROM ruled),
roomy AS (
  SELECT *, {budget} - CASE WHEN l1 + l2 <= {history} THEN l1 + l2 WHEN l1 <= {history} THEN l1 ELSE 0 END - CASE WHEN srn < rn THEN stok ELSE 0 END AS room FROM allowed),
walk(cid, pos, win, used, left_room) AS (
  SELECT conv_id, rn, 0::BIGINT, tokens, room FROM roomy WHERE rn = 1
  UNION ALL
  SELECT conv_id, rn, win + (used + tokens > left_room)::BIGINT, CASE WHEN used + tokens > left_room THEN tokens ELSE used + tokens END, CASE WHEN used + tokens > left_room THEN room ELSE left_room END
  FROM walk JOIN roomy ON conv_id IS NOT DISTINCT FROM cid AND rn = pos + 1),
spanned AS (SELECT r.*, w.win FROM roomy r JOIN walk w ON r.conv_id IS NOT DISTINCT FROM w.cid AND r.rn = w.pos),
tailed AS (
  SELECT *, max(win) OVER (PARTITION BY conv_id) AS last_win, row_number() OVER b AS from_end, sum(tokens) OVER (b ROWS UNBOUNDED PRECEDING) AS tail
  FROM spanned WINDOW b AS (PARTITION BY conv_id, win ORDER BY rn DESC)),
copies AS (
  SELECT *, CASE WHEN rn = coalesce(srn, -1) THEN last_win - win
    WHEN from_end <= {history_turns} AND tail <= {history} AND win < last_win THEN 1 ELSE 0 END AS again FROM tailed)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(coalesce(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn), '')) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars * (1 + again))::BIGINT AS formatted_chars
FROM copies GROUP BY conv_id
"""


OP7 = rf"""
WITH words AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WORD_GAP}'), lambda x: x <> '') AS w FROM documents),
starts AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
later AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first FROM starts) WHERE doc_id > first),
places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
covered AS (
  SELECT p.doc_id, p.i, p.word, coalesce(max(l.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS UNBOUNDED PRECEDING) > p.i - 50, false) AS gone
  FROM places p LEFT JOIN later l ON p.doc_id = l.doc_id AND p.i = l.i),
kept AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP8 = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
counted AS (
  SELECT doc_id, list_filter(string_split_regex(t, '{WORD_GAP}'), lambda x: x <> '') AS w,
    length(regexp_replace(t, '{WORD_GAP}', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
places AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM counted),
threes AS (SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS again FROM threes),
covered AS (SELECT doc_id, again OR coalesce(lag(again, 1) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS inside FROM twice WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeats AS (SELECT doc_id, count(*) FILTER (inside) AS n FROM covered GROUP BY doc_id),
based AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_upper, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM counted LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM based)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines) OR 2 * n_upper > word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM judged
"""

#: CRC-32 of the bytes whose hex digits are X.
CRC = "CASE WHEN X = '' THEN 0 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(X) // 2 + 1), lambda i: ('0x' || X[2 * i - 1 : 2 * i])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) END"
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM (SELECT unnest(range(256)) AS b)))"""


def lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



OP11 = rf"""
WITH {CRC_TABLE},
texts AS (SELECT true AS source, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
words AS (
  SELECT source, row_number() OVER () AS r, doc_id, list_filter(string_split_regex({lower("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM texts),
places AS (SELECT source, r, unnest(range(len(w))) AS i, unnest(w) AS a FROM words),
pairs AS (SELECT *, lead(a) OVER (PARTITION BY r ORDER BY i) AS b FROM places),
features AS (SELECT source, r, a AS f FROM pairs UNION ALL SELECT source, r, a || ' ' || b FROM pairs WHERE b IS NOT NULL),
per_doc AS (SELECT source, r, f, count(*) AS n FROM features GROUP BY ALL),
distinct_f AS (SELECT f, coalesce(sum(n) FILTER (source), 0) AS s, coalesce(sum(n) FILTER (NOT source), 0) AS t FROM per_doc GROUP BY f),
hexed AS (SELECT f, s, t, lower(hex(encode(f))) AS h FROM distinct_f),
dictionary AS (SELECT f, hexed.s, hexed.t, ({CRC.replace("X", "h").replace("t[(", "crc_table.t[(")}) % 10000 AS bucket FROM hexed, crc_table),
buckets AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM dictionary GROUP BY bucket),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM dictionary),
gains AS (
  SELECT bucket, floor(1000 * ln((b.t::DOUBLE + 1) * (a.s::DOUBLE + 10000) / ((b.s::DOUBLE + 1) * (a.t::DOUBLE + 10000))))::BIGINT AS gain FROM buckets b, totals a),
summed AS (SELECT r, sum(n * gain)::BIGINT AS total FROM per_doc JOIN dictionary USING (f) JOIN gains USING (bucket) WHERE source GROUP BY r),
weighed AS (
  SELECT doc_id, len(w) AS n_words, greatest(2 * len(w) - 1, 0)::BIGINT AS n_features, coalesce(total, 0) AS total,
    ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT AS h FROM words LEFT JOIN summed USING (r) WHERE source),
scored AS (
  SELECT *, CASE WHEN n_features = 0 THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight FROM weighed),
ordered AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM ordered)
SELECT doc_id, n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END::BIGINT AS rank FROM ranked
"""


def op12() -> str:
    field = "CASE WHEN X IS NULL THEN '-' ELSE octet_length(encode(X::VARCHAR)) || ':' || X END"
    leaf = lambda text: "sha256(" + " || ".join(f"({field.replace('X', c)})" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    grow = "SELECT g, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM X WHERE n > 1 GROUP BY g, lvl, n, pos // 8"
    runs = "SELECT g, lvl, pos // 8 AS up, list(digest ORDER BY pos) AS run FROM X WHERE n > 1 GROUP BY g, lvl, pos // 8"
    step = "lvl + 1, f.pos // 8, proof || array_to_string(list_concat(run[: f.pos % 8], run[f.pos % 8 + 2 :]), ''), sha256(array_to_string(list_concat(run[: f.pos % 8], [acc], run[f.pos % 8 + 2 :]), ''))"
    return rf"""
WITH RECURSIVE {CRC_TABLE},
marked AS (
  SELECT *, CASE WHEN ({CRC.replace("X", "hex(encode(doc_id::VARCHAR))")}) % 3 = 0 THEN {lower("text")} ELSE text END AS altered FROM documents, crc_table),
leaves AS (SELECT doc_id, coalesce('+' || lang, '') AS g, {leaf("text")} AS leaf, {leaf("altered")} AS other FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
numbered AS (SELECT *, row_number() OVER (ORDER BY g, pos) AS r FROM placed),
up(g, lvl, pos, n, digest) AS (SELECT g, 0, pos, n, leaf FROM placed UNION ALL {grow.replace("X", "up")}),
tops AS (SELECT g, digest FROM up WHERE n = 1),
langs AS (SELECT g AS lang_key, digest, '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM tops),
crown(g, lvl, pos, n, digest) AS (SELECT g, 0, pos, n, digest FROM langs UNION ALL {grow.replace("X", "crown")}),
runs AS ({runs.replace("X", "up")}),
crown_runs AS ({runs.replace("X", "crown")}),
path(r, g, lvl, pos, proof, acc) AS (
  SELECT r, g, 0, pos, '', other FROM numbered
  UNION ALL SELECT f.r, f.g, {step.replace("lvl", "f.lvl", 1)} FROM path f JOIN runs ON runs.g = f.g AND runs.lvl = f.lvl AND runs.up = f.pos // 8),
halfway AS (SELECT r, arg_max(proof, lvl) AS proof, arg_max(acc, lvl) AS acc FROM path GROUP BY r),
above(r, lvl, pos, proof, acc) AS (
  SELECT h.r, 0, l.pos, h.proof, h.acc FROM halfway h JOIN numbered USING (r) JOIN langs l ON l.lang_key = numbered.g
  UNION ALL SELECT f.r, {step.replace("lvl", "f.lvl", 1)} FROM above f JOIN crown_runs c ON c.lvl = f.lvl AND c.up = f.pos // 8),
whole AS (SELECT r, arg_max(proof, lvl) AS proof, arg_max(acc, lvl) AS acc FROM above GROUP BY r)
SELECT doc_id, leaf, tops.digest AS subroot, crown.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = crown.digest AS verified
FROM numbered JOIN whole USING (r) JOIN tops ON tops.g = numbered.g JOIN crown ON crown.n = 1
"""


ORACLE_SQL = {
    "op2_sharding": OP2, "op3_license_scan": op3(), "op6_chat_windows": op6(), "op7_substring_dedup": OP7, "op8_quality_rules": OP8,
    "op11_importance_resampling": OP11, "op12_merkle_manifest": op12(),
}
