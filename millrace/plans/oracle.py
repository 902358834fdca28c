"""DuckDB SQL for the queries of the registry."""

from __future__ import annotations

from millrace.plans.inputs import SQL_BLANKS, SQL_BOILERPLATE, SQL_FRONT, SQL_HEADERS

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def digest(text: str, rest: str = "FROM documents") -> str:
    return f"SELECT doc_id, length({text})::BIGINT AS n_chars, md5({text}) AS digest {rest}"


def over(source: str, text: str) -> str:
    """A digest of an expression over ``t``, the given text."""
    return digest(text, f"FROM (SELECT doc_id, {source} AS t FROM documents)")


def normalized(t: str) -> str:
    ends = f"regexp_replace({t}, '[ \\t\\r\\x0b\\x0c]+(\\n|$)', '\\1', 'g')"
    runs = f"regexp_replace(regexp_replace({ends}, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '^\\n{{3,}}', chr(10) || chr(10))"
    return f"CASE WHEN {runs} = '' THEN '' ELSE rtrim({runs}, {SPACES}) || chr(10) END"


def section(t: str, inclusive: bool, start: str = "<<BEGIN>>", end: str = "<<END>>", source: str = "documents") -> str:
    """Lines outside sections, by the last pure marker line and the parity of lines that hold both."""
    marker_kept = "false" if inclusive else "true"
    return f"""
lines AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS l FROM (SELECT doc_id, string_split({t}, chr(10)) AS a FROM {source})),
marks AS (SELECT *, contains(l, '{start}') AS s, contains(l, '{end}') AS e FROM lines),
pure AS (SELECT *, max(CASE WHEN s <> e THEN i END) OVER w AS last_pure FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
known AS (SELECT p.*, coalesce(m.s, false) AS opened FROM pure p LEFT JOIN marks m ON p.doc_id = m.doc_id AND p.last_pure = m.i),
turned AS (SELECT *, (count(*) FILTER (s AND e) OVER (PARTITION BY doc_id, last_pure ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) % 2 = 1 AS odd FROM known),
state AS (SELECT *, opened <> odd AS inside FROM turned),
kept AS (SELECT *, CASE WHEN NOT inside AND s THEN {marker_kept} WHEN inside AND e THEN {marker_kept} ELSE NOT inside END AS keep FROM state),
cut AS (SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (keep), '') AS t FROM kept GROUP BY doc_id)"""


def repeated(t: str, p: str, keep: str) -> str:
    parts = f"string_split({t}, '{p}')"
    some = {
        "first": f"{parts}[1] || '{p}' || array_to_string({parts}[2:], '')",
        "last": f"array_to_string({parts}[:-2], '') || '{p}' || {parts}[-1]",
        "none": f"array_to_string({parts}, '')",
    }[keep]
    return f"CASE WHEN len({parts}) > 2 THEN {some} ELSE {t} END"


def removed_k(t: str, p: str, k: int) -> str:
    for _ in range(k):
        t = f"(SELECT CASE WHEN strpos(x, '{p}') > 0 THEN left(x, strpos(x, '{p}') - 1) || substr(x, strpos(x, '{p}') + {len(p)}) ELSE x END FROM (SELECT {t} AS x))"
    return t


HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"
PATH = r"regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*', ''), ';[^/]*$', '')"
QUERY = r"regexp_extract(url, '\?([^#]+)', 1)"
CANONICAL = f"lower(split_part(url, '://', 1)) || '://' || {HOST} || {PATH} || CASE WHEN {QUERY} = '' THEN '' ELSE '?' || {QUERY} END"
FILE = f"replace({HOST}, 'www.', '') || CASE WHEN trim({PATH}, '/') = '' THEN '' ELSE '_' || replace(trim({PATH}, '/'), '/', '_') END || '.md'"

LINKS = f"""
found AS (SELECT DISTINCT url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS href FROM pages),
target AS (SELECT url AS page, split_part(url, '://', 1) || '://' || {HOST} || href AS url FROM found),
links AS (SELECT DISTINCT page, {CANONICAL} AS link FROM target)"""

CHUNKS = f"""
steps(doc_id, t, cur, n, start, piece) AS (
  SELECT doc_id, t, 0, 0, NULL::INTEGER, NULL::VARCHAR FROM source WHERE trim(t, {SPACES}) <> ''
  UNION ALL
  SELECT doc_id, t, CASE WHEN last THEN length(t) WHEN header THEN cur + p ELSE greatest(cur + p - 150, cur + 1) END, n + emit::INTEGER, CASE WHEN emit THEN cur END, CASE WHEN emit THEN body END
  FROM (
    SELECT *, body <> '' AND (last OR n = 0 OR length(body) >= 400) AS emit
    FROM (
      SELECT *, trim(CASE WHEN last THEN rem ELSE substr(rem, 1, p) END, {SPACES}) AS body
      FROM (
        SELECT *, CASE WHEN header THEN greatest(up, low) ELSE coalesce(
            CASE WHEN para > mp THEN para + 2 END, CASE WHEN dot > mp THEN dot + 2 END, CASE WHEN bang > mp THEN bang + 2 END, CASE WHEN ask > mp THEN ask + 2 END,
            CASE WHEN comma > mp THEN comma + 2 END, CASE WHEN gap > mp THEN gap + 1 END, 1200) END AS p
        FROM (
          SELECT *, up > mp OR (mp = 0 AND low > 0) AS header FROM (
            SELECT doc_id, t, cur, n, rem, length(rem) <= 1200 AS last, CASE WHEN n = 0 THEN 400 ELSE 0 END AS mp,
              CASE WHEN greatest({{up}}) > CASE WHEN n = 0 THEN 400 ELSE 0 END THEN greatest({{up}}) ELSE 0 END AS up,
              CASE WHEN n > 0 AND greatest({{up}}) <= 0 THEN greatest({{low}}) ELSE 0 END AS low,
              {{rfind}}
            FROM (SELECT *, substr(t, cur + 1) AS rem, substr(t, cur + 1, 1200) AS w FROM steps WHERE cur < length(t))))))))"""


def last_header(k: int) -> str:
    window = f"substr(rem, 1, {1200 + k + 1})"
    pattern = f"'(?s)^(.*)\\n{'#' * k} [^\\n]'"
    return f"CASE WHEN regexp_matches({window}, {pattern}) THEN length(regexp_extract({window}, {pattern}, 1)) + 1 ELSE 0 END"


def rfind(mark: str, name: str) -> str:
    return f"CASE WHEN contains(w, {mark}) THEN length(w) - strpos(reverse(w), reverse({mark})) - length({mark}) + 1 ELSE -1 END AS {name}"


def chunks(source: str) -> str:
    """A recursive query that walks through the texts ``t`` of ``source``."""
    marks = [("chr(10) || chr(10)", "para"), ("'. '", "dot"), ("'! '", "bang"), ("'? '", "ask"), ("', '", "comma"), ("' '", "gap")]
    steps = CHUNKS.replace("{up}", ", ".join(map(last_header, (1, 2, 3)))).replace("{low}", ", ".join(map(last_header, (4, 5, 6)))).replace("{rfind}", ", ".join(rfind(*m) for m in marks))
    return f"source AS ({source}), {steps}, chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS chunk_index, start, piece FROM steps WHERE piece IS NOT NULL)"


HEADED = f"SELECT doc_id, {SQL_HEADERS} AS t FROM documents"
HEADERS = r"""
rows AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS l FROM (SELECT doc_id, string_split(t, chr(10)) AS a FROM source)),
placed AS (SELECT doc_id, l, coalesce(sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM rows),
headers AS (SELECT doc_id, start, length(regexp_extract(l, '^(#+) ', 1)) AS level, trim(ltrim(l, '#')) AS title FROM placed WHERE regexp_matches(l, '^#{1,3} .'))"""
SECTIONS = """
met AS (SELECT c.doc_id, c.chunk_index, h.level, arg_max(h.title, h.start) AS title FROM chunks c JOIN headers h ON h.doc_id = c.doc_id AND h.start <= c.start GROUP BY ALL),
paths AS (SELECT doc_id, chunk_index, string_agg(title, ' > ' ORDER BY level) AS path, count(*) AS levels FROM met GROUP BY ALL)"""
WORDS = r"len(regexp_extract_all({0}, '[^ \t\n\r\x0b\x0c]+'))"

SCRAPED = f"SELECT doc_id, {SQL_FRONT} || {SQL_HEADERS} AS t FROM documents"
FRONT = r"""
split AS (SELECT doc_id, t, regexp_extract(t, '(?s)^---\n(.*?)\n---\n(.*)$', 1) AS block, regexp_extract(t, '(?s)^---\n(.*?)\n---\n(.*)$', 2) AS body FROM source),
fields AS (SELECT *, regexp_extract(block, '(?m)^original_url: (.*)$', 1) AS original_url, regexp_extract(block, '(?m)^title: (.*)$', 1) AS title FROM split)"""

QUESTIONS = f"""WITH RECURSIVE {chunks(HEADED)}, {HEADERS}, {SECTIONS},
questions AS (
  SELECT c.doc_id, c.chunk_index::INTEGER AS chunk_index, c.piece AS question, d.source || '/' || c.doc_id || '_' || lpad(c.chunk_index::VARCHAR, 4, '0') || '.md' AS chunk_path,
    sha256(d.source || '/' || c.doc_id || '.md#' || c.chunk_index) AS chunk_id, CASE WHEN c.doc_id % 3 = 0 THEN 'interview_question' ELSE 'synthetic' END AS source_type,
    'https://' || d.source || '.example.com/' || c.doc_id AS source_url, p.path, coalesce(l.quality, -1) AS quality
  FROM chunks c JOIN documents d USING (doc_id) LEFT JOIN paths p ON p.doc_id = c.doc_id AND p.chunk_index = c.chunk_index LEFT JOIN labels l ON l.doc_id = c.doc_id),
reviewed AS (SELECT *, CASE WHEN quality = 1 THEN 'approved' WHEN quality = 0 THEN 'rejected' WHEN source_type = 'interview_question' THEN 'approved' END AS status FROM questions)"""

APPROVED = f"{QUESTIONS}, ids AS (SELECT *, 'q_' || lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INTEGER, '0') AS question_id FROM (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_index) AS n FROM reviewed WHERE status IN ('approved', 'edited')))"

ORACLE_SQL: dict[str, str] = {
    "url_parts": f"SELECT page_id, {HOST} AS authority, {PATH} AS path, replace({HOST}, 'www.', '') AS domain FROM pages",
    "url_canonical": f"SELECT page_id, {CANONICAL} AS canonical FROM pages",
    "clean_filename": f"SELECT page_id, {FILE} AS file FROM pages",
    "filename_collisions": f"SELECT page_id, file FROM (SELECT page_id, {FILE} AS file, row_number() OVER (PARTITION BY {FILE} ORDER BY page_id DESC) AS r FROM pages) WHERE r = 1",
    "link_extract": f"WITH {LINKS} SELECT page AS url, link FROM links",
    "link_admission": f"""WITH {LINKS}, judged AS (
      SELECT DISTINCT link, CASE WHEN link LIKE '%/the%' OR regexp_matches(link, '^https://.*[.]net/[a-c].*$') THEN 'pattern' WHEN length(link) > 40 THEN 'hop' WHEN length(link) % 5 = 0 THEN 'known' ELSE 'new' END AS reason FROM links)
      SELECT reason, count(*)::BIGINT AS n FROM judged GROUP BY reason""",
    "crawl_hops": """WITH RECURSIVE edges AS (
        SELECT page_id AS a, (2 * page_id + 1) % n AS b FROM pages, (SELECT count(*) AS n FROM pages) UNION SELECT page_id, (3 * page_id + 7) % n FROM pages, (SELECT count(*) AS n FROM pages)),
      walk(id, hop) AS (SELECT x, 0 FROM (VALUES (0), (5)) v(x) UNION SELECT b, hop + 1 FROM walk JOIN edges ON a = id WHERE hop < 4 AND NOT regexp_matches('https://n/' || b, '^https://n/.*9$'))
      SELECT 'https://n/' || id AS url, min(hop)::INTEGER AS hop FROM walk GROUP BY id""",
    "html_strip_script": "SELECT page_id, md5(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', '', 'g'), '(?is)<style\\b.*?</style\\s*>', '', 'g')) AS digest FROM pages",
    "html_title": "SELECT page_id, replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS title FROM pages",
    "collapse_blank_lines": f"""SELECT doc_id, length(t)::BIGINT AS n_chars, md5(t) AS digest FROM (
      SELECT doc_id, array_to_string(list_filter(a, lambda x, i: NOT (trim(x, {SPACES}) = '' AND i > 1 AND trim(a[i - 1], {SPACES}) = '')), chr(10)) AS t FROM (SELECT doc_id, string_split({SQL_BLANKS}, chr(10)) AS a FROM documents))""",
    "normalize_whitespace": over(SQL_BLANKS, normalized("t")),
    "rule_exact_all": over("text", "replace(t, ' the ', '')"),
    "rule_exact_k": over("text", removed_k("t", "the", 3)),
    "rule_regex_all": over("text", "regexp_replace(t, '(?i)\\bTH[AE]\\b', '', 'g')"),
    "rule_regex_k": over("text", "regexp_replace(regexp_replace(t, '[aeiou]{2}', ''), '[aeiou]{2}', '')"),
    "rule_section_incl": f"WITH {section(SQL_BOILERPLATE, True)} {digest('t', 'FROM cut')}",
    "rule_section_excl": f"WITH {section(SQL_BOILERPLATE, False)} {digest('t', 'FROM cut')}",
    "rule_section_null": digest("text"),
    "rule_line": over(SQL_BOILERPLATE, "array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT regexp_matches(x, '^\\[Read more\\]|(?i)LOGGED')), chr(10))"),
    "rule_repeat_first": over("text", repeated("t", ", ", "first")),
    "rule_repeat_last": over("text", repeated("t", ", ", "last")),
    "rule_repeat_none": over("text", repeated("t", ", ", "none")),
}

CLEANED = f"""boiled AS (SELECT doc_id, array_to_string(list_filter(string_split({SQL_BOILERPLATE}, chr(10)), lambda x: NOT regexp_matches(x, '^\\[Read more\\]\\(.*\\)$')), chr(10)) AS b FROM documents),
{section("b", True, source="boiled")},
worded AS (SELECT doc_id, {removed_k("regexp_replace(t, '(?i) you are not logged in', '', 'g')", " the ", 2)} AS t FROM cut),
ruled AS (SELECT doc_id, {repeated("t", ", ", "first")} AS t FROM worded),
cleaned AS (SELECT r.doc_id, {normalized("t")} AS cleaned, o.original FROM ruled r JOIN (SELECT doc_id, {SQL_BOILERPLATE} AS original FROM documents) o USING (doc_id)),
report AS (
  SELECT *, length(original) AS a, length(cleaned) AS b, CASE WHEN length(original) > 0 THEN (length(original) - length(cleaned)) / length(original)::DOUBLE * 100 ELSE 0 END AS share FROM cleaned),
warned AS (
  SELECT *, list_filter([CASE WHEN share > 75 THEN printf('Warning: %.1f%% of content removed (>75%%)', share) END,
    CASE WHEN contains(original, '# ') AND NOT contains(cleaned, '# ') THEN 'Warning: All H1 headers were removed' END,
    CASE WHEN length(trim(cleaned, {SPACES})) < 100 THEN 'Warning: Cleaned content is very short (' || length(cleaned) || ' chars)' END], lambda x: x IS NOT NULL) AS warnings FROM report)"""

ORACLE_SQL |= {
    "clean_pipeline": f"WITH {CLEANED} {digest('cleaned', 'FROM cleaned')}",
    "clean_report": f"WITH {CLEANED} SELECT doc_id, a::BIGINT AS original_chars, b::BIGINT AS cleaned_chars, (a - b)::BIGINT AS removed_chars, round(share, 4) AS reduction_percent, original <> cleaned AS content_changed FROM report",
    "clean_warnings": f"WITH {CLEANED} SELECT doc_id, regexp_replace(unnest(warnings), '[0-9]+[.][0-9]%', 'N%') AS warning FROM warned",
    "clean_summary": f"""WITH {CLEANED} SELECT count(*)::BIGINT AS files_processed, count(*) FILTER (original <> cleaned)::BIGINT AS files_cleaned, sum(a - b)::BIGINT AS removed_chars,
      round(sum(a - b) * 100.0::DOUBLE / sum(a), 4) AS reduction_percent, count(*) FILTER (len(warnings) > 0)::BIGINT AS files_with_warnings FROM warned""",
    "clean_delete": "SELECT doc_id, 'page_' || doc_id || '.md' AS file FROM documents WHERE doc_id NOT IN (3, 14) AND NOT regexp_matches('page_' || doc_id || '.md', '^page_.*7[.]md$|^page_1.[.]md$')",
    "clean_preview": f"""WITH {CLEANED}, pair AS (SELECT doc_id, string_split(original, chr(10)) AS o, string_split(cleaned, chr(10)) AS n FROM cleaned),
      differ AS (SELECT doc_id, o, unnest(list_filter(range(least(len(o), len(n))), lambda i: o[i + 1] <> n[i + 1])[1:5]) AS line FROM pair),
      shown AS (SELECT doc_id, o, line, unnest(range(greatest(0, line - 3), least(len(o), line + 4))) AS place FROM differ)
      SELECT doc_id, line::INTEGER AS line, place::INTEGER AS place, CASE WHEN place = line THEN '- ' ELSE '  ' END || left(o[place + 1], 100) AS shown FROM shown""",
    "domain_detect": "SELECT doc_id, source || '.example.com' AS domain FROM documents",
    "ruleset_lookup": "SELECT doc_id, CASE source WHEN 'src0' THEN 'src0.example.com' WHEN 'src1' THEN 'src1.example' END AS rule_set FROM documents",
    "frontmatter_split": f"WITH source AS ({SCRAPED}), {FRONT} SELECT doc_id, block, md5(body) AS body_digest FROM fields",
    "frontmatter_lenient": f"WITH source AS ({SCRAPED}), {FRONT} SELECT doc_id, original_url, '2025-01-01' AS scrape_date, title FROM fields",
    "frontmatter_merge": f"WITH source AS ({SCRAPED}), {FRONT} SELECT doc_id, original_url, 'new ' || doc_id AS title, 'x' AS extra FROM fields",
    "chunk_smart": f"WITH RECURSIVE {chunks('SELECT doc_id, text AS t FROM documents')} SELECT doc_id, chunk_index::INTEGER AS chunk_index, start::INTEGER AS start, md5(piece) AS digest FROM chunks",
    "chunk_smart_headers": f"WITH RECURSIVE {chunks(HEADED)} SELECT doc_id, chunk_index::INTEGER AS chunk_index, start::INTEGER AS start, md5(piece) AS digest FROM chunks",
    "chunk_counts": f"WITH RECURSIVE {chunks(HEADED)} SELECT doc_id, count(*)::BIGINT AS n_chunks, sum(length(piece))::BIGINT AS n_chars FROM chunks GROUP BY doc_id",
    "chunk_headers": f"WITH source AS ({HEADED}), {HEADERS} SELECT doc_id, start::INTEGER AS start, level::INTEGER AS level, title FROM headers",
    "chunk_sections": f"WITH RECURSIVE {chunks(HEADED)}, {HEADERS}, {SECTIONS} SELECT c.doc_id, c.chunk_index::INTEGER AS chunk_index, coalesce(path, '') AS section_path, coalesce(levels, 0)::INTEGER AS section_level FROM chunks c LEFT JOIN paths p ON p.doc_id = c.doc_id AND p.chunk_index = c.chunk_index",
    "chunk_metadata": f"""WITH RECURSIVE {chunks(HEADED)}, {HEADERS}, {SECTIONS} SELECT c.doc_id, c.chunk_index::INTEGER AS chunk_index, sha256(d.source || '/' || c.doc_id || '.md#' || c.chunk_index) AS chunk_id,
      c.doc_id || '_' || lpad(c.chunk_index::VARCHAR, 4, '0') || '.md' AS chunk_file, count(*) OVER (PARTITION BY c.doc_id)::BIGINT AS total_chunks, length(piece)::BIGINT AS char_count, {WORDS.format("piece")}::BIGINT AS word_count,
      coalesce(path, '') AS section_path, coalesce(levels, 0)::INTEGER AS section_level
      FROM chunks c JOIN documents d USING (doc_id) LEFT JOIN paths p ON p.doc_id = c.doc_id AND p.chunk_index = c.chunk_index""",
    "slugify": "SELECT p_partkey, CASE WHEN s = '' THEN 'chunk' ELSE s END AS slug FROM (SELECT p_partkey, trim(regexp_replace(regexp_replace(replace(lower(trim(p_name)), ' ', '-'), '[^a-zA-Z0-9._-]+', '-', 'g'), '-{2,}', '-', 'g'), '-') AS s FROM part)",
    "breadcrumb": "SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE lang || ' > ' || source END AS breadcrumb FROM documents",
    "merge_rows": f"""WITH source AS ({SCRAPED}), {FRONT} SELECT doc_id || '.md' AS chunk_file, original_url, '2025-01-01' AS scrape_date, title, 0::INTEGER AS chunk_index, length(trim(body, {SPACES}))::BIGINT AS n_chars, md5(trim(body, {SPACES})) AS digest FROM fields""",
    "merge_rescue": f"WITH source AS ({SCRAPED}), {FRONT} SELECT doc_id || '.md' AS chunk_file, original_url, title FROM fields",
    "merge_summary": f"WITH source AS ({SCRAPED}), {FRONT} SELECT count(*)::BIGINT AS chunks, sum(length(trim(body, {SPACES})))::BIGINT AS total_chars, sum({WORDS.format('body')})::BIGINT AS total_words, count(DISTINCT original_url)::BIGINT AS unique_urls FROM fields",
    "qa_extract": f"""WITH RECURSIVE {chunks(HEADED)}, {HEADERS}, {SECTIONS}, told AS (SELECT c.doc_id, c.chunk_index, c.piece, regexp_replace(p.path, 'T', 'What is T') AS path FROM chunks c LEFT JOIN paths p ON p.doc_id = c.doc_id AND p.chunk_index = c.chunk_index)
      SELECT doc_id, chunk_index::INTEGER AS chunk_index, split_part(path, ' > ', 1) AS question FROM told WHERE doc_id % 3 = 0 AND contains(path, 'What is') AND {WORDS.format("piece")} > 30""",
    "qa_sample": "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 ORDER BY md5('42:p/' || doc_id), 'p/' || doc_id LIMIT 50",
    "qa_prompt": f"""SELECT doc_id, md5('Write 3 questions that the following passage answers best.' || chr(10) || chr(10) || 'Source: ' || source || chr(10) || 'Section: ' || CASE WHEN doc_id % 2 = 0 THEN lang || ' > ' || source ELSE 'No section' END || chr(10) || 'Title: Unknown' || chr(10) || chr(10) || 'Passage:' || chr(10) || text || chr(10) || chr(10) ||
      'The passage alone must answer each question. Ask as a reader would, of several kinds (facts, steps, ideas, faults), and don''t speak of the passage. Reply with a JSON array of strings only.') AS digest FROM documents WHERE {WORDS.format("text")} >= 20""",
    "qa_response_parse": "SELECT * FROM (VALUES (0, 'a|b'), (1, 'c'), (2, 'd'), (3, 'a'), (4, ''), (5, ''), (6, '')) v(id, questions)",
    "qa_number": f"""{QUESTIONS} SELECT doc_id, chunk_index, parse_filename(chunk_path, true) || '_' || lpad(n::VARCHAR, 3, '0') || '.md' AS qa_file FROM (SELECT *, row_number() OVER (PARTITION BY parse_filename(chunk_path, true) ORDER BY chunk_path, question) AS n FROM questions)""",
    "qa_summary": f"{QUESTIONS} SELECT count(*)::BIGINT AS total, count(DISTINCT chunk_path)::BIGINT AS unique_chunks, count(DISTINCT source_url)::BIGINT AS unique_urls FROM questions",
    "qa_by_type": f"{QUESTIONS} SELECT source_type, count(*)::BIGINT AS n FROM questions GROUP BY source_type",
    "review_pending": f"{QUESTIONS} SELECT doc_id, chunk_index FROM reviewed WHERE status IS NULL",
    "review_apply": f"{QUESTIONS} SELECT doc_id, chunk_index, CASE WHEN quality = 1 THEN 'approved' WHEN quality = 0 THEN 'rejected' END AS status, quality >= 0 AS reviewed FROM questions",
    "review_auto": f"{QUESTIONS} SELECT doc_id, chunk_index, status, status IS NOT NULL AS reviewed FROM reviewed",
    "review_stats": f"""{QUESTIONS} SELECT count(*)::BIGINT AS total, count(status)::BIGINT AS reviewed, (count(*) - count(status))::BIGINT AS pending, count(*) FILTER (status = 'approved')::BIGINT AS approved, 0::BIGINT AS edited,
      count(*) FILTER (status = 'rejected')::BIGINT AS rejected, round(count(status) * 100.0::DOUBLE / count(*), 4) AS reviewed_percent FROM reviewed""",
    "export_json": f"{APPROVED} SELECT question_id, question, chunk_id AS expected_chunk_id, chunk_path AS expected_chunk_path, source_url, coalesce(path, '') AS section_path, source_type, status FROM ids",
    "export_jsonl": f"{APPROVED} SELECT question_id, md5(question) AS digest, chunk_id AS expected_chunk_id, source_url FROM ids",
    "export_csv": f"""{APPROVED} SELECT question_id || ',' || CASE WHEN regexp_matches(question, '[",\\r\\n]') THEN '"' || replace(question, '"', '""') || '"' ELSE question END || ',' || chunk_id || ',' || parse_filename(chunk_path) || ',' || source_url || ',' || source_type AS line FROM ids""",
    "export_trec": f"{APPROVED} SELECT question_id || ' 0 ' || chunk_id || ' 1' AS line FROM ids",
    "export_report": f"""{APPROVED} SELECT md5('### Q' || substr(question_id, 3) || ': ' || question || chr(10) || chr(10) || '- **Chunk**: `' || parse_filename(chunk_path) || '`' || chr(10) || '- **Source**: ' || source_url || chr(10) || '- **Type**: ' || source_type || chr(10) ||
      CASE WHEN path IS NULL THEN '' ELSE '- **Section**: ' || path || chr(10) END || chr(10)) AS digest FROM ids""",
    "export_report_head": f"{APPROVED} SELECT source_type, '- ' || source_type || ': ' || count(*) AS line FROM ids GROUP BY source_type",
}


# --- queries over the SQL above -------------------------------------------


def lines_of_array(rows: str, order: str, head: str = "'['", tail: str = "']'", between: str = "','") -> str:
    """Lines of a document: ``rows`` gives ``line`` and the columns of ``order``."""
    ends = f" UNION ALL SELECT {tail}" if tail else ""
    return f"SELECT {head} AS value UNION ALL SELECT line || CASE WHEN row_number() OVER (ORDER BY {order}) = count(*) OVER () THEN '' ELSE {between} END FROM ({rows}){ends}"


METADATA = ORACLE_SQL["chunk_metadata"]
TEST_CASES = f"SELECT count(*) FROM ({ORACLE_SQL['export_trec']})"

ORACLE_SQL |= {
    "crawl_resume": f"SELECT * FROM ({ORACLE_SQL['crawl_hops']}) WHERE hop >= 2",
    "crawl_stream": ORACLE_SQL["crawl_hops"],
    "crawl_pages": f"""WITH RECURSIVE {LINKS}, walk(url, hop) AS (
        SELECT url, 0 FROM pages WHERE page_id % 3 = 0 AND NOT contains(url, '/the') UNION SELECT link, hop + 1 FROM walk JOIN links ON page = url WHERE hop < 2 AND NOT contains(link, '/the'))
      SELECT url, min(hop)::INTEGER AS hop FROM walk GROUP BY url""",
    "fetch_pages": """SELECT url, CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END::INTEGER AS status, CASE WHEN page_id % 5 <> 0 THEN md5(html) END AS digest, 1::INTEGER AS attempts,
      CASE WHEN page_id % 5 = 0 THEN 'status 404' END AS error FROM pages""",
    "crawl_summary": f"""SELECT count(*) AS processed, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed
      FROM (SELECT url IN (SELECT 'https://n/' || page_id FROM pages WHERE page_id % 3 <> 0) AS ok FROM ({ORACLE_SQL['crawl_hops']}))""",
    "scrape_list": f"""WITH listed AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, url FROM pages WHERE page_id % 5 = 0)
      SELECT url, {FILE} AS file, CASE WHEN page_id % 2 = 0 THEN title END AS title, page_id % 2 <> 0 AS error FROM listed JOIN ({ORACLE_SQL['html_title']}) USING (page_id)""",
    "clean_front_matter": f"""WITH source AS ({SCRAPED}), {FRONT},
      ruled AS (SELECT doc_id, t, '---' || chr(10) || block || chr(10) || '---' || chr(10) AS head, array_to_string(list_transform(string_split(replace(body, 'e', ''), chr(10)), lambda l: CASE WHEN starts_with(l, '# ') THEN '' ELSE l END), chr(10)) AS b FROM fields),
      done AS (SELECT doc_id, t, head || {normalized("b")} AS cleaned FROM ruled)
      SELECT doc_id, md5(cleaned) AS digest, 0::INTEGER AS n_yaml, (contains(t, '# ') AND NOT contains(cleaned, '# '))::INTEGER AS n_h1 FROM done""",
    "cleaned_files": f"""WITH source AS ({SCRAPED}), {FRONT},
      ruled AS (SELECT doc_id, '---' || chr(10) || block || chr(10) || '---' || chr(10) AS head, array_to_string(list_transform(string_split(replace(body, 'e', ''), chr(10)), lambda l: CASE WHEN starts_with(l, '# ') THEN '' ELSE l END), chr(10)) AS b FROM fields),
      done AS (SELECT doc_id, head || {normalized("b")} AS cleaned FROM ruled)
      SELECT doc_id || '.md' AS file, length(cleaned)::BIGINT AS n_chars, md5(cleaned) AS digest FROM done""",
    "rule_unknown": digest("text"),
    "frontmatter_build": """SELECT doc_id, '---' || chr(10) || 'doc_id: ' || doc_id || chr(10) || 'title: ''Doc ' || doc_id || ': ' || lang || '''' || chr(10) || 'even: ' || CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END || chr(10)
      || 'tags:' || chr(10) || '- ' || lang || chr(10) || '- ' || source || chr(10) || '---' || chr(10) AS block FROM documents""",
    "chunk_documents": f"""WITH RECURSIVE {chunks(HEADED)}, m AS ({METADATA})
      SELECT m.chunk_file, d.source || '/' || d.doc_id || '.md' AS source_file, 'https://x/' || d.doc_id AS original_url, '2025-01-01' AS scrape_date, 'T: ' || d.doc_id AS title, m.chunk_index, m.total_chunks::INTEGER AS total_chunks,
        m.char_count, m.word_count, m.section_path, md5(c.piece) AS digest
      FROM m JOIN chunks c ON c.doc_id = m.doc_id AND c.chunk_index = m.chunk_index JOIN documents d ON d.doc_id = m.doc_id""",
    "merge_filter": f"SELECT chunk_file, chunk_index, 'https://x/7' AS original_url FROM ({METADATA}) WHERE doc_id = 7",
    "merge_order": f"""SELECT chunk_file, row_number() OVER (ORDER BY source || '/' || doc_id || '.md', chunk_index, chunk_file) - 1 AS place FROM ({METADATA}) JOIN documents USING (doc_id)""",
    "clean_by_site": f"""WITH {CLEANED}, stays AS (SELECT d.doc_id, source, cleaned, original FROM cleaned JOIN documents d USING (doc_id)),
      sited AS (SELECT doc_id, CASE source WHEN 'src0' THEN 'src0.example.com' WHEN 'src1' THEN 'src1.example' END AS rule_set,
        CASE source WHEN 'src0' THEN cleaned WHEN 'src1' THEN {normalized("replace(original, ' the ', '')")} ELSE original END AS t FROM stays)
      SELECT doc_id, rule_set, length(t)::BIGINT AS n_chars, md5(t) AS digest FROM sited""",
    "merge_json_array": lines_of_array(f"""SELECT '{{"chunk_file":"' || chunk_file || '","original_url":"' || original_url || '","chunk_index":0}}' AS line, chunk_file FROM ({ORACLE_SQL['merge_rows']})""", "chunk_file"),
    "qa_union": """WITH d AS (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D\\x1c-\\x1f\\x85\\xa0]+')) AS words FROM documents)
      SELECT doc_id::VARCHAR AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN 'What is ' || lang ELSE 'What does this source say?' END AS question, doc_id || '_001.md' AS qa_file,
        CASE WHEN doc_id % 3 = 0 THEN 'interview_question' ELSE 'synthetic' END AS source_type, CASE WHEN doc_id % 3 = 0 THEN 'extracted' ELSE 'auto-generated' END AS confidence, false AS reviewed,
        'stub' AS generation_model, '2025-01-01' AS generation_date
      FROM d WHERE CASE WHEN doc_id % 3 = 0 THEN words > 30 ELSE words >= 20 END""",
    "qa_order": QUESTIONS + ", n AS (SELECT *, row_number() OVER (PARTITION BY parse_filename(chunk_path, true) ORDER BY chunk_path, question) AS n FROM questions) "
    + lines_of_array("""SELECT '{"chunk_file":"' || chunk_path || '","qa_file":"' || qa_file || '","generation_model":"extracted"}' AS line, chunk_path, qa_file FROM (SELECT *, parse_filename(chunk_path, true) || '_' || lpad(n::VARCHAR, 3, '0') || '.md' AS qa_file FROM n)""", "chunk_path, qa_file"),
    "qa_legacy_json": QUESTIONS + " " + lines_of_array(
        """SELECT '{"doc_id":' || doc_id || ',"chunk_index":' || chunk_index || ',"chunk_id":"' || chunk_id || '","source_type":"' || source_type || '","confidence":"auto","reviewed":false}' AS line, doc_id, chunk_index FROM questions""", "doc_id, chunk_index",
        """'{"metadata": {"total_questions": ' || (SELECT count(*) FROM questions) || ', "extracted_questions": 0, "synthetic_questions": ' || (SELECT count(*) FROM questions) || ', "random_seed": 42}, "questions": ['""", "']}'"),
    "export_json_document": lines_of_array(f"SELECT split_part(line, ' ', 1) AS line FROM ({ORACLE_SQL['export_trec']})", "line",
        f"""'{{"metadata": {{"created_at": "2025-01-01", "total_questions": ' || ({TEST_CASES}) || ', "format": "retrieval_test_set_v1"}}, "test_cases": ['""", "']}'"),
    "export_csv_document": f"SELECT 'question_id,question,chunk_id,chunk_path,source_url,source_type' AS value UNION ALL SELECT line FROM ({ORACLE_SQL['export_csv']})",
}
