"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

LINES = "lines AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS raw FROM documents)"
REG = (
    LINES
    + """, deco AS (SELECT doc_id, i, CASE WHEN i % 12 = 0 THEN '# 第 ' || (i // 12 + 1) || ' 章 ' || raw
 WHEN i % 4 = 1 THEN '第 ' || (i + 1) || ' 条 ' || raw
 WHEN i % 12 = 3 THEN '## ' || (i // 12 + 1) || '.' || (i % 12) || ' ' || raw
 WHEN i % 10 = 2 THEN '中 文 ' || raw
 WHEN i % 9 = 8 THEN '<table border="1" ><tr><td>' || raw || '</td></tr></table>' ELSE raw END AS line FROM lines),
reg AS (SELECT doc_id, CAST(i * 4 AS INT) AS pos, line FROM deco
 UNION ALL SELECT doc_id, CAST(i * 4 + 1 AS INT), '<!-- 第 ' || (i // 5 + 1) || ' 页 -->' FROM deco WHERE i % 5 = 4
 UNION ALL SELECT doc_id, CAST(i * 4 + 2 AS INT), CAST(i AS VARCHAR) FROM deco WHERE i % 7 = 6)"""
)
PAGED = REG + """, paged AS (SELECT doc_id, pos, line, CAST(greatest(1, coalesce(max(CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) + 1 END)
 OVER (PARTITION BY doc_id ORDER BY pos), 1)) AS INT) AS page FROM reg)"""
CITES = LINES + """, art AS (SELECT doc_id, i FROM lines WHERE i % 4 = 1),
named_cites AS (SELECT doc_id, i, i AS si, 0 AS ord, 'named' AS kind, doc_id + 1 AS t, 1 AS ti FROM art WHERE i % 8 = 5
 UNION ALL SELECT doc_id, i, i, 1, '前条', doc_id, i - 4 FROM art WHERE i % 8 = 5 AND doc_id % 6 = 0
 UNION ALL SELECT doc_id, i, i, CASE WHEN doc_id % 6 = 0 THEN 2 ELSE 1 END, 'own', doc_id, 9 FROM art WHERE i % 16 = 13
 UNION ALL SELECT doc_id, i, i, 0, 'own', doc_id, 5 FROM art WHERE i = 1
 UNION ALL SELECT doc_id, i, i, 0, '前条', doc_id, i - 4 FROM art WHERE i % 8 = 1 AND i > 1),
cites AS (SELECT * FROM named_cites UNION ALL SELECT doc_id, i, i - 1, k.ord, k.kind, doc_id, i - 1 FROM lines, (VALUES (0, '前款'), (1, '本条'), (2, '本章')) k(ord, kind) WHERE i % 4 = 2)"""
LABELS = PAGED + """, named AS (SELECT doc_id, pos, page, line, CASE WHEN NOT (line LIKE '%....%') AND line LIKE '## %' THEN regexp_extract(line, '^## ([0-9]+\\.[0-9]+)', 1)
 WHEN NOT (line LIKE '%....%') AND regexp_matches(line, '^第 [0-9]+ 条') THEN regexp_extract(line, '^(第 [0-9]+ 条)', 1) END AS label FROM paged),
outline AS (SELECT doc_id, label, CAST(arg_min(page, pos) AS INT) AS page, min(pos) AS pos FROM named WHERE label IS NOT NULL AND label <> '' GROUP BY ALL)"""
INDEX = LABELS + """, idx AS (SELECT doc_id AS norm, pos, label, page, CAST(page + doc_id % 2 + pos % 3 * (doc_id % 2) AS INT) AS wrong FROM outline)"""
ISSUES = INDEX + """, issues AS (SELECT norm, label, CASE WHEN pos % 2 = 0 THEN 'catalog' ELSE 'summary' END AS kind, wrong AS old_start, page AS start, page - wrong AS delta FROM idx WHERE wrong <> page)"""
FOOTER = "regexp_matches(line, '^[ \\t]*[-—·.]?\\s*[0-9]{1,4}\\s*[-—·.]?[ \\t]*$') OR regexp_matches(line, '^[ \\t]*——\\s*[0-9]{1,4}\\s*——[ \\t]*$')"
PROTECTED = "(?i)<table\\b[^>]*>[\\s\\S]*?</table>|!\\[[^\\]]*\\]\\([^)]*\\)(?:\\s*<!--[^>]*-->)?|<!--[\\s\\S]*?-->|\\$\\$[\\s\\S]*?\\$\\$|\\$[^\\n$]+?\\$"
LONE = "regexp_matches(line, '^[ \\t]*[Xx][ \\t]*$')"
ARTICLE_FIX = "regexp_replace(regexp_replace(line, '第\\s*([0-9]+)\\s*条', '第\\1条', 'g'), '第\\s*([0-9]+)\\s*章', '第\\1章', 'g')"
STRUCTURE = PAGED + """, marked AS (SELECT *, CASE WHEN regexp_matches(line, '^# 第 [0-9]+ 章') THEN 1 ELSE 0 END AS part, CASE WHEN regexp_matches(line, '^## [0-9]+\\.[0-9]+') THEN 1 ELSE 0 END AS sec FROM paged),
chap AS (SELECT *, CAST(sum(part) OVER (PARTITION BY doc_id ORDER BY pos) AS INT) AS chapter_id FROM marked),
struct AS (SELECT *, CAST(sum(sec) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS INT) AS section_id FROM chap)"""
GRID = """grids AS (SELECT l_orderkey, list(r ORDER BY l_linenumber) AS grid FROM (SELECT l_orderkey, l_linenumber,
 list_filter([CAST(l_partkey AS VARCHAR), CASE WHEN l_partkey % 3 > 0 THEN l_returnflag END, CASE WHEN l_partkey % 7 <> 0 THEN ' x ' END], lambda x: x IS NOT NULL OR l_partkey % 2 = 0) AS r FROM lineitem) GROUP BY 1)"""

#: Documents dressed as ``lines.dressed`` does.
RICH = """src AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS raw, len(string_split(text, chr(10))) AS n FROM documents),
g AS (SELECT *, doc_id % 5 = 4 AS flat, substring('一二三四五六七八九十', CAST(i // 9 % 10 + 1 AS INT), 1) AS num, substring(raw, 1, 30) AS short, ['<table>', '<tr><td>' || raw || '</td></tr>', '</table>'] AS tab FROM src),
made AS (SELECT doc_id, i, CASE WHEN i = 0 THEN ['目录', CASE WHEN flat THEN '说明........1' ELSE '一、总则........1' END, ''] WHEN NOT flat AND i = n - 2 THEN ['附：样表', raw]
 WHEN i = n - 1 AND doc_id % 3 = 0 THEN ['# 条文说明', raw] WHEN NOT flat AND i % 9 = 1 THEN [num || '、' || short] WHEN i % 9 = 2 THEN ['1.' || i || '.3 ' || raw]
 WHEN i % 9 = 3 THEN ['（' || num || '）' || short, raw] WHEN i % 18 = 5 THEN list_concat(['**表格（第2页）**'], tab) WHEN i % 9 = 5 THEN list_concat(['样表 ' || i], tab)
 WHEN i % 9 = 6 THEN ['#### 说明' || i, raw] WHEN i % 9 = 7 THEN ['<!-- 第 ' || (i // 9 + 1) || ' 页 --> ' || raw] WHEN i % 9 = 8 THEN ['第' || i || '条 ' || raw] ELSE [raw] END AS l FROM g),
rich AS (SELECT doc_id, CAST(i * 4 + k AS INT) AS pos, line FROM (SELECT doc_id, i, unnest(range(len(l))) AS k, unnest(l) AS line FROM made)),
rpaged AS (SELECT *, CAST(greatest(1, coalesce(max(CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) + 1 END) OVER (PARTITION BY doc_id ORDER BY pos), 1)) AS INT) AS page FROM rich)"""
RICH_STRUCTURE = RICH + """, rmark AS (SELECT *, regexp_matches(line, '^[一二三四五六七八九十]、') OR line LIKE '附：%' AS part, regexp_matches(line, '^（[一二三四五六七八九十]）') AS item, line = '# 条文说明' AS tail FROM rpaged),
rchap AS (SELECT *, CAST(sum(CAST(part AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS INT) AS chapter_id FROM rmark),
rkept AS (SELECT *, max(chapter_id) OVER (PARTITION BY doc_id) AS parts, max(CASE WHEN tail AND chapter_id > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS ended FROM rchap),
rstruct AS (SELECT *, item AND chapter_id > 0 AS starts_section FROM rkept WHERE parts = 0 OR (chapter_id > 0 AND ended = 0))"""
#: Lines of tables and the runs that split_chunks makes of a chapter's lines.
PARTS = STRUCTURE + """, p0 AS (SELECT *, line LIKE '<table%' AS tab FROM struct),
p1 AS (SELECT *, CASE WHEN tab THEN CAST(sum(CAST(tab AS INT)) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS INT) END AS table_no FROM p0),
p2 AS (SELECT *, sum(CASE WHEN table_no IS DISTINCT FROM before OR pos = first_pos THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS piece
 FROM (SELECT *, lag(table_no) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS before, min(pos) OVER (PARTITION BY doc_id, chapter_id) AS first_pos FROM p1)),
p3 AS (SELECT *, max(CASE WHEN line LIKE '<!-- 第 %' OR length(trim(replace(line, '**', ''))) < 4 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, chapter_id, piece) AS real,
 min(page) OVER (PARTITION BY doc_id, chapter_id, piece) AS lo, max(page) OVER (PARTITION BY doc_id, chapter_id, piece) AS hi FROM p2),
p4 AS (SELECT *, unnest(CASE WHEN tab OR hi - lo < 2 THEN [{'a': lo, 'b': hi}] ELSE list_transform(range(lo, hi + 1, 2), lambda s: {'a': CASE WHEN s > lo THEN CAST(s AS INT) - 1 ELSE CAST(s AS INT) END, 'b': least(hi, CAST(s AS INT) + 1)}) END) AS r FROM p3 WHERE tab OR real = 1),
p5 AS (SELECT doc_id, chapter_id, piece, table_no, r, min(pos) AS start_pos, max(pos) AS end_pos, min(page) AS start_page, max(page) AS end_page FROM p4 WHERE page BETWEEN r.a AND r.b GROUP BY ALL),
parts AS (SELECT *, CAST(row_number() OVER w AS INT) AS part_no, CAST(count(*) OVER (PARTITION BY doc_id, chapter_id) AS INT) AS parts, table_no IS NOT NULL AS is_table,
 CAST(row_number() OVER (PARTITION BY doc_id, chapter_id, piece ORDER BY start_pos, end_pos) AS INT) AS range_no, sum(CASE WHEN table_no IS NULL THEN 1 ELSE 0 END) OVER w AS texts FROM p5 WINDOW w AS (PARTITION BY doc_id, chapter_id ORDER BY piece, start_pos, end_pos))"""
#: A line's title where it is a heading of ``reg``.
TITLE = "rtrim(regexp_replace(regexp_replace(regexp_replace(line, '^#+ ', ''), '第 ([0-9]+) 章', '第\\1章'), ' {2,}', ' ', 'g'))"
SECTIONS = STRUCTURE + f""", secs AS (SELECT doc_id, chapter_id, section_id, arg_min({TITLE}, pos) AS title, min(pos) AS start_pos, max(pos) AS end_pos, min(page) AS start_page, max(page) AS end_page,
 CAST(count(*) FILTER (line NOT LIKE '<!-- 第 %' AND trim(line) <> '') AS INT) AS n_lines, CAST(sum(CASE WHEN line LIKE '<!-- 第 %' THEN 0 ELSE length(trim(line)) END) AS INT) AS n_chars FROM struct GROUP BY ALL)"""
GREEDY = """WITH RECURSIVE t AS (SELECT doc_id, text, regexp_extract_all(text, '\\n{2,}|[^\\n]+') AS atoms FROM (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents)),
r AS (SELECT doc_id, 0 AS k, '' AS held, CAST([] AS VARCHAR[]) AS outs FROM t WHERE length(text) > 1000
 UNION ALL SELECT r.doc_id, k + 1, CASE WHEN length(held) + length(x) <= 1000 THEN held || x WHEN length(x) > 1000 THEN '' ELSE x END,
 CASE WHEN length(held) + length(x) <= 1000 THEN [] ELSE list_concat(CASE WHEN held = '' THEN [] ELSE [held] END, CASE WHEN length(x) > 1000 THEN list_transform(range(0, length(x), 1000), lambda s: substring(x, CAST(s AS INT) + 1, 1000)) ELSE [] END) END
 FROM r JOIN (SELECT doc_id, unnest(range(len(atoms))) AS at, unnest(atoms) AS x FROM t) a ON a.doc_id = r.doc_id AND a.at = r.k),
o AS (SELECT doc_id, k, outs FROM r UNION ALL SELECT r.doc_id, k + 1, [held] FROM r JOIN t USING (doc_id) WHERE k = len(atoms) AND held <> ''),
u AS (SELECT doc_id, k, unnest(range(len(outs))) AS j, unnest(outs) AS text FROM o UNION ALL SELECT doc_id, 0, 0, text FROM t WHERE length(text) <= 1000)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k, j) - 1 AS INT) AS pos, text FROM u"""
EDGE = "(t LIKE '#%' OR t LIKE '![%' OR t LIKE '<!--%' OR regexp_matches(lower(t), '^(<table|</table|<tr|<td)'))"
NEW = """(regexp_matches(t, '^第\\s*[一二三四五六七八九十百零〇两0-9]+(\\s+[一二三四五六七八九十百零〇两0-9]+)*\\s*[章节]') OR regexp_matches(t, '^第[一二三四五六七八九十百零〇两0-9]+条')
 OR (regexp_matches(t, '^[0-9]+\\.[0-9]+(\\s|[^0-9.]|$)') AND NOT regexp_matches(t, '^[0-9]+\\.[0-9]+\\.[0-9]+(\\s|[^0-9.]|$)'))
 OR regexp_matches(t, '^(\\(?[一二三四五六七八九十百零〇]+\\)|（[一二三四五六七八九十百零〇]+）|[0-9]+[.、)]|[（(][0-9]+[）)])'))"""
TOKEN = "\\x01P[0-9]+\\x01"


def _reflow(source: str) -> str:
    """CTEs that join the wrapped lines (doc_id, i, raw) of a table: f4 (doc_id, text, merged)."""
    return f"""f0 AS (SELECT doc_id, i, t, coalesce(lag(t) OVER (PARTITION BY doc_id ORDER BY i) = '', false) AS gap FROM (SELECT doc_id, i, trim(raw, chr(9) || chr(11) || chr(12) || chr(13) || ' ' || chr(160) || chr(12288)) AS t FROM {source})),
f1 AS (SELECT *, {EDGE} OR regexp_matches(t, '^{TOKEN}$') AS edge, {NEW} AS new FROM f0 WHERE t <> ''),
f2 AS (SELECT *, lag(t) OVER w AS pt, lag(edge) OVER w AS pedge FROM f1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f3 AS (SELECT *, pt IS NOT NULL AND NOT pedge AND NOT edge AND NOT new AND NOT regexp_matches(pt, CASE WHEN gap THEN '[。！？；;：:]$' ELSE '[。！？；;]$' END) AS m FROM f2),
f4 AS (SELECT doc_id, string_agg(CASE WHEN pt IS NULL THEN '' WHEN m AND regexp_matches(pt, '[A-Za-z0-9]$') AND regexp_matches(t, '^[A-Za-z0-9]') THEN ' ' WHEN m THEN '' WHEN pedge OR edge OR gap THEN chr(10) || chr(10) ELSE chr(10) END || t, '' ORDER BY i) || chr(10) AS text, CAST(count(*) FILTER (m) AS INT) AS merged FROM f3 GROUP BY doc_id)"""


REFLOW = LINES + ", " + _reflow("lines")
BOLD_LEGAL = "\\*\\*\\s*(第\\s*[一二三四五六七八九十百零〇两0-9\\s]+[条章节项][^*]*?)\\s*\\*\\*"
BOLD_SHORT = "\\*\\*\\s*([\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{1,2})\\s*\\*\\*"
#: The whole rule pipeline over ``reg``: c9 has its texts and counters.
CLEAN = REG + f""", c0 AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS source, CAST(count(*) FILTER ({FOOTER}) AS INT) AS page_numbers_removed, CAST(count(*) FILTER ({LONE}) AS INT) AS boilerplate_removed,
 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT ({FOOTER}) AND NOT {LONE}), '') AS kept FROM reg GROUP BY doc_id),
c1 AS (SELECT *, regexp_extract_all(kept, '{PROTECTED}') AS regions, string_split_regex(kept, '{PROTECTED}') AS gaps FROM c0),
c2 AS (SELECT *, array_to_string(list_transform(range(1, len(gaps) + 1), lambda k: gaps[k] || CASE WHEN k <= len(regions) THEN chr(1) || 'P' || (k - 1) || chr(1) ELSE '' END), '') AS masked FROM c1),
c3 AS (SELECT doc_id, unnest(range(len(string_split(masked, chr(10))))) AS i, unnest(string_split(masked, chr(10))) AS line FROM c2),
c4 AS (SELECT *, len(regexp_extract_all(line, '第\\s*[0-9]+\\s*条')) AS a, len(regexp_extract_all(line, '第\\s*[0-9]+\\s*章')) AS c, regexp_replace(line, '第\\s*([0-9]+)\\s*([条章])', '第\\1\\2', 'g') AS l1 FROM c3),
c5 AS (SELECT *, len(regexp_extract_all(l1, '{BOLD_LEGAL}')) AS bl, regexp_replace(l1, '{BOLD_LEGAL}', '\\1', 'g') AS l2 FROM c4),
c6 AS (SELECT *, len(regexp_extract_all(l2, '{BOLD_SHORT}')) AS bs, regexp_replace(l2, '{BOLD_SHORT}', '\\1', 'g') AS l3 FROM c5),
c7 AS (SELECT *, trim(regexp_replace(trim(l3), '^#{{1,6}}\\s+', '')) AS t FROM c6),
c8 AS (SELECT *, regexp_matches(t, '^第[0-9]+章') AS h1, NOT regexp_matches(t, '^第[0-9]+章') AND regexp_matches(t, '^[0-9]+\\.[0-9]+(\\s|[^0-9.]|$)') AND NOT regexp_matches(t, '^[0-9]+\\.[0-9]+\\.[0-9]+') AS h2, regexp_matches(l3, '^#{{1,6}}\\s') AS marked FROM c7),
normal AS (SELECT doc_id, i, CASE WHEN trim(l3) = '' THEN l3 WHEN h1 THEN '# ' || t WHEN h2 THEN '## ' || t WHEN marked THEN t ELSE l3 END AS shown, a, c, bl, bs, h1, h2, marked FROM c8),
open AS (SELECT doc_id, i, replace(shown, '中 文', '中文') AS raw FROM normal),
{_reflow("open")},
counts AS (SELECT doc_id, CAST(sum(a) AS INT) AS article_spaces_fixed, CAST(sum(c) AS INT) AS chapter_spaces_fixed, CAST(sum(bl) AS INT) AS bold_removed, CAST(sum(bs) AS INT) AS bold_short_removed, CAST(count(*) FILTER (h1) AS INT) AS h1_normalized, CAST(count(*) FILTER (h2) AS INT) AS h2_normalized,
 CAST(count(*) FILTER (marked AND NOT h1 AND NOT h2) AS INT) AS headings_demoted, CAST(sum(length(shown) - length(replace(shown, '中 文', '中文'))) AS INT) AS cjk_gaps_removed FROM normal GROUP BY doc_id),
back AS (SELECT c2.*, counts.* EXCLUDE doc_id, coalesce(merged, 0) AS lines_merged, string_split_regex(coalesce(f4.text, chr(10)), '{TOKEN}') AS plain, regexp_extract_all(coalesce(f4.text, ''), '\\x01P([0-9]+)\\x01', 1) AS tokens FROM c2 JOIN counts USING (doc_id) LEFT JOIN f4 USING (doc_id)),
whole AS (SELECT *, array_to_string(list_transform(range(1, len(plain) + 1), lambda k: plain[k] || CASE WHEN k <= len(tokens) THEN regions[CAST(tokens[k] AS INT) + 1] ELSE '' END), '') AS w FROM back),
c9 AS (SELECT *, regexp_replace(regexp_replace(w, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') || chr(10) AS text, 0 AS section_spaces_fixed, 0 AS inline_boilerplate_removed, CAST(length(w) - length(regexp_replace(w, '\\n{{3,}}', chr(10) || chr(10), 'g')) AS INT) AS blank_lines_removed FROM whole)"""
COUNTED = ("page_numbers_removed", "boilerplate_removed", "article_spaces_fixed", "chapter_spaces_fixed", "section_spaces_fixed", "bold_removed", "bold_short_removed", "h1_normalized", "h2_normalized", "headings_demoted", "inline_boilerplate_removed", "cjk_gaps_removed", "lines_merged", "blank_lines_removed")
WORD_LINES = """WITH RECURSIVE w AS (SELECT l_orderkey, l_linenumber * 2 AS top, CAST(l_quantity AS DOUBLE) AS x, CAST(l_partkey AS VARCHAR) AS text FROM lineitem WHERE NOT (l_quantity + 1.5 BETWEEN 10 AND 15)),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY top, x, text) AS k FROM w),
r AS (SELECT l_orderkey, k, text, x, top AS anchor, 1 AS n FROM o WHERE k = 1
 UNION ALL SELECT o.l_orderkey, o.k, o.text, o.x, CASE WHEN abs(o.top - r.anchor) > 3 THEN o.top ELSE r.anchor END, r.n + CASE WHEN abs(o.top - r.anchor) > 3 THEN 1 ELSE 0 END FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.k = r.k + 1)
SELECT l_orderkey, CAST(n - 1 AS INT) AS pos, string_agg(text, ' ' ORDER BY x, text) AS line FROM r GROUP BY l_orderkey, n"""
GROUPS = SECTIONS + """, ord AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chapter_id ORDER BY section_id) AS k, n_lines < 8 OR n_chars < 350 AS small FROM secs),
fold AS (SELECT doc_id, chapter_id, section_id, k, 1 AS group_no, CASE WHEN small THEN 1 ELSE 0 END AS n, CASE WHEN small THEN n_lines ELSE 0 END AS l, CASE WHEN small THEN n_chars ELSE 0 END AS c FROM ord WHERE k = 1
 UNION ALL SELECT o.doc_id, o.chapter_id, o.section_id, o.k, f.group_no + CAST(fresh AS INT), CASE WHEN NOT o.small THEN 0 WHEN fresh THEN 1 ELSE f.n + 1 END, CASE WHEN NOT o.small THEN 0 WHEN fresh THEN o.n_lines ELSE f.l + o.n_lines END, CASE WHEN NOT o.small THEN 0 WHEN fresh THEN o.n_chars ELSE f.c + o.n_chars END
 FROM (SELECT f.*, o.section_id AS s2, (NOT o.small OR f.n = 0 OR f.n >= 15 OR (f.l >= 8 AND f.c >= 350)) AS fresh FROM fold f JOIN ord o ON o.doc_id = f.doc_id AND o.chapter_id = f.chapter_id AND o.k = f.k + 1) f JOIN ord o ON o.doc_id = f.doc_id AND o.chapter_id = f.chapter_id AND o.k = f.k + 1),
grouped AS (SELECT secs.*, group_no, count(*) OVER (PARTITION BY secs.doc_id, secs.chapter_id, group_no) > 1 AS merged, replace(translate(title, '/:\\*?"<>|', '／：＼＊？”＜＞｜'), ' ', '') AS slug FROM secs JOIN fold USING (doc_id, chapter_id, section_id))"""
RECORDS = """rec AS (SELECT 'f' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.x' AS file, CASE WHEN o_orderkey % 3 = 0 THEN 'pdf' ELSE 'doc/docx' END AS kind, CASE WHEN o_orderkey % 11 = 0 THEN 'failed' WHEN o_orderkey % 7 = 0 THEN 'skipped (exists)' ELSE 'ok' END AS status,
 CASE WHEN o_orderkey % 11 = 0 THEN 'a|b' END AS error, o_orderkey % 13 AS n_chars, o_orderkey % 5 AS pages, o_orderkey % 4 AS tables, o_orderkey % 6 AS images, o_orderkey % 3 AS model_calls, o_orderkey % 2 AS model_ok, o_orderkey % 3 - o_orderkey % 2 AS model_failed FROM orders)"""
TOTALS = "tot AS (SELECT count(*) AS files, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status LIKE 'skipped%') AS skipped, count(*) FILTER (status = 'failed') AS failed, " + ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("pages", "tables", "images", "model_calls", "model_ok", "model_failed")) + " FROM rec)"


def _lines(part: int, source: str, *made: str) -> str:
    """Rows (part, ord, line) of a list of line expressions over one row."""
    items = ", ".join(made)
    return f"SELECT {part} AS part, lpad(CAST(k AS VARCHAR), 6, '0') AS ord, line FROM (SELECT unnest(range({len(made)})) AS k, unnest([{items}]) AS line FROM {source})"


def _cells(*made: str) -> str:
    return "'| ' || " + " || ' | ' || ".join(f"coalesce(CAST({m} AS VARCHAR), '-')" for m in made) + " || ' |'"


def _table(part: int, title: str, heads: tuple[str, ...], source: str, order: str, *made: str) -> str:
    top = _lines(part, f"(SELECT 1 FROM {source} LIMIT 1)", "''", f"'## {title}'", "''", "'| " + " | ".join(heads) + " |'", "'| " + " | ".join(["---"] * len(heads)) + " |'")
    return f"{top} UNION ALL SELECT {part + 1}, {order}, {_cells(*made)} FROM {source}"


ESCAPED = "replace({}, '|', '\\|')"
EXTRACTION = f"WITH {RECORDS}, {TOTALS} " + " UNION ALL ".join(
    (
        _lines(
            0, "tot", "'# 文档提取运行报告'", "''", "'## 总览'", "''", "'| 指标 | 数值 |'", "'| --- | --- |'",
            *[_cells(f"'{n}'", c) for n, c in (("处理文件总数", "files"), ("✓ 成功", "ok"), ("↷ 跳过", "skipped"), ("✗ 失败", "failed"), ("PDF 总页数", "pages"), ("提取表格总数", "tables"), ("抽取图片总数", "images"))],
            _cells("'多模态调用'", "model_calls || ' 次（成功 ' || model_ok || ' / 失败 ' || model_failed || '）'"),
        ),
        _table(1, "PDF 文件明细", ("文件", "状态", "页数", "表格", "图片", "多模态调用", "输出字符"), "(SELECT * FROM rec WHERE kind = 'pdf')", "file", "file", "status", "pages", "tables", "images", "model_calls", "n_chars"),
        _table(3, "DOC / DOCX 文件明细", ("文件", "状态", "输出字符"), "(SELECT * FROM rec WHERE kind <> 'pdf')", "file", "file", "status", "n_chars"),
        _table(5, "失败文件", ("文件", "错误"), "(SELECT * FROM rec WHERE status = 'failed')", "file", "file", ESCAPED.format("error")),
    )
)
CANDIDATES = f"""{GRID}, cand AS (SELECT l_orderkey, l_orderkey // 4 AS doc_id, CASE WHEN l_orderkey % 2 = 1 AND l_orderkey % 3 = 0 THEN 'strict' ELSE 'loose' END AS mode, grid, (l_orderkey % 10 * 1000) / 10000 AS area FROM grids)"""

#: Terms of the documents (without Chinese) with their places, and those of the first n words of each item.
TERMS = """t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term, generate_subscripts(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), 1) AS pos FROM documents)"""
ASKED = """q0 AS (SELECT item_id AS query_id, list_slice(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), 1, {n}) AS ws FROM benchmark),
 q AS (SELECT query_id, len(ws) AS of, unnest(ws) AS term, generate_subscripts(ws, 1) AS slot FROM q0)"""

SQL = {
    "outline_first": f"WITH {LABELS} SELECT doc_id, label, page FROM outline",
    "line_explode": f"WITH {LINES} SELECT doc_id, CAST(i AS INT) AS pos, raw AS line FROM lines WHERE NOT (raw = '' AND i = (SELECT max(i) FROM lines l WHERE l.doc_id = lines.doc_id))",
    "line_clean": f"WITH {LINES} SELECT doc_id, CAST(i AS INT) AS pos, trim(regexp_replace(raw || ' ' || i, '[ \\t]+', ' ', 'g')) AS line FROM lines",
    "heading_guess": f"""WITH {REG}, bare AS (SELECT doc_id, pos, trim(regexp_replace(line, '^#{{1,6}}\\s+', '')) AS t FROM reg)
 SELECT doc_id, pos, CASE WHEN t = '' OR length(t) > 80 THEN NULL WHEN regexp_matches(t, '^第[一二三四五六七八九十百零0-9]+\\s*章') AND length(t) <= 40 THEN 1
 WHEN regexp_matches(t, '^[0-9]+\\.[0-9]+\\s') AND length(t) <= 60 THEN 2 WHEN regexp_matches(t, '^[0-9]+\\.[0-9]+\\.[0-9]+\\s') THEN 3 WHEN regexp_matches(t, '^第[0-9]+条(\\s|$)') THEN 4 END AS level FROM bare""",
    "quality_gate": f"""WITH {REG}, t AS (SELECT doc_id, pos, line, regexp_replace(line, '\\s+', '', 'g') AS s FROM reg),
 c AS (SELECT *, len(regexp_extract_all(s, '[\\x{{4e00}}-\\x{{9fff}}]')) AS cn, len(regexp_extract_all(s, '[\\x{{4e00}}-\\x{{9fff}}\\x{{3000}}-\\x{{303f}}\\x{{ff00}}-\\x{{ffef}}A-Za-z0-9,.:;!?+*/=()\\[\\]"''·…—\\\\-]')) AS ok FROM t)
 SELECT doc_id, pos, r = 'ok' AS ok, r AS reason FROM (SELECT *, CASE WHEN line = '' THEN 'empty' WHEN length(s) < 30 THEN 'too_short' WHEN cn > 0 AND cn / length(s) < 0.3 AND length(s) > 80 THEN 'cn_ratio_low' WHEN 1 - ok / length(s) > 0.15 THEN 'garbled' ELSE 'ok' END AS r FROM c)""",
    "page_of_line": f"WITH {PAGED} SELECT doc_id, pos, page FROM paged",
    "marker_body": f"""WITH {REG}, m AS (SELECT doc_id, pos, CASE WHEN pos % 3 = 0 THEN pos WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) END AS page,
 CASE WHEN pos % 3 = 0 THEN '' WHEN line LIKE '<!-- 第 %' THEN NULL ELSE '前' END AS head, line FROM reg)
 SELECT doc_id, pos, CAST(page AS INT) AS page, trim(CASE WHEN head IS NULL THEN '' ELSE head || ' ' || replace(line, '**', '') END) AS body FROM m""",
    "footer_filter": f"WITH {REG} SELECT doc_id, pos, line FROM reg WHERE NOT ({FOOTER}) AND NOT {LONE}",
    "footer_counts": f"WITH {REG} SELECT doc_id, count(*) FILTER ({FOOTER}) AS page_numbers, count(*) FILTER ({LONE}) AS boilerplate FROM reg GROUP BY doc_id",
    "legal_space_fix": f"WITH {REG} SELECT doc_id, pos, {ARTICLE_FIX} AS line, CAST(len(regexp_extract_all(line, '第\\s*[0-9]+\\s*条')) AS INT) AS hits FROM reg",
    "heading_normalize": f"""WITH {REG}, f AS (SELECT doc_id, pos, {ARTICLE_FIX} AS line FROM reg), b AS (SELECT *, trim(regexp_replace(line, '^#{{1,6}}\\s+', '')) AS t FROM f)
 SELECT doc_id, pos, CASE WHEN trim(line) = '' THEN line WHEN regexp_matches(t, '^第[0-9]+章') THEN '# ' || t WHEN regexp_matches(t, '^[0-9]+\\.[0-9]+(\\s|[^0-9.]|$)') THEN '## ' || t WHEN regexp_matches(line, '^#{{1,6}}\\s') THEN t ELSE line END AS line FROM b""",
    "cjk_gap": f"WITH {REG} SELECT doc_id, pos, '甲乙丙，' || replace(line, '中 文', '中文') AS line FROM reg",
    "blank_compress": f"WITH {LINES} SELECT doc_id, string_agg(raw || CASE WHEN i + 1 < n THEN repeat(chr(10), CAST(least(1, i % 4) + 1 AS INT)) ELSE repeat(chr(10), CAST(CASE WHEN i % 4 > 2 THEN 2 ELSE i % 4 END AS INT)) END, '' ORDER BY i) AS text FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM lines) GROUP BY doc_id",
    "rule_stats": f"""WITH {REG}, n AS (SELECT doc_id, CAST(count(*) FILTER ({FOOTER}) AS INT) AS page_numbers_removed, CAST(count(*) FILTER ({LONE}) AS INT) AS boilerplate_removed,
 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT ({FOOTER}) AND NOT {LONE}), '') AS kept FROM reg GROUP BY doc_id), m AS (SELECT *, regexp_replace(kept, '{PROTECTED}', chr(1), 'g') AS open FROM n)
 SELECT doc_id, page_numbers_removed, boilerplate_removed, CAST(len(regexp_extract_all(open, '第[ \\t]*[0-9]+[ \\t]*条')) AS INT) AS article_spaces_fixed, CAST(len(regexp_extract_all(open, '第[ \\t]*[0-9]+[ \\t]*章')) AS INT) AS chapter_spaces_fixed,
 CAST(0 AS INT) AS section_spaces_fixed FROM m""",
    "mask_spans": """WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)<table\\b[^>]*>[\\s\\S]*?</table>|!\\[[^\\]]*\\]\\([^)]*\\)(?:\\s*<!--[^>]*-->)?|<!--[\\s\\S]*?-->|\\$\\$[\\s\\S]*?\\$\\$|\\$[^\\n$]+?\\$') AS p FROM pages),
 e AS (SELECT page_id, unnest(range(len(p))) AS pos, unnest(p) AS payload FROM h) SELECT page_id, CAST(pos AS INT) AS pos, '<<' || CASE WHEN lower(payload) LIKE '<table%' THEN 'TAB' WHEN payload LIKE '![%' THEN 'IMG' WHEN payload LIKE '<!--%' THEN 'CMT' ELSE 'MATH' END || '_' || pos || '>>' AS token, payload FROM e""",
    "mask_roundtrip": """SELECT doc_id, '$a$ <!-- x --> ' || text AS text, CAST(2 + len(regexp_extract_all(text, '(?i)<table\\b[^>]*>[\\s\\S]*?</table>|!\\[[^\\]]*\\]\\([^)]*\\)(?:\\s*<!--[^>]*-->)?|<!--[\\s\\S]*?-->|\\$\\$[\\s\\S]*?\\$\\$|\\$[^\\n$]+?\\$')) AS INT) AS n FROM documents""",
    "size_chunks": "SELECT doc_id, CAST(k AS INT) AS pos, substring(text, k * 6000 + 1, 6000) AS text FROM (SELECT doc_id, text, unnest(range(greatest(1, (length(text) + 5999) // 6000))) AS k FROM documents WHERE text IS NOT NULL)",
    "chunk_reassemble": f"WITH {REG} SELECT doc_id, regexp_replace(string_agg(line, chr(10) ORDER BY pos), '^\\s+|\\s+$', '', 'g') || chr(10) AS text FROM reg GROUP BY doc_id",
    "clean_identity_model": "SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') || chr(10) AS text FROM documents WHERE text IS NOT NULL AND trim(text) <> ''",
    "chapters": f"""WITH {STRUCTURE} SELECT doc_id, chapter_id, arg_min(regexp_replace(regexp_replace(regexp_replace(line, '^# ', ''), '第 ([0-9]+) 章', '第\\1章'), '\\s+$', ''), pos) AS title,
 min(pos) AS start_pos, max(pos) AS end_pos, arg_min(page, pos) AS start_page, max(section_id) AS n_sections FROM struct GROUP BY ALL""",
    "sections": f"WITH {SECTIONS} SELECT doc_id, chapter_id, section_id, title, start_pos, end_pos, n_lines, n_chars FROM secs",
    "page_touches": f"""WITH {PAGED}, t AS (SELECT DISTINCT doc_id, CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) ELSE page END AS p FROM paged WHERE trim(line) <> '')
 SELECT doc_id, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS pages FROM t GROUP BY doc_id""",
    "table_spans": f"""WITH {PAGED} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS INT) AS table_no, pos AS start_pos, pos AS end_pos, page AS start_page, page AS end_page, label FROM (SELECT *, coalesce(last_value(named IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), '表' || row_number() OVER (PARTITION BY doc_id, line LIKE '<table%' ORDER BY pos)) AS label
 FROM (SELECT *, CASE WHEN line LIKE '#%' THEN substring(replace(translate({TITLE}, '/:\\*?"<>|', '／：＼＊？”＜＞｜'), ' ', ''), 1, 36) END AS named FROM paged)) WHERE line LIKE '<table%'""",
    "file_index": f"""WITH {LABELS} SELECT doc_id, string_agg('  - ' || label || '（第' || page || '页）', chr(10) ORDER BY pos) || chr(10) || chr(10) || string_agg('- **' || label || '**（第' || page || '页）：TODO: 待LLM补写', chr(10) ORDER BY pos) || chr(10) AS text FROM outline GROUP BY doc_id""",
    "root_index": f"""WITH {STRUCTURE}, c AS (SELECT doc_id, chapter_id, arg_min(regexp_replace(regexp_replace(regexp_replace(line, '^# ', ''), '第 ([0-9]+) 章', '第\\1章'), '\\s+$', ''), pos) AS title, min(page) AS a, max(page) AS b FROM struct GROUP BY ALL)
 SELECT doc_id, string_agg('- ' || title || '（' || CASE WHEN a = b THEN '第' || a || '页' ELSE '第' || a || '～' || b || '页' END || '）', chr(10) ORDER BY chapter_id) AS text FROM c GROUP BY doc_id""",
    "slug": """SELECT p_partkey, '第' || p_size || '条' || replace(p_name, ' ', '') || 'a／b：c' AS slug, '2.1' || substring(replace(p_name || p_type, ' ', ''), 1, 28) AS short FROM part""",
    "page_map_check": f"WITH {ISSUES} SELECT norm, label, kind, old_start, start, delta FROM issues",
    "page_map_fix": f"""WITH {INDEX} SELECT norm, pos, CASE WHEN pos % 2 = 0 THEN '  - ' || label || '（第' || page || '页）' ELSE '- **' || label || '**（第' || page || '页）：TODO: 待LLM补写' END AS line, wrong <> page AS changed FROM idx""",
    "body_page_range": f"WITH {LABELS} SELECT doc_id AS norm, CAST(pos % 3 AS VARCHAR) AS stem, min(page) AS start_page, max(page) AS end_page FROM outline GROUP BY ALL",
    "norm_semi": "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "pending_outputs": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "line_ratio": f"""WITH {REG}, n AS (SELECT doc_id, count(*) AS src_lines, count(*) FILTER (NOT ({FOOTER}) AND line NOT LIKE '<!-- 第 %') AS body_lines FROM reg GROUP BY doc_id)
 SELECT doc_id, src_lines, body_lines, body_lines - src_lines AS diff, body_lines / src_lines AS ratio, body_lines / src_lines > 1.05 OR body_lines / src_lines < 0.75 AS flag FROM n""",
    "dedup_stem": """WITH f AS (SELECT source || '-' || (doc_id // 5) AS stem, doc_id % 3 AS k FROM documents) SELECT '/in/' || stem || ext AS path, stem, ext FROM (SELECT stem, CASE min(k) WHEN 0 THEN '.docx' WHEN 1 THEN '.pdf' ELSE '.doc' END AS ext FROM f GROUP BY stem)""",
    "html_headings": """SELECT page_id, translate(regexp_replace(trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)), '\\s+', '', 'g'), '/:\\*?"<>|', '／：＼＊？”＜＞｜') AS slug, CAST(len(regexp_extract_all(html, '(?i)<p[ >]')) AS INT) AS n_paragraphs FROM pages""",
    "html_first_table": """SELECT page_id, '<table border="1"><tr><td>' || url || '</td></tr></table>' AS table_html, CASE WHEN t = '' OR contains(substring(t, 1, 80), 'border=') THEN t ELSE regexp_replace(t, '(?i)^<table', '<table border="1"') END AS of_page
 FROM (SELECT page_id, url, regexp_extract(html, '(?is)(<table.*?</table>)', 1) AS t FROM pages)""",
    "table_score": f"""WITH {GRID}, f AS (SELECT l_orderkey, len(grid) AS rows, list_transform(grid, lambda r: len(r)) AS c, flatten(grid) AS cells, (l_orderkey % 100) / 100 AS area FROM grids),
 g AS (SELECT *, list_sort(list_transform(list_distinct(c), lambda n: {{'a': -len(list_filter(c, lambda x: x = n)), 'n': n}}))[1].n AS cols, list_transform(cells, lambda x: length(trim(coalesce(x, '')))) AS k FROM f),
 h AS (SELECT *, len(list_filter(c, lambda x: x <> cols)) / rows AS var, len(k) AS total, len(list_filter(k, lambda x: x > 0)) AS filled, coalesce(list_sum(k), 0) AS chars FROM g),
 z AS (SELECT *, CASE WHEN rows < 2 THEN 'rows<2' WHEN cols < 2 THEN 'cols<2' WHEN area < 0.02 THEN 'area_ratio<0.02' WHEN area > 0.95 THEN 'area_ratio>0.95' WHEN var > 0.4 THEN 'col_var' WHEN total = 0 THEN 'no_cells' WHEN filled / total < 0.5 THEN 'filled_ratio' END AS reject_reason FROM h)
 SELECT l_orderkey, CAST(rows AS INT) AS rows, CAST(cols AS INT) AS cols, round(CASE WHEN reject_reason IS NULL THEN least(rows / 6, 1) * 0.3 + least(cols / 4, 1) * 0.3 + filled / total * 0.2 + (1 - least(chars / greatest(filled, 1) / 80, 1)) * 0.2 ELSE 0 END + 1e-9, 6) AS score, reject_reason FROM z""",
    "bbox_filter": """WITH b AS (SELECT l_orderkey, l_linenumber, greatest(0, CAST(l_quantity * 10 - 20 AS DOUBLE)) AS x0, greatest(0, CAST(l_discount * 1000 AS DOUBLE)) AS t, least(500, CAST(l_quantity * 14 AS DOUBLE)) AS x1, least(100, CAST(l_discount * 1000 + l_tax * 3000 AS DOUBLE)) AS bt FROM lineitem)
 SELECT l_orderkey, l_linenumber, CASE WHEN x1 > x0 AND bt > t THEN x0 END AS x0, CASE WHEN x1 > x0 AND bt > t THEN x1 END AS x1, CASE WHEN x1 > x0 AND bt > t THEN (x1 - x0) * (bt - t) / 50000 >= 0.05 ELSE false END AS is_large FROM b""",
    "html_table_build": """SELECT r_name, '<table border="1" >' || string_agg('<tr><td>' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '</td><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey) || '</table>' AS table_html FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
    "excerpt_verify": "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)",
    "citation_dangling": """WITH a AS (SELECT conv_id, unnest([1, CAST(max(turn) AS INT), CAST(max(turn) + 1 AS INT)]) AS seq FROM conversations GROUP BY conv_id) SELECT DISTINCT conv_id AS answer_id, seq FROM a WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = a.conv_id AND c.turn = a.seq)""",
    "verdict_counts": """SELECT lang, CASE WHEN quality = 1 AND toxic = 0 THEN '正确' WHEN quality = 1 THEN '溯源不足' WHEN toxic = 0 THEN '摘抄错误' ELSE '编造' END AS verdict, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL""",
    "clause_citations": f"WITH {LINES} SELECT doc_id, '甲法' AS norm, '第' || i || '条' AS article FROM lines UNION ALL SELECT doc_id, '乙法', '第二条' FROM lines",
    "lost_labels": f"WITH {LABELS} SELECT doc_id, label FROM outline WHERE label LIKE '%0 条'",
    "repeated_texts": "SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "report_rows": f"WITH {ISSUES} SELECT norm, CAST(place AS INT) AS place, label, delta, n_issues FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY encode(label)) AS place, count(*) OVER (PARTITION BY norm) AS n_issues FROM issues) WHERE place <= 200",
    "issue_deltas": f"WITH {ISSUES} SELECT norm, sum(n)::BIGINT AS n, string_agg(CAST(delta AS VARCHAR), ',' ORDER BY delta) AS deltas FROM (SELECT norm, delta, count(*) AS n FROM issues GROUP BY ALL) GROUP BY norm",
    "incremental_replay": f"WITH {LABELS} SELECT doc_id, label, page FROM outline",
    "bold_strip": f"""WITH {LINES} SELECT doc_id, CAST(i AS INT) AS pos, regexp_replace(regexp_replace(regexp_replace(raw, '([^ \\t\\n\\x0b\\f\\r]+)', '**\\1**', 'g'), '\\*\\*\\s*(第\\s*[一二三四五六七八九十百零〇两0-9\\s]+[条章节项][^*]*?)\\s*\\*\\*', '\\1', 'g'),
 '\\*\\*\\s*([\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]{{1,2}})\\s*\\*\\*', '\\1', 'g') AS line FROM lines""",
    "reflow": f"WITH {REFLOW} SELECT doc_id, coalesce(f4.text, chr(10)) AS text, coalesce(merged, 0) AS merged FROM documents LEFT JOIN f4 USING (doc_id)",
    "page_pieces": f"""WITH {REG}, p AS (SELECT *, coalesce(sum(CASE WHEN line LIKE '<!-- 第 %' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM reg),
 q AS (SELECT doc_id, CAST(k AS INT) AS pos, CASE WHEN k > 0 THEN chr(10) ELSE '' END || string_agg(line, chr(10) ORDER BY p.pos) AS text, max(CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) END) AS page FROM p GROUP BY doc_id, k)
 SELECT doc_id, pos, lag(page) OVER (PARTITION BY doc_id ORDER BY pos) AS page_no, page, text FROM q WHERE page IS NOT NULL OR regexp_matches(text, '[^\\s]')""",
    "greedy_chunks": GREEDY,
    "section_groups": f"""WITH RECURSIVE {GROUPS} SELECT doc_id, chapter_id, section_id, title, start_pos, end_pos, start_page, end_page, n_lines, n_chars, CAST(group_no AS INT) AS group_no, merged,
 CASE WHEN merged THEN 'TODO-待LLM命名-' || dense_rank() OVER (PARTITION BY doc_id, chapter_id, merged ORDER BY group_no) WHEN regexp_matches(slug, '^[0-9]') THEN regexp_extract(slug, '^([0-9]+(\\.[0-9]+)*)', 1) || substring(substring(slug, length(regexp_extract(slug, '^([0-9]+(\\.[0-9]+)*)', 1)) + 1), 1, 28) ELSE substring(slug, 1, 36) END AS stem FROM grouped""",
    "split_parts": f"""WITH {PARTS} SELECT doc_id, chapter_id, part_no, parts, start_pos, end_pos, start_page, end_page, is_table, table_no, range_no, CASE WHEN is_table THEN '-表' || table_no WHEN parts = 1 THEN '' ELSE '-' || texts END AS suffix FROM parts""",
    "split_bodies": f"""WITH {PARTS} SELECT p.doc_id, p.chapter_id, part_no, regexp_replace(regexp_replace(string_agg(CASE WHEN line LIKE '# %' THEN '# ' || {TITLE} WHEN line LIKE '## %' THEN '## ' || {TITLE} ELSE rtrim(line) END, chr(10) ORDER BY pos), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') || chr(10) AS text
 FROM parts p JOIN struct s ON s.doc_id = p.doc_id AND s.chapter_id = p.chapter_id AND s.pos BETWEEN start_pos AND end_pos GROUP BY ALL""",
    "word_lines": WORD_LINES,
    "page_overlap": f"""WITH {PARTS}, e AS (SELECT doc_id, chapter_id, unnest(range(start_page, end_page + 1)) AS page FROM parts WHERE NOT is_table) SELECT doc_id, chapter_id, CAST(page AS INT) AS page, count(*) AS files FROM e GROUP BY ALL HAVING count(*) > 1""",
    "rich_structure": f"WITH {RICH_STRUCTURE} SELECT doc_id, pos, page, chapter_id, CAST(sum(CAST(starts_section AS INT)) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS INT) AS section_id, starts_section FROM rstruct",
    "rich_tables": f"""WITH {RICH} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS INT) AS table_no, pos AS start_pos, pos + 2 AS end_pos, page AS start_page, page AS end_page, CASE WHEN pos // 4 % 18 = 5 THEN '表格第2页' ELSE '样表' || (pos // 4) END AS label FROM rpaged WHERE line = '<table>'""",
    "rich_outline": f"""WITH {RICH}, l AS (SELECT *, CASE WHEN regexp_matches(line, '^第[0-9]+条') THEN regexp_extract(line, '^(第[0-9]+条)', 1) WHEN regexp_matches(line, '^1\\.[0-9]+\\.3 ') THEN regexp_extract(line, '^(1\\.[0-9]+\\.3) ', 1) END AS label FROM rpaged WHERE NOT contains(line, '....')),
 b AS (SELECT *, max(CASE WHEN label LIKE '第%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS body FROM l) SELECT doc_id, label, CAST(arg_min(page, pos) AS INT) AS page FROM b WHERE body = 1 AND label IS NOT NULL GROUP BY doc_id, label""",
    "table_preambles": f"""WITH {RICH}, t AS (SELECT *, line IN ('<table>', '</table>') OR line LIKE '<tr><td>%' AS tab, trim(CASE WHEN line LIKE '<!-- 第 %' THEN regexp_replace(line, '^<!-- 第 [0-9]+ 页 -->', '') ELSE replace(line, '**', '') END) AS body FROM rpaged),
 n AS (SELECT *, row_number() OVER w AS k, CASE WHEN tab OR (length(body) > 80 AND line NOT LIKE '<!-- 第 %' AND NOT contains(substring(body, 1, 20), '表格')) THEN row_number() OVER w END AS stop FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
 b AS (SELECT *, greatest(coalesce(max(stop) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1, k - 9) AS since, CAST(row_number() OVER (PARTITION BY doc_id, line = '<table>' ORDER BY pos) AS INT) AS table_no FROM n)
 SELECT b.doc_id, b.table_no, b.pos AS start_pos, n.pos AS preamble FROM b JOIN n ON n.doc_id = b.doc_id AND n.k = b.since WHERE b.line = '<table>'""",
    "clean_with_model": "SELECT doc_id, CASE WHEN text IS NULL THEN 'failed' ELSE 'ok' END AS status, CAST(0 AS BIGINT) AS chunks_failed, CAST(0 AS BIGINT) AS tables_recovered, text IS NOT NULL AS asked FROM documents",
    "extraction_totals": f"WITH {RECORDS}, {TOTALS} SELECT * FROM tot",
    "extraction_report": EXTRACTION,
    "page_totals": """WITH p AS (SELECT l_orderkey AS file, l_linenumber % 3 + 1 AS tier, l_partkey % 3 AS a, l_partkey % 5 AS b, l_partkey % 2 AS c FROM lineitem), t AS (SELECT file, tier, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM p GROUP BY ALL)
 SELECT file, CAST(sum(n) AS BIGINT) AS pages, CAST(sum(a) AS BIGINT) AS tables, CAST(sum(b) AS BIGINT) AS images, CAST(sum(c) AS BIGINT) AS model_calls, string_agg(tier || ':' || n, ',' ORDER BY tier) AS tiers FROM t GROUP BY file""",
    "page_report": f"""WITH {ISSUES}, x AS (SELECT i.*, x.pos, row_number() OVER (PARTITION BY i.norm ORDER BY x.pos, encode(i.label)) AS k, count(*) OVER (PARTITION BY i.norm) AS n FROM issues i JOIN idx x ON x.norm = i.norm AND x.label = i.label)
 SELECT norm, '## ' || norm || '（' || any_value(n) || ' 处）（条号 delta: [' || array_to_string(list_transform(list_sort(list_distinct(list(delta))), lambda v: CAST(v AS VARCHAR)), ', ') || ']）' || chr(10) || chr(10) || '| 类型 | 标签 | index | 当前 | 应为 |' || chr(10) || '| --- | --- | --- | --- | --- |' || chr(10)
 || string_agg('| ' || kind || ' | ' || label || ' | `a-index.md` | ' || old_start || ' | ' || start || ' |', chr(10) ORDER BY k) FILTER (k <= 200) || CASE WHEN any_value(n) > 200 THEN chr(10) || chr(10) || '… 另有 ' || (any_value(n) - 200) || ' 处' ELSE '' END AS text FROM x GROUP BY norm""",
    "run_outcome": f"WITH {ISSUES} SELECT count(*) AS n, CAST(count(*) > 0 AS INT) AS exit_code FROM issues",
    "norm_warnings": f"""WITH {LABELS}, n AS (SELECT DISTINCT doc_id, CASE WHEN doc_id % 5 = 0 THEN '缺少 raw/' || doc_id || '.md' WHEN doc_id % 7 = 0 THEN '缺少 wiki/' || doc_id || '/' WHEN doc_id NOT IN (SELECT doc_id FROM outline) THEN doc_id || ': raw 未解析到条号/小节（指南类或结构特殊）' END AS warning FROM documents)
 SELECT CAST(doc_id AS VARCHAR) AS norm, warning FROM n WHERE warning IS NOT NULL""",
    "file_ranges_check": f"""WITH {LABELS}, r AS (SELECT doc_id AS norm, CAST(pos % 3 AS VARCHAR) AS stem, min(page) AS a, max(page) AS b FROM outline GROUP BY ALL) SELECT norm, stem, 'file' AS kind, a AS old_start, CAST(b + norm % 2 AS INT) AS old_end, a AS start, b AS "end" FROM r WHERE norm % 2 = 1""",
    "file_ranges_fix": f"""WITH {LABELS}, r AS (SELECT doc_id AS norm, CAST(pos % 3 AS VARCHAR) AS stem, min(page) AS a, max(page) AS b FROM outline GROUP BY ALL) SELECT norm, CAST(stem AS INT) AS pos, '- ' || stem || '（第' || a || '～' || b || '页）' AS line, norm % 2 = 1 AS changed FROM r""",
    "dead_links": """SELECT doc_id AS norm, 'i-index.md' AS index_path, 'b/c.md' AS target FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT doc_id, 'i-index.md', 'd' || doc_id || '.md' FROM documents WHERE doc_id % 3 <> 0""",
    "missing_references": "SELECT DISTINCT source, lang AS norm FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL AND source <> lang AND lang <> 'en'",
    "model_answers": r"SELECT doc_id, md5(CASE WHEN regexp_matches(text, '^\s*$') THEN text ELSE '答：' || text END) AS text_md5, TRUE AS model_ok FROM documents",
    "citation_graph": f"""WITH {CITES} SELECT CAST(doc_id AS VARCHAR) AS norm, CAST(i * 4 AS INT) AS pos, CAST(ord AS INT) AS ord, '第' || (si + 1) || '条' AS article, kind, CAST(t AS VARCHAR) AS target_norm,
 CASE WHEN kind = '本章' THEN '第' || (i // 12 + 1) || '章' WHEN ti >= 0 THEN '第' || (ti + 1) || '条' END AS target_article, CAST(CASE WHEN kind = '前款' THEN 1 ELSE 0 END AS BIGINT) AS target_paragraph,
 kind IN ('前款', '本条', '本章') OR (ti >= 0 AND EXISTS (SELECT 1 FROM art WHERE art.doc_id = t AND art.i = ti)) AS found FROM cites""",
    "citation_reach": f"""WITH RECURSIVE {CITES}, e AS (SELECT DISTINCT doc_id AS s, si, t, ti FROM cites WHERE kind <> '本章' AND EXISTS (SELECT 1 FROM art WHERE art.doc_id = t AND art.i = ti)),
r AS (SELECT doc_id AS s, i AS si, doc_id AS t, i AS ti, 0 AS n FROM art UNION SELECT r.s, r.si, e.t, e.ti, r.n + 1 FROM r JOIN e ON e.s = r.t AND e.si = r.ti WHERE r.n < 3)
SELECT CAST(s AS VARCHAR) AS start_norm, '第' || (si + 1) || '条' AS start_article, CAST(t AS VARCHAR) AS norm, '第' || (ti + 1) || '条' AS article, CAST(min(n) AS INT) AS distance,
 EXISTS (SELECT 1 FROM e WHERE e.s = r.t AND e.si = r.ti AND e.t = r.s AND e.ti = r.si) AS closes FROM r GROUP BY s, si, t, ti""",
    "citation_targets": f"""WITH {LABELS}, c AS (SELECT doc_id, '第 ' || (pos // 4) || ' 条' AS article, pos FROM reg WHERE pos % 4 = 0) SELECT '规范' || c.doc_id AS norm, article, c.pos, o.page FROM c LEFT JOIN outline o ON o.doc_id = c.doc_id AND o.label = article""",
    "long_document_scan": f"""WITH {REG}, one AS (SELECT 'all' AS doc_id, doc_id * 1000000 + pos AS pos, line FROM reg)
 SELECT doc_id, pos, CAST(greatest(1, coalesce(max(CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) + 1 END) OVER w, 1)) AS INT) AS page,
 CASE WHEN line LIKE '<table%' THEN CAST(count(*) FILTER (line LIKE '<table%') OVER w AS INT) END AS table_no FROM one WINDOW w AS (ORDER BY pos ROWS UNBOUNDED PRECEDING)""",
    "long_document_tables": f"""WITH {RICH}, one AS (SELECT doc_id * 1000000 + pos AS k, pos, line FROM rpaged),
 p AS (SELECT *, CAST(greatest(1, coalesce(max(CASE WHEN line LIKE '<!-- 第 %' THEN CAST(regexp_extract(line, '([0-9]+)', 1) AS INT) + 1 END) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING), 1)) AS INT) AS gpage FROM one)
 SELECT 'all' AS doc_id, CAST(row_number() OVER (ORDER BY k) AS INT) AS table_no, k AS start_pos, k + 2 AS end_pos, gpage AS start_page, gpage AS end_page, CASE WHEN pos // 4 % 18 = 5 THEN '表格第2页' ELSE '样表' || (pos // 4) END AS label FROM p WHERE line = '<table>'""",
    "content_pages": f"WITH {STRUCTURE} SELECT doc_id, pos, page, chapter_id FROM struct",
    "title_lines": f"WITH {STRUCTURE} SELECT doc_id, pos, page, chapter_id FROM struct",
    "index_terms": f"WITH {TERMS} SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM t GROUP BY term",
    "index_search": f"""WITH {TERMS}, {ASKED.format(n=5)}, tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
 SELECT query_id, doc_id, CAST(sum(n) AS BIGINT) AS hits, round(sum(n * ln(1 + (SELECT CAST(count(*) AS DOUBLE) FROM documents WHERE text IS NOT NULL) / df)), 6) AS score
 FROM q JOIN tf USING (term) JOIN df USING (term) GROUP BY query_id, doc_id, of HAVING count(*) = of""",
    "index_phrases": f"""WITH {TERMS}, {ASKED.format(n=3)}, df AS (SELECT term, count(DISTINCT doc_id) AS df FROM t GROUP BY term),
 w AS (SELECT query_id, sum(ln(1 + (SELECT CAST(count(*) AS DOUBLE) FROM documents WHERE text IS NOT NULL) / df)) AS weight FROM q JOIN df USING (term) GROUP BY query_id),
 m AS (SELECT query_id, doc_id, pos - slot AS start FROM q JOIN t USING (term) GROUP BY query_id, doc_id, pos - slot, of HAVING count(DISTINCT slot) = of)
 SELECT query_id, doc_id, count(*) AS hits, round(count(*) * any_value(weight), 6) AS score FROM m JOIN w USING (query_id) GROUP BY query_id, doc_id""",
    "keyword_search": "SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 + (length(text) - length(replace(text, 'and', ''))) / 3 AS INT) AS hits FROM documents WHERE contains(text, 'the') AND contains(text, 'and')",
    "norm_anti": "SELECT DISTINCT lang || '-' || doc_id AS norm FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL AND lang || '-' || doc_id NOT IN (SELECT lang || '-' || doc_id FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL AND toxic = 1)",
    "modal_cols": f"""WITH {GRID}, c AS (SELECT list_transform(grid, lambda r: len(r)) AS c FROM grids) SELECT CAST(list_sort(list_transform(list_distinct(c), lambda n: {{'a': -len(list_filter(c, lambda x: x = n)), 'n': n}}))[1].n AS INT) AS cols, count(*) AS n FROM c GROUP BY 1""",
    "table_candidates": f"""WITH {CANDIDATES}, f AS (SELECT *, list_transform(grid, lambda r: len(r)) AS c, list_transform(flatten(grid), lambda x: length(trim(coalesce(x, '')))) AS cells, max(CASE WHEN mode = 'strict' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS strict FROM cand),
 g AS (SELECT *, list_sort(list_transform(list_distinct(c), lambda n: {{'a': -len(list_filter(c, lambda x: x = n)), 'n': n}}))[1].n AS cols FROM f WHERE strict = 0 OR mode = 'strict')
 SELECT l_orderkey, mode, CAST(len(grid) AS INT) AS rows, NOT (len(grid) < 2 OR cols < 2 OR area < 0.02 OR area > 0.95 OR len(list_filter(c, lambda x: x <> cols)) / len(grid) > 0.4 OR len(cells) = 0 OR len(list_filter(cells, lambda x: x > 0)) / len(cells) < 0.5) AS accepted FROM g""",
    "box_dedup": "SELECT l_orderkey, count(DISTINCT round_even(round(CAST(l_quantity AS DOUBLE) / 4) + 0.2, 0)) AS n FROM lineitem GROUP BY 1",
    "cell_spans": "SELECT l_orderkey, CAST(l_partkey % 2 AS BIGINT) AS cell_id, min(l_linenumber) AS r, min(l_linenumber % 2) AS c, count(DISTINCT l_linenumber) AS rs, count(DISTINCT l_linenumber % 2) AS cs, CAST(l_partkey % 2 AS VARCHAR) AS text FROM lineitem GROUP BY l_orderkey, l_partkey % 2",
    "page_assembly": "SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), chr(10) || chr(10) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS markdown FROM lineitem WHERE l_partkey % 4 <> 0 GROUP BY 1",
    "blank_runs": f"""WITH {LINES}, b AS (SELECT doc_id, i, CASE WHEN i % 5 > 2 THEN ' ' ELSE raw END AS line FROM lines), c AS (SELECT *, trim(line) = '' AND coalesce(lag(trim(line) = '') OVER (PARTITION BY doc_id ORDER BY i), false) AS again FROM b) SELECT doc_id, CAST(i AS INT) AS pos, line FROM c WHERE NOT again""",
    "provenance_fill": "SELECT conv_id AS answer_id, CAST(turn AS INT) AS seq, last_value(CASE WHEN turn % 3 = 0 THEN 'p' || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM conversations",
    "provenance_pages": f"WITH {LABELS} SELECT doc_id AS norm, label, CAST(page + 1 AS INT) AS cited_page, page FROM outline WHERE pos // 4 % 2 = 1",
    "topic_labels": """SELECT p_partkey, '第' || p_size || '条' AS article, p_size || '.1.2' AS clause, string_split(p_name, ' ')[1] AS word, substring('第' || p_size || '章' || replace(p_name, ' ', ''), 1, 40) AS dir, substring(replace(p_name, ' ', ''), 1, 40) AS stem FROM part""",
    "prompt_messages": """SELECT item_id, '[{"role":"system","content":"清洗"},{"role":"user","content":' || CAST(to_json(text) AS VARCHAR) || '}]' AS messages FROM benchmark""",
    "paragraphs_markdown": f"""WITH {LINES}, c AS (SELECT doc_id, i, trim(regexp_replace(CASE WHEN i % 6 = 0 THEN '第' || (i + 1) || '章 ' ELSE '' END || raw, '[ \\t]+', ' ', 'g')) AS t FROM lines)
 SELECT doc_id, string_agg(CASE WHEN length(t) <= 40 AND regexp_matches(t, '^第[0-9]+\\s*章') THEN '# ' || t ELSE t END, chr(10) || chr(10) ORDER BY i) AS text FROM c WHERE t <> '' GROUP BY doc_id""",
    "rules_clean": f"WITH {CLEAN} SELECT doc_id, text, {', '.join(COUNTED)} FROM c9",
    "clean_report": f"WITH {CLEAN} SELECT count(*) AS n_docs, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in COUNTED)} FROM c9",
    "clean_rules_only": f"WITH {CLEAN} SELECT doc_id, md5(text) AS text_md5, 'ok' AS status, CAST(NULL AS VARCHAR) AS error, CAST(length(source) AS INT) AS chars_before, CAST(length(text) AS INT) AS chars_after, CAST(0 AS BIGINT) AS chunks, lines_merged FROM c9",
}
