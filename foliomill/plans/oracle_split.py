"""DuckDB SQL for whole runs: the split of dressed documents with its indexes and report, and the report of a cleaning run."""

from __future__ import annotations

from ..operators.report import RULE_NAMES
from .oracle import CLEAN, COUNTED, GROUPS, LINES, REG, RICH_STRUCTURE, SECTIONS, _cells, _lines, _table

SEGMENT = "doc_id, chapter_id, group_no"
AFTER_MARKER = "trim(replace(CASE WHEN line LIKE '<!-- 第 %' THEN regexp_replace(line, '^<!-- 第 [0-9]+ 页 -->', '') ELSE line END, '**', ''))"


def _plain(line: str) -> str:
    return f"trim(regexp_replace(replace({line}, '*', ''), '\\s+', ' ', 'g'))"


def _cut(text: str, stops: tuple[str, ...]) -> str:
    for stop in stops:
        text = f"split_part({text}, '{stop}', 1)"
    return text


def _slug(title: str) -> str:
    return f"""replace(translate({title}, '/:\\*?"<>|', '／：＼＊？”＜＞｜'), ' ', '')"""


def _pages(start: str, end: str) -> str:
    return f"'（' || CASE WHEN {start} = {end} THEN '第' || {start} || '页' ELSE '第' || {start} || '～' || {end} || '页' END || '）'"


PART_TITLE = f"substring(line, 1, 2) || substring({_cut(_plain('substring(line, 3)'), ('。', '；'))}, 1, 18)"
ITEM_TITLE = f"substring(line, 1, 3) || substring({_cut(_plain('substring(line, 4)'), ('。', '；', '本指导', '本原则', '常见', '良好'))}, 1, 18)"
#: Structured lines of the dressed documents, a final empty line left out as every reader of line breaks does.
PLACED = f"""{RICH_STRUCTURE}, ends AS (SELECT doc_id, max(pos) AS last_pos, arg_max(line, pos) = '' AS open_end, count(*) AS n_all FROM rich GROUP BY doc_id),
sx AS (SELECT doc_id, pos, line, page, chapter_id, starts_section, CAST(sum(CAST(starts_section AS INT)) OVER (PARTITION BY doc_id, chapter_id ORDER BY pos) AS INT) AS section_id,
 CASE WHEN part AND line LIKE '附：%' THEN {_plain('line')} WHEN part THEN {PART_TITLE} WHEN item THEN {ITEM_TITLE} END AS title, {AFTER_MARKER} AS body, CASE WHEN line LIKE '<!-- 第 %' THEN {AFTER_MARKER} ELSE trim(line) END AS counted
 FROM rstruct JOIN ends USING (doc_id) WHERE NOT (open_end AND pos = last_pos)),
secs AS (SELECT doc_id, chapter_id, section_id, arg_min(title, pos) AS title, count(*) FILTER (counted <> '') AS n_lines, sum(length(counted)) AS n_chars FROM sx WHERE section_id > 0 GROUP BY ALL)"""
#: Segments with their names: the section groups of a chapter, and what comes before them as group 0.
SEGMENTS = f"""{PLACED}{GROUPS.removeprefix(SECTIONS)},
stems AS (SELECT *, CASE WHEN merged THEN 'TODO-待LLM命名-' || dense_rank() OVER (PARTITION BY doc_id, chapter_id, merged ORDER BY group_no) ELSE substring(slug, 1, 36) END AS gstem FROM grouped),
gnames AS (SELECT doc_id, chapter_id, group_no, any_value(merged) AS merged, any_value(gstem) AS gstem, list(title ORDER BY section_id) AS titles FROM stems GROUP BY ALL),
heads AS (SELECT doc_id, chapter_id, arg_min(title, pos) AS chapter FROM sx WHERE chapter_id > 0 GROUP BY ALL),
seg AS (SELECT sx.*, CAST(coalesce(group_no, 0) AS INT) AS group_no FROM sx LEFT JOIN (SELECT doc_id, chapter_id, section_id, group_no FROM grouped) USING (doc_id, chapter_id, section_id)),
facts AS (SELECT s.*, '规范' || doc_id AS name, chapter, CASE WHEN merged THEN titles END AS titles, coalesce(merged, false) AS merged,
 CASE WHEN chapter_id = 0 THEN '规范' || doc_id WHEN group_no = 0 THEN substring({_slug('chapter')}, 1, 40) ELSE gstem END AS stem, CASE WHEN chapter_id = 0 THEN '规范' || doc_id WHEN group_no = 0 OR merged THEN chapter ELSE titles[1] END AS file_title
 FROM (SELECT {SEGMENT}, CASE WHEN chapter_id > 0 THEN rtrim(arg_min(line, pos)) END AS heading FROM seg GROUP BY {SEGMENT}) s LEFT JOIN gnames USING ({SEGMENT}) LEFT JOIN heads USING (doc_id, chapter_id))"""
#: Body files: tables with the short lines above them, text between them by pages.
FILES = f"""{SEGMENTS}, q0 AS (SELECT *, line IN ('<table>', '</table>') OR line LIKE '<tr><td>%' AS tab FROM seg),
q1 AS (SELECT *, row_number() OVER w AS k, CASE WHEN tab THEN sum(CAST(line = '<table>' AS INT)) OVER w END AS table_no,
 CASE WHEN tab OR (length(body) > 80 AND line NOT LIKE '<!-- 第 %' AND NOT contains(substring(body, 1, 20), '表格')) THEN row_number() OVER w END AS stop, body = '' OR regexp_matches(body, '^表格（第[0-9]+页）$') OR length(body) < 4 AS scrap FROM q0 WINDOW w AS (PARTITION BY {SEGMENT} ORDER BY pos)),
q2 AS (SELECT *, CASE WHEN line = '<table>' THEN greatest(coalesce(max(stop) OVER (PARTITION BY {SEGMENT} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1, k - 9) END AS since, lag(table_no) OVER (PARTITION BY {SEGMENT} ORDER BY pos) AS before FROM q1),
q3 AS (SELECT q2.*, p.pos AS preamble, sum(CASE WHEN q2.k = 1 OR q2.table_no IS DISTINCT FROM q2.before THEN 1 ELSE 0 END) OVER (PARTITION BY q2.doc_id, q2.chapter_id, q2.group_no ORDER BY q2.pos) AS piece
 FROM q2 LEFT JOIN (SELECT {SEGMENT}, k, pos FROM q1) p ON p.doc_id = q2.doc_id AND p.chapter_id = q2.chapter_id AND p.group_no = q2.group_no AND p.k = q2.since),
q4 AS (SELECT *, min(pos) OVER p AS piece_pos, max(CAST(NOT scrap AS INT)) OVER p AS real, min(page) OVER p AS lo, max(page) OVER p AS hi, min(preamble) OVER (PARTITION BY {SEGMENT} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next FROM q3 WINDOW p AS (PARTITION BY {SEGMENT}, piece)),
q5 AS (SELECT *, unnest(CASE WHEN tab OR hi - lo < 2 THEN [{{'a': lo, 'b': hi}}] ELSE list_transform(range(lo, hi + 1, 2), lambda s: {{'a': CASE WHEN s > lo THEN CAST(s AS INT) - 1 ELSE CAST(s AS INT) END, 'b': least(hi, CAST(s AS INT) + 1)}}) END) AS r FROM q4 WHERE tab OR (real = 1 AND (next IS NULL OR piece_pos < next))),
q6 AS (SELECT {SEGMENT}, piece, table_no, r, coalesce(min(preamble), min(pos)) AS start_pos, max(pos) AS end_pos, min(page) AS start_page, max(page) AS end_page FROM q5 WHERE page BETWEEN r.a AND r.b GROUP BY ALL),
q7 AS (SELECT *, CAST(row_number() OVER w AS INT) AS part_no, CAST(count(*) OVER (PARTITION BY {SEGMENT}) AS INT) AS parts, table_no IS NOT NULL AS is_table, row_number() OVER (PARTITION BY {SEGMENT}, piece ORDER BY start_pos, end_pos) AS range_no, sum(CASE WHEN table_no IS NULL THEN 1 ELSE 0 END) OVER w AS texts FROM q6 WINDOW w AS (PARTITION BY {SEGMENT} ORDER BY piece, start_pos, end_pos)),
files AS (SELECT q7.*, facts.* EXCLUDE ({SEGMENT}, stem), stem || CASE WHEN is_table THEN '-表' || table_no WHEN parts = 1 THEN '' ELSE '-' || texts END AS stem, CASE WHEN (end_pos // 4) % 18 = 5 THEN '表格第2页' ELSE '样表' || (end_pos // 4) END AS label FROM q7 JOIN facts USING ({SEGMENT})),
shown AS (SELECT f.doc_id, f.chapter_id, f.group_no, part_no, is_table, range_no, heading, s.pos, s.page, rtrim(s.line) AS line FROM files f JOIN seg s ON s.doc_id = f.doc_id AND s.chapter_id = f.chapter_id AND s.group_no = f.group_no AND s.pos BETWEEN start_pos AND end_pos),
bodies AS (SELECT {SEGMENT}, part_no, regexp_replace(regexp_replace(CASE WHEN NOT any_value(is_table) AND any_value(range_no) > 1 AND any_value(heading) IS NOT NULL THEN any_value(heading) || chr(10) || chr(10) ELSE '' END || string_agg(line, chr(10) ORDER BY pos), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') || chr(10) AS text FROM shown GROUP BY {SEGMENT}, part_no)"""


def _labels(source: str, key: str) -> str:
    """One row for each key with its labels in order, from the first article on."""
    return f"""(SELECT {key}, list({{'label': label, 'page': page}} ORDER BY pos) AS entries FROM (SELECT {key}, label, arg_min(page, pos) AS page, min(pos) AS pos FROM
 (SELECT *, max(CASE WHEN label LIKE '第%' THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY pos) AS begun FROM (SELECT *, CASE WHEN contains(line, '....') THEN NULL WHEN regexp_matches(line, '^第[0-9]+条') THEN regexp_extract(line, '^(第[0-9]+条)', 1)
 WHEN regexp_matches(line, '^1\\.[0-9]+\\.3([^0-9.]|$)') THEN regexp_extract(line, '^(1\\.[0-9]+\\.3)', 1) END AS label FROM {source})) WHERE begun = 1 AND label IS NOT NULL GROUP BY {key}, label) GROUP BY {key})"""


def _each(of: str, made: str) -> str:
    return f"list_transform({of}, lambda e: {made})"


TODO, NAME_TODO = "TODO: 待LLM补写", "TODO: 待LLM补写合并块的文件名"
NOTHING = "CAST([] AS VARCHAR[])"
CATALOG = f"""list_concat(['- ' || {_slug('file_title')}], CASE WHEN merged THEN list_concat(['  - （合并块，含以下二级标题）'], {_each('titles', "'    - ' || " + _slug('e'))}, ['  - **文件名**：{NAME_TODO}']) ELSE {NOTHING} END,
 {_each('listed', "'  - ' || e.label || '（第' || e.page || '页）'")}, CASE WHEN parts > 1 THEN ['- 拆分段：第 ' || part_no || ' 段，共 ' || parts || ' 段'] ELSE {NOTHING} END)"""
SUMMARIES = f"""list_concat({_each('listed', f"'- **' || e.label || '**（第' || e.page || '页）：{TODO}'")}, CASE WHEN merged OR len(listed) = 0 THEN ['- **' || stem || '**' || {_pages('start_page', 'end_page')} || '：' || CASE WHEN merged THEN '{NAME_TODO}' ELSE '{TODO}' END] ELSE {NOTHING} END)"""
WRITTEN = f"""{FILES}, listing AS (SELECT f.*, text, CASE WHEN is_table THEN [{{'label': label, 'page': start_page}}] ELSE coalesce(entries, []) END AS listed FROM files f JOIN bodies USING ({SEGMENT}, part_no) LEFT JOIN {_labels('(SELECT * FROM shown WHERE NOT is_table)', SEGMENT + ', part_no')} USING ({SEGMENT}, part_no)),
written AS (SELECT doc_id, name || '/' || CASE WHEN chapter_id > 0 THEN substring({_slug('chapter')}, 1, 40) || '/' ELSE '' END || stem || '.md' AS path, stem, chapter_id, group_no, part_no, parts, start_page, end_page, is_table, text,
 '# ' || stem || '索引' || chr(10) || chr(10) || '## 条目录' || chr(10) || chr(10) || array_to_string({CATALOG}, chr(10)) || chr(10) || chr(10) || '## 条文摘要' || chr(10) || chr(10) || array_to_string({SUMMARIES}, chr(10)) || chr(10) AS index_text FROM listing)"""
HEAD = f"""CASE WHEN len(tree) > 0 THEN list_concat(['## 章节目录', ''], tree) WHEN len(labels) > 0 THEN list_concat(['## 条目录', ''], {_each('labels', "'- ' || e.label || '（第' || e.page || '页）'")}) ELSE ['## 章节目录', ''] END"""
INDEXES = f"""{WRITTEN}, outs AS (SELECT doc_id, count(*) AS files, sum(len(string_split(regexp_replace(text, '\\n$', ''), chr(10)))) AS body_lines, list({{'stem': stem, 'start_page': start_page, 'end_page': end_page}} ORDER BY chapter_id, group_no, part_no) AS listed FROM written GROUP BY doc_id),
trees AS (SELECT doc_id, count(*) AS chapters, flatten(list(l ORDER BY chapter_id)) AS tree FROM (SELECT doc_id, chapter_id, list_concat(['- ' || {_slug('any_value(chapter)')}], coalesce(list('  - ' || {_slug('title')} ORDER BY pos) FILTER (starts_section), {NOTHING})) AS l FROM sx JOIN heads USING (doc_id, chapter_id) GROUP BY doc_id, chapter_id) GROUP BY doc_id),
whole AS (SELECT doc_id, n_all - CAST(open_end AS INT) AS src_lines, coalesce(chapters, 0) AS chapters, coalesce(files, 0) AS files, coalesce(body_lines, 0) AS body_lines, coalesce(tree, {NOTHING}) AS tree, coalesce(listed, []) AS listed, coalesce(entries, []) AS labels
 FROM ends LEFT JOIN outs USING (doc_id) LEFT JOIN trees USING (doc_id) LEFT JOIN {_labels('(SELECT * FROM sx WHERE chapter_id = 0)', 'doc_id')} USING (doc_id)),
indexes AS (SELECT doc_id, '规范' || doc_id || '/规范' || doc_id || '-index.md' AS path, '# 规范' || doc_id || '索引' || chr(10) || chr(10) || array_to_string({HEAD}, chr(10)) || chr(10) || chr(10) || '## 文件目录' || chr(10) || chr(10) || array_to_string({_each('listed', "'- ' || e.stem || " + _pages('e.start_page', 'e.end_page'))}, chr(10))
 || chr(10) || chr(10) || '## 各文件摘要' || chr(10) || chr(10) || array_to_string({_each('listed', "'- **' || e.stem || '**' || " + _pages('e.start_page', 'e.end_page') + f" || '：{TODO}'")}, chr(10)) || chr(10) AS text,
 CAST(chapters AS INT) AS chapters, CAST(files AS INT) AS files, CAST(src_lines AS INT) AS src_lines, CAST(body_lines AS BIGINT) AS body_lines FROM whole)"""
SHARE = "CAST(coalesce(round(CAST(body_lines AS DECIMAL(18, 0)) * 100 / src_lines, 12), 0) AS DECIMAL(30, 12))"
SHOWN = f"CAST(CAST(round({SHARE}, 2) AS DECIMAL(18, 2)) AS VARCHAR) || '%' || CASE WHEN body_lines / src_lines > 1.05 OR body_lines / src_lines < 0.75 THEN ' [!]' ELSE '' END"
SPLIT_REPORT = f"WITH RECURSIVE {INDEXES} " + " UNION ALL ".join(
    (
        _lines(0, "(SELECT count(*) AS n FROM indexes)", "'# Wiki 批量拆分报告'", "''", "'- 成功：' || n || ' 份'", "''", "'| 源文件 | 章数 | 正文文件数 | 源行数 | 拆分行数 | 差值 | 比值 |'", "'| --- | ---: | ---: | ---: | ---: | ---: | ---: |'"),
        f"SELECT 1, lpad(CAST(doc_id AS VARCHAR), 20, '0'), {_cells('doc_id', 'chapters', 'files', 'src_lines', 'body_lines', "printf('%+d', body_lines - src_lines)", SHOWN)} FROM indexes",
    )
)

#: The cleaning run over the documents as they are; a null text is a failed one.
RAW = LINES + ", reg AS (SELECT doc_id, CAST(i AS INT) AS pos, raw AS line FROM lines)"
SUMS = ("chars_before", "chars_after", *COUNTED)
RUN = f"""{RAW}{CLEAN.removeprefix(REG)}, rows AS (SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 'failed' ELSE 'ok' END AS status, CASE WHEN d.text IS NULL THEN 'no text' END AS error, length(d.text) AS chars_before, length(c9.text) AS chars_after, {', '.join(COUNTED)} FROM documents d LEFT JOIN c9 USING (doc_id)),
tot AS (SELECT count(*) AS files, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in SUMS)} FROM rows)"""
HITS = " + ".join(f"coalesce({c}, 0)" for c in COUNTED)
KEY = "lpad(CAST(doc_id AS VARCHAR), 20, '0')"
CLEAN_REPORT = f"WITH {RUN} " + " UNION ALL ".join(
    (
        _lines(
            0, "tot", "'# Markdown 清洗运行报告'", "''", "'## 总览'", "''", "'| 指标 | 数值 |'", "'| --- | --- |'", *[_cells(f"'{n}'", c) for n, c in (("文件总数", "files"), ("✓ 成功", "ok"), ("✗ 失败", "failed"), ("总字符（清洗前）", "chars_before"), ("总字符（清洗后）", "chars_after"))],
            _cells("'LLM chunk 调用'", "'0/0（失败 0）'"), _cells("'LLM 恢复表格数'", "0"), "''", "'## 本地规则命中（累计）'", "''", "'| 规则 | 命中次数 |'", "'| --- | --- |'", *[_cells(f"'{n}'", c) for n, c in RULE_NAMES],
        ),
        _table(1, "文件明细", ("文件", "状态", "本地规则命中", "LLM chunks", "恢复表格", "清洗前字符", "清洗后字符", "变化"), "rows", KEY, "doc_id", "status", HITS, "'0/0'", "0", "chars_before", "chars_after", "chars_after - chars_before"),
        _table(3, "失败文件", ("文件", "错误"), "(SELECT * FROM rows WHERE status = 'failed')", KEY, "doc_id", "error"),
    )
)

SPLIT_SQL = {
    "split_files": f"WITH RECURSIVE {WRITTEN} SELECT * FROM written",
    "split_indexes": f"WITH RECURSIVE {INDEXES} SELECT * FROM indexes",
    "split_report": SPLIT_REPORT,
    "clean_run_report": CLEAN_REPORT,
}
