"""Patterns, names and limits that results depend on (Java regular expressions)."""

# Numerals of article, chapter and section numbers; the second set also has thousands.
CN_NUM = "一二三四五六七八九十百零〇两"
CN_NUM_LONG = "一二三四五六七八九十百千零〇两"
CJK = "\\u4e00-\\u9fff"

# Regions that text rules leave alone, in this order of preference.
PROTECTED = (
    r"(?i)<table\b[^>]*>[\s\S]*?</table>"
    r"|!\[[^\]]*\]\([^)]*\)(?:\s*<!--[^>]*-->)?"
    r"|<!--[\s\S]*?-->"
    r"|\$\$[\s\S]*?\$\$"
    r"|\$[^\n$]+?\$"
)
PAGE_END = r"<!--\s*第\s*(\d+)\s*页\s*-->"
PAGE_MARKER = r"<!--\s*(?:第\s*)?[·•.]?\s*(\d+)\s*[·•.]?\s*(?:页)?\s*-->"
HEADING = r"^(#{1,6})\s*(.+?)\s*$"

# Lines and phrases of page furniture.
NUMERIC_FOOTER = r"^[ \t]*[-—·.]?\s*\d{1,4}\s*[-—·.]?[ \t]*$"
DASH_PAGE = r"^[ \t]*[-—·]\s*\d{1,4}\s*[-—·][ \t]*$"
EM_DASH_PAGE = r"^[ \t]*——\s*\d{1,4}\s*——[ \t]*$"
AUTHORITY = "(?:总局|委员会|部|署)"
RULE_HEADER = "(?:原)?国家(?:市场监督管理|食品药品监督管理|药品监督管理)总局规章"
ISSUED_LINE = rf"^[ \t]*(?:[Xx])?(?:原)?国家[{CJK}、]{{2,100}}?{AUTHORITY}(?:[、,，][{CJK}、]{{2,60}}?{AUTHORITY})*发布[ \t]*$"
ISSUED_PHRASE = rf"(?:[Xx](?=国)|(?<=[{CJK}])[Xx])?(?:原)?国家[{CJK}、]{{4,56}}?{AUTHORITY}(?:[、,，]国家[{CJK}、]{{4,40}}?{AUTHORITY})?发布"
LONE_X = r"^[ \t]*[Xx][ \t]*$"

ARTICLE = rf"^第\s*([{CN_NUM}\d]+)\s*条"
CHAPTER = rf"^第\s*([{CN_NUM}\d]+)\s*[章编]\s*(.*)$"
SECTION = rf"^第\s*([{CN_NUM}\d]+)\s*节\s*(.*)$"
SECTION_NUMBER = r"^(\d+\.\d+)(?=\s|[^\d.]|$)\s*(.*)$"
CLAUSE_NUMBER = r"^(\d+\.\d+\.\d+)(?=\s|[^\d.]|$)"
GUIDE_TITLE = r"^(\d+(?:\.\d+)*)\s*\.?\s*(.*)$"
GUIDE_CLAUSE = rf"^(\d+\.\d+(?:\.\d+)*)\s+[{CJK}（(]"
SUPPLEMENT = r"^附\s*则\s*(.*)$"
APPENDIX = rf"^附\s*([录件])\s*([A-Za-z\d{CN_NUM}]*)?\s*(.*)$"
APPENDED = r"^附[：:]\s*(.*)$"
CN_PART = rf"^([{CN_NUM_LONG}]+)、\s*(.*)$"
CN_ITEM = rf"^(?:（[{CN_NUM_LONG}]+）|\([{CN_NUM_LONG}]+\))"
TAIL = "^(本规范用词说明|引用标准名录|条文说明|修订说明|本标准用词说明)$"
TABLE_CAPTION = r"^表格\s*(?:[（(]\s*第\s*\d+\s*页\s*[）)])?\s*$"
LIST_ITEM = r"^(\(?[一二三四五六七八九十百零〇]+\)|（[一二三四五六七八九十百零〇]+）|\d+[.、)]|[（(]\d+[）)])"
CLAUSE_WORDS = ("应当", "不得", "报告单位", "以下规定", "包括", "有下列")
SECTION_TITLE_STOPS = ("。", "；", "本指导", "本原则", "常见", "良好")
FULL_WIDTH = {"/": "／", ":": "：", "\\": "＼", "*": "＊", "?": "？", '"': "”", "<": "＜", ">": "＞", "|": "｜"}

# Rules on lines and titles.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SHIELD = r"^\x00P\d+\x00$"
SENTENCE_END, SENTENCE_END_OR_COLON = "[。！？；;]$", "[。！？；;：:]$"
NUMBERED_TITLE = rf"^\d+[.\s、．]?\s*[{CJK}（(][^\n]{{1,40}}$"
NUMBERED_SHORT = rf"^\d+\s+[{CJK}]{{2,25}}$"
NUMBERED_CLAUSE = rf"^\d+\.\d+[{CJK}]"
GUESS_NUM = r"[一二三四五六七八九十百零\d]+"
BOLD_LEGAL = rf"\*\*\s*(第\s*[{CN_NUM}\d\s]+[条章节项][^*]*?)\s*\*\*"
BOLD_SHORT = rf"\*\*\s*([{CJK}\w]{{1,2}})\s*\*\*"
GAP_AFTER = rf"([{CJK}])[ \t]+(?=[{CJK}、，。；：！？）」』】])"
GAP_BEFORE = rf"([{CJK}、，。；：！？（「『【])[ \t]+(?=[{CJK}])"
OCR_NUMBER, OCR_STOP = r"(\d+)\s*[．.]\s+\$([0-9][^$]*)\$", r"(\$\s*[^$]+?\$)\s*、\s*的"
OCR_RANGE = ("$25\\mathrm {\\;Pa}\\;30\\mathrm {\\;Pa}$", "$25\\mathrm {\\;Pa}~30\\mathrm {\\;Pa}$")

# Index line shapes.
CATALOG_LINE = r"^\s{2}- (.+?)（第(\d+)页）\s*$"
SUMMARY_LINE = r"^- \*\*(.+?)\*\*（第(\d+)页）："
FILE_LINE = r"^- (?!\*\*)(.+?)（第(\d+)～(\d+)页）(?:：.*)?\s*$"
SUMMARY_FILE_LINE = r"^- \*\*(.+?)\*\*（第(\d+)～(\d+)页）："

# Limits.
H1_MAX, H2_MAX, H3_MAX = 40, 60, 80
MIN_CHARS, MIN_CN_RATIO, MAX_GARBLED = 30, 0.30, 0.15
PRINTABLE = rf"[{CJK}　-〿＀-￯A-Za-z0-9\s,.，。；：、:;！？!?\-+*/=（）()\[\]【】《》\"'·…—\\]"
TABLE_LIMITS = {"rows": 2, "cols": 2, "cell": 200, "avg": 80, "filled": 0.50, "variance": 0.40, "least_area": 0.02, "most_area": 0.95}
IMAGE_AREA = 0.05
CHUNK_CHARS = 6000
SMALL_LINES, SMALL_CHARS, MERGED_MOST = 8, 350, 15
MERGED_NAME = "TODO-待LLM命名"
SUMMARY_TODO = "TODO: 待LLM补写"
NAME_TODO = "TODO: 待LLM补写合并块的文件名"
LABEL_CHARS, LABEL_LINES, PREAMBLE_LINES, PREAMBLE_CHARS = 36, 7, 9, 80
PAGED_CAPTION = r"表格\s*[（(]\s*第\s*(\d+)\s*页\s*[）)]"
REPORT_ROWS = 200
SPLIT_RATIO = (0.75, 1.05)
LINE_BREAKS = "\\r\\n|[\\n\\r\\u000b\\u000c\\u001c-\\u001e\\u0085\\u2028\\u2029]"
FORMATS = (".docx", ".pdf", ".doc")
