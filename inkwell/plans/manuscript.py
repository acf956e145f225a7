"""Queries on chapter headings and manuscript format, over texts into which headings and dialogue are written, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import INLINE, SPACE
from ..operators import headings

#: Documents as manuscripts, in words that Spark and DuckDB read alike.
MANUSCRIPT = """CASE doc_id % 6
WHEN 0 THEN 'front' || chr(10) || 'ⓚ제 1 화 : 처음' || chr(10) || left(text, 300) || chr(10) || '　# 2.  둘째' || chr(10) || chr(10) || chr(10) || chr(10) || left(text, 50) || chr(10) || 'Episode 1000 - Long' || chr(10)
  || '“대사”' || chr(10) || '“또”' || chr(10) || '지문' || chr(10) || 'chapter 1001' || chr(10) || '***' || chr(10) || chr(10) || '“끝”' || chr(10) || chr(10) || '지문 2' || chr(10) || chr(10) || '지문 3' || chr(10) || 'ⓚ1화' || chr(10) || 'again'
WHEN 1 THEN '# Title one' || chr(10) || left(text, 100) || chr(10) || '## Title two  ' || chr(10) || 'z'
WHEN 2 THEN text
WHEN 3 THEN '# 10일 후의 일' || chr(10) || left(text, 80) || chr(10) || '제3장 끝' || chr(10) || '18화의 말' || chr(10) || '  4 화' || chr(10) || '제5회: 다섯 번째' || chr(10) || right(text, 40)
WHEN 4 THEN '1.' || chr(10) || left(text, 60) || chr(10) || chr(10) || '2. 둘' || chr(10) || 'b' || chr(10) || '　' || chr(10) || '“c” 그는 말했다'
ELSE '“' || left(text, 30) || '”' || chr(10) || chr(10) || '“x”' || chr(10) || 'ⓚ 챕터' || chr(10) || 'ⓚEp 7 일곱' || chr(10) || left(text, 200) END"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.expr(MANUSCRIPT).alias("text"))


def _markers(spark, d):
    m = _docs(spark, d).select("doc_id", headings.heading_markers(F.col("text")).alias("m"))
    return m.select("doc_id", F.explode("m").alias("m")).select("doc_id", "m.episode", "m.title", F.col("m.start").cast("long").alias("start"), F.col("m.stop").cast("long").alias("stop"))


def _chapters(spark, d):
    out = headings.chapters(_docs(spark, d), "doc_id")
    return out.select(F.col("work_id").alias("doc_id"), F.col("chapter_no").cast("long").alias("chapter_no"), "episode", "base_episode", "title", F.sha2("text", 256).alias("sha256"), F.col("start_offset").cast("long").alias("start_offset"), F.col("stop_offset").cast("long").alias("stop_offset"))


def _plain(spark, d):
    """Manuscripts without signs that typography changes."""
    return _docs(spark, d).withColumn("text", F.translate("text", "\"'.\r", ""))


def _hash(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.sha2("text", 256).alias("sha256"), F.length("text").cast("long").alias("chars"))


QUERIES = {
    "heading_markers": _markers,
    "chapter_split": _chapters,
    "heading_normalize": lambda s, d: _hash(_docs(s, d).withColumn("text", headings.normalize_headings(F.col("text")))),
    "heading_predicates": lambda s, d: _docs(s, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("n", "line")).select("doc_id", F.col("n").cast("long").alias("n"), headings.is_heading(F.col("line")).alias("heading"), headings.is_plain_number(F.col("line")).alias("plain_number"), headings.is_markdown_title(F.col("line")).alias("markdown_title")).where("heading or plain_number or markdown_title"),
    "format_manuscript": lambda s, d: _hash(headings.format_manuscript(_plain(s, d))),
    "format_flags": lambda s, d: headings.format_flags(_docs(s, d)),
}

# -- the SQL ------------------------------------------------------------------------------------------------------------------


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_SRC = f"SELECT doc_id, {MANUSCRIPT} AS text FROM documents"
_ROWS = f"""SELECT doc_id, line, CAST(n AS BIGINT) AS n, CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n) - length(line) - 1 AS BIGINT) AS start
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM ({{}}))"""
_FAMILY = lambda g: "CASE " + " ".join(f"WHEN regexp_matches(line, {_q('(?i)' + p)}) THEN regexp_extract(line, {_q('(?i)' + p)}, {g})" for p in headings.FAMILIES) + " END"
_TRIM = lambda x: f"regexp_replace({x}, {_q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"
_MD = f"^#{{1,6}}[{INLINE}]+(.+?)[{INLINE}]*$"
_HEADS = f"""
r AS ({_ROWS.format(_SRC)}),
num AS (SELECT *, {_FAMILY(1)} AS number, {_FAMILY(2)} AS title FROM r),
md AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) AS VARCHAR) AS number, regexp_extract(line, {_q(_MD)}, 1) AS title FROM r WHERE regexp_matches(line, {_q(_MD)}) AND doc_id NOT IN (SELECT doc_id FROM num WHERE number IS NOT NULL)),
heads AS (SELECT doc_id, n, CASE WHEN length(number) < 3 THEN lpad(number, 3, '0') ELSE number END AS base, {_TRIM("coalesce(title, '')")} AS title, start, start + length(line) AS stop FROM (SELECT * FROM num WHERE number IS NOT NULL UNION ALL SELECT * FROM md))"""

_HASHED, _BODY = f"regexp_matches(s, {_q(headings.HASH)})", _TRIM(f"regexp_replace(s, {_q(headings.HASH)}, '')")
_INNER = _TRIM(f"regexp_replace(b, {_q(f'^ⓚ[{INLINE}]*')}, '')")
_WORDED = lambda x: f"(regexp_matches({x}, {_q(headings.NUMBERED_BODY)}) OR regexp_matches({x}, {_q(headings.ENGLISH_BODY)}))"
_PLAIN = lambda x: f"regexp_matches({x}, {_q(headings.PLAIN_BODY)})"
_JUDGED = f"""
s1 AS (SELECT *, {_TRIM("line")} AS s FROM r), s2 AS (SELECT *, {_HASHED} AS hashed, {_BODY} AS b FROM s1), s3 AS (SELECT *, starts_with(b, 'ⓚ') AS marked, {_INNER} AS i FROM s2),
j AS (SELECT *, s <> '' AND CASE WHEN marked THEN {_WORDED("i")} OR {_PLAIN("i")} ELSE {_WORDED("b")} OR (hashed AND {_PLAIN("b")}) END AS heading,
  s <> '' AND NOT hashed AND NOT starts_with(s, 'ⓚ') AND {_PLAIN("s")} AS plain_number, hashed AND b <> '' AS markdown_title FROM s3)"""
_CANON_RE = headings._CANON


def _canon(x: str) -> str:
    one = f"regexp_replace({x}, {_q(f'[{INLINE}]+')}, ' ', 'g')"
    part = lambda n: f"regexp_extract({one}, {_q(_CANON_RE)}, {n})"
    tail = _TRIM(f"regexp_replace(regexp_replace({_TRIM(part(4))}, {_q(f'^[{headings.SEPARATORS}]+[{INLINE}]*')}, ''), {_q(f'[{SPACE}]+')}, ' ', 'g')")
    return f"CASE WHEN regexp_matches({one}, {_q(_CANON_RE)}) THEN {part(1)} || {part(2)} || {part(3)} || CASE WHEN {tail} <> '' THEN ' ' || {tail} ELSE '' END ELSE {one} END"


_NORMAL = f"""{_JUDGED},
t AS (SELECT *, count(*) FILTER (plain_number) OVER (PARTITION BY doc_id) >= 2 AS many, bool_or(heading) OVER (PARTITION BY doc_id) AS named, count(*) FILTER (markdown_title) OVER (PARTITION BY doc_id ORDER BY n) AS nth FROM j),
nl AS (SELECT doc_id, n, CASE WHEN NOT named AND NOT many AND markdown_title THEN ind || 'ⓚ제' || nth || '화 ' || b WHEN s = '' THEN line WHEN marked THEN CASE WHEN i <> '' THEN ind || 'ⓚ' || {_canon("i")} ELSE line END
  WHEN {_WORDED("b")} OR ((hashed OR many) AND {_PLAIN("b")}) THEN ind || 'ⓚ' || {_canon("b")} ELSE line END AS line FROM (SELECT *, CASE WHEN s = '' THEN '' ELSE regexp_extract(line, {_q(f'^[{SPACE}]*')}) END AS ind FROM t))"""
_SRC_PLAIN = f"SELECT doc_id, translate(text, '\"''.' || chr(13), '') AS text FROM ({_SRC})"
_KIND = "CASE WHEN heading THEN 'chapter_heading' WHEN s IN ('***', '* * *') THEN 'scene_break' WHEN starts_with(s, '“') THEN 'dialogue' ELSE 'narration' END"
_STYLE = "regexp_replace(regexp_replace(line, '([A-Za-z])''([A-Za-z])', '\\1\\2', 'g'), '([A-Za-z])''([A-Za-z])', '\\1\\2', 'g')"

ORACLES = {
    "heading_markers": f"WITH {_HEADS} SELECT doc_id, base AS episode, title, start, stop FROM heads",
    "chapter_split": f"""WITH {_HEADS},
e AS (SELECT doc_id, base, title, stop, coalesce(lead(start) OVER w, length(text)) AS till, text, row_number() OVER w AS chapter_no, row_number() OVER (PARTITION BY doc_id, base ORDER BY n) AS nth FROM heads JOIN ({_SRC}) USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY n))
SELECT doc_id, chapter_no, CASE WHEN nth > 1 THEN base || '_' || nth ELSE base END AS episode, base AS base_episode, title, sha256(substr(text, stop + 1, till - stop)) AS sha256, stop AS start_offset, CAST(till AS BIGINT) AS stop_offset FROM e
UNION ALL SELECT doc_id, 1, '001', '001', '', sha256(coalesce(text, '')), 0, CAST(length(coalesce(text, '')) AS BIGINT) FROM ({_SRC}) WHERE doc_id NOT IN (SELECT doc_id FROM heads)""",
    "heading_normalize": f"WITH r AS ({_ROWS.format(_SRC)}), {_NORMAL} SELECT doc_id, sha256(string_agg(line, chr(10) ORDER BY n)) AS sha256, CAST(length(string_agg(line, chr(10) ORDER BY n)) AS BIGINT) AS chars FROM nl GROUP BY doc_id",
    "heading_predicates": f"WITH r AS ({_ROWS.format(_SRC)}), {_JUDGED} SELECT doc_id, n - 1 AS n, heading, plain_number, markdown_title FROM j WHERE heading OR plain_number OR markdown_title",
    "format_manuscript": f"""WITH r AS ({_ROWS.format(_SRC_PLAIN)}), {_NORMAL},
f1 AS (SELECT doc_id, n, line, {_TRIM("line")} AS s FROM nl), f2 AS (SELECT *, {_HASHED} AS hashed, {_BODY} AS b FROM f1 WHERE s <> ''), f3 AS (SELECT *, starts_with(b, 'ⓚ') AS marked, {_INNER} AS i FROM f2),
f4 AS (SELECT *, CASE WHEN marked THEN {_WORDED("i")} OR {_PLAIN("i")} ELSE {_WORDED("b")} OR (hashed AND {_PLAIN("b")}) END AS heading FROM f3),
f5 AS (SELECT *, {_KIND} AS kind FROM f4), f6 AS (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY n) AS was FROM f5),
f7 AS (SELECT doc_id, n, repeat(chr(10), CASE WHEN was IS NULL OR kind = 'chapter_heading' THEN 0 WHEN kind = 'scene_break' THEN 1 WHEN was = 'chapter_heading' THEN 3 WHEN was = 'scene_break' OR was <> kind THEN 1 ELSE 0 END) || line AS line FROM f6),
f8 AS (SELECT doc_id, regexp_replace(string_agg(line, chr(10) ORDER BY n), {_q(f'[{SPACE}]+$')}, '') || chr(10) AS text FROM f7 GROUP BY doc_id)
SELECT doc_id, sha256(o) AS sha256, CAST(length(o) AS BIGINT) AS chars FROM (SELECT p.doc_id, CASE WHEN coalesce(p.text, '') = '' THEN '' ELSE coalesce(f8.text, chr(10)) END AS o FROM ({_SRC_PLAIN}) p LEFT JOIN f8 USING (doc_id))""",
    "format_flags": f"""WITH r AS ({_ROWS.format(f"SELECT doc_id, regexp_replace(text, chr(10) || '$', '') AS text FROM ({_SRC})")}), {_JUDGED},
k AS (SELECT *, {_KIND} AS kind, max(n) OVER (PARTITION BY doc_id) AS total FROM j),
w AS (SELECT *, coalesce(lead(n) OVER v, total + 1) - n - 1 AS under, lag(n) OVER v AS pn, lag(kind) OVER v AS pk FROM k WHERE s <> '' WINDOW v AS (PARTITION BY doc_id ORDER BY n))
SELECT doc_id, 'chapter_heading_missing_k' AS subtype, n AS line, s AS value, CAST(NULL AS BIGINT) AS actual, CAST(NULL AS BIGINT) AS expected FROM w WHERE heading AND NOT starts_with(s, 'ⓚ')
UNION ALL SELECT doc_id, 'chapter_heading_blank_lines', n, s, under, 3 FROM w WHERE heading AND under <> 3
UNION ALL SELECT doc_id, 'straight_double_quote', n, s, NULL, NULL FROM w WHERE contains(line, '"')
UNION ALL SELECT doc_id, 'straight_single_quote', n, s, length({_STYLE}) - length(replace({_STYLE}, '''', '')), NULL FROM w WHERE contains({_STYLE}, '''')
UNION ALL SELECT doc_id, 'ascii_ellipsis', n, s, NULL, NULL FROM w WHERE contains(line, '...')
UNION ALL SELECT doc_id, 'dialogue_narration_spacing', n, s, n - pn - 1, CASE WHEN pk = kind THEN 0 ELSE 1 END FROM w WHERE kind IN ('dialogue', 'narration') AND pk IN ('dialogue', 'narration') AND n - pn - 1 <> CASE WHEN pk = kind THEN 0 ELSE 1 END""",
}
