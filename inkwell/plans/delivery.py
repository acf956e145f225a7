"""Queries on reports, source integrity, the catalogue and delivery, over the tables as stand-ins, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import INLINE, SPACE, lines_of
from ..operators import catalog, reports, sourcecheck
from . import manuscript
from .reviews import _cycle, _sql

_KO = "이 보고서는 원고 전체의 정합성과 표현을 검토한 결과를 정리한 것입니다. 각 항목은 원문 위치와 함께 적었으며, 독자가 바로 이해할 수 있도록 작업 용어를 줄였습니다. 남은 항목은 다음 회차에서 다시 확인합니다. 모두 확인했습니다."
_BODIES = [
    "# 보고서\n\n- 주장: 3화의 날짜가 어긋난다\n- 근거: 3화 12행\n\n" + _KO, "- 문제: 금액이 다르다\n그리고\n그리고\n그리고\n근거: 늦다\n" + _KO, "주장: TBD\n판정 : 작성 필요 근거: x\n" + _KO,
    "| 항목 | 주장 | 근거 |\n|---|:---:|---|\n| 1 | 날짜 | 3화 |\n| 2 | | 4화 |\n| 3 | 금액 | <b></b> |\n| 4 | | |\n\n" + _KO, "manual_review 파일의 프롬프트를 보라\n" + _KO, "```\n코드 안의 글\n```\nonly latin text here " * 3,
    "# 작품 최종 개선 보고서\n## 루프 결과 요약\n리스크: 시간 역류 위치: 5화\n## 개선 요약\n## 주요 해결 항목\n## `루프별 개선 이력`\n| a | b |\n|---|---|\n| 1화 | 고침 |\n## 누락 금지 이슈\n| a | b |\n|---|---|\n| 미정 | x |\n" + _KO,
    "## 루프 결과 요약\n## 개선 요약\n" + _KO + "\n문제: 상태 회귀 - 증거: 7화",
]
REPORTS = f"SELECT n_nationkey, {_cycle('n_nationkey', _BODIES)} AS text FROM {{nation}}"
_NAMES = ["원고 3화.txt", "1~20화 합본.txt", "제21-40 화.hwp", "외전.txt", "5_9화", "10화 final"]
RUNS = "SELECT o_custkey, o_orderkey, " + ", ".join(f"CASE WHEN o_orderkey % {i + 2} = 0 THEN 'pending' ELSE 'Done' END AS s{i}" for i in range(len(catalog.STAGES))) + " FROM {orders}"
TITLES = f"SELECT doc_id, {_cycle('doc_id', ['final_draft', '합본 원고', '12 원고', 'My_Novel-final (2nd)', '제목: 긴 밤', ''])} AS stem, {manuscript.MANUSCRIPT} AS text FROM {{documents}}"
_HOLDS = ["P0 차단", "문체 확인", "이름 정책", " ", "tone", "Blocking issue", "기타"]
HOLDS = f"SELECT o_custkey, o_orderkey, {_cycle('o_orderkey', _HOLDS)} AS item FROM {{orders}}"


def _runs(spark, d):
    stages = F.array(*[F.struct(F.lit(n).alias("stage"), F.col(f"s{i}").alias("status")) for i, n in enumerate(catalog.STAGES)])
    return _sql(spark, d, RUNS, "orders").select("o_custkey", "o_orderkey", stages.alias("stages"))


def _portfolio(spark, d):
    works = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey AS o_custkey", "CASE WHEN c_custkey % 10 = 0 THEN 'archived' ELSE 'active' END AS status")
    return catalog.portfolio(works, _runs(spark, d), "o_custkey", "o_orderkey")


def _reports(spark, d):
    return reports.validate_reports(_sql(spark, d, REPORTS, "nation"))


def _seals(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    now = docs.select("doc_id", F.sha2("text", 256).alias("sha256"))
    before = docs.where("doc_id % 3 > 0").select("doc_id", F.expr("CASE WHEN doc_id % 3 = 1 THEN sha2(text, 256) WHEN doc_id % 2 = 0 THEN '' ELSE 'x' END").alias("sha256"))
    return catalog.reseal_status(now, before, "doc_id")


def _glossary(spark, d):
    rows = spark.read.parquet(f"{d}/part.parquet").select(F.expr("p_partkey % 50").alias("work"), F.split("p_name", " ").alias("forbidden_aliases"), F.expr("map('a', p_partkey % 7, 'b', CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 5 END)").alias("residual_forbidden_alias_counts"))
    return catalog.glossary_rollup(rows, "work")


def _splits(spark, d):
    tailed = F.expr("'ⓚ제1화' || chr(10) || 'a b' || chr(10) || replace(text, ' und ', ' 2화' || chr(10)) || chr(10) || 'x 3화 ' || chr(10) || 'y 9화' || chr(10) || '/끝 4화 끝'")
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", tailed.alias("text"))
    out = sourcecheck.split_tails(docs)
    return out.select("doc_id", F.size("splits").cast("long").alias("splits"), F.array_join(F.transform("splits", lambda s: s.line.cast("string")), ",").alias("lines"), F.sha2("text", 256).alias("sha256"))


QUERIES = {
    "report_status": lambda s, d: _reports(s, d).select("n_nationkey", "hangul", "korean_ratio", "pairs", F.size("issues").cast("long").alias("issues"), "ready"),
    "report_issues": lambda s, d: _reports(s, d).select("n_nationkey", F.inline("issues")).withColumn("line", F.col("line").cast("long")),
    "source_blocked": lambda s, d: sourcecheck.blocked_issues(manuscript._docs(s, d), ["doc_id"]).withColumn("line", F.col("line").cast("long")),
    "source_splits": _splits,
    "document_order": lambda s, d: s.read.parquet(f"{d}/nation.parquet").select("n_nationkey", sourcecheck.document_order(F.expr(_cycle("n_nationkey", _NAMES))).alias("k")).select("n_nationkey", F.col("k.first").cast("long").alias("first"), F.col("k.last").cast("long").alias("last"), "k.name"),
    "list_runs": lambda s, d: catalog.list_runs(_runs(s, d)).select("o_orderkey", "pending_stage_count", "next_stage"),
    "portfolio_status": _portfolio,
    "title_inference": lambda s, d: _sql(s, d, TITLES, "documents").select("doc_id", catalog.infer_title(F.col("stem"), lines_of(F.col("text")), ("final draft", "draft")).alias("title")),
    "run_kinds": lambda s, d: s.read.parquet(f"{d}/nation.parquet").select("n_nationkey", catalog.run_kind(F.expr(_cycle("n_nationkey", ["검수", "Full", "표면교정", "my mode", "", "editor"]))).alias("kind")),
    "unique_slugs": lambda s, d: catalog.unique_names(s.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", F.concat(F.lit("work-"), (F.col("s_suppkey") % 7).cast("string")).alias("slug")), "slug", "s_suppkey").select("s_suppkey", "unique_name"),
    "hold_summary": lambda s, d: catalog.hold_summary(_sql(s, d, HOLDS, "orders"), "o_custkey", "item", "o_orderkey").withColumn("examples", F.array_join("examples", "|")),
    "glossary_rollup": _glossary,
    "surface_counts": lambda s, d: catalog.last_counts(s.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_returnflag").alias("term"), F.col("l_linenumber").cast("long").alias("count"), F.struct("l_orderkey", "l_linenumber").alias("at")), "term", "count", "at"),
    "reseal_status": _seals,
}

# -- the SQL ------------------------------------------------------------------------------------------------------------------


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_TRIM = lambda x: f"regexp_replace({x}, {_q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"
_EMPTY = lambda x: f"({_TRIM(f'regexp_replace(coalesce({x}, {_q("")}), {_q("<[^>]+>")}, {_q("")}, {_q("g")})')} = '' OR regexp_matches(coalesce({x}, ''), {_q('(?i)(?:^|[^0-9A-Za-z_])TBD(?:$|[^0-9A-Za-z_])|작성 필요|분석 전|없음 또는 항목 작성|미정')}))"
_INTERNAL = r"(?i)(?:^|[^0-9A-Za-z_])(?:llm-facing|task_brief|manual_review|run_manifest|schema_version|prompt)(?:$|[^0-9A-Za-z_])|프롬프트"
_BARE = "regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?```', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '`[^`]*`', '', 'g')"
_CELLS = f"CASE WHEN starts_with(s, '|') AND ends_with(s, '|') THEN list_transform(string_split(regexp_replace(s, '^[|]+|[|]+$', '', 'g'), '|'), lambda x: {_TRIM('x')}) ELSE [] END"
_REPORT_SQL = f"""
WITH t AS ({REPORTS.replace("{nation}", "nation")}),
r AS (SELECT n_nationkey, n, line, {_TRIM("line")} AS s FROM (SELECT n_nationkey, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM t)),
k AS (SELECT n_nationkey, CAST(len(regexp_extract_all({_BARE}, '[가-힣]')) AS BIGINT) AS hangul, len(regexp_extract_all({_BARE}, '[A-Za-z]')) AS latin, regexp_matches(text, {_q(reports.TITLE)}) OR (contains(text, '## 루프 결과 요약') AND contains(text, '## 개선 요약')) AS shaped FROM t),
l AS (SELECT *, regexp_matches(line, {_q(reports.CLAIM)}) AS claims, regexp_extract(line, {_q(reports.CLAIM)}, 1) AS claim, NOT {_EMPTY(f"regexp_extract(line, {_q(reports.EVIDENCE)}, 1)")} AS proof, {_CELLS} AS cells FROM r),
m AS (SELECT *, bool_or(proof) OVER (PARTITION BY n_nationkey ORDER BY n ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS near,
  len(cells) > 0 AND list_bool_or(list_transform(cells, lambda c: regexp_matches(c, '주장|판정|문제|리스크'))) AND list_bool_or(list_transform(cells, lambda c: regexp_matches(c, '근거|증거|원문|위치|수치'))) AS head FROM l),
g AS (SELECT *, count(*) FILTER (NOT contains(line, '|')) OVER (PARTITION BY n_nationkey ORDER BY n) AS block FROM m),
h AS (SELECT n_nationkey, block, min(n) AS at, arg_min(cells, n) AS names FROM g WHERE head AND contains(line, '|') GROUP BY ALL),
b AS (SELECT g.n_nationkey, g.n, g.cells[list_position(list_transform(names, lambda c: regexp_matches(c, '주장|판정|문제|리스크')), true)] AS c, g.cells[list_position(list_transform(names, lambda c: regexp_matches(c, '근거|증거|원문|위치|수치')), true)] AS e
  FROM g JOIN h USING (n_nationkey, block) WHERE g.n > h.at AND contains(g.line, '|') AND len(g.cells) > 0 AND NOT (g.n = h.at + 1 AND list_bool_and(list_transform(g.cells, lambda c: regexp_matches(c, '^:?-{{3,}}:?$'))))),
f AS (SELECT n_nationkey, n, CASE WHEN {_EMPTY("c")} AND {_EMPTY("e")} THEN NULL WHEN {_EMPTY("c")} THEN 'empty_table_claim' WHEN {_EMPTY("e")} THEN 'table_claim_without_evidence' ELSE 'pair' END AS code FROM b
  UNION ALL SELECT n_nationkey, n, CASE WHEN {_EMPTY("claim")} THEN 'empty_claim' WHEN near THEN 'pair' ELSE 'claim_without_evidence' END FROM m WHERE claims
  UNION ALL SELECT n_nationkey, n, 'internal_artifact_leak' FROM r WHERE regexp_matches(line, {_q(_INTERNAL)})
  UNION ALL SELECT n_nationkey, n, 'placeholder_left' FROM r WHERE regexp_matches(line, {_q('(?i)(?:^|[^0-9A-Za-z_])TBD(?:$|[^0-9A-Za-z_])|작성 필요|분석 전|없음 또는 항목 작성|미정')})),
sec AS (SELECT n_nationkey, n, trim(regexp_replace(regexp_extract(line, '^#{{1,6}}\\s+(.+?)\\s*$', 1), '`([^`]*)`', '\\1', 'g')) AS title, lead(n) OVER (PARTITION BY n_nationkey ORDER BY n) AS till FROM r WHERE regexp_matches(line, '^#{{1,6}}\\s+\\S')),
filled AS (SELECT DISTINCT sec.n_nationkey, sec.n FROM sec JOIN l ON l.n_nationkey = sec.n_nationkey AND l.n > sec.n + 2 AND l.n < coalesce(sec.till, 1000000) WHERE len(l.cells) >= 2 AND NOT list_bool_or(list_transform(l.cells, lambda c: {_EMPTY("c")})) AND NOT list_bool_and(list_transform(l.cells, lambda c: regexp_matches(c, '^[-: ]+$')))),
p AS (SELECT n_nationkey, count(*) FILTER (code = 'pair') AS pairs FROM t LEFT JOIN f USING (n_nationkey) GROUP BY n_nationkey),
issues AS (SELECT n_nationkey, code, CAST(n AS BIGINT) AS line FROM f WHERE code <> 'pair' UNION ALL SELECT n_nationkey, 'too_little_korean', NULL FROM k WHERE hangul < 80 UNION ALL SELECT n_nationkey, 'not_korean_facing', NULL FROM k WHERE round(hangul / greatest(hangul + latin, 1), 3) < 0.55
  UNION ALL SELECT n_nationkey, 'missing_claim_evidence_pair', NULL FROM p WHERE pairs = 0
  UNION ALL SELECT k.n_nationkey, 'missing_final_report_section', NULL FROM k, (VALUES {", ".join(f"('{s}')" for s in reports.SECTIONS)}) d(s) WHERE shaped AND NOT EXISTS (SELECT 1 FROM sec WHERE sec.n_nationkey = k.n_nationkey AND title = s)
  UNION ALL SELECT n_nationkey, 'empty_final_report_section', n FROM sec JOIN k USING (n_nationkey) WHERE shaped AND title IN ({", ".join(f"'{s}'" for s in reports.FILLED_SECTIONS)}) AND (n_nationkey, n) NOT IN (SELECT (n_nationkey, n) FROM filled))"""
_NAME = _cycle("n_nationkey", _NAMES)
_RUN_SQL = f"SELECT *, list_filter([{', '.join(f'CASE WHEN s{i} = {_q("pending")} THEN {_q(n)} END' for i, n in enumerate(catalog.STAGES))}], lambda x: x IS NOT NULL) AS pending FROM ({RUNS.replace('{orders}', 'orders')})"
_PAD = lambda e: f"CASE WHEN {e} < 1000 THEN lpad(CAST({e} AS VARCHAR), 3, '0') ELSE CAST({e} AS VARCHAR) END"

_SQUEEZE = lambda x: _TRIM(f"regexp_replace({x}, {_q(f'[{SPACE}]+')}, ' ', 'g')")


def _clean(x: str) -> str:
    out = f"regexp_replace({_TRIM(x)}, {_q(f'^#{{1,6}}[{INLINE}]*')}, '')"
    out = f"regexp_replace(regexp_replace({out}, {_q(f'(?i)^(?:제목|작품명|타이틀|title)[{INLINE}]*[:：][{INLINE}]*')}, ''), {_q(f'^ⓚ[0-9]{{3}}[{INLINE}]*')}, '')"
    out = _SQUEEZE(f"translate(regexp_replace({out}, {_q(r'\[[^\]]*\]|\([^)]*\)')}, '', 'g'), '_-', '  ')")
    out = _TRIM(f"regexp_replace({out}, {_q(r'(?i)\b(final|draft|source|manuscript)\b')}, '', 'g')")
    return _SQUEEZE(f"regexp_replace({out}, {_q(r'최종|수정\s*완|수정본|원고|합본|초기\s*원고')}, '', 'g')")


_LINES = "CASE WHEN ends_with(text, chr(10)) OR text = '' THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END"
_TITLED = "(?i)^(?:제[ ]*)?[0-9]{1,4}[ ]*(?:화|회|장|편|챕터|chapter|ep(?:isode)?)(?:[ .:：_-].*)?$"
_COUNT = "CAST((length(text) - length(replace(text, {0}, ''))) / length({0}) AS BIGINT)"
_HEAD = "'ⓚ제1화' || chr(10) || 'a b' || chr(10)"

ORACLES = {
    "source_splits": f"""SELECT doc_id, CASE WHEN p > 0 THEN CAST(2 AS BIGINT) ELSE 0 END AS splits, CASE WHEN p > 0 THEN 3 + length(left(text, p)) - length(replace(left(text, p), chr(10), '')) || ',' || 4 + {_COUNT.format("chr(10)")} + {_COUNT.format("' und '")} ELSE '' END AS lines,
  sha256(CASE WHEN p > 0 THEN {_HEAD} || rtrim(left(text, p - 1)) || chr(10) || 'ⓚ제2화' || chr(10) || replace(substr(text, p + 5), ' und ', ' 2화' || chr(10)) || chr(10) || 'x' || chr(10) || 'ⓚ제3화' ELSE {_HEAD} || text || chr(10) || 'x 3화 ' END || chr(10) || 'y 9화' || chr(10) || '/끝 4화 끝') AS sha256
FROM (SELECT doc_id, text, strpos(text, ' und ') AS p FROM documents)""",
    "title_inference": f"""
SELECT doc_id, CASE WHEN c NOT IN ('', 'final draft', 'draft') AND NOT (regexp_matches(c, '^[0-9]{{1,4}}$') AND regexp_matches(lower(stem), '합본|원고|draft|source|manuscript')) THEN c ELSE coalesce(t, nullif(c, ''), 'untitled-work') END AS title
FROM (SELECT doc_id, stem, {_clean("stem")} AS c, list_filter(list_transform(({_LINES})[1:80], lambda x: {_clean("x")}), lambda y: length(y) BETWEEN 2 AND 60 AND NOT regexp_matches(y, '^ⓚ?[0-9]{{1,4}}$') AND NOT regexp_matches(y, {_q(_TITLED)}) AND NOT regexp_matches(y, '[.다요죠]$'))[1] AS t FROM ({TITLES.replace("{documents}", "documents")}))""",
    "report_status": f"{_REPORT_SQL} SELECT k.n_nationkey, hangul, round(hangul / greatest(hangul + latin, 1), 3) AS korean_ratio, pairs, count(code) AS issues, count(code) = 0 AS ready FROM k JOIN p USING (n_nationkey) LEFT JOIN issues USING (n_nationkey) GROUP BY ALL",
    "report_issues": f"{_REPORT_SQL} SELECT * FROM issues",
    "source_blocked": f"""WITH {manuscript._HEADS}, n AS (SELECT doc_id, base, CAST(base AS INT) AS number FROM heads), lo AS (SELECT doc_id, unnest(generate_series(min(number), max(number))) AS number FROM n GROUP BY doc_id),
miss AS (SELECT doc_id, number, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS i FROM lo WHERE (doc_id, number) NOT IN (SELECT (doc_id, number) FROM n)),
dup AS (SELECT doc_id, base, row_number() OVER (PARTITION BY doc_id ORDER BY base) AS i FROM (SELECT doc_id, base FROM n GROUP BY ALL HAVING count(*) > 1)),
c AS (SELECT doc_id, (SELECT count(*) FROM miss WHERE miss.doc_id = d.doc_id) AS m FROM documents d)
SELECT doc_id, 'SRC-BLOCK-' || {_PAD("i")} AS id, 'missing_episode' AS operation, {_PAD("number")} AS episode, CAST(NULL AS BIGINT) AS line FROM miss
UNION ALL SELECT doc_id, 'SRC-BLOCK-' || {_PAD("i + m")}, 'duplicate_episode', base, NULL FROM dup JOIN c USING (doc_id)""",
    "document_order": f"""SELECT n_nationkey, CAST(CASE WHEN regexp_matches(x, {_q(sourcecheck.NAME_RANGE)}) THEN regexp_extract(x, {_q(sourcecheck.NAME_RANGE)}, 1) WHEN regexp_matches(x, {_q(sourcecheck.NAME_SINGLE)}) THEN regexp_extract(x, {_q(sourcecheck.NAME_SINGLE)}, 1) ELSE '10000' END AS BIGINT) AS first,
  CAST(CASE WHEN regexp_matches(x, {_q(sourcecheck.NAME_RANGE)}) THEN regexp_extract(x, {_q(sourcecheck.NAME_RANGE)}, 2) WHEN regexp_matches(x, {_q(sourcecheck.NAME_SINGLE)}) THEN regexp_extract(x, {_q(sourcecheck.NAME_SINGLE)}, 1) ELSE '10000' END AS BIGINT) AS last, x AS name FROM (SELECT n_nationkey, {_NAME} AS x FROM nation)""",
    "list_runs": f"SELECT o_orderkey, CAST(len(pending) AS BIGINT) AS pending_stage_count, coalesce(pending[1], '') AS next_stage FROM ({_RUN_SQL})",
    "portfolio_status": f"""SELECT c.c_custkey AS o_custkey, 'active' AS status, coalesce(runs, 0) AS runs, latest_run, CAST(coalesce(len(p), 0) AS BIGINT) AS pending, CASE WHEN runs IS NULL THEN NULL ELSE coalesce(p[1], '') END AS next_stage, CASE WHEN runs IS NULL THEN 'no_runs' WHEN len(p) > 0 THEN 'pending' ELSE 'done' END AS state
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS runs, max(o_orderkey) AS latest_run, arg_max(pending, o_orderkey) AS p FROM ({_RUN_SQL}) GROUP BY o_custkey) r ON r.o_custkey = c.c_custkey WHERE c.c_custkey % 10 <> 0""",
    "run_kinds": f"SELECT n_nationkey, CASE {_cycle('n_nationkey', ['검수', 'Full', '표면교정', 'my mode', '', 'editor'])} WHEN '검수' THEN 'global-audit' WHEN 'Full' THEN 'full-qc-correction' WHEN '표면교정' THEN 'proofread-pass' WHEN 'my mode' THEN 'my-mode' WHEN '' THEN 'global-audit' ELSE 'editorial-pass' END AS kind FROM nation",
    "unique_slugs": "SELECT s_suppkey, 'work-' || s_suppkey % 7 || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS unique_name FROM (SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey % 7 ORDER BY s_suppkey) AS n FROM supplier)",
    "hold_summary": f"""SELECT o_custkey, bucket, count(*) AS n, array_to_string(list(item ORDER BY o_orderkey)[1:5], '|') AS examples FROM (SELECT *, CASE WHEN regexp_matches(lower(item), '{catalog.BLOCKING}') THEN 'blocking' WHEN regexp_matches(lower(item), '{catalog.STYLE}') THEN 'style' ELSE 'policy' END AS bucket
  FROM ({HOLDS.replace("{orders}", "orders")}) WHERE trim(item) <> '') GROUP BY o_custkey, bucket""",
    "glossary_rollup": "SELECT p_partkey % 50 AS work, count(*) AS entry_count, CAST(sum(len(string_split(p_name, ' '))) AS BIGINT) AS forbidden_alias_count, CAST(sum(p_partkey % 7 + CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 5 ELSE 0 END) AS BIGINT) AS residual_forbidden_total FROM part GROUP BY ALL",
    "surface_counts": "SELECT l_returnflag AS term, CAST(arg_max(l_linenumber, (l_orderkey, l_linenumber)) AS BIGINT) AS count FROM lineitem GROUP BY l_returnflag",
    "reseal_status": "SELECT doc_id, sha256(text) AS sha256, CASE WHEN doc_id % 3 = 1 THEN sha256(text) WHEN doc_id % 3 = 2 AND doc_id % 2 = 0 THEN '' WHEN doc_id % 3 = 2 THEN 'x' END AS previous_sha256, doc_id % 3 = 2 AND doc_id % 2 <> 0 AS stale FROM documents",
}
