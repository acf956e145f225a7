"""Queries that run the Korean packs, over documents into which Korean lines are written, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..operators import facts, review, rules, style, typos

_LINES = (
    "2024년 3월 5일 화요일, 오전 10시 30분에 김민수 팀장이 말했다. 3억 원과 25% 지분이었다.",
    "다음 날 그의 할머니 댁에서 마치 거대한 침묵이 내려앉았다. 결국 마침내 그는 고개를 끄덕였다.",
    "이 회장은 제품에 끌어안고 튀어 나왔다... 순간 숙식간 피난 주에도 정도록 \"말했다\" 하고",
    "11자 틈새와 펜촉. 책임의무게 말하지마요 색이 고았다 “열린 따옴표",
    "@ 메모 확인 /잘못(옳게)/ &nbsp; ~~지움~~ ⓐ{가|나} (제 3 화 끝) OOO TODO 편집자 메모",
    "그날 밤 보고를 마쳤다. 매수 주문은 아직 하지 않았다. 이미 승인 서명을 받았다.",
    "그날 밤 보고는 없었다. 매수 주문을 확인했다. 스마트폰 브리핑",
    "이민수 대표 김민수 부장 김민수팀장 어제 12:30 2024.03.05 35세",
)


def _quote(line: str) -> str:
    return "'" + line.replace("'", "''") + "'"


#: Two of the lines, by the document's id, around its own text; in words that Spark and DuckDB read alike.
KOREAN = (
    "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN {_quote(x)}" for i, x in enumerate(_LINES)) + " END || chr(10) || replace(text, '\"', '') || chr(10) || '　' || CASE (doc_id // 8) % 8 ".replace("(doc_id // 8)", "((doc_id - doc_id % 8) / 8)")
    + " ".join(f"WHEN {i} THEN {_quote(x)}" for i, x in enumerate(_LINES)) + " ELSE '' END"
)


def _docs(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", *extra, F.expr(KOREAN).alias("text"))


def _count(df: DataFrame, kind: str) -> DataFrame:
    return df.groupBy("doc_id", kind).agg(F.count(F.lit(1)).alias("n"), F.min("line_no").cast("long").alias("first_line"))


def _titles(spark, d):
    out = facts.title_matrix(_docs(spark, d, "source"), "source", "doc_id")
    roles = F.array_join(F.transform("roles", lambda x: F.concat(x.role, F.lit(":"), x.n.cast("string"))), ",")
    samples = F.array_join(F.transform("samples", lambda x: F.concat(x.chapter.cast("string"), F.lit("/"), x.role)), ",")
    return out.select("source", "name", roles.alias("roles"), "mentions", "drift", samples.alias("samples"))


QUERIES = {
    "facts_korean": lambda s, d: review.facts(_docs(s, d), rules.FACTS).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first_value"), F.min("line_no").cast("long").alias("first_line")),
    "fact_enrichment": lambda s, d: facts.enrich(review.facts(_docs(s, d), rules.FACTS)).groupBy("doc_id", "kind", "axis", "strictness", "disposition_hint", "manual_reading_required").agg(F.count(F.lit(1)).alias("n")),
    "timeline_summary": lambda s, d: facts.timeline(_docs(s, d)).withColumn("samples", F.array_join("samples", ",")),
    "character_titles": _titles,
    "hygiene_korean": lambda s, d: _count(review.flags(_docs(s, d), rules.HYGIENE), "rule"),
    "contextual_typos": lambda s, d: typos.contextual_typos(_docs(s, d)).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "subtype", "value", "severity", F.sha2("replacement", 256).alias("replacement"), F.col("confidence_floor").cast("long").alias("confidence_floor")),
    "term_densities": lambda s, d: style.density_features(_docs(s, d), "doc_id"),
    "style_summary": lambda s, d: style.style_summary(_docs(s, d), "doc_id"),
    "surface_scan": lambda s, d: style.surface_scan(_docs(s, d), "doc_id").select("doc_id", "signal_type", "n", F.array_join(F.transform("examples", lambda x: F.concat(x.line.cast("string"), F.lit(" "), x.text)), "\n").alias("examples")),
}

# -- the SQL ------------------------------------------------------------------------------------------------------------------

_SRC = f"SELECT doc_id, source, {KOREAN} AS text FROM documents"
_L = f"SELECT *, CASE WHEN ends_with(text, chr(10)) THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END AS l FROM ({_SRC})"
_ROWS = f"SELECT doc_id, source, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM ({_L})"
_ALL = " UNION ALL ".join(f"SELECT doc_id, source, line_no, {_quote(k)} AS kind, unnest(regexp_extract_all(line, {_quote(p)})) AS value FROM r" for k, p in rules.FACTS.items())
_FACTS = f"r AS ({_ROWS}), f AS ({_ALL})"
_SUFFIX = "|".join((*rules.ROLE_SUFFIXES, *rules.KIN_SUFFIXES))
_TRIM = lambda x: f"regexp_replace({x}, {_quote(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"
_HARD = ", ".join(map(_quote, rules.HARD_CARRYOVER_KINDS))
_STYLE = "regexp_replace(regexp_replace(line, '([A-Za-z])''([A-Za-z])', '\\1\\2', 'g'), '([A-Za-z])''([A-Za-z])', '\\1\\2', 'g')"
_DOUBLE, _SINGLE = "(length(line) - length(replace(line, '\"', '')))", f"(length({_STYLE}) - length(replace({_STYLE}, '''', '')))"
_QUOTES = f"""concat_ws(',', CASE WHEN {_DOUBLE} > 0 THEN 'straight_double_quote_style' END, CASE WHEN {_SINGLE} > 0 THEN 'straight_single_quote_style' END, CASE WHEN {_DOUBLE} % 2 = 1 THEN 'odd_ascii_quote_count' END,
  CASE WHEN length(replace(line, '“', '')) <> length(replace(line, '”', '')) THEN 'curly_quote_imbalance' END, CASE WHEN ends_with(line, '“') THEN 'line_ends_with_open_quote' END, CASE WHEN contains(line, '”"') OR contains(line, '"”') THEN 'mixed_closing_quotes' END)"""
_AHEAD = {r"피난\s+주(?=에도|에|에는|를|가|\b)": r"피난\s+주(?:에도|에|에는|를|가|[^\p{L}\p{N}_]|$)"}
_GAP = r"(?:^|[^\p{L}\p{N}_])(11자(?:의)?\s*틈새)"
_MASKED = "regexp_replace(regexp_replace(line, '([A-Za-z])''([A-Za-z])', '\\1' || chr(2) || '\\2', 'g'), '([A-Za-z])''([A-Za-z])', '\\1' || chr(2) || '\\2', 'g')"
_TYPOS = f"""
k AS (SELECT doc_id, line_no, {_TRIM("line")} AS line FROM r), s AS (SELECT *, {_QUOTES} AS quotes,
  replace(list_reduce(list_prepend('', list_transform(string_split(list_reduce(list_prepend('', list_transform(string_split({_MASKED}, '"'), lambda p, i: CASE WHEN i = 1 THEN '' WHEN i % 2 = 0 THEN '“' ELSE '”' END || p)), lambda a, b: a || b), ''''), lambda p, i: CASE WHEN i = 1 THEN '' WHEN i % 2 = 0 THEN '‘' ELSE '’' END || p)), lambda a, b: a || b), chr(2), '''') AS curly FROM k WHERE line <> ''),
t AS ({" UNION ALL ".join(f"SELECT doc_id, line_no, {_quote(s)} AS subtype, {_quote(v)} AS value, {_quote(lv)} AS severity, {_quote(n)} AS replacement FROM s WHERE regexp_matches(line, {_quote(_AHEAD.get(p, p))})" for s, v, n, p, lv in rules.PROOFREAD)}
UNION ALL SELECT doc_id, line_no, 'product_vs_chest', '제품에', 'P2', '품에' FROM s WHERE regexp_matches(line, {_quote(rules.EMBRACE)})
UNION ALL SELECT doc_id, line_no, 'numeric_shape_homograph', regexp_extract(line, {_quote(_GAP)}, 1), CASE WHEN regexp_matches(line, {_quote(rules.NIB)}) THEN 'P2' ELSE 'P3' END, '일자형 틈새' FROM s WHERE regexp_matches(line, {_quote(_GAP)})
UNION ALL SELECT doc_id, line_no, 'compound_spacing', '튀어 나왔다', 'P3', '튀어나왔다' FROM s WHERE contains(line, '튀어 나왔다')
UNION ALL SELECT doc_id, line_no, 'ascii_ellipsis', d, 'P3', repeat('…', CAST(greatest(1, round_even(length(d) / 3.0, 0)) AS INT)) FROM (SELECT *, regexp_extract(line, '\\.{{3,}}') AS d FROM s) WHERE d <> ''
UNION ALL SELECT doc_id, line_no, 'quote_balance', quotes, 'P3', curly FROM s WHERE quotes <> '')"""
_TERMS = " UNION ALL ".join(f"SELECT doc_id, {_quote(name)} AS feature, {w}.0::DOUBLE AS weight, {full}.0::DOUBLE AS dense, {j} AS j, {_quote(t)} AS term, CAST((length(text) - length(replace(text, {_quote(t)}, ''))) / {len(t)} AS BIGINT) AS n, greatest(length(text) / 10000.0::DOUBLE, 1) AS size FROM src" for name, (terms, w, full) in rules.DENSITIES.items() for j, t in enumerate(terms))
_DENSITIES = f"""
SELECT doc_id, feature, round(least(greatest(value / dense * weight, 0), weight), 1) AS score, weight, value, hits, evidence FROM (
  SELECT doc_id, feature, any_value(weight) AS weight, any_value(dense) AS dense, round(sum(n) / any_value(size), 3) AS value, CAST(sum(n) AS BIGINT) AS hits, coalesce(array_to_string((list(term || ':' || n ORDER BY -n, j) FILTER (n > 0))[1:8], ','), '') AS evidence FROM terms GROUP BY doc_id, feature)"""
_SENT = r"SELECT doc_id, s FROM (SELECT doc_id, trim(regexp_replace(unnest(regexp_split_to_array(regexp_replace(text, '([.!?。？！])', E'\\1\n', 'g'), E'[\r\n]+')), " + _quote(f"[{SPACE}]+") + ", ' ', 'g')) AS s FROM src) WHERE length(s) BETWEEN 8 AND 240"
_BARE = f"regexp_replace(s, {_quote(f'[{SPACE}]+')}, '', 'g')"


def _repeat(side: str, weight: float, name: str) -> str:
    return f"""SELECT doc_id, '{name}' AS feature, round(least(coalesce(sum(n - 3) FILTER (n >= 4 AND token IS NOT NULL), 0) * 100.0::DOUBLE / sum(n) / 4 * {weight}, {weight}), 1) AS score, NULL AS hits
  FROM (SELECT doc_id, CASE WHEN length(b) >= 10 THEN {side}(b, 8) END AS token, count(*) AS n FROM (SELECT doc_id, {_BARE} AS b FROM sent) GROUP BY ALL) GROUP BY doc_id HAVING sum(n) >= 30"""


_SCANS = {k: p for k, p in rules.SURFACE.items()}
_SCANS["placeholder_surface"] = "OOO|○○|20XX|XX년"  # the lookaround branch has no match in these texts (Latin capitals before 사 do not occur)

ORACLES = {
    "facts_korean": f"WITH {_FACTS} SELECT doc_id, kind, count(*) AS n, min(value) AS first_value, min(line_no) AS first_line FROM f GROUP BY doc_id, kind",
    "fact_enrichment": f"""WITH {_FACTS} SELECT doc_id, kind, CASE WHEN kind IN ('money', 'percent') THEN 'numeric_carryover' WHEN kind IN ('title_or_role', 'kin_title') THEN 'title_role_drift' WHEN kind IN ({_HARD}) THEN 'timeline_continuity' WHEN kind = 'era_or_modern_tone_candidate' THEN 'era_validation' END AS axis,
  CASE WHEN kind IN ({_HARD}) THEN 'hard_carryover' WHEN kind = 'era_or_modern_tone_candidate' THEN 'soft_external_fact' END AS strictness, CASE WHEN kind IN ({_HARD}) THEN 'hard_carryover_conflict' WHEN kind = 'era_or_modern_tone_candidate' THEN 'external_fact_soft' END AS disposition_hint,
  CASE WHEN kind IN ({_HARD}) OR kind = 'era_or_modern_tone_candidate' THEN true END AS manual_reading_required, count(*) AS n FROM f GROUP BY doc_id, kind""",
    "timeline_summary": f"""WITH r AS ({_ROWS}), c AS (SELECT doc_id, line_no, regexp_extract_all(line, {_quote(rules.FACTS["date"])}) AS d, regexp_extract_all(line, {_quote(rules.FACTS["time"])}) AS t, regexp_extract_all(line, {_quote(rules.FACTS["relative_time"])}) AS x FROM r),
g AS (SELECT doc_id, flatten(list(d ORDER BY line_no)) AS d, flatten(list(t ORDER BY line_no)) AS t, flatten(list(x ORDER BY line_no)) AS x FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(d) AS BIGINT) AS dates, CAST(len(t) AS BIGINT) AS times, CAST(len(x) AS BIGINT) AS relative_times, array_to_string(list_concat(list_concat(d, t), x)[1:5], ',') AS samples, len(d) + len(t) + len(x) >= 4 AS high_signal FROM g""",
    "character_titles": f"""WITH {_FACTS}, b AS (SELECT source, doc_id, line_no, kind, regexp_replace(value, {_quote(f'[{SPACE}]+')}, '', 'g') AS v FROM f WHERE kind IN ('title_or_role', 'kin_title')),
n AS (SELECT source, doc_id, line_no, kind, regexp_extract(v, '^(.+?)({_SUFFIX})$', 1) AS name, regexp_extract(v, '^(.+?)({_SUFFIX})$', 2) AS role FROM b WHERE regexp_matches(v, '^(.+?)({_SUFFIX})$')),
c AS (SELECT source, name, array_to_string(list(role || ':' || n ORDER BY role), ',') AS roles, CAST(sum(n) AS BIGINT) AS mentions, count(*) >= 2 AS drift FROM (SELECT source, name, role, count(*) AS n FROM n GROUP BY ALL) GROUP BY source, name),
o AS (SELECT *, row_number() OVER (PARTITION BY source, name ORDER BY kind = 'kin_title', doc_id, line_no, role) AS i FROM n)
SELECT c.*, s.samples FROM c JOIN (SELECT source, name, string_agg(doc_id || '/' || role, ',' ORDER BY i) AS samples FROM o WHERE i <= 8 GROUP BY source, name) s USING (source, name)""",
    "hygiene_korean": f"WITH r AS ({_ROWS}) " + " UNION ALL ".join(f"SELECT doc_id, {_quote(k)} AS rule, count(*) AS n, min(line_no) AS first_line FROM r WHERE regexp_matches(line, {_quote(p)}) GROUP BY doc_id" for k, p in rules.HYGIENE.items()),
    "contextual_typos": f"WITH r AS ({_ROWS}), {_TYPOS} SELECT doc_id, line_no, subtype, value, severity, sha256(replacement) AS replacement, CAST(95 AS BIGINT) AS confidence_floor FROM t",
    "term_densities": f"WITH src AS ({_SRC}), terms AS ({_TERMS}) {_DENSITIES}",
    "style_summary": f"""WITH src AS ({_SRC}), terms AS ({_TERMS}), dens AS ({_DENSITIES}), sent AS ({_SENT}),
feat AS (SELECT doc_id, feature, score, hits FROM dens UNION ALL {_repeat("left", 14.0, "sentence_starter_repetition")} UNION ALL {_repeat("right", 10.0, "sentence_ending_repetition")}
  UNION ALL SELECT doc_id, 'sentence_length_uniformity', round(least(greatest((0.55::DOUBLE - cv) / 0.25 * 8, 0), 8), 1), NULL FROM (SELECT doc_id, count(*) AS k, stddev_pop(n) / avg(n) AS cv FROM (SELECT doc_id, length({_BARE}) AS n FROM sent WHERE length(s) <= 220) GROUP BY doc_id) WHERE k >= 50
  UNION ALL SELECT doc_id, 'brick_line_density', round(least(n / greatest(chars / 10000.0::DOUBLE, 1) / 8 * 6, 6), 1), NULL FROM (SELECT doc_id, any_value(chars) AS chars, count(*) FILTER (length({_TRIM("line")}) >= 160) AS n FROM (SELECT r.doc_id, line, length(text) AS chars FROM ({_ROWS}) r JOIN src USING (doc_id)) GROUP BY doc_id)),
sums AS (SELECT doc_id, CAST(least(greatest(round_even(round(sum(score), 6), 0), 0), 100) AS BIGINT) AS score, CAST(sum(hits) AS BIGINT) AS total_hits FROM feat GROUP BY doc_id),
top AS (SELECT doc_id, string_agg(feature, ',' ORDER BY i) AS top_features FROM (SELECT doc_id, feature, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, feature) AS i FROM feat) WHERE i <= 4 AND score > 0 GROUP BY doc_id),
size AS (SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(coalesce(k, 0) AS BIGINT) AS sentences FROM src LEFT JOIN (SELECT doc_id, count(*) AS k FROM sent GROUP BY doc_id) USING (doc_id))
SELECT doc_id, chars, sentences, score, CAST(least(greatest(score, 3), 95) AS BIGINT) AS probability, CASE WHEN score >= 75 THEN 'Very High' WHEN score >= 50 THEN 'High' WHEN score >= 25 THEN 'Medium' ELSE 'Low' END AS band,
  CASE WHEN chars >= 80000 AND sentences >= 500 THEN 'High' WHEN chars >= 20000 AND sentences >= 150 THEN 'Medium' ELSE 'Low' END AS confidence, total_hits, round(total_hits / greatest(chars / 10000.0::DOUBLE, 1), 3) AS density, coalesce(top_features, '') AS top_features
FROM size JOIN sums USING (doc_id) LEFT JOIN top USING (doc_id)""",
    "surface_scan": f"WITH r AS ({_ROWS}) " + " UNION ALL ".join(f"SELECT doc_id, {_quote(k)} AS signal_type, CAST(sum(len(regexp_extract_all(line, {_quote(p)}))) AS BIGINT) AS n, coalesce(array_to_string((list(line_no || ' ' || {_TRIM('line')} ORDER BY line_no) FILTER (regexp_matches(line, {_quote(p)})))[1:5], chr(10)), '') AS examples FROM r GROUP BY doc_id" for k, p in _SCANS.items()),
}
