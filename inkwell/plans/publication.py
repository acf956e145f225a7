"""Queries on the submission gate, author reports, folders as works and rendered text, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import author, contracts, gate, rules
from ..sinks import files
from ..sources import collections
from . import delivery, manuscript, reviews
from .reviews import _cycle, _sql

WORKS = f"SELECT doc_id, {_cycle('doc_id', ['delivery', 'proofread', '정합성', 'editor', None])} AS gate_profile, {manuscript.MANUSCRIPT} || CASE WHEN doc_id % 4 = 0 THEN chr(10) || '[메모 확인]' || chr(10) || '스마트폰 ~~x~~' ELSE '' END AS text FROM {{documents}}"
FILES = f"SELECT c_custkey % 40 AS work, c_name || '-' || {_cycle('c_custkey', ['2', '10', '1', '010'])} || '.txt' AS name, {_cycle('((c_custkey - c_custkey % 3) / 3)', ['본문 ' + 'x' * 5, chr(10) + ' ', '제3화' + chr(10) + '이미', 'a' + chr(10) + 'b' + chr(10) + '7.' + chr(10) + 'c', None])} AS text FROM {{customer}}"
AUTHORED = reviews.FINDINGS.replace("SELECT o_orderkey,", "SELECT o_orderkey, o_custkey,")
LINES = f"SELECT o_custkey, {_cycle('o_orderkey', ['{' + chr(34) + 'kind' + chr(34) + ':' + chr(34) + 'possible_internal_action_conflict' + chr(34) + '}', 'no json', ' ', '{' + chr(34) + 'kind' + chr(34) + ':' + chr(34) + 'state_trace_checkpoint' + chr(34) + '}', '[1]'])} AS value FROM {{orders}}"
PAGES = f"SELECT n_nationkey, n_name, {_cycle('n_nationkey', ['# {{title}}' + chr(10) + '{{n}} of {{n}} {{other}}', 'x' + chr(10) + '## 다음 액션' + chr(10) + 'y {{title}}', '<!-- S -->old $1<!-- E --> tail', 'plain  '])} AS page FROM {{nation}}"


def _gate(spark, d):
    submitted = _sql(spark, d, reviews.SUBMISSIONS, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("doc_id"), F.from_json("doc", contracts.SUBMISSION).alias("d")).select("doc_id", "d.*")
    texts = _sql(spark, d, delivery.REPORTS, "nation").withColumnRenamed("n_nationkey", "doc_id")
    out = gate.gate_of(_sql(spark, d, WORKS, "documents"), submitted, texts, "doc_id")
    return out.withColumn("blockers", F.array_join("blockers", ","))


def _refreshed(spark, d):
    held = _sql(spark, d, PAGES, "nation").select("n_nationkey", F.expr("array('stage_cues_present', 'human_report_missing', 'hygiene_flags_present')").alias("b"), F.expr("CASE WHEN n_nationkey % 2 = 0 THEN array('human_report_not_claim_evidence_ready', 'hygiene_flags_present') ELSE array() END").cast("array<string>").alias("now"))
    return held.select("n_nationkey", F.array_join(gate.refresh(F.col("b"), gate.REPORT_BLOCKERS, F.col("now")), ",").alias("blockers"))


QUERIES = {
    "gate_status": _gate,
    "gate_refresh": _refreshed,
    "author_findings": lambda s, d: author.author_findings(_sql(s, d, AUTHORED, "orders"), "o_custkey", "o_orderkey"),
    "reaudit_groups": lambda s, d: author.reaudit_groups(_sql(s, d, AUTHORED, "orders"), "o_custkey", "o_orderkey"),
    "finding_rollup": lambda s, d: author.finding_rollup(_sql(s, d, AUTHORED, "orders"), "o_custkey"),
    "folder_texts": lambda s, d: collections.folder_texts(_sql(s, d, FILES, "customer"), "work", "name"),
    "jsonl_counts": lambda s, d: collections.jsonl_counts(_sql(s, d, LINES, "orders"), "o_custkey"),
    "render_template": lambda s, d: _sql(s, d, PAGES, "nation").select("n_nationkey", files.render_template(F.col("page"), {"title": F.col("n_name"), "n": F.col("n_nationkey")}).alias("page")),
    "upsert_section": lambda s, d: _sql(s, d, PAGES, "nation").select("n_nationkey", files.upsert_section(F.col("page"), F.concat(F.lit("new $1 \\ "), "n_name"), "<!-- S -->", "<!-- E -->", ("## 우선 확인할 것", "## 다음 액션")).alias("page")),
    "ledger_html": lambda s, d: files.html_table(s.read.parquet(f"{d}/nation.parquet").select("n_regionkey", "n_nationkey", F.concat(F.lit("<"), "n_name", F.lit("&>")).alias("name")), "n_regionkey", ["n_nationkey", "name"], "n_nationkey"),
}

# -- the SQL ------------------------------------------------------------------------------------------------------------------

_W = WORKS.replace("{documents}", "documents")


def _over(sql: str) -> str:
    """A manuscript query's SQL over the works of the gate."""
    return sql.replace(manuscript._SRC, f"SELECT doc_id, text FROM ({_W})")


def reviews_sql(name: str) -> str:
    return reviews.ORACLES[name]


_STATUS = reviews.ORACLES["submission_status"].replace("FROM customer", "FROM (SELECT * FROM customer WHERE c_custkey % 3 > 0)")
_CHAPTERS = f"""WITH {_over(manuscript._HEADS)}, e AS (SELECT doc_id, n, stop, coalesce(lead(start) OVER w, length(text)) AS till, text FROM heads JOIN ({_W}) USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY n))
SELECT doc_id, n AS no, substr(text, stop + 1, till - stop) AS text FROM e UNION ALL SELECT doc_id, 0, text FROM ({_W}) WHERE doc_id NOT IN (SELECT doc_id FROM heads)"""
_CLINES = f"SELECT doc_id, no, unnest(string_split(text, chr(10))) AS line FROM ({_CHAPTERS})"
_HYGIENE = " UNION ALL ".join(f"SELECT doc_id FROM cl WHERE regexp_matches(line, '{p}')" for p in rules.HYGIENE.values())
_DECIDED = "CASE lower(trim(coalesce(CASE WHEN coalesce(decision, '') <> '' THEN decision ELSE status END, ''))) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in author.DECISIONS.items()) + " ELSE 'deferred' END"
_PRIORITY = "CASE WHEN trim(coalesce(nullif(final_priority, ''), priority, '')) IN ('P0', 'P1', 'P2', 'P3') THEN trim(coalesce(nullif(final_priority, ''), priority, '')) ELSE 'P3' END"
_CONF = "CAST(least(greatest(coalesce(TRY_CAST(nullif(regexp_extract(coalesce(confidence_percent, ''), '-?[0-9]+'), '') AS INT), 0), 0), 100) AS BIGINT)"
_AUTHORED = f"SELECT *, {_DECIDED} AS group_decision, {_PRIORITY} AS group_priority, {_CONF} AS confidence FROM ({AUTHORED.replace('{orders}', 'orders')})"
_PAGES = PAGES.replace("{nation}", "nation")
_HEAD5 = f"string_split(body, chr(10))[1:5]"

ORACLES = {
    "gate_status": f"""
WITH cl AS ({_CLINES}), ff AS (SELECT doc_id, count(*) AS n FROM ({_over(manuscript.ORACLES["format_flags"])}) GROUP BY doc_id), hy AS (SELECT doc_id, count(*) AS n FROM ({_HYGIENE}) GROUP BY doc_id),
sc AS (SELECT doc_id, count(*) AS n FROM ({_CHAPTERS}) WHERE length(text) < 4000 GROUP BY doc_id), cue AS (SELECT doc_id, count(*) AS n FROM cl WHERE trim(line) = '[메모 확인]' GROUP BY doc_id), era AS (SELECT doc_id, sum(len(regexp_extract_all(line, '{rules.FACTS["era_or_modern_tone_candidate"]}'))) AS n FROM cl GROUP BY doc_id),
ty AS (SELECT doc_id, sum(CASE WHEN regexp_matches(line, '[.]{{3,}}') THEN 1 ELSE 0 END + CASE WHEN contains(line, '"') OR contains({manuscript._STYLE}, '''') OR length(replace(line, '“', '')) <> length(replace(line, '”', '')) THEN 1 ELSE 0 END) AS n FROM cl GROUP BY doc_id),
st AS ({_STATUS}), rp AS ({delivery.ORACLES["report_status"]}),
j AS (SELECT w.doc_id, {reviews._ALIAS("gate_profile")} AS gate_profile, CAST(coalesce(cue.n, 0) AS BIGINT) AS stage_cues, coalesce(ff.n, 0) AS format_flags, coalesce(hy.n, 0) + coalesce(cue.n, 0) AS hygiene_flags, coalesce(sc.n, 0) AS short_chapters, CAST(0 AS BIGINT) AS narrative_allowances,
  CAST(coalesce(ty.n, 0) AS BIGINT) AS contextual_typos, CAST(coalesce(era.n, 0) AS BIGINT) AS era_candidates, coalesce(st.ready, false) AS manual, st.blockers AS sb, rp.ready AS rr
  FROM ({_W}) w LEFT JOIN cue USING (doc_id) LEFT JOIN ff USING (doc_id) LEFT JOIN hy USING (doc_id) LEFT JOIN sc USING (doc_id) LEFT JOIN ty USING (doc_id) LEFT JOIN era USING (doc_id) LEFT JOIN st ON st.c_custkey = w.doc_id LEFT JOIN rp ON rp.n_nationkey = w.doc_id),
b AS (SELECT *, concat_ws(',', CASE WHEN stage_cues > 0 THEN 'stage_cues_present' END, CASE WHEN format_flags > 0 THEN 'manuscript_format_policy_violations' END, CASE WHEN hygiene_flags > 0 THEN 'hygiene_flags_present' END, CASE WHEN short_chapters > 0 THEN 'chapter_under_minimum_chars' END, nullif(sb, ''),
  CASE WHEN NOT manual THEN 'manual_review_not_complete' END, CASE WHEN gate_profile = 'delivery' AND rr IS NOT NULL AND NOT (rr AND manual) THEN 'human_report_not_claim_evidence_ready' END, CASE WHEN gate_profile = 'delivery' AND rr IS NULL THEN 'human_report_missing' END) AS blockers FROM j)
SELECT * EXCLUDE (manual, sb, rr), blockers = '' AS ready FROM b""",
    "gate_refresh": "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'human_report_not_claim_evidence_ready,hygiene_flags_present,stage_cues_present' ELSE 'hygiene_flags_present,stage_cues_present' END AS blockers FROM nation",
    "author_findings": f"SELECT o_custkey, o_orderkey, group_priority, group_decision, confidence, row_number() OVER (PARTITION BY o_custkey, group_priority ORDER BY confidence DESC, claim, o_orderkey) AS place FROM ({_AUTHORED}) WHERE group_decision NOT IN ('retracted', 'deferred') AND (group_priority NOT IN ('P0', 'P1') OR group_decision = 'confirmed') AND trim(coalesce(claim, '')) <> ''",
    "reaudit_groups": f"SELECT o_custkey, o_orderkey, group_decision, group_priority, confidence, row_number() OVER (PARTITION BY o_custkey, group_decision ORDER BY group_priority, confidence DESC, o_orderkey) AS place FROM ({_AUTHORED})",
    "finding_rollup": f"SELECT o_custkey, group_priority AS priority, group_decision AS decision, count(*) AS n FROM ({_AUTHORED}) GROUP BY ALL",
    "folder_texts": f"""
WITH f AS (SELECT work, name, trim(coalesce(text, ''), ' ' || chr(10)) AS body, array_to_string(list_transform(regexp_extract_all(lower(name), '\\d+|\\D+'), lambda p: CASE WHEN regexp_matches(p, '^\\d') THEN lpad(p, 20, '0') ELSE p END), '') AS k FROM ({FILES.replace("{customer}", "customer")})),
i AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY k, name) AS i, list_bool_or(list_transform({_HEAD5}, lambda x: regexp_matches(x, '^제3화$|^7[.]$'))) AS headed FROM f)
SELECT work, coalesce(string_agg(CASE WHEN headed THEN body ELSE 'ⓚ제' || i || '화' || chr(10) || body END, chr(10) || chr(10) ORDER BY i) FILTER (body <> ''), '') AS text, count(*) AS documents FROM i GROUP BY work""",
    "jsonl_counts": f"SELECT o_custkey, count(*) AS total, count(*) FILTER (contains(value, 'possible_internal')) AS conflicts, count(*) FILTER (contains(value, 'state_trace')) AS checkpoints FROM ({LINES.replace('{orders}', 'orders')}) WHERE trim(value) <> '' GROUP BY o_custkey",
    "render_template": f"SELECT n_nationkey, replace(replace(page, '{{{{title}}}}', n_name), '{{{{n}}}}', CAST(n_nationkey AS VARCHAR)) AS page FROM ({_PAGES})",
    "upsert_section": f"""SELECT n_nationkey, CASE WHEN contains(page, '<!-- S -->') THEN s || ' tail' WHEN contains(page, '다음 액션') THEN 'x' || chr(10) || chr(10) || s || chr(10) || '## 다음 액션' || chr(10) || 'y {{{{title}}}}' ELSE rtrim(page) || chr(10) || chr(10) || s || chr(10) END AS page
  FROM (SELECT *, '<!-- S -->' || chr(10) || 'new $1 \\ ' || n_name || chr(10) || '<!-- E -->' AS s FROM ({_PAGES}))""",
    "ledger_html": "SELECT n_regionkey, '<table><tr><th>n_nationkey</th><th>name</th></tr>' || string_agg('<tr><td>' || n_nationkey || '</td><td>&lt;' || n_name || '&amp;&gt;</td></tr>', '' ORDER BY n_nationkey) || '</table>' AS html FROM nation GROUP BY n_regionkey",
}
