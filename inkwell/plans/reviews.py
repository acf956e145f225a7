"""Queries on review contracts: orders as findings, customers as submissions (JSON documents read with a schema), nations as works; and their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import contracts
from ..operators import protocol as P
from ..operators.rules import HARD_CARRYOVER_KINDS


def _cycle(column: str, values: list) -> str:
    """One of the values by a column's remainder, in words that Spark and DuckDB read alike."""
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values)) + " END"


_CYCLES = {
    "priority": ("o_orderkey", ["P0", "p1 ", "P2", "P9", None]), "status": ("o_custkey", ["확정", "강등", "open", ""]), "decision": ("o_orderkey", [None, "confirmed", "기각", "유보", "downgraded", "", "Confirmed"]),
    "original_priority": ("o_custkey", [None, "P0", "P2"]), "final_priority": ("o_orderkey", ["P0", "P1", None, "P2", "P3", "P1", "", "P0", "P0"]), "repairability": ("o_custkey", [None, "local_fixable", "webnovel_allowance", "odd", "irreconcilable_premise"]),
    "disposition": ("o_orderkey", ["editable_conflict", "hard_carryover_conflict", "accepted_world_premise", None, "odd", "external_fact_soft"]), "strictness": ("o_custkey", [None, "hard_carryover", "soft"]), "kind": ("o_orderkey", [None, "money", "other", ""]),
    "fact_kind": ("o_custkey", ["time", None]), "category": ("o_orderkey", ["Era check", "numeric", "", "style", "외부 고증", "plot"]), "claim": ("o_custkey", ["x", "x", None]), "rationale": ("o_orderkey", ["x", "x", "x", ""]),
    "evidence": ("o_orderkey", [None, "e", " ", "e"]), "evidence_snippet": ("o_custkey", [None, "s", ""]), "counter_evidence": ("o_orderkey", [None, " ", "c", None, ""]), "story_state_before": ("o_custkey", [None, "b"]),
    "story_state_after": ("o_orderkey", [None, "a", " "]), "story_internal_impact": ("o_custkey", [None, None, "i"]), "fix_hint": ("o_orderkey", ["f", None]), "reader_risk": ("o_custkey", ["r", ""]),
    "confidence_percent": ("o_orderkey", ["95", "94", None, "101", "x", "100", "96", "-1", "99", "97", "98"]),
}
FINDINGS = "SELECT o_orderkey, " + ", ".join(f"{_cycle(*_CYCLES[c])} AS {c}" for c in contracts.FINDING_FIELDS) + " FROM {orders}"


def _passes(kind: str) -> dict:
    good = {"status": "completed", "notes": ["n"], "completed_task_ids": ["t"]}
    out = {n: dict(good) for n in P.PASSES}
    if kind == "open":
        out["pass2"] = {"status": "pending", "notes": [], "completed_task_ids": []}
    elif kind == "missing":
        del out["pass3"]
    elif kind == "bare":
        out["pass1"] = {"status": "completed", "notes": [" "], "completed_task_ids": []}
    return out


def _blind(kind: str) -> dict:
    out = {r: {"status": "completed", "passes": _passes("good")} for r in P.REVIEWERS}
    if kind == "open":
        out["blind_agent_2"] = {"status": "pending", "passes": _passes("open")}
    elif kind == "missing":
        del out["blind_agent_3"]
        out["blind_agent_1"]["passes"] = _passes("missing")
    return out


_AXES = [{"axis": a, "status": "checked", "notes": "n"} for a in P.AXES]
_FINDING = {"priority": "P2", "status": "open", "category": "style", "claim": "c", "rationale": "r", "decision": "confirmed", "confidence_percent": 96, "final_priority": "P2", "fix_hint": "f", "reader_risk": "r", "evidence": "e"}
_SECTIONS = {
    "status": ["complete", "complete", "complete", "pending"], "gate_profile": ["delivery", "검수", "editor", "proofread", "correction_pass", None, "odd"], "final_summary": ["s", "s", "s", "s", " "],
    "checked_axes": [_AXES, _AXES, _AXES, [*_AXES[1:], {"axis": "odd", "status": "skipped"}], [{**_AXES[0], "notes": ""}, *_AXES[1:]], None],
    "passes": [_passes("good"), _passes("good"), _passes("open"), _passes("missing"), _passes("bare"), None, _passes("good")], "adversarial_passes": [_passes("good"), _passes("good"), _passes("good"), _passes("missing"), None],
    "blind_reviews": [_blind("good"), _blind("good"), _blind("good"), _blind("open"), _blind("missing"), None, _blind("good"), _blind("good")],
    "total_consistency_report": [{"status": "completed", "path": "p", "notes": ["n"]}] * 3 + [{"status": "pending"}, {"status": "completed", "path": "", "notes": []}, None],
    "consistency_repetition_contract": [{"requested_unit_count": 1, "completed_unit_count": 1, "units": []}] * 2 + [{"requested_unit_count": 3, "completed_unit_count": 1, "units": [{"unit_id": "u", "status": "completed", "total_report_path": "", "notes": []}] * 2}, {"requested_unit_count": 0, "completed_unit_count": "x"}, None],
    "findings": [[], [_FINDING], [_FINDING, {**_FINDING, "priority": "", "decision": "retracted"}], None],
}
SUBMISSIONS = (
    "SELECT c_custkey, '{' || "
    + " || ',' || ".join(f"'\"{k}\":' || {_cycle(f'((c_custkey - c_custkey % {m}) / {m})', [json.dumps(v, ensure_ascii=False) for v in vs])}" for k, vs, m in zip(_SECTIONS, _SECTIONS.values(), (1, 1, 2, 1, 3, 1, 1, 2, 1, 1), strict=True))
    + " || '}' AS doc FROM {customer}"
)


def _sql(spark, d, query: str, name: str):
    """A query on one table whose text holds braces of its own."""
    view = f"inkwell_{name}_reviews"
    spark.read.parquet(f"{d}/{name}.parquet").createOrReplaceTempView(view)
    return spark.sql(query.replace("{" + name + "}", view))


def _submissions(spark, d):
    docs = _sql(spark, d, SUBMISSIONS, "customer")
    return contracts.validate_submissions(docs.select("c_custkey", F.from_json("doc", contracts.SUBMISSION).alias("d")).select("c_custkey", "d.*"), ["c_custkey"])


_PROFILE_NAMES = ["delivery", "검수", "Editorial_Pass", "표면교정", "교정", "", "unknown", None]
_QUEUE = f"SELECT n_nationkey, {_cycle('n_nationkey', _PROFILE_NAMES)} AS profile FROM {{nation}}"

QUERIES = {
    "review_queue": lambda s, d: P.review_queue(_sql(s, d, _QUEUE, "nation"), "profile"),
    "finding_issues": lambda s, d: contracts.finding_issues(_sql(s, d, FINDINGS, "orders"), ["o_orderkey"]),
    "submission_issues": lambda s, d: _submissions(s, d).select("c_custkey", F.inline("issues")),
    "submission_status": lambda s, d: _submissions(s, d).drop("issues").withColumn("blockers", F.array_join("blockers", ",")),
    "workflow_blockers": lambda s, d: _submissions(s, d).select("c_custkey", F.explode("blockers").alias("blocker")).groupBy("blocker").agg(F.count(F.lit(1)).alias("n")),
}

# -- the SQL ------------------------------------------------------------------------------------------------------------------


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_ALIAS = lambda x: f"CASE replace(lower(trim(coalesce({x}, ''))), '_', '-') " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.ALIASES.items()) + " ELSE 'delivery' END"
_NEED = {n: _in([p for p, v in P.PROFILES.items() if v[2 + i]] or ["-"]) for i, n in enumerate(P.NEEDS)}
_DIM_AXES = "(VALUES " + ", ".join(f"('{p}', '{a}')" for p, v in P.PROFILES.items() for a in v[1]) + ") pa(p, axis)"
_ONE = lambda values, name: "(VALUES " + ", ".join(f"('{v}')" for v in values) + f") {name}"
_QUEUE_SQL = f"""
WITH w AS (SELECT n_nationkey, {_ALIAS("profile")} AS profile FROM ({_QUEUE.replace("{nation}", "nation")})), t AS (
  SELECT n_nationkey, profile, 'source-preflight-' || r AS task_id, 'source_preflight' AS phase, 'source' AS lane, 'preflight' AS pass, r AS axis, true AS required FROM w, {_ONE(P.RISKS, "d(r)")}
  UNION ALL SELECT n_nationkey, profile, 'profile-axis-' || axis, 'profile_axis_review', 'profile', 'single', axis, true FROM w JOIN {_DIM_AXES} ON p = profile WHERE profile NOT IN {_NEED["primary"]}
  UNION ALL SELECT n_nationkey, profile, n || '-' || a, 'primary_consistency_review', 'primary', n, a, profile IN {_NEED["primary"]} AND EXISTS (SELECT 1 FROM {_DIM_AXES} WHERE p = profile AND axis = a) FROM w, {_ONE(P.PASSES, "d(n)")}, {_ONE(P.AXES, "e(a)")}
  UNION ALL SELECT n_nationkey, profile, r || '-' || n || '-blind-consistency', 'blind_consistency_review', r, n, 'all_axes', profile IN {_NEED["blind"]} FROM w, {_ONE(P.PASSES, "d(n)")}, {_ONE(P.REVIEWERS, "e(r)")}
  UNION ALL SELECT n_nationkey, profile, 'total-consistency-report', 'synthesis', 'total', 'synthesis', 'all_axes', profile IN {_NEED["total"]} FROM w
  UNION ALL SELECT n_nationkey, profile, 'adversarial-' || n, 'adversarial_audit', 'adversarial', n, 'all_axes', profile IN {_NEED["adversarial"]} FROM w, {_ONE(P.PASSES, "d(n)")})
SELECT *, CASE WHEN required THEN 'pending' ELSE 'skipped' END AS status FROM t"""

_T = lambda c: f"(coalesce({c}, '') <> '')"
_H = lambda c: f"(trim(coalesce({c}, '')) <> '')"
_PRIO = lambda first: f"CASE WHEN upper(trim(coalesce(CASE WHEN {_T(first)} THEN {first} ELSE priority END, ''))) IN {_in(P.PRIORITIES)} THEN upper(trim(coalesce(CASE WHEN {_T(first)} THEN {first} ELSE priority END, ''))) ELSE 'P3' END"
_DECIDED = f"CASE lower(trim(coalesce(CASE WHEN {_T('decision')} THEN decision ELSE status END, ''))) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.DECISIONS.items()) + f" ELSE lower(trim(coalesce(CASE WHEN {_T('decision')} THEN decision ELSE status END, ''))) END"
_JUDGED = f"""SELECT *, {_DECIDED} AS dec, {_PRIO("original_priority")} AS first_p, {_PRIO("final_priority")} AS last_p, {_H("evidence")} OR {_H("evidence_snippet")} AS proof, {_H("counter_evidence")} AS counter,
  {_H("story_internal_impact")} OR {_H("story_state_before")} OR {_H("story_state_after")} AS impact, lower(trim(coalesce(category, ''))) AS cat, CASE WHEN regexp_matches(confidence_percent, '^-?[0-9]+$') THEN CAST(confidence_percent AS INT) END AS conf,
  coalesce(decision, confidence_percent, evidence_snippet, counter_evidence, original_priority, final_priority) IS NOT NULL AS audited,
  trim(coalesce(strictness, '')) = 'hard_carryover' OR trim(coalesce(disposition, '')) = 'hard_carryover_conflict' OR CASE WHEN {_T("kind")} THEN trim(kind) ELSE trim(coalesce(fact_kind, '')) END IN {_in(HARD_CARRYOVER_KINDS)} OR regexp_matches(lower(trim(coalesce(category, ''))), '{"|".join(P.CARRYOVER_CATEGORY)}') AS hard FROM ({{}})"""
_TOP = "last_p IN ('P0', 'P1')"
_BASE_CHECKS = [(f"NOT {_T(c)}", c, "required") for c in ("priority", "status", "category", "claim", "rationale")] + [
    (f"trim(coalesce(repairability, '')) NOT IN ('', {_in(P.REPAIRABILITY)[1:]}", "repairability", "unknown value"), (f"trim(coalesce(disposition, '')) NOT IN ('', {_in(P.DISPOSITIONS)[1:]}", "disposition", "unknown value"),
    (f"{_TOP} AND repairability IN ('irreconcilable_premise', 'webnovel_allowance')", "repairability", "premise or allowance stays P0/P1"), (f"{_TOP} AND disposition IN ('accepted_world_premise', 'genre_hyperbole_allowance', 'external_fact_soft')", "disposition", "premise, allowance or soft fact stays P0/P1"),
]
_FINAL_CHECKS = [(f"NOT {_T(c)}", c, "final triage field missing") for c in ("decision", "confidence_percent", "final_priority", "fix_hint", "reader_risk")] + [
    (f"{_TOP} AND dec <> 'confirmed'", "decision", "P0/P1 not confirmed"), (f"{_TOP} AND coalesce(conf, 0) < 95", "confidence_percent", "P0/P1 below 95"), (f"{_TOP} AND NOT proof", "evidence", "P0/P1 without evidence"), (f"{_TOP} AND counter", "counter_evidence", "P0/P1 with counter evidence"),
    (f"{_TOP} AND NOT impact", "story_internal_impact", "P0/P1 without story impact"), (f"{_TOP} AND regexp_matches(cat, '{'|'.join(P.EXTERNAL_CATEGORY)}') AND NOT {_H('story_internal_impact')}", "story_internal_impact", "external fact without story impact"),
    (f"{_TOP} AND hard AND NOT {_H('story_state_before')}", "story_state_before", "hard carryover without prior state"), (f"{_TOP} AND hard AND NOT {_H('story_state_after')}", "story_state_after", "hard carryover without later state"),
    (f"{_TOP} AND counter", "final_priority", "counter evidence at P0/P1"), (f"dec IN ('downgraded', 'retracted', 'deferred') AND {_TOP}", "final_priority", "not confirmed at P0/P1"), ("dec = 'downgraded' AND last_p <= first_p", "final_priority", "downgrade does not lower severity"),
    ("confidence_percent IS NOT NULL AND (conf IS NULL OR conf NOT BETWEEN 0 AND 100)", "confidence_percent", "not an integer from 0 to 100"), ("audited AND dec = 'confirmed' AND confidence_percent IS NULL", "confidence_percent", "confirmed without confidence"),
    ("audited AND dec = 'confirmed' AND conf < 95", "confidence_percent", "confirmed below 95"), ("audited AND dec = 'confirmed' AND NOT proof", "evidence", "confirmed without evidence"), (f"audited AND dec = 'downgraded' AND NOT {_T('original_priority')}", "original_priority", "downgrade without trace"),
    (f"audited AND dec = 'downgraded' AND NOT {_T('final_priority')}", "final_priority", "downgrade without trace"), ("audited AND dec = 'downgraded' AND NOT counter", "counter_evidence", "downgrade without counter evidence"), ("audited AND dec = 'retracted' AND NOT counter", "counter_evidence", "retraction without counter evidence"),
]


def _checks(table: str, checks: list, keys: str, prefix: str = "''") -> str:
    rows = ", ".join(f"CASE WHEN {c} THEN {{'field': {prefix} || '{f}', 'message': '{m}'}} END" for c, f, m in checks)
    return f"SELECT {keys}, x.field AS field, x.message AS message FROM (SELECT {keys}, unnest(list_filter([{rows}], lambda x: x IS NOT NULL)) AS x FROM ({table}))"


_J = lambda path: f"(j->>'$.{path}')"
_NOTED = lambda path: f"len(list_filter(coalesce(CAST(json_extract_string(j, '$.{path}.notes[*]') AS VARCHAR[]), []), lambda x: trim(x) <> '')) > 0"


def _pass_sql(path: str, present: str, complete: str) -> list[tuple[str, str, str]]:
    held = f"{_J(path)} IS NOT NULL"
    out = [(f"{present} AND NOT ({held})", path, "must be an object")]
    for n in P.PASSES:
        at = f"{path}.{n}"
        there, done = f"{_J(at)} IS NOT NULL", f"coalesce({_J(at + '.status')}, '') = 'completed'"
        out += [
            (f"{held} AND NOT ({there}) AND {present}", at, "missing pass object"), (f"{there} AND {done} AND NOT ({_NOTED(at)})", f"{at}.notes", "completed pass without notes"),
            (f"{there} AND {done} AND coalesce(json_array_length(j, '$.{at}.completed_task_ids'), 0) = 0", f"{at}.completed_task_ids", "completed pass without task ids"), (f"{there} AND NOT ({done}) AND {complete}", f"{at}.status", "not completed"),
        ]
    return out


_DONE = lambda n: f"(complete AND profile IN {_NEED[n]})"
_HAS = lambda n: f"profile IN {_NEED[n]}"
_BLIND = [(f"{_DONE('blind')} AND {_J('blind_reviews')} IS NULL", "blind_reviews", "must be an object")]
for _r in P.REVIEWERS:
    _at = f"blind_reviews.{_r}"
    _there = f"{_J(_at)} IS NOT NULL"
    _BLIND += [(f"{_DONE('blind')} AND {_J('blind_reviews')} IS NOT NULL AND NOT ({_there})", _at, "missing blind reviewer object"), (f"{_DONE('blind')} AND {_there} AND coalesce({_J(_at + '.status')}, '') <> 'completed'", f"{_at}.status", "not completed")]
    _BLIND += [(f"{_there} AND {c}", f, m) for c, f, m in _pass_sql(f"{_at}.passes", _DONE("blind"), _DONE("blind"))]
_REPORT, _R3 = "total_consistency_report", "consistency_repetition_contract"
_INT = lambda path, least: f"(regexp_matches({_J(path)}, '^[0-9]+$') AND TRY_CAST({_J(path)} AS INT) >= {least})"
_WANTED = f"CASE WHEN {_INT(_R3 + '.requested_unit_count', 1)} THEN TRY_CAST({_J(_R3 + '.requested_unit_count')} AS INT) ELSE 1 END"
_UNITS = f"greatest(CASE WHEN {_INT(_R3 + '.completed_unit_count', 0)} THEN TRY_CAST({_J(_R3 + '.completed_unit_count')} AS INT) ELSE 0 END, len(list_filter(coalesce(CAST(json_extract_string(j, '$.{_R3}.units[*].status') AS VARCHAR[]), []), lambda x: x = 'completed')))"
_SHORT = f"({_DONE('repetition')} AND {_J(_R3)} IS NOT NULL AND {_WANTED} > 1 AND {_UNITS} < {_WANTED})"
_REPORTED = f"coalesce({_J(_REPORT + '.status')}, '') = 'completed'"
_READY_REPORT = f"({_REPORTED} AND trim(coalesce({_J(_REPORT + '.path')}, '')) <> '' AND {_NOTED(_REPORT)})"
_PASSED = " + ".join(f"CASE WHEN coalesce({_J(f'{path}.{n}.status')}, '') = 'completed' THEN 1 ELSE 0 END" for path in ("passes", "adversarial_passes", *(f"blind_reviews.{r}.passes" for r in P.REVIEWERS)) for n in P.PASSES)
_WHOLE = [
    (f"{_J('checked_axes')} IS NULL", "checked_axes", "must be an array"), *_pass_sql("passes", _HAS("primary"), _DONE("primary")), *_BLIND, *_pass_sql("adversarial_passes", _HAS("adversarial"), _DONE("adversarial")),
    (f"{_DONE('total')} AND {_J(_REPORT)} IS NULL", _REPORT, "must be an object"), (f"{_DONE('total')} AND {_J(_REPORT)} IS NOT NULL AND NOT ({_REPORTED})", f"{_REPORT}.status", "not completed"),
    (f"{_REPORTED} AND trim(coalesce({_J(_REPORT + '.path')}, '')) = ''", f"{_REPORT}.path", "completed report without path"), (f"{_REPORTED} AND NOT ({_NOTED(_REPORT)})", f"{_REPORT}.notes", "completed report without notes"),
    (f"{_DONE('repetition')} AND {_J(_R3)} IS NULL", _R3, "must be an object"), (f"{_J(_R3 + '.requested_unit_count')} IS NOT NULL AND NOT {_INT(_R3 + '.requested_unit_count', 1)}", f"{_R3}.requested_unit_count", "not an integer from 1"),
    (f"{_J(_R3 + '.completed_unit_count')} IS NOT NULL AND NOT {_INT(_R3 + '.completed_unit_count', 0)}", f"{_R3}.completed_unit_count", "not an integer from 0"), (_SHORT, f"{_R3}.completed_unit_count", "fewer units than requested"),
    ("complete AND reviewed_axes < required_axes", "checked_axes", "profile axes not all checked"), (f"{_DONE('total')} AND NOT coalesce({_READY_REPORT}, false)", _REPORT, "no completed report"), ("complete AND completed_passes < required_passes", "passes", "required passes not all completed"),
    ("complete AND trim(coalesce(j->>'$.final_summary', '')) = ''", "final_summary", "complete without summary"),
]
_F = "SELECT c_custkey, complete, i, " + ", ".join(f"(f->>'$.{c}') AS {c}" for c in contracts.FINDING_FIELDS) + " FROM (SELECT c_custkey, complete, unnest(json_extract(j, '$.findings[*]')) AS f, generate_subscripts(json_extract(j, '$.findings[*]'), 1) AS i FROM q)"
_SUBMISSION_SQL = f"""
WITH s0 AS (SELECT c_custkey, CAST(doc AS JSON) AS j FROM ({SUBMISSIONS.replace("{customer}", "customer")})),
s1 AS (SELECT *, {_ALIAS("j->>'$.gate_profile'")} AS profile, coalesce(j->>'$.status', '') = 'complete' AS complete FROM s0),
ax AS (SELECT c_custkey, profile, i, a->>'$.axis' AS axis, a->>'$.status' AS status, trim(coalesce(a->>'$.notes', '')) AS notes FROM (SELECT c_custkey, profile, unnest(json_extract(j, '$.checked_axes[*]')) AS a, generate_subscripts(json_extract(j, '$.checked_axes[*]'), 1) AS i FROM s1)),
q AS (SELECT s1.*, (SELECT count(*) FROM {_DIM_AXES} WHERE p = profile) AS required_axes, coalesce((SELECT count(*) FROM ax JOIN {_DIM_AXES} ON p = ax.profile AND pa.axis = ax.axis WHERE ax.c_custkey = s1.c_custkey AND ax.status = 'checked'), 0) AS reviewed_axes,
  {_PASSED} AS completed_passes, CASE WHEN {_HAS("primary")} THEN 3 ELSE 0 END + CASE WHEN {_HAS("blind")} THEN 9 ELSE 0 END + CASE WHEN {_HAS("adversarial")} THEN 3 ELSE 0 END AS required_passes FROM s1),
issues AS ({_checks("SELECT * FROM q", _WHOLE, "c_custkey")}
  UNION ALL {_checks("SELECT * FROM ax", [("status = 'checked' AND notes = ''", ".notes", "checked axis without notes"), ("status = 'skipped' AND notes = ''", ".notes", "skipped axis without reason"), (f"axis NOT IN {_in(P.AXES)}", ".axis", "unknown axis")], "c_custkey", "'checked_axes[' || i || ']'")}
  UNION ALL SELECT c_custkey, 'checked_axes', 'missing axis: ' || a FROM q, {_ONE(P.AXES, "d(a)")} WHERE NOT EXISTS (SELECT 1 FROM ax WHERE ax.c_custkey = q.c_custkey AND ax.axis = a)
  UNION ALL {_checks(f"SELECT *, u->>'$.status' AS us FROM (SELECT c_custkey, unnest(json_extract(j, '$.{_R3}.units[*]')) AS u, generate_subscripts(json_extract(j, '$.{_R3}.units[*]'), 1) AS i FROM q)", [("us = 'completed' AND trim(coalesce(u->>'$.unit_id', '')) = ''", ".unit_id", "completed unit without id"), ("us = 'completed' AND trim(coalesce(u->>'$.total_report_path', '')) = ''", ".total_report_path", "completed unit without report"), ("us = 'completed' AND coalesce(json_array_length(u, '$.notes'), 0) = 0", ".notes", "completed unit without notes")], "c_custkey", f"'{_R3}.units[' || i || ']'")}
  UNION ALL {_checks(_JUDGED.format(_F), [*_BASE_CHECKS, *((f"complete AND ({c})", f, m) for c, f, m in _FINAL_CHECKS)], "c_custkey", "'findings[' || i || '].'")})"""
_STARTS = lambda p: f"EXISTS (SELECT 1 FROM issues WHERE issues.c_custkey = q.c_custkey AND starts_with(field, '{p}'))"
_BEHIND = "completed_passes < required_passes"
_BLOCKERS = f"""list_filter([CASE WHEN {_HAS("adversarial")} AND ({_BEHIND} OR {_STARTS("adversarial_passes.")}) THEN 'adversarial_3pass_not_complete' END, CASE WHEN {_HAS("blind")} AND ({_BEHIND} OR {_STARTS("blind_reviews.")}) THEN 'blind_reviews_not_complete' END,
  CASE WHEN {_HAS("repetition")} AND {_STARTS(_R3)} THEN 'consistency_repetitions_not_complete' END, CASE WHEN reviewed_axes < required_axes OR {_STARTS("checked_axes")} THEN 'manual_review_axes_not_complete' END,
  CASE WHEN {_HAS("primary")} AND ({_BEHIND} OR {_STARTS("passes")}) THEN 'primary_consistency_passes_not_complete' END, CASE WHEN {_HAS("total")} AND (NOT complete OR {_BEHIND} OR {_STARTS(_REPORT)}) THEN 'total_consistency_report_not_complete' END], lambda x: x IS NOT NULL)"""
_STATUS = f"""SELECT c_custkey, profile, coalesce(j->>'$.status', 'pending') AS status, reviewed_axes, required_axes, CAST(completed_passes AS BIGINT) AS completed_passes, CAST(required_passes AS BIGINT) AS required_passes, CAST(coalesce(json_array_length(j, '$.findings'), 0) AS BIGINT) AS findings,
  complete AND NOT EXISTS (SELECT 1 FROM issues WHERE issues.c_custkey = q.c_custkey) AND reviewed_axes >= required_axes AND completed_passes >= required_passes AS ready, {_BLOCKERS} AS b FROM q"""

ORACLES = {
    "review_queue": _QUEUE_SQL,
    "finding_issues": _checks(_JUDGED.format(FINDINGS.replace("{orders}", "orders")), [*_BASE_CHECKS, *_FINAL_CHECKS], "o_orderkey"),
    "submission_issues": f"{_SUBMISSION_SQL} SELECT * FROM issues",
    "submission_status": f"{_SUBMISSION_SQL} SELECT * EXCLUDE (b), array_to_string(b, ',') AS blockers FROM ({_STATUS})",
    "workflow_blockers": f"{_SUBMISSION_SQL} SELECT blocker, count(*) AS n FROM (SELECT unnest(b) AS blocker FROM ({_STATUS})) GROUP BY blocker",
}
