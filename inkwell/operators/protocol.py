"""The review protocol as data: axes, risks, passes, lanes, gate profiles; and the queue of review tasks that a profile asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that manifests and submissions use.
AXES = (
    "verisimilitude_continuity", "timeline_continuity", "numeric_carryover", "title_role_drift", "era_validation", "replay_vs_escalation", "front_back_bridge", "character_consistency",
    "state_regression", "submission_hygiene", "reader_facing_polish", "non_reader_facing_notes",
)
RISKS = ("source-risk-ai-slop", "source-risk-glossary-missing", "source-risk-consistency-duplication", "source-risk-internal-memos", "source-risk-episode-numbering")
PASSES = ("pass1", "pass2", "pass3")
REVIEWERS = ("blind_agent_1", "blind_agent_2", "blind_agent_3")
SURFACE_AXES = ("submission_hygiene", "reader_facing_polish")
EDITORIAL_AXES = ("replay_vs_escalation", "front_back_bridge", "character_consistency", "submission_hygiene", "reader_facing_polish", "non_reader_facing_notes")
#: Profile: (level, axes, primary passes, blind reviews, total report, adversarial passes, repetition, delivery report).
PROFILES = {
    "proofread": (1, SURFACE_AXES, False, False, False, False, False, False),
    "correction": (2, (*SURFACE_AXES, "non_reader_facing_notes"), False, False, False, False, False, False),
    "editorial": (3, EDITORIAL_AXES, True, False, False, False, False, False),
    "consistency": (4, AXES, True, True, True, True, True, False),
    "delivery": (5, AXES, True, True, True, True, True, True),
}
ALIASES = {
    "audit": "consistency", "global-audit": "consistency", "검수": "consistency", "consistency": "consistency", "정합성": "consistency",
    "full": "delivery", "full-qc-correction": "delivery", "delivery": "delivery", "전체": "delivery", "납품": "delivery",
    "correction": "correction", "correction-pass": "correction", "교정": "correction",
    "editor": "editorial", "editorial": "editorial", "editorial-pass": "editorial", "편집": "editorial", "편집자": "editorial",
    "proofread": "proofread", "proofread-pass": "proofread", "표면교정": "proofread",
}
REPAIRABILITY = ("local_fixable", "structural_fixable", "needs_author_decision", "irreconcilable_premise", "webnovel_allowance")
DISPOSITIONS = ("editable_conflict", "accepted_world_premise", "genre_hyperbole_allowance", "hard_carryover_conflict", "external_fact_soft", "needs_author_decision")
DECISIONS = {"확정": "confirmed", "confirmed": "confirmed", "강등": "downgraded", "downgraded": "downgraded", "철회": "retracted", "기각": "retracted", "retracted": "retracted", "rejected": "retracted", "유보": "deferred", "deferred": "deferred"}
PRIORITIES = ("P0", "P1", "P2", "P3")
CARRYOVER_CATEGORY = ("numeric", "money", "percent", "date", "time", "timeline", "state", "role", "amount", "수치", "숫자", "금액", "퍼센트", "지분", "날짜", "시간", "상태", "직함")
EXTERNAL_CATEGORY = ("era", "external", "calendar", "weekday", "bank", "holiday", "고증", "외부", "달력", "영업일")
STAGES_OF_QUEUE = ("source_preflight", "profile_axis_review", "primary_consistency_review", "blind_consistency_review", "synthesis", "adversarial_audit")
# End of the fixed values.

NEEDS = ("primary", "blind", "total", "adversarial", "repetition", "delivery")


def case(value: Column, table: dict, other: Column | None = None) -> Column:
    """The table's entry for a value, as one CASE."""
    out = None
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)) if out is None else out.when(value == k, F.lit(v))
    return out if other is None else out.otherwise(other)


def gate_profile(value: Column) -> Column:
    """A profile from its name or an alias of it; delivery for anything else."""
    key = F.replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), F.lit("_"), F.lit("-"))
    return case(key, ALIASES, F.lit("delivery"))


def needs(profile: Column, what: str) -> Column:
    at = 2 + NEEDS.index(what)
    return profile.isin(*[p for p, d in PROFILES.items() if d[at]])


def required_axes(profile: Column) -> Column:
    out = None
    for p, d in PROFILES.items():
        axes = F.array(*[F.lit(a) for a in d[1]])
        out = F.when(profile == p, axes) if out is None else out.when(profile == p, axes)
    return out


def normalize_decision(value: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return case(text, DECISIONS, text)


def normalize_priority(value: Column) -> Column:
    text = F.upper(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(text.isin(*PRIORITIES), text).otherwise(F.lit("P3"))


def review_queue(works: DataFrame, profile: str) -> DataFrame:
    """Columns of works (profile normalised) and a row per review task: task_id, phase, lane, pass, axis, required, status. The tasks are literals: no join."""
    p = F.col(profile)
    rows = works.withColumn(profile, gate_profile(p))

    def task(task_id: str, phase: int, lane: str, name: str, axis: str, required: Column) -> Column:
        return F.struct(
            F.lit(task_id).alias("task_id"), F.lit(STAGES_OF_QUEUE[phase]).alias("phase"), F.lit(lane).alias("lane"), F.lit(name).alias("pass"), F.lit(axis).alias("axis"),
            required.alias("required"), F.when(required, "pending").otherwise("skipped").alias("status"),
        )

    yes, axes = F.lit(True), F.col("axes_")
    rows = rows.withColumn("axes_", required_axes(p))
    tasks = [task(f"source-preflight-{r}", 0, "source", "preflight", r, yes) for r in RISKS]
    tasks += [F.when(~needs(p, "primary") & F.array_contains(axes, a), task(f"profile-axis-{a}", 1, "profile", "single", a, yes)) for a in AXES]
    tasks += [task(f"{n}-{a}", 2, "primary", n, a, needs(p, "primary") & F.array_contains(axes, a)) for n in PASSES for a in AXES]
    tasks += [task(f"{r}-{n}-blind-consistency", 3, r, n, "all_axes", needs(p, "blind")) for r in REVIEWERS for n in PASSES]
    tasks += [task("total-consistency-report", 4, "total", "synthesis", "all_axes", needs(p, "total"))]
    tasks += [task(f"adversarial-{n}", 5, "adversarial", n, "all_axes", needs(p, "adversarial")) for n in PASSES]
    return rows.select(*works.columns, F.inline(F.array_compact(F.array(*tasks))))
