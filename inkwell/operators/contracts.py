"""Contracts of reviews: findings, passes, blind lanes, reports, repetition; a submission's issues, readiness and blockers.

A submission is one row with nested columns (``SUBMISSION``), as its JSON document is; it is validated within the row, so any number of them needs no shuffle.
Issues are (field, message).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from . import protocol as P
from .rules import HARD_CARRYOVER_KINDS

_PASS = "struct<status:string,notes:array<string>,completed_task_ids:array<string>>"
FINDING_FIELDS = (
    "priority", "status", "decision", "original_priority", "final_priority", "repairability", "disposition", "strictness", "kind", "fact_kind", "category", "claim", "rationale", "evidence",
    "evidence_snippet", "counter_evidence", "story_state_before", "story_state_after", "story_internal_impact", "fix_hint", "reader_risk", "confidence_percent",
)
_FINDING = "struct<" + ",".join(f"{c}:string" for c in FINDING_FIELDS) + ">"
#: Schema of a submission document; confidence and unit counts are read as text, so that what is no integer can be told.
SUBMISSION = (
    f"status string, gate_profile string, final_summary string, checked_axes array<struct<axis:string,status:string,notes:string>>, passes map<string,{_PASS}>, adversarial_passes map<string,{_PASS}>, "
    f"blind_reviews map<string,struct<status:string,passes:map<string,{_PASS}>>>, total_consistency_report struct<status:string,path:string,notes:array<string>>, "
    f"consistency_repetition_contract struct<requested_unit_count:string,completed_unit_count:string,units:array<struct<unit_id:string,status:string,total_report_path:string,notes:array<string>>>>, "
    f"findings array<{_FINDING}>"
)
Check = tuple[Column, str, str]


def _has(x: Column) -> Column:
    return F.coalesce(strip(x) != "", F.lit(False))


def _truthy(x: Column) -> Column:
    return F.coalesce(x != "", F.lit(False))


def _some_note(notes: Column) -> Column:
    return F.coalesce(F.exists(notes, _has), F.lit(False))


def _integer(x: Column, least: int, most: int | None = None) -> Column:
    """A text that is a whole number in these bounds."""
    n = F.when(x.rlike(r"^-?[0-9]{1,9}$"), x.cast("int"))
    return F.coalesce((n >= least) & ((n <= most) if most is not None else F.lit(True)), F.lit(False))


def taxonomy_checks(f: Callable[[str], Column]) -> list[Check]:
    repair, disposition, final = strip(F.coalesce(f("repairability"), F.lit(""))), strip(F.coalesce(f("disposition"), F.lit(""))), _priority(f, "final_priority")
    top = final.isin("P0", "P1")
    return [
        ((repair != "") & ~repair.isin(*P.REPAIRABILITY), "repairability", "unknown value"),
        ((disposition != "") & ~disposition.isin(*P.DISPOSITIONS), "disposition", "unknown value"),
        (top & repair.isin("irreconcilable_premise", "webnovel_allowance"), "repairability", "premise or allowance stays P0/P1"),
        (top & disposition.isin("accepted_world_premise", "genre_hyperbole_allowance", "external_fact_soft"), "disposition", "premise, allowance or soft fact stays P0/P1"),
    ]


def _priority(f: Callable[[str], Column], first: str) -> Column:
    return P.normalize_priority(F.when(_truthy(f(first)), f(first)).otherwise(f("priority")))


def _decision(f: Callable[[str], Column]) -> Column:
    return P.normalize_decision(F.when(_truthy(f("decision")), f("decision")).otherwise(f("status")))


def confidence_checks(f: Callable[[str], Column]) -> list[Check]:
    decision, confidence = _decision(f), f("confidence_percent")
    number = F.when(confidence.rlike(r"^-?[0-9]{1,9}$"), confidence.cast("int"))
    evidence, counter = _has(f("evidence")) | _has(f("evidence_snippet")), _has(f("counter_evidence"))
    audited = F.greatest(*[f(c).isNotNull() for c in ("decision", "confidence_percent", "evidence_snippet", "counter_evidence", "original_priority", "final_priority")])
    confirmed, downgraded = audited & (decision == "confirmed"), audited & (decision == "downgraded")
    return [
        (confidence.isNotNull() & ~_integer(confidence, 0, 100), "confidence_percent", "not an integer from 0 to 100"),
        (confirmed & confidence.isNull(), "confidence_percent", "confirmed without confidence"),
        (confirmed & F.coalesce(number < 95, F.lit(False)), "confidence_percent", "confirmed below 95"),
        (confirmed & ~evidence, "evidence", "confirmed without evidence"),
        (downgraded & ~_truthy(f("original_priority")), "original_priority", "downgrade without trace"),
        (downgraded & ~_truthy(f("final_priority")), "final_priority", "downgrade without trace"),
        (downgraded & ~counter, "counter_evidence", "downgrade without counter evidence"),
        (audited & (decision == "retracted") & ~counter, "counter_evidence", "retraction without counter evidence"),
    ]


def _hard_carryover(f: Callable[[str], Column], category: Column) -> Column:
    value = lambda c: strip(F.coalesce(f(c), F.lit("")))
    kind = strip(F.when(_truthy(f("kind")), f("kind")).otherwise(F.coalesce(f("fact_kind"), F.lit(""))))
    return (value("strictness") == "hard_carryover") | (value("disposition") == "hard_carryover_conflict") | kind.isin(*HARD_CARRYOVER_KINDS) | category.rlike("|".join(P.CARRYOVER_CATEGORY))


def complete_checks(f: Callable[[str], Column]) -> list[Check]:
    decision, first, final = _decision(f), _priority(f, "original_priority"), _priority(f, "final_priority")
    category = F.lower(strip(F.coalesce(f("category"), F.lit(""))))
    evidence, counter = _has(f("evidence")) | _has(f("evidence_snippet")), _has(f("counter_evidence"))
    impact = _has(f("story_internal_impact")) | _has(f("story_state_before")) | _has(f("story_state_after"))
    top, hard = final.isin("P0", "P1"), _hard_carryover(f, category)
    out = [(~_truthy(f(c)), c, "final triage field missing") for c in ("decision", "confidence_percent", "final_priority", "fix_hint", "reader_risk")]
    return out + [
        (top & (decision != "confirmed"), "decision", "P0/P1 not confirmed"),
        (top & ~_integer(f("confidence_percent"), 95), "confidence_percent", "P0/P1 below 95"),
        (top & ~evidence, "evidence", "P0/P1 without evidence"),
        (top & counter, "counter_evidence", "P0/P1 with counter evidence"),
        (top & ~impact, "story_internal_impact", "P0/P1 without story impact"),
        (top & category.rlike("|".join(P.EXTERNAL_CATEGORY)) & ~_has(f("story_internal_impact")), "story_internal_impact", "external fact without story impact"),
        (top & hard & ~_has(f("story_state_before")), "story_state_before", "hard carryover without prior state"),
        (top & hard & ~_has(f("story_state_after")), "story_state_after", "hard carryover without later state"),
        (counter & top, "final_priority", "counter evidence at P0/P1"),
        (decision.isin("downgraded", "retracted", "deferred") & top, "final_priority", "not confirmed at P0/P1"),
        ((decision == "downgraded") & (final <= first), "final_priority", "downgrade does not lower severity"),
    ]


def required_checks(f: Callable[[str], Column]) -> list[Check]:
    return [(~_truthy(f(c)), c, "required") for c in ("priority", "status", "category", "claim", "rationale")]


def _issues(checks: list[Check], prefix: Column | None = None) -> Column:
    name = lambda field: F.concat(prefix, F.lit(field)) if prefix is not None else F.lit(field)
    return F.array_compact(F.array(*[F.when(c, F.struct(name(field).alias("field"), F.lit(message).alias("message"))) for c, field, message in checks]))


def finding_issues(findings: DataFrame, keys: list[str], complete: bool = True) -> DataFrame:
    """keys, field, message: what is wrong with each finding (columns of ``FINDING_FIELDS``, text; missing ones are null). complete: also the contracts of a completed review."""
    held = findings.columns
    f = lambda c: F.col(c).cast("string") if c in held else F.lit(None).cast("string")
    checks = required_checks(f) + taxonomy_checks(f) + (complete_checks(f) + confidence_checks(f) if complete else [])
    return findings.select(*keys, F.inline(_issues(checks)))


# -- submissions ---------------------------------------------------------------------------------------------------------------


def _pass_issues(passes: Column, prefix: str, present: Column, complete: Column) -> Column:
    out = [F.when(present & passes.isNull(), F.array(F.struct(F.lit(prefix).alias("field"), F.lit("must be an object").alias("message"))))]
    for name in P.PASSES:
        at, p = F.lit(f"{prefix}.{name}"), F.try_element_at(passes, F.lit(name))
        done = F.coalesce(p.status == "completed", F.lit(False))
        there = passes.isNotNull() & p.isNotNull()
        checks = [
            (passes.isNotNull() & p.isNull() & present, "", "missing pass object"),
            (there & done & ~_some_note(p.notes), ".notes", "completed pass without notes"),
            (there & done & ~F.coalesce(F.size(p.completed_task_ids) > 0, F.lit(False)), ".completed_task_ids", "completed pass without task ids"),
            (there & ~done & complete, ".status", "not completed"),
        ]
        out.append(_issues(checks, at))
    return F.flatten(F.array_compact(F.array(*out)))


def _completed(passes: Column) -> Column:
    return sum((F.coalesce(F.try_element_at(passes, F.lit(n)).status == "completed", F.lit(False)).cast("int") for n in P.PASSES), F.lit(0))


def validate_submissions(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Per submission (columns of ``SUBMISSION``): profile, status, axes reviewed and required, passes completed and required, findings, issues, ready, blockers."""
    rows = docs.withColumn("profile", P.gate_profile(F.col("gate_profile"))).withColumn("complete", F.coalesce(F.col("status") == "complete", F.lit(False)))
    for n in P.NEEDS:
        rows = rows.withColumn(f"need_{n}", P.needs(F.col("profile"), n))
    rows = rows.withColumn("axes_", P.required_axes(F.col("profile")))
    need = lambda n: F.col(f"need_{n}")
    done = lambda n: F.col("complete") & need(n)
    axes, complete = F.coalesce("checked_axes", F.array().cast("array<struct<axis:string,status:string,notes:string>>")), F.col("complete")
    checked = F.filter(axes, lambda x: x.status == "checked")
    known = F.array(*[F.lit(a) for a in P.AXES])

    def axis_issues(x: Column, i: Column) -> Column:
        at = F.concat(F.lit("checked_axes["), (i + 1).cast("string"), F.lit("]"))
        unnoted = ~_has(x.notes)
        return _issues([((x.status == "checked") & unnoted, ".notes", "checked axis without notes"), ((x.status == "skipped") & unnoted, ".notes", "skipped axis without reason"), (~F.array_contains(known, F.coalesce(x.axis, F.lit(""))), ".axis", "unknown axis")], at)

    one = lambda cond, field, message: F.when(cond, F.array(F.struct(F.lit(field).alias("field"), F.lit(message).alias("message"))))
    missing = F.transform(F.filter(F.array_sort(known), lambda a: ~F.array_contains(F.transform(axes, lambda x: F.coalesce(x.axis, F.lit(""))), a)), lambda a: F.struct(F.lit("checked_axes").alias("field"), F.concat(F.lit("missing axis: "), a).alias("message")))
    blind, blind_done = F.col("blind_reviews"), done("blind")
    lanes = [one(blind_done & blind.isNull(), "blind_reviews", "must be an object")]
    for r in P.REVIEWERS:
        lane = F.try_element_at(blind, F.lit(r))
        there = blind.isNotNull() & lane.isNotNull()
        lanes += [
            one(blind_done & blind.isNotNull() & lane.isNull(), f"blind_reviews.{r}", "missing blind reviewer object"),
            one(blind_done & there & ~F.coalesce(lane.status == "completed", F.lit(False)), f"blind_reviews.{r}.status", "not completed"),
            F.when(there, _pass_issues(lane.passes, f"blind_reviews.{r}.passes", blind_done, blind_done)),
        ]
    report = F.col("total_consistency_report")
    reported = F.coalesce(report.status == "completed", F.lit(False))
    report_ready = report.isNotNull() & reported & _has(report.path) & _some_note(report.notes)
    reports = [
        one(done("total") & report.isNull(), "total_consistency_report", "must be an object"),
        one(done("total") & report.isNotNull() & ~reported, "total_consistency_report.status", "not completed"),
        one(reported & ~_has(report.path), "total_consistency_report.path", "completed report without path"),
        one(reported & ~_some_note(report.notes), "total_consistency_report.notes", "completed report without notes"),
    ]
    contract, name = F.col("consistency_repetition_contract"), "consistency_repetition_contract"
    wanted, units_done = contract.requested_unit_count, contract.completed_unit_count
    bad_wanted, bad_done = wanted.isNotNull() & ~_integer(wanted, 1), units_done.isNotNull() & ~_integer(units_done, 0)
    requested = F.coalesce(F.when(_integer(wanted, 1), F.expr(f"try_cast({name}.requested_unit_count AS INT)")), F.lit(1))
    finished = F.filter(contract.units, lambda u: u.status == "completed")
    effective = F.greatest(F.coalesce(F.when(_integer(units_done, 0), F.expr(f"try_cast({name}.completed_unit_count AS INT)")), F.lit(0)), F.coalesce(F.size(finished), F.lit(0)))
    short = done("repetition") & contract.isNotNull() & (requested > 1) & (effective < requested)

    def unit_issues(u: Column, i: Column) -> Column:
        at = F.concat(F.lit(f"{name}.units["), (i + 1).cast("string"), F.lit("]"))
        ok = F.coalesce(u.status == "completed", F.lit(False))
        return _issues([(ok & ~_has(u.unit_id), ".unit_id", "completed unit without id"), (ok & ~_has(u.total_report_path), ".total_report_path", "completed unit without report"), (ok & ~_some_note(u.notes), ".notes", "completed unit without notes")], at)

    repetition = [
        one(done("repetition") & contract.isNull(), name, "must be an object"),
        one(contract.isNotNull() & bad_wanted, f"{name}.requested_unit_count", "not an integer from 1"),
        one(contract.isNotNull() & bad_done, f"{name}.completed_unit_count", "not an integer from 0"),
        F.flatten(F.transform(contract.units, unit_issues)),
        one(short, f"{name}.completed_unit_count", "fewer units than requested"),
    ]
    repetition_ready = F.when(contract.isNull(), ~done("repetition")).otherwise(~short)

    def found_issues(x: Column, i: Column) -> Column:
        f = lambda c: x.getField(c)
        at = F.concat(F.lit("findings["), (i + 1).cast("string"), F.lit("]."))
        always, final = _issues(required_checks(f) + taxonomy_checks(f), at), _issues(complete_checks(f) + confidence_checks(f), at)
        return F.when(complete, F.concat(always, final)).otherwise(always)

    reviewed = F.size(F.filter(checked, lambda x: F.array_contains(F.col("axes_"), x.axis)))
    passed = _completed(F.col("passes")) + _completed(F.col("adversarial_passes")) + sum((_completed(F.try_element_at(blind, F.lit(r)).passes) for r in P.REVIEWERS), F.lit(0))
    per = len(P.PASSES)
    required = F.when(need("primary"), per).otherwise(0) + F.when(need("blind"), per * len(P.REVIEWERS)).otherwise(0) + F.when(need("adversarial"), per).otherwise(0)
    rows = rows.withColumn("reviewed_axes", reviewed).withColumn("required_axes", F.size("axes_")).withColumn("completed_passes", passed).withColumn("required_passes", required).withColumn("report_ready", report_ready)
    parts = [
        F.when(F.col("checked_axes").isNull(), F.array(F.struct(F.lit("checked_axes").alias("field"), F.lit("must be an array").alias("message")))),
        F.flatten(F.transform(axes, axis_issues)), missing, _pass_issues(F.col("passes"), "passes", need("primary"), done("primary")), *lanes,
        _pass_issues(F.col("adversarial_passes"), "adversarial_passes", need("adversarial"), done("adversarial")), *reports, *repetition, F.flatten(F.transform("findings", found_issues)),
        one(complete & (F.col("reviewed_axes") < F.col("required_axes")), "checked_axes", "profile axes not all checked"),
        one(done("total") & ~F.col("report_ready"), "total_consistency_report", "no completed report"),
        one(complete & (F.col("completed_passes") < F.col("required_passes")), "passes", "required passes not all completed"),
    ]
    rows = rows.withColumn("open_", F.flatten(F.array_compact(F.array(*parts))))
    ready = complete & (F.col("reviewed_axes") >= F.col("required_axes")) & (F.col("completed_passes") >= F.col("required_passes")) & (F.col("report_ready") | ~need("total")) & repetition_ready & _has(F.col("final_summary")) & (F.size("open_") == 0)
    rows = rows.withColumn("ready", ready).withColumn("issues", F.concat("open_", F.coalesce(one(complete & ~_has(F.col("final_summary")), "final_summary", "complete without summary"), F.array().cast("array<struct<field:string,message:string>>"))))
    fields = F.transform("issues", lambda x: x.field)
    starts = lambda p: F.exists(fields, lambda x: x.startswith(p))
    behind = F.col("completed_passes") < F.col("required_passes")
    blockers = F.array_compact(
        F.array(
            F.when(need("adversarial") & (behind | starts("adversarial_passes.")), F.lit("adversarial_3pass_not_complete")),
            F.when(need("blind") & (behind | starts("blind_reviews.")), F.lit("blind_reviews_not_complete")),
            F.when(need("repetition") & starts(name), F.lit("consistency_repetitions_not_complete")),
            F.when((F.col("reviewed_axes") < F.col("required_axes")) | starts("checked_axes"), F.lit("manual_review_axes_not_complete")),
            F.when(need("primary") & (behind | starts("passes")), F.lit("primary_consistency_passes_not_complete")),
            F.when(need("total") & (~complete | behind | starts("total_consistency_report")), F.lit("total_consistency_report_not_complete")),
        )
    )
    out = F.struct(
        *keys, "profile", F.coalesce("status", F.lit("pending")).alias("status"), *[F.col(c).cast("long").alias(c) for c in ("reviewed_axes", "required_axes", "completed_passes", "required_passes")],
        F.coalesce(F.size("findings"), F.lit(0)).cast("long").alias("findings"), "issues", "ready", blockers.alias("blockers"),
    )
    # Of a generator's columns no filter passes below it. In a plain projection a reader's filter (explode and inline bring one of their own) is written out in full at the scan, where
    # each blocker holds all the issues again: the plan then outgrows the driver.
    return rows.select(F.inline(F.array(out)))
