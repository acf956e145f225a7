"""The submission gate over its evidence: what each check counts per work, what blocks, and the refreshes of a stored gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import contracts, headings, metrics, narrative, reports, review, rules, typos
from .protocol import gate_profile, needs

#: Counts of evidence per work, in the order of the result.
EVIDENCE = ("stage_cues", "format_flags", "hygiene_flags", "short_chapters", "narrative_allowances", "contextual_typos", "era_candidates")
# Blockers that a refresh owns.
REPORT_BLOCKERS = ("human_report_missing", "human_report_not_claim_evidence_ready")
SUBMISSION_BLOCKERS = (
    "manual_review_not_complete", "manual_review_submission_invalid_json", "manual_review_axes_not_complete", "primary_consistency_passes_not_complete", "blind_reviews_not_complete",
    "total_consistency_report_not_complete", "adversarial_3pass_not_complete", "consistency_repetitions_not_complete",
)
# End of the fixed values.


def evidence(works: DataFrame, work: str, text: str = "text") -> DataFrame:
    """(work, one column per count of EVIDENCE), also for works without any. Each check is a projection; its rows are counted before one shuffle by work."""
    docs = works.select(F.col(work).alias("work_id"), F.col(text).alias("text"))
    chapters = headings.chapters(docs)
    parts = chapters.select(F.struct("work_id", "chapter_no").alias("chapter"), "text")
    brackets = narrative.bracket_lines(parts).select(F.col("chapter.work_id").alias("work_id"), "blocks")
    tall = [
        brackets.where("blocks").select("work_id", F.lit("stage_cues").alias("kind")),
        headings.format_flags(docs).select("work_id", F.lit("format_flags").alias("kind")),
        review.flags(chapters.select("work_id", "text"), rules.HYGIENE).select("work_id", F.lit("hygiene_flags").alias("kind")),
        brackets.where("blocks").select("work_id", F.lit("hygiene_flags").alias("kind")),
        metrics.chapter_metrics(chapters.select("work_id", "text")).where("below_minimum").select("work_id", F.lit("short_chapters").alias("kind")),
        brackets.where("not blocks").select("work_id", F.lit("narrative_allowances").alias("kind")),
        typos.contextual_typos(chapters.select("work_id", "text")).select("work_id", F.lit("contextual_typos").alias("kind")),
        review.facts(chapters.select("work_id", "text"), {"era": rules.FACTS["era_or_modern_tone_candidate"]}).select("work_id", F.lit("era_candidates").alias("kind")),
        docs.select("work_id", F.lit("").alias("kind")),
    ]
    found = reduce(DataFrame.unionByName, tall).groupBy("work_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in EVIDENCE])
    return found.withColumnRenamed("work_id", work)


def submission_gate(counts: DataFrame, submissions: DataFrame, checked: DataFrame, work: str, profile: str = "gate_profile") -> DataFrame:
    """counts (work, profile, EVIDENCE) with blockers, in the gate's order, and ready.

    submissions: (work, ready, blockers) as ``contracts.validate_submissions`` gives them; a work without one is not complete. checked: (work, ready) as
    ``reports.validate_reports`` gives them; only the delivery profile asks for a report, and then for a completed review behind it.
    """
    s = submissions.select(work, F.col("ready").alias("s_ready"), F.col("blockers").alias("s_blockers"))
    r = checked.select(work, F.col("ready").alias("r_ready"))
    rows = counts.join(s, work, "left").join(r, work, "left").withColumn("p_", gate_profile(F.col(profile)))
    manual, delivery = F.coalesce("s_ready", F.lit(False)), needs(F.col("p_"), "delivery")
    first = F.array_compact(
        F.array(*[F.when(F.col(c) > 0, F.lit(b)) for c, b in (("stage_cues", "stage_cues_present"), ("format_flags", "manuscript_format_policy_violations"), ("hygiene_flags", "hygiene_flags_present"), ("short_chapters", "chapter_under_minimum_chars"))])
    )
    last = F.array_compact(
        F.array(
            F.when(~manual, F.lit("manual_review_not_complete")),
            F.when(delivery & F.col("r_ready").isNotNull() & ~(F.col("r_ready") & manual), F.lit("human_report_not_claim_evidence_ready")),
            F.when(delivery & F.col("r_ready").isNull(), F.lit("human_report_missing")),
        )
    )
    blockers = F.concat(first, F.coalesce("s_blockers", F.array().cast("array<string>")), last)
    out = rows.withColumn("blockers", blockers).withColumn("ready", F.size("blockers") == 0)
    return out.withColumn(profile, F.col("p_")).drop("s_ready", "s_blockers", "r_ready", "p_")


def refresh(blockers: Column, owned: tuple[str, ...], now: Column) -> Column:
    """A stored gate's blockers after one of its checks ran again: the owned ones go, the new ones come, sorted and once each."""
    return F.array_sort(F.array_distinct(F.concat(F.filter(blockers, lambda b: ~b.isin(*owned)), now)))


def gate_of(works: DataFrame, submissions: DataFrame, texts: DataFrame, work: str, profile: str = "gate_profile") -> DataFrame:
    """The whole gate: works (work, profile, text), submission documents (work, ``contracts.SUBMISSION``), reports (work, text)."""
    counts = works.select(work, profile).join(evidence(works, work), work)
    return submission_gate(counts, contracts.validate_submissions(submissions, [work]), reports.validate_reports(texts.select(work, "text")), work, profile)
