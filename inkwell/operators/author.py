"""Findings for authors and re-audits: which are shown, in what groups and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .protocol import DECISIONS, PRIORITIES, case


def report_decision(value: Column) -> Column:
    """A decision by its name; anything else is deferred."""
    return case(F.lower(F.trim(F.coalesce(value, F.lit("")))), DECISIONS, F.lit("deferred"))


def effective_priority(final: Column, first: Column) -> Column:
    text = strip(F.when(F.coalesce(final != "", F.lit(False)), final).otherwise(F.coalesce(first, F.lit(""))))
    return F.when(text.isin(*PRIORITIES), text).otherwise("P3")


def confidence(value: Column) -> Column:
    """The first whole number in a text, held between 0 and 100; 0 without one."""
    n = F.regexp_extract(F.coalesce(value.cast("string"), F.lit("")), r"-?\d{1,9}", 0)
    return F.least(F.greatest(F.when(n != "", n.cast("int")).otherwise(0), F.lit(0)), F.lit(100)).cast("long")


def _judged(findings: DataFrame) -> DataFrame:
    known = F.when(F.coalesce(F.col("decision") != "", F.lit(False)), F.col("decision")).otherwise(F.col("status"))
    return findings.withColumn("group_decision", report_decision(known)).withColumn("group_priority", effective_priority(F.col("final_priority"), F.col("priority"))).withColumn("confidence", confidence(F.col("confidence_percent")))


def author_findings(findings: DataFrame, work: str, key: str) -> DataFrame:
    """The findings an author sees, with place (from 1) in their priority's group: not retracted or deferred, P0 and P1 only if confirmed, with a claim.
    Order: confidence, then claim, then key; a priority of one work is one group of the window, which Spark sorts with spilling."""
    shown = _judged(findings).where("group_decision not in ('retracted', 'deferred') and (group_priority not in ('P0', 'P1') or group_decision = 'confirmed') and trim(coalesce(claim, '')) != ''")
    order = Window.partitionBy(work, "group_priority").orderBy(F.desc("confidence"), "claim", key)
    return shown.withColumn("place", F.row_number().over(order).cast("long")).select(work, key, "group_priority", "group_decision", "confidence", "place")


def reaudit_groups(findings: DataFrame, work: str, key: str) -> DataFrame:
    """All findings with their place in their decision's group, by priority and confidence."""
    order = Window.partitionBy(work, "group_decision").orderBy("group_priority", F.desc("confidence"), key)
    return _judged(findings).withColumn("place", F.row_number().over(order).cast("long")).select(work, key, "group_decision", "group_priority", "confidence", "place")


def finding_rollup(findings: DataFrame, work: str) -> DataFrame:
    """Counts per work, priority and decision."""
    return _judged(findings).groupBy(work, F.col("group_priority").alias("priority"), F.col("group_decision").alias("decision")).agg(F.count(F.lit(1)).alias("n"))
