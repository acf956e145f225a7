"""What facts say: policy per kind, timeline per chapter, titles per character."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE, lines_of
from . import rules
from .review import facts

_AXIS = {"money": "numeric_carryover", "percent": "numeric_carryover", "title_or_role": "title_role_drift", "kin_title": "title_role_drift"}


def enrich(found: DataFrame) -> DataFrame:
    """facts with axis, strictness, disposition_hint and manual_reading_required; null for kinds without a policy."""
    kind = F.col("kind")
    hard, soft = kind.isin(*rules.HARD_CARRYOVER_KINDS), kind == "era_or_modern_tone_candidate"
    axis = F.when(soft, F.lit("era_validation"))
    for k, v in _AXIS.items():
        axis = axis.when(kind == k, F.lit(v))
    return (
        found.withColumn("axis", axis.when(hard, F.lit("timeline_continuity")))
        .withColumn("strictness", F.when(hard, "hard_carryover").when(soft, "soft_external_fact"))
        .withColumn("disposition_hint", F.when(hard, "hard_carryover_conflict").when(soft, "external_fact_soft"))
        .withColumn("manual_reading_required", F.when(hard | soft, F.lit(True)))
    )


def timeline(chapters: DataFrame, text: str = "text", high: int = 4, most: int = 5) -> DataFrame:
    """A row per chapter, also without any: dates, times, relative_times, samples (at most five, dates first), high_signal. One projection, no shuffle."""
    rest = [c for c in chapters.columns if c != text]
    rows = chapters.withColumn("rows_", lines_of(F.col(text)))
    values = lambda kind: F.flatten(F.transform("rows_", lambda x: F.regexp_extract_all(x, F.lit(f"(?U)({rules.FACTS[kind]})"), F.lit(1))))
    for name, kind in (("d_", "date"), ("t_", "time"), ("r_", "relative_time")):
        rows = rows.withColumn(name, values(kind))
    n = F.size("d_") + F.size("t_") + F.size("r_")
    return rows.select(
        *rest, *[F.size(c).cast("long").alias(name) for c, name in (("d_", "dates"), ("t_", "times"), ("r_", "relative_times"))],
        F.slice(F.concat("d_", "t_", "r_"), 1, most).alias("samples"), (n >= high).alias("high_signal"),
    )


def split_name_role(value: Column) -> tuple[Column, Column]:
    """(name, role): the longest known suffix is the role; the name is not empty. Without one the role is empty."""
    bare = F.regexp_replace(value, f"[{SPACE}]+", "")
    pattern = f"^(.+?)({'|'.join((*rules.ROLE_SUFFIXES, *rules.KIN_SUFFIXES))})$"
    role = F.regexp_extract(bare, pattern, 2)
    return F.when(role != "", F.regexp_extract(bare, pattern, 1)).otherwise(value), role


def title_matrix(chapters: DataFrame, work: str, order: str, text: str = "text", most: int = 8) -> DataFrame:
    """(work, name, roles, mentions, drift, samples): how often each role goes with a name; drift where there are two or more; the first samples, titles before kin.

    Roles are counted with partial aggregates; of a name's rows only the first `most` are ever brought together.
    """
    pack = {k: rules.FACTS[k] for k in ("title_or_role", "kin_title")}
    found = facts(chapters.select(work, order, text), pack)
    name, role = split_name_role(F.trim("value"))
    rows = found.select(work, order, "line_no", "kind", name.alias("name"), role.alias("role")).where("role != ''")
    counts = rows.groupBy(work, "name", "role").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy(work, "name").agg(F.array_sort(F.collect_list(F.struct("role", "n"))).alias("roles"), F.sum("n").alias("mentions"))  # as many as there are roles
    first = Window.partitionBy(work, "name").orderBy(F.col("kind") == "kin_title", order, "line_no", "role")
    samples = rows.withColumn("i", F.row_number().over(first)).where(F.col("i") <= most)
    samples = samples.groupBy(work, "name").agg(F.array_sort(F.collect_list(F.struct("i", "role", F.col(order).alias("chapter"), "line_no"))).alias("samples"))
    return counts.join(samples, [work, "name"]).withColumn("drift", F.size("roles") >= 2)
