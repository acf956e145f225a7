"""Catalogue of works and runs, and rollups for delivery: stages, titles, modes, holds, glossary, seals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import INLINE, SPACE, slug, strip

# Stages, modes and words that classify.
STAGES = ("01_intake", "02_global_audit", "03_adversarial_audit", "04_episode_deep_dive", "05_editorial_pass", "06_consistency_correction_loop", "07_human_facing_report", "08_final_manuscript", "09_export")
RUN_KINDS = {
    "audit": "global-audit", "검수": "global-audit", "correction": "correction-pass", "교정": "correction-pass", "editor": "editorial-pass", "editorial": "editorial-pass", "편집": "editorial-pass",
    "편집자": "editorial-pass", "full": "full-qc-correction", "전체": "full-qc-correction", "proofread": "proofread-pass", "표면교정": "proofread-pass",
}
BLOCKING = r"blocking|blocker|p0|p1|출고 차단|차단|필수 수정"
STYLE = r"style|tone|문체|톤|대사 리듬|리듬"
# End of the fixed values.


def run_kind(mode: Column) -> Column:
    from .protocol import case

    name = slug(F.coalesce(mode, F.lit("")))
    return case(name, RUN_KINDS, F.when(name == "", F.lit("global-audit")).otherwise(name))


def list_runs(runs: DataFrame) -> DataFrame:
    """runs (stages: array of stage and status, in order) with pending_stage_count and next_stage (empty if all are done)."""
    pending = F.filter("stages", lambda s: F.lower(F.coalesce(s.status, F.lit(""))) != "done")
    out = runs.withColumn("pending_", pending)
    return out.withColumn("pending_stage_count", F.size("pending_").cast("long")).withColumn("next_stage", F.coalesce(F.get("pending_", F.lit(0)).stage, F.lit(""))).drop("pending_")


def mark_stage(runs: DataFrame, stage: str, status: str, allow_new: bool = False) -> DataFrame:
    """runs with the stage's status set; an unknown stage is appended where allowed, else `rejected` is true and nothing changes."""
    known = F.exists("stages", lambda s: s.stage == stage)
    new = F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"))
    changed = F.when(known, F.transform("stages", lambda s: F.when(s.stage == stage, new).otherwise(s))).otherwise(F.concat("stages", F.array(new)) if allow_new else F.col("stages"))
    return runs.withColumn("rejected", F.lit(False) if allow_new else ~known).withColumn("stages", changed)


def portfolio(works: DataFrame, runs: DataFrame, work: str, run: str) -> DataFrame:
    """Per work that is not archived: runs, latest_run, pending stages of that run, state (no_runs, pending, done). Runs are reduced before the join."""
    latest = list_runs(runs).groupBy(work).agg(F.count(F.lit(1)).alias("runs"), F.max_by(F.struct(run, "pending_stage_count", "next_stage"), run).alias("last"))
    out = works.where("status != 'archived'").join(latest, work, "left")
    state = F.when(F.col("last").isNull(), "no_runs").when(F.col("last.pending_stage_count") > 0, "pending").otherwise("done")
    return out.select(*works.columns, F.coalesce("runs", F.lit(0)).alias("runs"), F.col(f"last.{run}").alias("latest_run"), F.coalesce("last.pending_stage_count", F.lit(0)).alias("pending"), F.col("last.next_stage").alias("next_stage"), state.alias("state"))


def unique_names(rows: DataFrame, name: str, order: str, to: str = "unique_name") -> DataFrame:
    """Names made unique by a suffix: the second of a name is name-2, the third name-3. (order decides; rows of one name meet in one task.)"""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return rows.withColumn("n_", n).withColumn(to, F.when(F.col("n_") > 1, F.concat(name, F.lit("-"), F.col("n_").cast("string"))).otherwise(F.col(name))).drop("n_")


def clean_title(value: Column) -> Column:
    """A title without marks, labels, brackets and words that tell of a draft."""
    squeeze = lambda x: strip(F.regexp_replace(x, f"[{SPACE}]+", " "))
    out = F.regexp_replace(strip(F.coalesce(value, F.lit(""))), rf"^#{{1,6}}[{INLINE}]*", "")
    out = F.regexp_replace(out, rf"(?i)^(?:제목|작품명|타이틀|title)[{INLINE}]*[:：][{INLINE}]*", "")
    out = F.regexp_replace(F.regexp_replace(out, rf"^ⓚ\d{{3}}[{INLINE}]*", ""), r"\[[^\]]*\]|\([^)]*\)", "")
    out = squeeze(F.translate(out, "_-", "  "))
    out = strip(F.regexp_replace(out, r"(?iU)\b(final|draft|source|manuscript)\b", ""))
    return squeeze(F.regexp_replace(out, r"최종|수정\s*완|수정본|원고|합본|초기\s*원고", ""))


def infer_title(stem: Column, rows: Column, generic: tuple[str, ...] = ()) -> Column:
    """A work's title: its file's cleaned stem unless generic, else the first of 80 lines (array) that can be one, else the stem or untitled-work."""
    cleaned = clean_title(stem)
    dull = F.lower(cleaned).isin("", *generic) | (cleaned.rlike(r"^\d{1,4}$") & F.lower(stem).rlike("합본|원고|draft|source|manuscript"))
    heading = r"(?i)^(?:제\s*)?\d{1,4}\s*(?:화|회|장|편|챕터|chapter|ep(?:isode)?)(?:[\s.:：_\-].*)?$"
    fits = F.filter(F.transform(F.slice(rows, 1, 80), clean_title), lambda x: (F.length(x).between(2, 60)) & ~x.rlike(r"^ⓚ?\d{1,4}$") & ~x.rlike(heading) & ~x.rlike("[.다요죠]$"))
    return F.when(~dull, cleaned).otherwise(F.coalesce(F.get(fits, F.lit(0)), F.when(cleaned != "", cleaned), F.lit("untitled-work")))


def hold_bucket(item: Column) -> Column:
    text = F.lower(item)
    return F.when(text.rlike(BLOCKING), "blocking").when(text.rlike(STYLE), "style").otherwise("policy")


def hold_summary(items: DataFrame, work: str, item: str, order: str, most: int = 5) -> DataFrame:
    """(work, bucket, n, examples): holds by bucket, blank ones left out, with the first few of each (240 characters)."""
    rows = items.where(F.trim(item) != "").withColumn("bucket", hold_bucket(F.col(item)))
    ranked = rows.withColumn("i", F.row_number().over(Window.partitionBy(work, "bucket").orderBy(order))).where(F.col("i") <= most)
    examples = ranked.groupBy(work, "bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.left(F.col(item), F.lit(240)).alias("x")))), lambda x: x.x).alias("examples"))
    return rows.groupBy(work, "bucket").agg(F.count(F.lit(1)).alias("n")).join(examples, [work, "bucket"])


def hold_counts(classified: Column, explicit: Column, legacy: Column | None = None, items: Column | None = None) -> Column:
    """The count that a manifest states, else what was classified; for blocking holds without any item the legacy count."""
    return F.coalesce(explicit, F.when(items > 0, classified).otherwise(legacy) if legacy is not None else classified)


def glossary_rollup(entries: DataFrame, work: str) -> DataFrame:
    """Per work: entries, forbidden aliases and what is left of them in the text (residual_forbidden_alias_counts: map)."""
    left = F.aggregate(F.map_values("residual_forbidden_alias_counts"), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return entries.groupBy(work).agg(F.count(F.lit(1)).alias("entry_count"), F.sum(F.coalesce(F.size("forbidden_aliases"), F.lit(0)).cast("long")).alias("forbidden_alias_count"), F.sum(F.coalesce(left, F.lit(0))).alias("residual_forbidden_total"))


def last_counts(rows: DataFrame, term: str, count: str, order: str) -> DataFrame:
    """(term, count): the last row of each term wins."""
    return rows.groupBy(term).agg(F.max_by(count, order).alias(count))


def reseal_status(current: DataFrame, previous: DataFrame, work: str) -> DataFrame:
    """Per delivered work (sha256): the previous seal (sha256) and whether it is stale; a missing or empty one is not."""
    before = previous.select(work, F.col("sha256").alias("previous_sha256"))
    out = current.join(before, work, "left")
    return out.withColumn("stale", F.coalesce((F.col("previous_sha256") != "") & (F.col("previous_sha256") != F.col("sha256")), F.lit(False)))
