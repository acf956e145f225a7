"""The whole inspection of a text in one row, and the totals of ledgers and change lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, lines_of, no_space_length, style_quotes
from .changes import ledger_issues
from .headings import format_flags, heading_markers
from .narrative import bracket_lines
from .rules import MINIMUM_CHAPTER_CHARS

_SUBTYPES = {"chapter_heading_missing_k": "headings_without_k", "chapter_heading_blank_lines": "heading_spacing", "dialogue_narration_spacing": "dialogue_spacing"}


def inspect_texts(docs: DataFrame, key: str, text: str = "text", minimum: int = MINIMUM_CHAPTER_CHARS) -> DataFrame:
    """Per text: sizes, long lines, signs, Markdown headers, chapters with their sizes (maps by episode) and those below the minimum, bracket cues, quotes, ellipses, departures from the
    format. Sizes are one projection; cues and departures are counted per text and joined on."""
    docs = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = docs.withColumn("rows_", lines_of(F.col("text"))).withColumn("kept_", F.filter("rows_", lambda x: x.rlike(f"[^{SPACE}]"))).withColumn("m_", heading_markers(F.col("text")))
    long = lambda n: F.size(F.filter("kept_", lambda x: F.length(x) >= n)).cast("long").alias(f"lines_{n}")
    count = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    names = F.transform("m_.episode", lambda e, i: F.struct(e.alias("e"), F.size(F.filter(F.slice("m_.episode", 1, i + 1), lambda x: x == e)).alias("n")))
    episode = F.transform(names, lambda x: F.when(x.n > 1, F.concat(x.e, F.lit("_"), x.n)).otherwise(x.e))
    rows = rows.withColumn("names_", episode).withColumn("chapter_chars", F.map_from_arrays("names_", F.transform("m_.body", lambda b: F.length(b).cast("long")))).withColumn("chapter_chars_no_space", F.map_from_arrays("names_", F.transform("m_.body", lambda b: no_space_length(b).cast("long"))))
    total = F.aggregate("kept_", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    sized = rows.select(
        key, F.length("text").cast("long").alias("chars"), no_space_length(F.col("text")).cast("long").alias("chars_no_space"), F.size("rows_").cast("long").alias("lines"), F.size("kept_").cast("long").alias("non_empty_lines"),
        F.when(F.size("kept_") > 0, F.round(total / F.size("kept_"), 1)).otherwise(0.0).alias("mean_line"), long(80), long(120), long(200), count("!").alias("bangs"), count(r"\?").alias("questions"), count(rf"(?md)^#{{1,6}}[{SPACE}]+").alias("markdown_headers"),
        F.size("m_").cast("long").alias("chapters"), "chapter_chars", "chapter_chars_no_space", F.map_filter("chapter_chars", lambda k, v: v < minimum).alias("under_minimum"), count('"').alias("double_quotes"), style_quotes(F.col("text")).cast("long").alias("single_quotes"), count(r"\.{3,}").alias("ellipses"),
    )
    cues = bracket_lines(docs).groupBy(key).agg(F.count_if("blocks").alias("stage_cues"), F.count(F.lit(1)).alias("stage_cue_candidates"))
    flags = format_flags(docs).groupBy(key).agg(*[F.count_if(F.col("subtype") == s).alias(n) for s, n in _SUBTYPES.items()], F.count(F.lit(1)).alias("format_violations"))
    out = sized.join(cues, key, "left").join(flags, key, "left").na.fill(0, ["stage_cues", "stage_cue_candidates", *_SUBTYPES.values(), "format_violations"])
    return out.withColumn("stage_cues_allowed", F.col("stage_cue_candidates") - F.col("stage_cues"))


def ledger_totals(rows: DataFrame, work: str, key: str, line_issues: DataFrame | None = None) -> DataFrame:
    """Per work: total, valid, invalid (with line_issues, a row per line that could not be read: work). A row without issues is valid."""
    bad = ledger_issues(rows, key).select(key).distinct().withColumn("bad", F.lit(1))
    out = rows.select(work, key).join(bad, key, "left").groupBy(work).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("bad").isNull()).alias("valid"))
    unread = line_issues.groupBy(work).agg(F.count(F.lit(1)).alias("unread")) if line_issues is not None else None
    out = out.join(unread, work, "left").na.fill(0, ["unread"]) if unread is not None else out.withColumn("unread", F.lit(0).cast("long"))
    return out.select(work, "total", "valid", (F.col("total") - F.col("valid") + F.col("unread")).alias("invalid"))


def value_counts(rows: DataFrame, work: str, column: str, missing: str) -> DataFrame:
    """(work, value, n): how often each value of a column stands in a list; null and empty under the name `missing`."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(missing))
    return rows.groupBy(work, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
