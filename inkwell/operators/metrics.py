"""Chapter metrics and style-risk features: narrow projections and map-side combined aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, count_of, lines_of, no_space_length, strip
from .rules import MINIMUM_CHAPTER_CHARS
from .segment import sentences


def chapter_metrics(chapters: DataFrame, text: str = "text", minimum: int = MINIMUM_CHAPTER_CHARS) -> DataFrame:
    """Columns of chapters without the text, and its measures. One projection, no shuffle. A null text measures as empty."""
    t, long, rows = F.col("t_"), "long", F.col("rows_")
    chars = F.length(t).cast(long)
    held = chapters.withColumn("t_", F.coalesce(F.col(text), F.lit(""))).withColumn("rows_", lines_of(F.col("t_")))
    return held.select(
        *[c for c in chapters.columns if c != text], chars.alias("chars"), no_space_length(t).cast(long).alias("chars_no_space"), (chars < minimum).alias("below_minimum"),
        F.greatest(F.lit(minimum) - chars, F.lit(0)).cast(long).alias("deficit"), F.size(rows).cast(long).alias("lines"), F.size(F.filter(rows, lambda x: x.rlike(f"[^{SPACE}]"))).cast(long).alias("non_empty_lines"),
        F.size(F.filter(rows, lambda x: F.length(x) >= 120)).cast(long).alias("lines_120"), F.size(F.filter(rows, lambda x: F.length(x) >= 200)).cast(long).alias("lines_200"),
        count_of(t, "!").alias("bangs"), count_of(t, "?").alias("questions"),
    )


def text_inspection(metrics: DataFrame, work: str) -> DataFrame:
    """Sums of chapter metrics by work."""
    total = [F.sum(c).alias(c) for c in ("chars", "chars_no_space", "lines", "non_empty_lines", "lines_120", "lines_200", "bangs", "questions")]
    return metrics.groupBy(work).agg(F.count(F.lit(1)).alias("chapters"), F.count_if("below_minimum").alias("chapters_below_minimum"), *total)


def term_density(docs: DataFrame, terms: tuple[str, ...], weight: float, most: float, text: str = "text") -> DataFrame:
    """Occurrences of the terms per 10,000 characters and their score, per row."""
    hits = sum((count_of(F.col(text), t) for t in terms), F.lit(0).cast("long"))
    density = F.round(F.col("hits") / F.greatest(F.length(text) / 10000, F.lit(1.0)), 3)
    out = docs.withColumn("hits", hits).withColumn("density", density)
    return out.withColumn("score", F.round(F.least(F.greatest(F.col("density") / most * weight, F.lit(0.0)), F.lit(float(weight))), 1)).drop(text)


def repetition(docs: DataFrame, key: str, last: bool = False, weight: float = 14.0) -> DataFrame:
    """How often sentences start (or end) alike, per document of at least 30 sentences: the surplus over three of every opening of 8 characters, per 100 sentences."""
    s = sentences(docs.select(key, "text")).withColumn("bare", F.regexp_replace("sentence", f"[{SPACE}]+", ""))
    token = F.expr("right(bare, 8)") if last else F.expr("left(bare, 8)")
    per = s.groupBy(key, F.when(F.length("bare") >= 10, token).alias("token")).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy(key).agg(F.sum("n").alias("sentences"), F.coalesce(F.sum(F.when((F.col("n") >= 4) & F.col("token").isNotNull(), F.col("n") - 3)), F.lit(0)).alias("surplus")).where("sentences >= 30")
    value = F.col("surplus") * 100.0 / F.col("sentences")
    return out.withColumn("score", F.round(F.least(value / 4 * weight, F.lit(weight)), 1))


def length_uniformity(docs: DataFrame, key: str) -> DataFrame:
    """Population coefficient of variation of sentence lengths, for documents with at least 50 sentences of 8 to 220 characters."""
    s = sentences(docs.select(key, "text")).where(F.length("sentence") <= 220).withColumn("n", F.length(F.regexp_replace("sentence", f"[{SPACE}]+", "")))
    out = s.groupBy(key).agg(F.count(F.lit(1)).alias("sentences"), (F.stddev_pop("n") / F.avg("n")).alias("cv")).where("sentences >= 50")
    return out.select(key, "sentences", F.round("cv", 3).alias("cv"), F.round(F.least(F.greatest((0.55 - F.col("cv")) / 0.25 * 8, F.lit(0.0)), F.lit(8.0)), 1).alias("score"))


def brick_lines(docs: DataFrame, key: str, weight: float = 6.0, divisor: float = 8.0) -> DataFrame:
    """Stripped lines of 160 characters or more per 10,000 characters, and their score."""
    n = F.size(F.filter(lines_of(F.col("text")), lambda x: F.length(strip(x)) >= 160)).cast("long")
    out = docs.select(key, n.alias("bricks"), F.length("text").alias("chars"))
    value = F.col("bricks") / F.greatest(F.col("chars") / 10000, F.lit(1.0))
    return out.select(key, "bricks", F.round(value, 3).alias("density"), F.round(F.least(value / divisor * weight, F.lit(weight)), 1).alias("score"))
