"""Gaps and repeats in numbered sequences, and text edits by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 65_536


def missing_episodes(rows: DataFrame, work: str, number: str) -> DataFrame:
    """(work, number) of the numbers between a work's smallest and largest that no row has. From neighbours, so no full range is built for dense works."""
    from pyspark.sql import Window

    after = F.lead(number).over(Window.partitionBy(work).orderBy(number))
    gaps = rows.where(f"{number} is not null").select(work, number).distinct().withColumn("after", after).where(f"after > {number} + 1")
    # one odd number makes a gap of any length: it is listed in pieces, so that no array holds all of it
    first, last = F.col(number) + 1, F.col("after") - 1
    pieces = gaps.select(work, last.alias("last_"), F.explode(F.sequence(first, last, F.lit(GAP).cast(gaps.schema[number].dataType))).alias("first_"))
    return pieces.select(work, F.explode(F.sequence("first_", F.least("last_", F.col("first_") + (GAP - 1)))).alias(number))


def duplicate_episodes(rows: DataFrame, work: str, number: str) -> DataFrame:
    return rows.groupBy(work, number).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def apply_edits(docs: DataFrame, edits: str = "edits", text: str = "text", in_order: bool = False) -> DataFrame:
    """Replace spans (array of start, stop, replacement; 0-based positions in the given text, not overlapping); null or no edits leave the text. `in_order`: they are sorted already."""
    given = F.coalesce(F.col(edits), F.array().cast("array<struct<start:int,stop:int,replacement:string>>"))
    ordered = given if in_order else F.sort_array(given)
    # each edit gives what stands between it and the one before, then its replacement: the text is cut once, not copied per edit
    before = F.concat(F.array(F.lit(0)), F.transform(ordered, lambda e: e.stop))
    pieces = F.zip_with(ordered, F.slice(before, 1, F.size(ordered)), lambda e, b: F.concat(F.substring(F.col(text), b + 1, e.start - b), e.replacement))
    last = F.get(before, F.size(before) - 1)
    return docs.withColumn(text, F.concat(F.array_join(pieces, ""), F.substring(F.col(text), last + 1, F.length(text))))
