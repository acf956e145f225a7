"""Review candidates from lines and adjacent chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_inline, lines_of, style_quotes
from .segment import lines


def facts(docs: DataFrame, pack: dict[str, str]) -> DataFrame:
    """A row per match of each rule: (columns of docs, line_no, kind, value, context). All rules run in one projection over each line, the cheap union of patterns first."""
    some = lines(docs).where(F.col("line").rlike("(?U)" + "|".join(f"(?:{p})" for p in pack.values())))

    def matches(kind: str, pattern: str):
        return F.transform(F.regexp_extract_all("line", F.lit(f"(?U)({pattern})"), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    found = F.flatten(F.array(*[matches(k, p) for k, p in pack.items()]))
    return some.withColumn("m", F.explode(found)).select("*", "m.kind", "m.value", F.expr("left(trim(line), 240)").alias("context")).drop("m", "line")


def flags(docs: DataFrame, pack: dict[str, str]) -> DataFrame:
    """A row per line and rule that it meets."""
    which = F.array_compact(F.array(*[F.when(F.col("line").rlike(f"(?U){p}"), F.lit(k)) for k, p in pack.items()]))
    return lines(docs).withColumn("rule", F.explode(which)).withColumn("context", F.expr("left(trim(line), 240)")).drop("line")


def typography(docs: DataFrame) -> DataFrame:
    """Lines with straight double quotes, style single quotes or runs of dots, and how many."""
    kinds = {"straight_double_quote": F.regexp_count("line", F.lit('"')), "straight_single_quote": style_quotes(F.col("line")), "ascii_ellipsis": F.regexp_count("line", F.lit(r"\.{3,}"))}
    found = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("long").alias("n")) for k, v in kinds.items()]), lambda x: x.n > 0)
    return lines(docs).withColumn("m", F.explode(found)).select("*", "m.kind", "m.n").drop("m", "line")


def replay(chapters: DataFrame, work: str, order: str, text: str = "text", edge: int = 20) -> DataFrame:
    """Adjacent chapters whose last and first lines share whole lines: (work, previous, order, shared, samples)."""
    signal = lambda part: F.filter(F.transform(part, lambda x: F.left(clean_inline(x), F.lit(160))), lambda x: (F.length(x) >= 12) & (x != "***"))
    rows = lines_of(F.col(text))
    # only the edges go through the shuffle by work, not the text
    edges = chapters.select(work, order, signal(F.slice(rows, 1, edge)).alias("head"), signal(F.slice(rows, F.greatest(F.size(rows) - edge + 1, F.lit(1)), edge)).alias("tail"))
    w = Window.partitionBy(work).orderBy(order)
    pairs = edges.select(work, F.lag(order).over(w).alias("previous"), order, F.array_sort(F.array_intersect(F.lag("tail").over(w), F.col("head"))).alias("same"))
    return pairs.where("size(same) > 0").select(work, "previous", order, F.size("same").cast("long").alias("shared"), F.array_join(F.slice("same", 1, 5), "\n").alias("samples"))


def bridge(chapters: DataFrame, work: str, order: str, anchor: str, text: str = "text", edge: int = 5) -> DataFrame:
    """Adjacent chapters with a weak transition: (work, previous, order, signals): a short head, no time anchor in it, or an open ending that the head does not take up."""
    rows = F.filter(F.transform(lines_of(F.col(text)), lambda x: F.left(clean_inline(x), F.lit(160))), lambda x: (F.length(x) >= 12) & (x != "***"))
    edges = chapters.select(work, order, F.slice(rows, 1, edge).alias("head"), F.slice(rows, F.greatest(F.size(rows) - edge + 1, F.lit(1)), edge).alias("tail"))
    w = Window.partitionBy(work).orderBy(order)
    pairs = edges.select(work, F.lag(order).over(w).alias("previous"), order, F.array_join("head", "\n").alias("h"), F.lag("tail").over(w).alias("t")).where("previous is not null")
    last = F.get("t", F.size("t") - 1)
    taken = F.exists("t", lambda x: F.contains(F.col("h"), F.left(x, F.lit(20))))
    signals = F.array_compact(F.array(F.when(F.length("h") < 80, F.lit("short_head")), F.when(~F.col("h").rlike(anchor), F.lit("no_time_anchor")), F.when(last.rlike("[?!…]$") & ~taken, F.lit("open_ending"))))
    return pairs.select(work, "previous", order, F.array_join(signals, ",").alias("signals")).where("signals != ''")


def spacing(turns: DataFrame, group: str, order: str, kind: str) -> DataFrame:
    """Consecutive rows of a group and the blank lines wanted between them: none where the kind stays, one where it changes."""
    w = Window.partitionBy(group).orderBy(order)
    pairs = turns.select(group, order, F.lag(order).over(w).alias("previous"), F.lag(kind).over(w).alias("was"), F.col(kind).alias("now")).where("previous is not null")
    return pairs.select(group, order, (F.col(order) - F.col("previous") - 1).cast("long").alias("blanks"), F.when(F.col("was").eqNullSafe(F.col("now")), 0).otherwise(1).cast("long").alias("wanted"))
