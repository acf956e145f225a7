"""Source integrity: order of documents by name, episode labels at the end of a line, gaps and repeats in a text's own sequence. Per row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines_of
from .headings import MARKDOWN, _number, heading_markers

# Labels of episodes in names and lines.
EMBEDDED_TAIL = r"^(.+?)(\d{1,4})\s*화\s*$"
AMBIGUOUS_TAIL = r"/[^\n]{0,40}\d{1,4}\s*화[^\n]{0,40}(?:끝|\))"
NAME_RANGE = r"(\d{1,4})\s*(?:~|-|_)\s*(\d{1,4})\s*화"
NAME_SINGLE = r"(\d{1,4})\s*화"
LAST = 10_000
# End of the fixed values.


def document_order(name: Column) -> Column:
    """struct<first, last, name>: the episodes that a file's name gives, or the last places; sorts documents."""
    number = lambda p, g: F.regexp_extract(name, p, g).cast("int")
    ranged, single = name.rlike(NAME_RANGE), name.rlike(NAME_SINGLE)
    first = F.when(ranged, number(NAME_RANGE, 1)).when(single, number(NAME_SINGLE, 1)).otherwise(LAST)
    last = F.when(ranged, number(NAME_RANGE, 2)).when(single, number(NAME_SINGLE, 1)).otherwise(LAST)
    return F.struct(first.alias("first"), last.alias("last"), name.alias("name"))


def split_tails(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the text repaired and `splits` (line, from_episode, to_episode): a line that ends in the next episode's label is cut before it, and the label becomes a heading.

    Only headings and lines with a label at their end go through the fold, so it is short however long the text is.
    """
    line_no = lambda x: F.coalesce(_number(x, 1), F.when(x.rlike(f"(?m){MARKDOWN}"), "1")).cast("int")
    out = docs.withColumn("rows_", lines_of(F.col(text)))
    marked = F.transform("rows_", lambda x, i: F.struct((i + 1).alias("line"), line_no(x).alias("head"), F.when(x.rlike(EMBEDDED_TAIL), F.regexp_extract(x, EMBEDDED_TAIL, 2).cast("int")).alias("tail"), F.rtrim(F.regexp_extract(x, EMBEDDED_TAIL, 1)).alias("body")))
    out = out.withColumn("some_", F.filter(marked, lambda x: x.head.isNotNull() | x.tail.isNotNull()))
    kind = "array<struct<line:int,from_episode:int,to_episode:int>>"
    start = F.struct(F.lit(None).cast("int").alias("now"), F.array().cast(kind).alias("out"))

    def step(a: Column, x: Column) -> Column:
        next_ = F.coalesce((x.tail == a.now + 1) & (x.body != ""), F.lit(False))
        split = F.struct(x.line.cast("int").alias("line"), a.now.alias("from_episode"), x.tail.alias("to_episode"))
        return (
            F.when(x.head.isNotNull(), F.struct(x.head.alias("now"), a.out.alias("out")))
            .when(next_, F.struct(x.tail.alias("now"), F.concat(a.out, F.array(split)).alias("out")))
            .otherwise(a)
        )

    out = out.withColumn("splits", F.aggregate("some_", start, step, lambda a: a.out))
    at = F.map_from_arrays(F.transform("splits", lambda s: s.line), F.transform("splits", lambda s: s.to_episode))
    out = out.withColumn("at_", at)
    cut = lambda x, i: F.when(F.map_contains_key("at_", i + 1), F.concat(F.rtrim(F.regexp_extract(x, EMBEDDED_TAIL, 1)), F.lit("\nⓚ제"), F.try_element_at("at_", i + 1).cast("string"), F.lit("화"))).otherwise(x)
    return out.withColumn(text, F.array_join(F.transform("rows_", cut), "\n")).drop("rows_", "some_", "at_")


def blocked_issues(docs: DataFrame, keys: list[str], text: str = "text", first_id: int = 1) -> DataFrame:
    """keys, id, operation, episode, line: episodes missing between the first and the last, repeated ones, and lines with a label that is not clear.

    Ids count on from first_id; those of unclear labels leave out as many numbers as there are rows before them.
    """
    rows = docs.select(*keys, F.col(text).alias("text")).withColumn("m", heading_markers(F.col("text"))).withColumn("names", F.col("m.episode")).withColumn("numbers", F.transform("names", lambda e: e.cast("int")))
    low, high = F.array_min("numbers"), F.array_max("numbers")
    missing = F.when(F.size("numbers") > 0, F.array_sort(F.array_except(F.sequence(low, high), F.col("numbers")))).otherwise(F.array().cast("array<int>"))
    repeated = F.array_sort(F.array_distinct(F.filter("names", lambda e: F.size(F.filter("names", lambda x: x == e)) > 1)))
    unclear = F.filter(F.transform(lines_of(F.col("text")), lambda x, i: F.struct((i + 1).alias("line"), (x.rlike(f"(?U){AMBIGUOUS_TAIL}") & ~x.rlike(f"(?U){EMBEDDED_TAIL}")).alias("is"))), lambda x: x["is"])
    rows = rows.withColumn("missing", missing).withColumn("repeated", repeated).withColumn("unclear", unclear).withColumn("before", F.size("missing") + F.size("repeated"))
    name = lambda n: F.concat(F.lit("SRC-BLOCK-"), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string")))
    row = lambda i, op, episode, line: F.struct(name(i + first_id).alias("id"), F.lit(op).alias("operation"), episode.cast("string").alias("episode"), line.cast("int").alias("line"))
    none = F.lit(None)
    padded = lambda e: F.when(e < 1000, F.lpad(e.cast("string"), 3, "0")).otherwise(e.cast("string"))
    found = F.concat(
        F.transform("missing", lambda e, i: row(i, "missing_episode", padded(e), none)),
        F.transform("repeated", lambda e, i: row(i + F.size("missing"), "duplicate_episode", e, none)),
        F.transform("unclear", lambda x, i: row(i + 2 * F.col("before"), "ambiguous_tail_label", none, x.line)),
    )
    return rows.select(*keys, F.inline(found))


def sequence_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, episode, change (added, removed, moved): chapters (keys, chapter_no, episode) before and after a repair, by a full outer join on the episode."""
    a, b = before.select(*keys, "episode", F.col("chapter_no").alias("was")), after.select(*keys, "episode", F.col("chapter_no").alias("now"))
    both = a.join(b, [*keys, "episode"], "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "moved")
    return both.withColumn("change", change).where("change is not null")
