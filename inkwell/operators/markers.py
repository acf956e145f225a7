"""Review markers in a text: events of changes, their application, and paragraphs of what results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_inline, let, occurrences

# Signs and words of markers.
JUDGED, PLAIN_CANDIDATE = "ⓐⓐ", "수정 후보"
HEADING_ANCHOR = r"^(?:[#\s]*)?ⓚ?\s*(?:제\s*)?\d+\s*(?:화|장)(?:$|[^\p{L}\p{N}_])"
# End of the fixed values.


def _line_start(text: Column, at: Column) -> Column:
    """Where the line of a position (from 0) starts."""
    return at - F.length(F.substring_index(F.substring(text, F.lit(1), at), "\n", -1))


def marker_events(docs: DataFrame, changes: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, order, id, start, stop, marked) of changes (key, order, id, find, replace, marker, operation, occurrence, opinion) against their texts, and `issue` where one has no place.

    A missing marker counts as ⓐⓐ, a missing occurrence as the first. ⓐ gives ⓐ{find|replace}; ⓐⓐ the candidate with its opinion in brackets; inserts at a heading, or
    that begin or end with a line break, stand on their own, behind the heading's empty lines. The list of a text's changes meets the text by a join on key.
    """
    rows = changes.join(docs.select(key, F.col(text).alias("text")), key)
    operation = F.coalesce(F.nullif(F.trim(F.col("operation")), F.lit("")), F.when(F.coalesce("replace", F.lit("")) == "", "delete").otherwise("replace"))
    rows = rows.withColumn("find", F.coalesce("find", F.lit(""))).withColumn("new_", F.coalesce("replace", F.lit(""))).withColumn("op_", operation).withColumn("mark_", F.coalesce(F.nullif(F.col("marker"), F.lit("")), F.lit(JUDGED)))
    rows = rows.withColumn("at_", occurrences(F.col("text"), F.col("find"))).withColumn("nth_", F.coalesce(F.nullif(F.col("occurrence"), F.lit(0)), F.lit(1)))
    issue = (
        F.when(F.col("find") == "", "find is empty").when(F.size("at_") == 0, "anchor not found").when((F.col("nth_") < 1) | (F.col("nth_") > F.size("at_")), "occurrence out of range")
        .when(~F.col("op_").isin("replace", "delete", "insert_before", "insert_after"), "unsupported operation")
    )
    rows = rows.withColumn("issue", issue).withColumn("start_", F.get("at_", F.col("nth_") - 1)).withColumn("stop_", F.col("start_") + F.length("find"))
    inserts, judged = F.col("op_").isin("insert_before", "insert_after"), F.col("mark_") == JUDGED
    begin = _line_start(F.col("text"), F.col("start_"))
    rest = F.substring(F.col("text"), F.col("stop_") + 1, F.length("text"))
    line = F.trim(F.concat(F.substring(F.col("text"), begin + 1, F.col("stop_") - begin), F.substring_index(rest, "\n", 1)))
    rows = rows.withColumn("heading_", line.rlike(HEADING_ANCHOR)).withColumn("begin_", begin).withColumn("rest_", rest)
    own_line = F.length(F.substring_index("rest_", "\n", 1)) + 1
    behind = F.when(F.contains("rest_", F.lit("\n")), let(F.substring(F.col("rest_"), own_line + 1, F.length("rest_")), lambda r: F.col("stop_") + own_line + F.length(F.regexp_extract(r, r"^(?:[ \t]*\r?\n)*", 0)))).otherwise(F.col("stop_"))
    place = (
        F.when(~inserts, F.col("start_")).when(judged & F.col("heading_"), F.when(F.col("op_") == "insert_after", behind).otherwise(F.col("begin_"))).when(F.col("op_") == "insert_after", F.col("stop_")).otherwise(F.col("start_"))
    )
    alone = inserts & (F.col("heading_") | F.col("new_").rlike(r"^[\n\r]|[\n\r]\z"))
    candidate = F.when(F.col("op_") == "delete", "").when(inserts, clean_inline(F.col("new_"))).otherwise(F.coalesce(F.nullif(clean_inline(F.col("new_")), F.lit("")), F.lit(PLAIN_CANDIDATE)))
    opinion = F.when(F.coalesce(F.col("opinion"), F.lit("")) != "", F.concat(F.lit("["), "opinion", F.lit("]"))).otherwise("")
    original = F.when(inserts, "").otherwise(F.col("find"))
    shown = F.concat(
        F.when(inserts & ~alone, f" {JUDGED}").otherwise(JUDGED), F.lit("{"), original, F.lit("|"), candidate, F.lit("}"), opinion, F.when(alone, "\n\n").otherwise("")
    )
    plain = F.concat("mark_", F.lit("{"), original, F.lit("|"), F.when(F.col("op_") == "delete", "").otherwise(F.col("new_")), F.lit("}"))
    ok = F.col("issue").isNull()
    return rows.select(key, "order", "id", F.when(ok, place).alias("start"), F.when(ok, F.when(inserts, place).otherwise(F.col("stop_"))).alias("stop"), F.when(ok, F.when(judged, shown).otherwise(plain)).alias("marked"), "issue")


def apply_events(docs: DataFrame, events: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with the events of ``marker_events`` written in, in order of (start, stop, order); one that begins before the last one's end is left out and listed in `skipped` (ids)."""
    listed = events.where("issue is null").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "order", "id", "marked"))).alias("events_"))
    kind = "struct<cursor:int,taken:array<struct<start:int,stop:int,marked:string>>,skipped:array<string>>"
    empty = F.struct(F.lit(0).alias("cursor"), F.array().cast("array<struct<start:int,stop:int,marked:string>>").alias("taken"), F.array().cast("array<string>").alias("skipped")).cast(kind)

    def step(a: Column, e: Column) -> Column:
        late = F.struct(a.cursor.alias("cursor"), a.taken.alias("taken"), F.concat(a.skipped, F.array(e.id.cast("string"))).alias("skipped"))
        kept = F.struct(e.stop.alias("cursor"), F.concat(a.taken, F.array(F.struct(e.start.alias("start"), e.stop.alias("stop"), e.marked.alias("marked")))).alias("taken"), a.skipped.alias("skipped"))
        return F.when(e.start < a.cursor, late.cast(kind)).otherwise(kept.cast(kind))

    rows = docs.join(listed, key, "left").withColumn("s_", F.aggregate(F.coalesce("events_", F.array().cast("array<struct<start:int,stop:int,order:int,id:string,marked:string>>")), empty, step))
    before = F.concat(F.array(F.lit(0)), F.transform("s_.taken", lambda e: e.stop))
    pieces = F.zip_with("s_.taken", F.slice(before, 1, F.size("s_.taken")), lambda e, b: F.concat(F.substring(F.col(text), b + 1, e.start - b), e.marked))
    last = F.get(before, F.size(before) - 1)
    return rows.withColumn(text, F.concat(F.array_join(pieces, ""), F.substring(F.col(text), last + 1, F.length(text)))).withColumn("skipped", F.col("s_.skipped")).drop("events_", "s_")


def paragraphs(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, paragraph, text): a row per line of a marked text."""
    rows = docs.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n", -1)).alias("pos", "text"))
    return rows.select(key, (F.col("pos") + 1).alias("paragraph"), "text")
