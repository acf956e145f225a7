"""Change lists and ledgers: validation, anchors, application, markers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_inline, occurrences
from . import rules
from .integrity import apply_edits

#: Marked-up edits in text; the doubled mark asks for a decision and may carry an opinion.
DECIDED = r"ⓐⓐ\{([^|{}]*)\|([^{}]*)\}(?:\[[^\]\n]*\])?"
PLAIN = r"(?<!ⓐ)ⓐ\{([^|{}]*)\|([^{}]*)\}"


def _given(df: DataFrame):
    """Column by name as text; one that the table lacks is null."""
    return lambda name: F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _filled(*cols: Column) -> Column:
    return reduce(or_, [F.coalesce(F.trim(c) != "", F.lit(False)) for c in cols])


def _rows(df: DataFrame, issues: list[tuple[Column, str]], keep: tuple[str, ...]) -> DataFrame:
    """A row per issue: kept columns and the field. A null condition is none."""
    return df.select(*keep, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(field)) for c, field in issues]))).alias("field"))


def change_issues(changes: DataFrame, *keep: str) -> DataFrame:
    """What is wrong with each change: (kept columns, field), in the order of the checks, a field once per failed check. One projection; missing columns count as null."""
    c = _given(changes)
    find, replace, marker = c("find"), c("replace"), F.coalesce(c("marker"), F.lit(""))
    operation = F.coalesce(F.nullif(F.trim(c("operation")), F.lit("")), F.when(replace == "", "delete").otherwise("replace"))
    kind = F.lower(F.trim(F.coalesce(c("edit_class"), F.lit(""))))
    hay = F.concat_ws("\n", *[c(x) for x in ("find", "replace", "reason", "location", "context_before", "context_after", "context_window")])
    signal = reduce(or_, [F.contains(hay, F.lit(s)) for s in (*rules.CONTEXTUAL_SIGNALS, "...")]) | F.coalesce(find.rlike("[\"']"), F.lit(False))
    contextual = F.coalesce(c("requires_context").cast("boolean"), F.lit(False)) | kind.isin(*rules.CONTEXTUAL_CLASSES) | signal
    memo = reduce(or_, [F.contains(clean_inline(replace), F.lit(s)) for s in rules.MEMO_PHRASES])
    count, sure = F.expr("try_cast(occurrence as int)") if "occurrence" in changes.columns else F.lit(None).cast("int"), c("confidence_percent").try_cast("int")
    plain, inserts = marker == "ⓐ", operation.isin("insert_before", "insert_after")
    slop = kind.isin(*rules.SLOP_CLASSES) & ~_filled(c("ai_slop_signal")) & ~F.coalesce(c("reason").rlike("AI-slop 신호|AI 티"), F.lit(False))
    return _rows(changes, [
        (F.coalesce(find == "", F.lit(True)), "find"), (replace.isNull(), "replace"), (~marker.isin(*rules.MARKERS), "marker"), (~operation.isin(*rules.OPERATIONS), "operation"),
        ((operation == "delete") & (replace != ""), "replace"), (inserts & (replace == ""), "replace"), ((operation == "replace") & (find == replace), "replace"),
        ((marker == "ⓐⓐ") & (inserts | (operation == "replace")) & memo, "replace"), (c("occurrence").isNotNull() & F.coalesce(count < 1, F.lit(True)), "occurrence"),
        (c("confidence_percent").isNotNull() & F.coalesce(~sure.between(0, 100), F.lit(True)), "confidence_percent"), (contextual & plain & (sure < 95), "confidence_percent"),
        (contextual & ~_filled(c("reason")), "reason"), (contextual & ~_filled(c("reading_basis")), "reading_basis"),
        (contextual & ~_filled(*[c(x) for x in ("context_before", "context_after", "context_window", "evidence_snippet")]), "context"), (contextual & plain & c("confidence_percent").isNull(), "confidence_percent"),
        (contextual & plain & ~_filled(*[c(x) for x in ("alternative_interpretation", "counter_evidence", "rejected_interpretation", "rejection_basis")]), "alternative_interpretation"), (slop, "ai_slop_signal"),
    ], keep)


def apply_changes(docs: DataFrame, changes: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Apply a change list (key, index, find, replace, operation, occurrence) to texts: columns of docs with the new text, applied and blocked (indexes, ascending).

    Blocked: no such anchor or occurrence; several anchors and no occurrence; overlap with a span accepted before (by start, stop, index); an insertion strictly inside
    an accepted span. At one place, text inserted before comes first, then text inserted after, then a replacement that starts there. Changes are gathered by document
    first, so each text is joined once. Null texts block every change."""
    per = changes.where(F.col(key).isNotNull()).groupBy(key).agg(gathered().alias("_changes"))
    return apply_gathered(docs.join(per, key, "left"), "_changes", text)


def gathered() -> Column:
    """The aggregate that turns a change list into the array that apply_gathered takes."""
    fields = F.struct(F.col("index").cast("int").alias("index"), "find", F.coalesce("replace", F.lit("")).alias("replace"), F.coalesce("operation", F.lit("replace")).alias("operation"), F.col("occurrence").cast("int").alias("occurrence"))
    return F.collect_list(fields)


def apply_gathered(docs: DataFrame, listed: str, text: str = "text") -> DataFrame:
    """As apply_changes, where each row has its list in the column `listed`, which is dropped."""

    def span(c: Column) -> Column:
        found = occurrences(F.coalesce(F.col(text), F.lit("")), c.find)
        at = F.when((F.size(found) > 1) & c.occurrence.isNull(), F.lit(None)).otherwise(F.when(F.coalesce(c.occurrence, F.lit(1)) >= 1, F.get(found, F.coalesce(c.occurrence, F.lit(1)) - 1)))
        inserted, end = c.operation.startswith("insert"), at + F.length(c.find)
        start = F.when(c.operation == "insert_after", end).otherwise(at).cast("int")
        rank = F.when(c.operation == "insert_before", 0).when(c.operation == "insert_after", 1).otherwise(2)
        return F.struct(start.alias("start"), F.when(inserted, start).otherwise(end).cast("int").alias("stop"), rank.alias("rank"), c.index.alias("index"), F.when(c.operation == "delete", "").otherwise(c.replace).alias("replacement"))

    kind = "array<struct<start:int,stop:int,rank:int,index:int,replacement:string>>"
    df = docs.withColumn("_changes", F.coalesce(listed, F.array().cast("array<struct<index:int,find:string,replace:string,operation:string,occurrence:int>>")))
    df = df.withColumn("_spans", F.array_sort(F.filter(F.transform("_changes", span), lambda s: s.start.isNotNull())).cast(kind))
    taken = F.aggregate(F.filter("_spans", lambda s: s.rank == 2), F.array().cast(kind), lambda acc, s: F.when(F.coalesce(s.start >= F.get(acc, F.size(acc) - 1).stop, F.lit(True)), F.concat(acc, F.array(s))).otherwise(acc))
    df = df.withColumn("_taken", taken)
    df = df.withColumn("_edits", F.array_sort(F.concat("_taken", F.filter("_spans", lambda s: (s.rank < 2) & ~F.exists("_taken", lambda t: (t.start < s.start) & (s.start < t.stop))))))
    done = F.array_sort(F.transform("_edits", lambda e: e.index))
    df = df.withColumn("applied", done).withColumn("blocked", F.array_sort(F.array_except(F.transform("_changes", lambda c: c.index), done)))
    df = df.withColumn("_edits", F.transform("_edits", lambda e: F.struct(e.start.alias("start"), e.stop.alias("stop"), e.replacement.alias("replacement"))))
    return apply_edits(df, "_edits", text, in_order=True).drop("_changes", listed, "_spans", "_taken", "_edits")


def approved(changes: DataFrame, accept_judged: bool = False) -> DataFrame:
    """Changes to apply: none that were rejected; those that ask for a decision only when accepted, singly or all together."""
    status, marker = F.lower(F.trim(F.coalesce("status", F.lit("")))), F.coalesce("marker", F.lit(""))
    return changes.where(~status.isin(*rules.REJECTED_STATUSES) & ((marker != "ⓐⓐ") | F.lit(accept_judged) | status.isin(*rules.APPROVED_STATUSES)))


def marker_text(find: Column, replace: Column, operation: Column, marker: Column, reason: Column) -> Column:
    """The change as a mark: source, bar, new text in braces; one without a marker asks for a decision, with the reason behind it."""
    judged = F.coalesce(marker, F.lit("")) != "ⓐ"
    source, new = F.when(operation.startswith("insert"), "").otherwise(find), F.when(operation == "delete", "").otherwise(F.coalesce(replace, F.lit("")))
    opinion = F.when(judged & _filled(reason), F.concat(F.lit("[수정 판단: "), F.trim(reason), F.lit("]"))).otherwise("")
    return F.concat(F.when(judged, "ⓐⓐ{").otherwise("ⓐ{"), source, F.lit("|"), new, F.lit("}"), opinion)


def finalize_markers(text: Column, accept_judged: bool) -> Column:
    """Marks to text: plain ones to the correction, judged ones to the correction if accepted, else back to the source."""
    return F.regexp_replace(F.regexp_replace(text, DECIDED, "$2" if accept_judged else "$1"), PLAIN, "$2")


def marker_counts(text: Column) -> tuple[Column, Column]:
    """How many plain and how many judged marks."""
    return F.regexp_count(text, F.lit(r"(?<!ⓐ)ⓐ\{")), F.regexp_count(text, F.lit(r"ⓐⓐ\{"))


def change_contexts(docs: DataFrame, find: str, window: int = 40, most: int = 3, text: str = "text") -> DataFrame:
    """Up to `most` matches (a report's limit) with `window` characters on each side: columns of docs without the text, nth, context."""
    n, t = len(find), F.col(text)
    cut = lambda p: F.concat(F.substring(t, F.greatest(p - window, F.lit(0)) + 1, F.least(p, F.lit(window))), F.lit("[["), F.substring(t, p + 1, F.lit(n)), F.lit("]]"), F.substring(t, p + n + 1, F.lit(window)))
    found = F.transform(F.slice(occurrences(t, find), 1, most), cut)
    return docs.select(*[c for c in docs.columns if c != text], F.posexplode(found).alias("_n", "context")).withColumn("nth", F.col("_n") + 1).drop("_n")


def ledger_issues(rows: DataFrame, *keep: str) -> DataFrame:
    """What is wrong with each row of a ledger: (kept columns, field). Required fields depend on record_type; the statuses are a fixed list. Missing columns count as empty."""
    c = _given(rows)
    kind, status = F.trim(F.coalesce(c("record_type"), F.lit(""))), F.trim(F.coalesce(c("status"), F.lit("")))
    lacks = lambda name: F.coalesce(c(name) == "", F.lit(True))
    checks = [(kind == "", "record_type"), (~_filled(c("id")), "id"), ((status != "") & ~status.isin(*rules.LEDGER_STATUSES), "status"), (kind.isin("confirmed", "entity", "hold", "ledger_queue") & (status == ""), "status")]
    checks += [((kind == "confirmed") & lacks(f), f) for f in ("source", "target", "reason", "action")]
    checks += [((kind == "issue") & lacks(f), f) for f in ("episode", "type", "status", "source", "reason", "action")]
    return _rows(rows, [*checks, ((kind == "issue") & (status == "confirmed_error") & lacks("target"), "target")], keep)
