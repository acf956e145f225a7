"""Bracket lines, subtitles and contradicting action states."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES, clean_inline, lines_of, unescape_common, upper_each
from . import rules
from .segment import lines

BRACKETS = r"^\[[^\]\n]{1,160}\]\z"


def _among(terms: tuple[str, ...], *places: Column) -> Column:
    """The terms, in their order, that one of the places holds; places are in upper case."""
    return F.array_compact(F.array(*[F.when(reduce(or_, [F.contains(p, F.lit(t.upper())) for p in places]), F.lit(t)) for t in terms]))


def bracket_lines(docs: DataFrame, text: str = "text", radius: int = 3, split: Callable[[Column], Column] = lines_of) -> DataFrame:
    """A row per line that is one bracket: columns of docs without the text, line_no, body, classification, blocks, confidence, terms.

    The neighbours are the nearest `radius` lines on each side that are not blank, from the same row, so nothing is shuffled. Notes to oneself block, text of
    screens and papers inside the story does not, anything else blocks until it is read. Terms are compared in upper case, a letter for a letter (no SS in ß); null texts have no rows.
    split cuts a text into lines; any of Unicode's spaces go at their ends."""
    kept = F.filter(F.transform(split(F.col(text)), lambda x, i: F.struct((i + 1).alias("line_no"), F.trim(x, F.lit(SPACES)).alias("line"))), lambda x: x.line != "")
    rows = docs.select(*[c for c in docs.columns if c != text], kept.alias("_kept"))
    near = F.transform("_kept", lambda x, i: F.struct(x.line_no.alias("line_no"), x.line.alias("line"), F.when(x.line.rlike(BRACKETS), F.concat(
        F.slice("_kept", F.greatest(i + 1 - radius, F.lit(1)), F.least(i, F.lit(radius))), F.slice("_kept", i + 2, radius))).alias("near")))
    rows = rows.withColumn("_m", F.explode(F.filter(near, lambda x: x.near.isNotNull()))).drop("_kept")
    body = F.trim(F.regexp_extract("_m.line", r"(?s)^\[(.*)\]\z", 1), F.lit(SPACES))
    rows = rows.withColumn("_body", upper_each(body)).withColumn("_around", upper_each(F.array_join(F.transform("_m.near", lambda x: x.line), "\n")))
    rows = rows.withColumn("_notes", _among(rules.NOTE_TERMS, F.col("_body"), F.col("_around"))).withColumn("_screen", _among(rules.SCREEN_TERMS, F.col("_around"))).withColumn("_head", _among(rules.HEADLINE_TERMS, F.col("_body")))
    note, screen = F.size("_notes") > 0, F.size("_screen") > 0
    shown = screen | (F.size("_head") >= 2) | ((F.size("_head") >= 1) & body.rlike(rules.HEADLINE_SHAPE))
    kind = F.when(note, "authorial_or_editing_note").when(shown, "storyworld_artifact").otherwise("possible_stage_cue")
    terms = F.when(note, F.slice("_notes", 1, 5)).when(shown, F.concat(F.slice("_screen", 1, 4), F.slice("_head", 1, 4))).otherwise(F.array().cast("array<string>"))
    out = rows.select("*", F.col("_m.line_no").alias("line_no"), body.alias("body"), kind.alias("classification"), (note | ~shown).alias("blocks"), F.when(note | screen, "high").otherwise("medium").alias("confidence"), terms.alias("terms"))
    return out.drop("_m", "_body", "_around", "_notes", "_screen", "_head")


def is_subtitle(line: Column) -> Column:
    """Short, without an opening quote, bracket or marker, no sentence, with a letter or digit; null: no."""
    t = clean_inline(line)
    bad = t.isin("***", "* * *", "---") | t.rlike("^[\"'“‘「『\\[(ⓐⓚ]") | t.rlike(r"[.?!]|…$|[:：]\s*$") | t.rlike(rules.SUBTITLE_ENDING)
    return F.coalesce(F.length(t).between(1, 36) & ~bad & t.rlike("[가-힣A-Za-z0-9]"), F.lit(False))


def subtitles(chapters: DataFrame, title: str | None = "title", text: str = "text") -> DataFrame:
    """Columns of chapters without title and text, has_subtitle, subtitle (empty if none) and subtitle_source: the heading's title, else the first line that is not blank."""
    first = clean_inline(F.get(F.filter(lines_of(F.col(text)), lambda x: F.trim(x) != ""), F.lit(0)))
    head = clean_inline(F.col(title)) if title else F.lit(None).cast("string")
    source = F.when(is_subtitle(head), "marker").when(is_subtitle(first), "body").otherwise("none")
    out = chapters.select(*[c for c in chapters.columns if c not in (title, text)], source.alias("subtitle_source"), head.alias("_head"), first.alias("_first"))
    value = F.when(F.col("subtitle_source") == "marker", F.col("_head")).when(F.col("subtitle_source") == "body", F.col("_first")).otherwise("")
    return out.withColumn("has_subtitle", F.col("subtitle_source") != "none").withColumn("subtitle", value).drop("_head", "_first")


def subtitle_flags(rows: DataFrame, work: str, order: str) -> DataFrame:
    """Chapters on the rarer side of a work in which some have a subtitle and some have none: (work, order, action, present, missing, examples: the first five). Ties: no rows.
    Counts and the five examples are aggregated by work before the join, so a work of any size passes through no single task with its texts."""
    sums = rows.groupBy(work).agg(F.count_if("has_subtitle").alias("present"), F.count_if(~F.col("has_subtitle")).alias("missing")).where("present > 0 and missing > 0 and present != missing")
    nth = F.row_number().over(Window.partitionBy(work).orderBy(order))
    some = rows.where("has_subtitle").select(work, order, "subtitle").withColumn("nth", nth).where("nth <= 5").groupBy(work).agg(F.array_sort(F.collect_list(F.struct("nth", "subtitle"))).alias("found"))
    out = rows.select(work, order, "has_subtitle").join(sums.join(some, work), work).where(F.col("has_subtitle") == (F.col("present") < F.col("missing")))
    action = F.when(F.col("has_subtitle"), "consider_deleting_existing_subtitle").otherwise("consider_adding_missing_subtitle")
    return out.select(work, order, action.alias("action"), "present", "missing", F.array_join(F.transform("found", lambda x: x.subtitle), "\n").alias("examples"))


def _states(docs: DataFrame, key: str, states: dict[str, str], actions: dict[str, str]) -> DataFrame:
    """Lines with an action or a time anchor: (key, line_no, anchor that holds there, actions, polarity, traced, context). Only these go through the shuffle by document."""
    line = unescape_common(F.trim("line"))
    at = lines(docs.select(key, "text")).select(key, "line_no", line.alias("line"))
    has = lambda name: F.col("line").rlike(states[name])
    which = F.array_compact(F.array(*[F.when(F.col("line").rlike(p), F.lit(k)) for k, p in actions.items()]))
    polarity = F.when(has("plan") & ~has("hard_affirmation"), "planned").when(has("negation") & ~has("affirmation"), "negated").when(has("affirmation") & ~has("negation"), "affirmed").when(has("negation"), "mixed").otherwise("unknown")
    hit = F.nullif(F.regexp_extract("line", f"({states['anchor']})", 1), F.lit(""))
    some = at.select(key, "line_no", hit.alias("hit"), which.alias("actions"), polarity.alias("polarity"), (has("trace") | has("anchor")).alias("traced"), F.expr("left(line, 260)").alias("context")).where("hit is not null or size(actions) > 0")
    return some.withColumn("anchor", F.coalesce(F.last("hit", True).over(Window.partitionBy(key).orderBy("line_no")), F.lit("episode_start"))).drop("hit")


def action_conflicts(docs: DataFrame, key: str, states: dict[str, str] = rules.STATES, actions: dict[str, str] = rules.ACTIONS) -> DataFrame:
    """Pairs of lines that affirm and negate one action under one time anchor: each line against the last three of the other polarity, at most 160 lines back.
    The frame is bounded by those 160 lines, so neither a long document nor a frequent action makes it grow. Null texts have no rows."""
    one = _states(docs, key, states, actions).where("polarity in ('affirmed', 'negated')").withColumn("action", F.explode("actions")).drop("actions")
    w = Window.partitionBy(key, "anchor", "action").orderBy("line_no").rangeBetween(-160, -1)
    seen = lambda p: F.collect_list(F.when(F.col("polarity") == p, F.struct("line_no", "polarity", "context"))).over(w)
    both = one.withColumn("_aff", seen("affirmed")).withColumn("_neg", seen("negated")).withColumn("_opp", F.when(F.col("polarity") == "affirmed", F.col("_neg")).otherwise(F.col("_aff")))
    pairs = both.withColumn("f", F.explode(F.slice("_opp", F.greatest(F.size("_opp") - 2, F.lit(1)), 3)))
    return pairs.select(key, "anchor", "action", F.col("f.line_no").alias("first_line"), F.col("line_no").alias("second_line"), F.col("f.polarity").alias("first_polarity"), F.col("polarity").alias("second_polarity"), F.col("f.context").alias("first_context"), F.col("context").alias("second_context"))


def state_traces(docs: DataFrame, key: str, states: dict[str, str] = rules.STATES, actions: dict[str, str] = rules.ACTIONS) -> DataFrame:
    """Lines with an action and either a word of change or a time anchor: (key, line_no, anchor, actions, context)."""
    return _states(docs, key, states, actions).where("traced and size(actions) > 0").select(key, "line_no", "anchor", F.array_join("actions", ",").alias("actions"), "context")
