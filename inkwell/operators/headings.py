"""Chapter headings: markers, predicates, normalisation, chapters, and the manuscript format that rests on them.

All of it works on one row at a time (arrays of lines, no shuffle, no Python): a work of any number of chapters is one row in, its chapters are rows out.
Texts have line feeds only (``normalize_newlines``). U+0001 and U+0002 part text here and are read as U+FFFD.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import INLINE, SPACE, curly_quotes, ellipsis, let, normalize_newlines, style_quotes, strip

# The words and signs of headings.
UNITS = "화|회|장|편|챕터"
ENGLISH = "chapter|ep(?:isode)?"
SEPARATORS = ".:：_\\-"
SCENE_BREAKS = ("***", "* * *")
# End of the fixed values.

_W, _D, _END = f"[{INLINE}]", r"\p{Nd}{1,4}", r"(?:$|[^\p{L}\p{N}_])"
_SEP = f"[{INLINE}{SEPARATORS}]"
_NUMBERED = rf"(?:제{_W}*)?({_D})(?:{_W}*(?:{UNITS}))?(?:{_SEP}+([^\n]*))?{_W}*$"
_NAMED = rf"(?:{ENGLISH}){_W}*({_D}){_SEP}*([^\n]*)$"
#: In order of precedence; group 1 is the number, group 2 the title.
FAMILIES = (
    rf"^{_W}*ⓚ{_W}*{_NUMBERED}", rf"^{_W}*ⓚ{_W}*{_NAMED}", rf"^{_W}*#{{1,6}}{_W}*{_NUMBERED}", rf"^{_W}*#{{1,6}}{_W}*{_NAMED}", rf"^{_W}*{_NAMED}",
    rf"^{_W}*(?:제{_W}*)?({_D}){_W}*(?:{UNITS}|{ENGLISH}){_SEP}*([^\n]*)$",
)
MARKDOWN = rf"^#{{1,6}}[{SPACE}]+(.+?)[{SPACE}]*$"
HASH = rf"^#{{1,6}}{_W}*"
NUMBERED_BODY = rf"(?i)^(?:제{_W}*)?{_D}{_W}*(?:{UNITS}){_END}"
ENGLISH_BODY = rf"(?i)^(?:{ENGLISH}){_W}*{_D}{_END}"
PLAIN_BODY = rf"^{_D}(?:[.)．]{_W}*$|{_W}*$|{_SEP}+.+$)"
_CANON = rf"(?i)^(제)?{_W}*({_D}){_W}*({UNITS})(.*)$"


def _any_family() -> str:
    plain = "|".join(f"(?:{p.replace('(' + _D + ')', _D).replace('([^' + chr(92) + 'n]*)', '[^' + chr(92) + 'n]*')})" for p in FAMILIES)
    return f"(?imd){plain}"


def _number(line: Column, group: int) -> Column:
    return F.coalesce(*[F.when(line.rlike(f"(?i){p}"), F.regexp_extract(line, f"(?i){p}", group)) for p in FAMILIES])


def _padded(number: Column) -> Column:
    return F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)


def heading_markers(text: Column) -> Column:
    """array<struct<episode, title, start, stop, body>>: the heading lines of a text, where they stand, and what follows each up to the next.

    Numbered and English headings in their order of precedence; only where there is none, Markdown headers numbered from 1.
    """
    clean = F.translate(normalize_newlines(F.coalesce(text, F.lit(""))), "\u0001\u0002", "��")

    def cut(pattern: str) -> Column:
        return F.split(F.regexp_replace(clean, pattern, "\u0001$0\u0002"), "\u0001")

    def found(pieces: Column, episode, title) -> Column:
        heads = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        begin = lambda i: F.aggregate(F.slice(pieces, 1, i + 1), F.lit(0), lambda a, p: a + F.length(p)) - i
        line = lambda p: F.substring_index(p, "\u0002", 1)
        return F.transform(heads, lambda p, i: F.struct(episode(line(p), i).alias("episode"), strip(title(line(p))).alias("title"), begin(i).alias("start"), (begin(i) + F.length(line(p))).alias("stop"), F.substring_index(p, "\u0002", -1).alias("body")))

    numbered = cut(_any_family())
    markdown = cut(f"(?md){MARKDOWN}")
    return F.when(F.size(numbered) > 1, found(numbered, lambda x, i: _padded(_number(x, 1)), lambda x: F.coalesce(_number(x, 2), F.lit("")))).otherwise(
        found(markdown, lambda x, i: _padded((i + 1).cast("string")), lambda x: F.regexp_extract(x, rf"(?md){MARKDOWN}", 1))
    )


def chapters(works: DataFrame, work: str = "work_id", text: str = "text") -> DataFrame:
    """(work_id, chapter_no, episode, base_episode, title, text, start_offset, stop_offset). Text before the first heading goes; without headings the whole text is chapter
    001; the n-th repeat of an episode is suffixed _n. No shuffle: a work's chapters come from its row."""
    body = works.select(F.col(work).alias("work_id"), normalize_newlines(F.coalesce(F.col(text), F.lit(""))).alias("text")).withColumn("m", heading_markers(F.col("text")))
    whole = F.array(F.struct(F.lit("001").alias("episode"), F.lit("").alias("title"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.col("text").alias("body")))
    rows = body.withColumn("m", F.when(F.size("m") > 0, F.col("m")).otherwise(whole))
    rows = rows.withColumn("all", F.col("m.episode")).select("work_id", "all", F.posexplode("m").alias("pos", "m"))
    nth = F.size(F.filter(F.slice("all", 1, F.col("pos") + 1), lambda e: e == F.col("m.episode")))
    episode = F.when(nth > 1, F.concat("m.episode", F.lit("_"), nth)).otherwise(F.col("m.episode"))
    return rows.select("work_id", (F.col("pos") + 1).alias("chapter_no"), episode.alias("episode"), F.col("m.episode").alias("base_episode"), "m.title", F.col("m.body").alias("text"), F.col("m.stop").alias("start_offset"), (F.col("m.stop") + F.length("m.body")).alias("stop_offset"))


def _body(stripped: Column) -> Column:
    return strip(F.regexp_replace(stripped, HASH, ""))


def is_heading_body(body: Column, plain: Column | bool = False) -> Column:
    return body.rlike(NUMBERED_BODY) | body.rlike(ENGLISH_BODY) | ((F.lit(plain) if isinstance(plain, bool) else plain) & body.rlike(PLAIN_BODY))


def is_heading(line: Column) -> Column:
    """Whether a line is a chapter heading; a bare number is one behind # or ⓚ only."""

    def judged(s: Column) -> Column:
        def body(b: Column) -> Column:
            inner = strip(F.regexp_replace(b, f"^ⓚ{_W}*", ""))
            return F.when(b.startswith("ⓚ"), let(inner, lambda x: is_heading_body(x, True))).otherwise(is_heading_body(b, s.rlike(HASH)))

        return let(_body(s), body)

    return F.when(line.rlike(r"\p{Nd}"), let(strip(line), judged)).otherwise(False)  # most lines have no digit


def is_plain_number(line: Column) -> Column:
    return F.when(line.rlike(rf"^[{SPACE}]*\p{{Nd}}"), strip(line).rlike(PLAIN_BODY)).otherwise(False)


def is_markdown_title(line: Column) -> Column:
    return F.when(line.rlike(rf"^[{SPACE}]*#"), _body(strip(line)) != "").otherwise(False)


def is_scene_break(stripped: Column) -> Column:
    return stripped.isin(*SCENE_BREAKS)


def is_dialogue(stripped: Column) -> Column:
    return stripped.startswith("“")


def canonical_body(body: Column) -> Column:
    """제 18 화 : x to 제18화 x; other headings keep their words, with single spaces."""
    text = F.regexp_replace(strip(body), f"{_W}+", " ")
    part = lambda n: F.regexp_extract(text, _CANON, n)
    tail = strip(F.regexp_replace(F.regexp_replace(strip(part(4)), f"^[{SEPARATORS}]+{_W}*", ""), f"[{SPACE}]+", " "))
    return F.when(text.rlike(_CANON), F.concat(part(1), part(2), part(3), F.when(tail != "", F.concat(F.lit(" "), tail)).otherwise(F.lit("")))).otherwise(text)


def normalize_headings(text: Column) -> Column:
    """Heading lines to one form: ⓚ in front, no #, 제18화 without inner spaces or separators. Bare numbers are headings where there are two or more; Markdown titles get
    numbers where the text has no numbered heading."""
    def usual(line: Column, s: Column, many: Column) -> Column:
        indent = F.regexp_extract(line, f"^([{SPACE}]*)", 1)

        def named(b: Column) -> Column:
            inner = let(strip(F.regexp_replace(b, f"^ⓚ{_W}*", "")), lambda x: F.when(x != "", F.concat(indent, F.lit("ⓚ"), canonical_body(x))).otherwise(line))
            return F.when(b.startswith("ⓚ"), inner).when(is_heading_body(b, s.rlike(HASH) | many), F.concat(indent, F.lit("ⓚ"), canonical_body(b))).otherwise(line)

        return F.when(s.rlike(r"ⓚ|\p{Nd}"), let(_body(s), named)).otherwise(line)

    def whole(rows: Column) -> Column:
        facts = F.struct((F.size(F.filter(rows, is_plain_number)) >= 2).alias("many"), F.exists(rows, is_heading).alias("named"))

        def titled(line: Column, i: Column) -> Column:
            nth = F.size(F.filter(F.slice(rows, 1, i + 1), is_markdown_title)).cast("string")
            return F.concat(F.regexp_extract(line, f"^([{SPACE}]*)", 1), F.lit("ⓚ제"), nth, F.lit("화 "), _body(strip(line)))

        def one(line: Column, i: Column, f: Column) -> Column:
            return F.when(~f.named & ~f.many & is_markdown_title(line), titled(line, i)).otherwise(let(strip(line), lambda s: usual(line, s, f.many)))

        return let(facts, lambda f: F.array_join(F.transform(rows, lambda x, i: one(x, i, f)), "\n"))

    return let(F.split(text, "\n", -1), whole)


def lines_with_kind(text: Column) -> Column:
    """The lines that are not blank: array<struct<no, line, value, kind>>."""
    kind = lambda x, s: F.when(is_heading(x), F.lit("chapter_heading")).when(is_scene_break(s), F.lit("scene_break")).when(is_dialogue(s), F.lit("dialogue")).otherwise(F.lit("narration"))
    rows = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct((i + 1).alias("no"), x.alias("line"), strip(x).alias("value")))
    rows = F.filter(rows, lambda x: x.value != "")
    return F.transform(rows, lambda x: F.struct(x.no.alias("no"), x.line.alias("line"), x.value.alias("value"), kind(x.line, x.value).alias("kind")))


def format_manuscript(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the text in manuscript format: typography and headings normalised, three empty lines under a heading, one around scene breaks and between dialogue and
    narration, none between lines of one kind. Applying it twice changes nothing."""
    out = docs.withColumn("fmt_", curly_quotes(ellipsis(normalize_headings(normalize_newlines(F.coalesce(F.col(text), F.lit("")))))))
    out = out.withColumn("kept_", lines_with_kind(F.col("fmt_")))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("kept_", lambda x: x.kind))
    blanks = lambda was, now: F.when(was.isNull() | (now == "chapter_heading"), 0).when(now == "scene_break", 1).when(was == "chapter_heading", 3).when((was == "scene_break") | (was != now), 1).otherwise(0)
    pieces = F.zip_with("kept_", F.slice(before, 1, F.size("kept_")), lambda x, was: F.concat(F.repeat(F.lit("\n"), blanks(was, x.kind)), x.line))
    joined = F.regexp_replace(F.array_join(pieces, "\n"), f"[{SPACE}]+$", "")
    return out.withColumn(text, F.when(F.col("fmt_") == "", F.lit("")).otherwise(F.concat(joined, F.lit("\n")))).drop("fmt_", "kept_")


def format_flags(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row per departure from the manuscript format: columns of docs without the text, subtype, line, value, actual, expected (counts; null where there are none)."""
    rest = [c for c in docs.columns if c != text]
    rows = docs.withColumn("all_", F.split(normalize_newlines(F.coalesce(F.col(text), F.lit(""))), "\n", -1))
    # a final line feed ends the last line
    last = F.get("all_", F.size("all_") - 1)
    rows = rows.withColumn("all_", F.when(last == "", F.slice("all_", 1, F.size("all_") - 1)).otherwise(F.col("all_")))
    rows = rows.withColumn("n_", F.size("all_")).withColumn("kept_", lines_with_kind(F.array_join("all_", "\n")))
    flag = lambda subtype, line, value, actual=None, expected=None: F.struct(F.lit(subtype).alias("subtype"), line.cast("long").alias("line"), value.alias("value"), (F.lit(None) if actual is None else actual).cast("long").alias("actual"), F.lit(expected).cast("long").alias("expected"))

    def own(x: Column, i: Column) -> Column:
        after, prev = F.get("kept_", i + 1), F.get("kept_", i - 1)
        head = x.kind == "chapter_heading"
        under = F.coalesce(after.no, F.col("n_") + 1) - x.no - 1
        plain = lambda k: (k == "dialogue") | (k == "narration")
        gap = x.no - prev.no - 1
        wanted = F.when(prev.kind == x.kind, 0).otherwise(1)
        spaced = flag("dialogue_narration_spacing", x.no, x.value, gap)
        return F.array_compact(
            F.array(
                F.when(head & ~x.value.startswith("ⓚ"), flag("chapter_heading_missing_k", x.no, x.value)),
                F.when(head & (under != 3), flag("chapter_heading_blank_lines", x.no, x.value, under, 3)),
                F.when(x.line.contains('"'), flag("straight_double_quote", x.no, x.value)),
                F.when(style_quotes(x.line) > 0, flag("straight_single_quote", x.no, x.value, style_quotes(x.line))),
                F.when(x.line.rlike(r"\.{3,}"), flag("ascii_ellipsis", x.no, x.value)),
                F.when((i > 0) & plain(x.kind) & plain(prev.kind) & (gap != wanted), spaced.withField("expected", wanted.cast("long"))),
            )
        )

    found = F.flatten(F.transform("kept_", own))
    return rows.select(*rest, F.explode(found).alias("f")).select(*rest, "f.*")
