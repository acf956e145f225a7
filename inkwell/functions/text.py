"""Column functions on manuscript text (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ranges(codes: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return out


#: White space as members of a character class, for Java and RE2 alike: within a line, and with the line feed and carriage return.
INLINE = "\t\x0b\x0c\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = INLINE + "\r\n"
#: The space signs, which part words and no lines; as single characters.
SPACES = " \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
#: Letters whose upper case is more than one letter (ß: SS); few ranges, since a class is tried range by range.
GROWING = "".join(f"{chr(a)}-{chr(b)}" for a, b in _ranges([c for c in range(0x10000) if len(chr(c).upper()) > 1]))


def strip(text: Column) -> Column:
    """Without white space (any of Unicode's) at both ends."""
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


def upper_each(text: Column) -> Column:
    """Upper case, a letter for a letter, to look for terms in; a letter whose upper case is several gives a sign that is in no term."""
    return F.upper(F.regexp_replace(text, f"[{GROWING}]", "\u0001"))


def round_at(value: Column, digits: int) -> Column:
    """Rounded half away from zero, as value * 10^digits stands in binary: 0.525 / 14 * 12, a hair below 0.45, gives 0.5 and not, by its decimal digits, 0.4."""
    scale = F.lit(10.0**digits)
    return F.round(value * scale, 0) / scale


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def lines_of(text: Column) -> Column:
    """Lines without the empty piece that follows a final newline."""
    pieces = F.split(normalize_newlines(F.coalesce(text, F.lit(""))), "\n")
    return F.when(F.get(pieces, F.size(pieces) - 1) == "", F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))).otherwise(pieces)


def clean_inline(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def sentences_of(text: Column) -> Column:
    """Cleaned sentences of 8 to 240 characters: cut after terminators and at newlines."""
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "([.!?。？！])", "$1\n"), "[\r\n]+")
    return F.filter(F.transform(cut, clean_inline), lambda s: F.length(s).between(8, 240))


def no_space_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))


def ellipsis(text: Column) -> Column:
    """Runs of three or more ASCII dots become one ellipsis sign per three dots, rounded; a sentinel keeps existing signs apart."""
    s = "\u0001"
    out = text
    for a, b in (("...", s), (f"{s}..", s + s), (f"{s}.", s), (s, "…")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def style_quotes(text: Column) -> Column:
    """How many single quotes do not stand between two ASCII letters."""
    return F.regexp_count(text, F.lit("(?<![A-Za-z])'|'(?![A-Za-z])"))


def curly_quotes(text: Column) -> Column:
    """Straight quotes to curly ones, opening and closing by turns; double and single ones apart, apostrophes stay."""
    masked = F.regexp_replace(text, "(?<=[A-Za-z])'(?=[A-Za-z])", "\u0002")

    def by_turns(value: Column, straight: str, opening: str, closing: str) -> Column:
        mark = lambda i: F.when(i == 0, F.lit("")).when(i % 2 == 1, F.lit(opening)).otherwise(F.lit(closing))
        return F.array_join(F.transform(F.split(value, straight), lambda p, i: F.concat(mark(i), p)), "")

    return F.replace(by_turns(by_turns(masked, '"', "“", "”"), "'", "‘", "’"), F.lit("\u0002"), F.lit("'"))


def natural_key(name: Column) -> Column:
    """Sorts digit runs by value: each padded to 20 digits, the rest in lower case. A longer run (without leading zeros) is kept whole behind nines and its length, so that
    longer numbers sort later and no two share a key."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+", "")
        long = F.concat(F.lit("9" * 20), F.lpad(F.length(bare).cast("string"), 10, "0"), bare)
        return F.when(~p.rlike(r"^\d"), p).when(F.length(bare) > 20, long).otherwise(F.lpad(bare, 20, "0"))

    return F.array_join(F.transform(parts, key), "")


def slug(title: Column) -> Column:
    out = F.regexp_replace(F.lower(F.trim(title)), r"\s+", "-")
    out = F.regexp_replace(F.regexp_replace(out, "[^0-9A-Za-z가-힣_.-]", ""), "-{2,}", "-")
    return F.regexp_replace(out, "^[-.]+|[-.]+$", "")


def hangul_ratio(text: Column) -> Column:
    hangul, latin = F.regexp_count(text, F.lit("[가-힣]")), F.regexp_count(text, F.lit("[A-Za-z]"))
    return F.round(hangul / F.greatest(hangul + latin, F.lit(1)), 3)


def occurrences(text: Column, needle: str | Column) -> Column:
    """0-based positions of all non-overlapping occurrences; a null or empty needle has none."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    quoted = F.concat(F.lit(r"\Q"), F.replace(needle, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    parts = F.when(F.length(needle) > 0, F.split(text, quoted, F.lit(-1))).otherwise(F.array(text))
    heads = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    n = F.length(needle)
    return F.aggregate(heads, start, lambda acc, p: F.struct((acc.at + F.length(p) + n).alias("at"), F.concat(acc.found, F.array(acc.at + F.length(p))).alias("found")), lambda acc: acc.found)


def count_of(text: Column, term: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / F.lit(len(term))).cast("long")


def unescape_common(text: Column) -> Column:
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def html_body(html: Column) -> Column:
    """Body text of possibly broken HTML by patterns alone: what is no text goes, block tags part lines, the common entities are decoded, blank lines go."""
    out = F.regexp_replace(html, r"(?is)<(head|script|style|svg|nav|header|footer|aside)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)</?(?:p|div|h[1-6]|li|ul|ol|br|tr|table|blockquote|section|article|body)\b[^>]*>", "\n")
    out = F.regexp_replace(out, "<[^>]+>", "")
    return F.array_join(F.filter(F.transform(F.split(unescape_common(out), "\n"), clean_inline), lambda x: x != ""), "\n")
