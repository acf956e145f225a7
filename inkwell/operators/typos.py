"""Proofreading candidates per line: surface rules, words that context decides, typography and quote balance. One projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import curly_quotes, ellipsis, strip, style_quotes
from . import rules
from .segment import lines

CONFIDENCE_FLOOR = 95


def quote_issues(line: Column) -> Column:
    """The quote checks that a line fails, in order, joined by commas; empty if none."""
    double = F.regexp_count(line, F.lit('"'))
    checks = (
        (double > 0, "straight_double_quote_style"),
        (style_quotes(line) > 0, "straight_single_quote_style"),
        (double % 2 == 1, "odd_ascii_quote_count"),
        (F.regexp_count(line, F.lit("“")) != F.regexp_count(line, F.lit("”")), "curly_quote_imbalance"),
        (line.endswith("“"), "line_ends_with_open_quote"),
        (line.contains('”"') | line.contains('"”'), "mixed_closing_quotes"),
    )
    return F.concat_ws(",", *[F.when(c, F.lit(name)) for c, name in checks])


def contextual_typos(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of docs without the text, line_no, subtype, value, severity, replacement, context (240 characters), confidence_floor; a row per rule that a line meets."""
    rest = [c for c in docs.columns if c != text]
    rows = lines(docs, text).withColumn("line", strip(F.col("line"))).where("line != ''")
    rows = rows.withColumn("quotes_", quote_issues(F.col("line")))
    line = F.col("line")
    row = lambda subtype, value, severity, replacement: F.struct(F.lit(subtype).alias("subtype"), value.alias("value"), severity.alias("severity"), replacement.alias("replacement"))
    dots = F.regexp_extract(line, r"\.{3,}", 0)
    gap = F.regexp_extract(line, f"(?U){rules.NUMERIC_GAP}", 0)
    found = [F.when(line.rlike(f"(?U){p}"), row(s, F.lit(v), F.lit(level), F.lit(new))) for s, v, new, p, level in rules.PROOFREAD]
    found += [
        F.when(line.rlike(f"(?U){rules.EMBRACE}"), row("product_vs_chest", F.lit("제품에"), F.lit("P2"), F.lit("품에"))),
        F.when(gap != "", row("numeric_shape_homograph", gap, F.when(line.rlike(rules.NIB), "P2").otherwise("P3"), F.lit("일자형 틈새"))),
        F.when(line.contains("튀어 나왔다"), row("compound_spacing", F.lit("튀어 나왔다"), F.lit("P3"), F.lit("튀어나왔다"))),
        F.when(dots != "", row("ascii_ellipsis", dots, F.lit("P3"), ellipsis(dots))),
        F.when(F.col("quotes_") != "", row("quote_balance", F.col("quotes_"), F.lit("P3"), curly_quotes(line))),
    ]
    out = rows.select(*rest, "line_no", F.left(line, F.lit(240)).alias("context"), F.explode(F.array_compact(F.array(*found))).alias("f"))
    return out.select(*rest, "line_no", "f.*", "context", F.lit(CONFIDENCE_FLOOR).alias("confidence_floor"))
