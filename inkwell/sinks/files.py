"""Results as files: JSON documents, JSON lines, a text file per chapter, templates and sections of reports. All are written by Spark to any path that it can reach."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, strip


def write_jsonl(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """One JSON object per line, nulls kept, in folders by the columns of `by`; what was there before is replaced."""
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(*by) if by else w).json(path)


def write_json(df: DataFrame, key: str, path: str) -> None:
    """One JSON document per row, as text files in folders by key."""
    rest = [c for c in df.columns if c != key]
    df.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def safe_name(name: Column) -> Column:
    """A name for a file: other signs become _, none at the ends; episode if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(name, "[^0-9A-Za-z가-힣_.-]+", "_"), "^[_.-]+|[_.-]+$", "")
    return F.when(out != "", out).otherwise("episode")


def write_chapters(chapters: DataFrame, path: str) -> None:
    """A text per chapter (work_id, episode, text) in folders work_id=/episode=; chapters of an earlier run are gone."""
    out = chapters.select("work_id", safe_name(F.col("episode")).alias("episode"), strip(F.col("text")).alias("value"))
    out.write.mode("overwrite").partitionBy("work_id", "episode").text(path)


def render_template(template: Column, values: dict[str, Column]) -> Column:
    """A template with each {{key}} replaced, one key after the other in the given order."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{{" + key + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def upsert_section(report: Column, section: Column, start: str, end: str, before: tuple[str, ...] = ()) -> Column:
    """A report with the section between its two marks: in place of the one there, else before the first heading of `before` that it has, else at its end."""
    block = F.concat(F.lit(start + "\n"), section, F.lit("\n" + end))
    trimmed = lambda x: F.regexp_replace(x, f"[{SPACE}]+\\z", "")
    quoted = "(?s)\\Q" + start + "\\E.*?\\Q" + end + "\\E"
    out = F.concat(trimmed(report), F.lit("\n\n"), block, F.lit("\n"))
    for heading in reversed(before):
        at = F.locate("\n" + heading, report)
        placed = F.concat(trimmed(F.substring(report, F.lit(1), at - 1)), F.lit("\n\n"), block, F.lit("\n"), F.regexp_replace(F.substring(report, at, F.length(report)), "^\n+", ""))
        out = F.when(at > 0, placed).otherwise(out)
    literal = F.replace(F.replace(block, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(report.contains(start) & report.contains(end), F.regexp_replace(report, F.lit(quoted), literal)).otherwise(out)


def html_table(rows: DataFrame, by: str, columns: list[str], order: str) -> DataFrame:
    """(by, html): a table per group with a row per row, in order, cells escaped. A group's rows are one document, so they meet in one task; keep groups to a report's size."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), escaped(c), F.lit("</td>")) for c in columns], F.lit("</tr>"))
    head = "<table><tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in columns) + "</tr>"
    found = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, row.alias("r")))).alias("rows"))
    return found.select(by, F.concat(F.lit(head), F.array_join(F.transform("rows", lambda x: x.r), ""), F.lit("</table>")).alias("html"))
