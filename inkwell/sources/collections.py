"""Folders as one work, the XML part of HWP documents, and JSON lines counted."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import lines_of, natural_key, strip
from ..operators.headings import is_heading, is_plain_number


def begins_with_heading(text: Column) -> Column:
    return F.exists(F.slice(lines_of(text), 1, 5), lambda x: is_heading(x) | is_plain_number(x))


def folder_texts(files: DataFrame, work: str, name: str, text: str = "text") -> DataFrame:
    """(work, text, documents): the files of a folder as one text, in natural order of their names, parted by an empty line. Files without text are left out but
    count for the number in the heading that a file without one gets. A folder's files meet in one task: they are one text in the end."""
    body = strip(F.coalesce(F.col(text), F.lit("")))
    rows = files.select(work, F.struct(natural_key(F.col(name)).alias("k"), F.col(name).alias("n"), body.alias("body"), begins_with_heading(body).alias("headed")).alias("f"))
    parts = rows.groupBy(work).agg(F.array_sort(F.collect_list("f")).alias("f"))
    headed = F.transform("f", lambda x, i: F.when(x.body == "", F.lit(None).cast("string")).when(x.headed, x.body).otherwise(F.concat(F.lit("ⓚ제"), (i + 1).cast("string"), F.lit("화\n"), x.body)))
    return parts.select(work, F.array_join(F.array_compact(headed), "\n\n").alias("text"), F.size("f").cast("long").alias("documents"))


@F.pandas_udf(StringType())
def hwp_xml_text(documents: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The text of an HWP document's XML: a line per paragraph and per line break in it. Null where the XML can't be read, empty without a body."""
    import xml.etree.ElementTree as ET

    name = lambda e: e.tag.rpartition("}")[2].lower()

    def lines(paragraph) -> Iterator[str]:
        held, any_ = [], False
        for e in paragraph.iter():
            control = (e.attrib.get("name") or "").upper() if name(e) == "controlchar" else ""
            if name(e) == "text":
                held.append(e.text or "")
            elif control == "LINE_BREAK":
                yield "".join(held)
                held = []
            any_ = any_ or name(e) == "text" or control in ("LINE_BREAK", "PARAGRAPH_BREAK")
        if any_:
            yield "".join(held)

    def text(document: str | None) -> str | None:
        if document is None:
            return None
        try:
            root = ET.fromstring(document.encode("utf-8"))
        except ET.ParseError:
            return None
        body = next((e for e in root.iter() if name(e) == "bodytext"), None)
        return "" if body is None else "\n".join(x for p in body.iter() if name(p) == "paragraph" for x in lines(p)).strip()

    for part in documents:
        yield part.map(text, na_action=None)


def jsonl_counts(rows: DataFrame, work: str, value: str = "value") -> DataFrame:
    """Per work: lines that are not blank, and of these the possible conflicts and the checkpoints by `kind`; a line that is no JSON counts for the total only."""
    found = rows.where(F.col(value).rlike(r"\S")).select(work, F.expr(f"try_variant_get(try_parse_json({value}), '$.kind', 'string')").alias("kind"))
    return found.groupBy(work).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("kind") == "possible_internal_action_conflict").alias("conflicts"), F.count_if(F.col("kind") == "state_trace_checkpoint").alias("checkpoints"))
