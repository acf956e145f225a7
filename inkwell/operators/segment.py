"""Documents to lines, sentences and chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines_of, sentences_of
from .headings import chapters

__all__ = ["chapters", "lines", "sentences"]


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row per line: the columns of docs without the text, line_no from 1, line. Null and empty texts have none."""
    return docs.select(*[c for c in docs.columns if c != text], F.posexplode(lines_of(F.col(text))).alias("pos", "line")).withColumn("line_no", F.col("pos") + 1).drop("pos")


def sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(*[c for c in docs.columns if c != text], F.posexplode(sentences_of(F.col(text))).alias("sentence_no", "sentence"))
