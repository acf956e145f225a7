"""Documents from files: one scan of a folder, a row per file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "cp949", "euc-kr", "utf-16", "utf-16-le", "utf-16-be")
# End of the fixed values.
SCHEMA = "path string, modificationTime timestamp, text string"


def decode(content: bytes) -> str:
    """The first encoding that reads the bytes without a replacement sign; else UTF-8 with replacement signs. Newlines become LF."""
    for name in ENCODINGS:
        try:
            text = content.decode(name)
        except UnicodeDecodeError:
            continue
        if "�" not in text:
            break
    else:
        text = content.decode("utf-8", "replace")
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _decoded(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("modificationTime"), pa.array([decode(c or b"") for c in b.column("content").to_pylist()], pa.string())], ["path", "modificationTime", "text"])

    return files.select("path", "modificationTime", "content").mapInArrow(run, SCHEMA)


def text_files(spark: SparkSession, folder: str, pattern: str = "*.{txt,text,md,markdown}") -> DataFrame:
    """(path, modificationTime, text) of the text files in and below a folder, decoded by trial. Spark skips files of no bytes, so they give no row."""
    return _decoded(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder))


def jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON objects as VARIANT, and the lines that are none: (line), both from one text scan; blank lines are skipped."""
    lines = spark.read.text(path).where("trim(value) != ''").withColumn("v", F.try_parse_json("value"))
    good = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    return lines.where(good).select("v"), lines.where(~good).select(F.col("value").alias("line"))
