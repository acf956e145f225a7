"""The inbox as a stream: new files of a folder, each once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.documents import _decoded


def run_inbox(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern: str = "*.{txt,text,md,markdown}") -> StreamingQuery:
    """Append (path, modificationTime, text) of all files that the checkpoint has not seen to the Parquet table `out`, then stop. Exactly once by the file sink's log."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder)
    return _decoded(files).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
