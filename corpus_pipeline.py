"""The corpus pipeline: toxicity, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, best-fit packing.

Each stage takes the rows that its predecessor kept and returns the columns of documents; the last returns packed pieces. Rejected: documents
scored toxic; all but the smallest id of each group of near copies (five words, similarity 0.8 or more); bytes of 100-byte strings
that stand earlier (a text keeps its other characters; one cut inside a character loses it whole); documents contaminated by a benchmark. Null ids,
null and empty texts pass every stage and are packed as empty documents. Each stage begins with the executors' heaps freed of what the stage before left there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.common import free_heaps, staged, table
from inkwell.llm.decontaminate import decontaminate
from inkwell.llm.jaccard_join import jaccard_components
from inkwell.llm.packing import byte_bpe, pack
from inkwell.llm.substring_dedup import remove_repeats
from inkwell.llm.toxicity import score_toxicity, toxicity_model

BROADCAST_ROWS = 1_000_000


def _with_row(docs: DataFrame) -> DataFrame:
    """(row, text): all columns in one, carried through an operator as its id."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), "text")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_heaps(spark)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(_with_row(docs), model, id_col="row").where("score < 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_heaps(spark)
    found = jaccard_components(docs, shingle=5, threshold=(80, 100))
    later = staged(found.where("doc_id != component").select("doc_id").distinct(), "near-copies")
    few = later.count() <= BROADCAST_ROWS  # 8 MB of ids; else both sides are dealt by id
    return docs.join(F.broadcast(later) if few else later, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_heaps(spark)
    whole = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = remove_repeats(docs.withColumn("no_text", F.col("text").isNull()), as_text=True)
    text = F.when(~F.col("row.no_text"), F.col("kept"))
    cut = out.select(*[F.col(f"row.{c}").alias(c) for c in whole], text.alias("text"), F.col("row.n_chars").alias("n_chars_"), "n_removed")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars_"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_heaps(spark)
    return decontaminate(_with_row(docs), table(spark, sf_dir, "benchmark"), id_col="row").where("not contaminated").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_heaps(spark)
    return pack(docs, tokenizer=byte_bpe())


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: None: language models, tokenization and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
