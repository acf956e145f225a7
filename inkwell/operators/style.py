"""Style-risk features, their composite, and the scan for surface remains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import count_of, lines_of, round_at, sentences_of, strip
from . import metrics, rules

_TALL = ("feature", "score", "weight", "value", "hits")


def density_features(docs: DataFrame, key: str, text: str = "text", most: int = 8) -> DataFrame:
    """A row per document and term list: feature, score, weight, value (per 10,000 characters), hits, evidence (the most frequent terms, "term:n"). One projection."""
    size = F.greatest(F.length(text) / 10000, F.lit(1.0))
    rows = docs.select(key, text).withColumn("size_", size)
    structs = []
    for i, (name, (terms, weight, full)) in enumerate(rules.DENSITIES.items()):
        rows = rows.withColumn(f"c{i}", F.array(*[F.struct((-count_of(F.col(text), t)).alias("n"), F.lit(j).alias("j"), F.lit(t).alias("term")) for j, t in enumerate(terms)]))
        hits = -F.aggregate(f"c{i}", F.lit(0).cast("long"), lambda a, x: a + x.n)
        rows = rows.withColumn(f"h{i}", hits).withColumn(f"v{i}", round_at(F.col(f"h{i}") / F.col("size_"), 3))
        score = round_at(F.least(F.greatest(F.col(f"v{i}") / full * weight, F.lit(0.0)), F.lit(float(weight))), 1)
        top = F.transform(F.slice(F.array_sort(F.filter(f"c{i}", lambda x: x.n < 0)), 1, most), lambda x: F.concat(x.term, F.lit(":"), (-x.n).cast("string")))
        structs.append(F.struct(F.lit(name).alias("feature"), score.alias("score"), F.lit(float(weight)).alias("weight"), F.col(f"v{i}").alias("value"), F.col(f"h{i}").alias("hits"), F.array_join(top, ",").alias("evidence")))
    return rows.select(key, F.inline(F.array(*structs)))


def style_features(docs: DataFrame, key: str) -> DataFrame:
    """The eight features of each document, tall: key, feature, score, weight, value, hits. A feature with too little text has no row."""
    terms = density_features(docs, key).select(key, *_TALL)
    none = F.lit(None).cast("long")
    repeats = [
        metrics.repetition(docs, key, last=last, weight=w).select(key, F.lit(n).alias("feature"), "score", F.lit(w).alias("weight"), F.round(F.col("surplus") * 100.0 / F.col("sentences"), 3).alias("value"), F.col("surplus").alias("hits"))
        for last, w, n in ((False, 14.0, "sentence_starter_repetition"), (True, 10.0, "sentence_ending_repetition"))
    ]
    even = metrics.length_uniformity(docs, key).select(key, F.lit("sentence_length_uniformity").alias("feature"), "score", F.lit(8.0).alias("weight"), F.col("cv").alias("value"), none.alias("hits"))
    bricks = metrics.brick_lines(docs, key).select(key, F.lit("brick_line_density").alias("feature"), "score", F.lit(6.0).alias("weight"), F.col("density").alias("value"), F.col("bricks").alias("hits"))
    return reduce(DataFrame.unionByName, [terms, *repeats, even, bricks])


def style_summary(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The composite per document: score 0 to 100, probability 3 to 95, band, confidence by size, the four strongest features, all term hits and their density."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "feature")
    ranked = style_features(docs, key).withColumn("i", F.row_number().over(order))
    total = ranked.groupBy(key).agg(
        F.sum("score").alias("sum_"), F.sum(F.when(F.col("feature").isin(*rules.DENSITIES), F.col("hits"))).alias("total_hits"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("i") <= 4) & (F.col("score") > 0), F.struct("i", "feature")))), lambda x: x.feature), ",").alias("top_features"),
    )
    score = F.least(F.greatest(F.rint(F.round("sum_", 6)), F.lit(0.0)), F.lit(100.0)).cast("long")
    sizes = docs.select(key, F.length(text).cast("long").alias("chars"), F.size(sentences_of(F.col(text))).cast("long").alias("sentences"))
    out = sizes.join(total.withColumn("score", score), key)
    band = F.when(F.col("score") >= 75, "Very High").when(F.col("score") >= 50, "High").when(F.col("score") >= 25, "Medium").otherwise("Low")
    sure = F.when((F.col("chars") >= 80000) & (F.col("sentences") >= 500), "High").when((F.col("chars") >= 20000) & (F.col("sentences") >= 150), "Medium").otherwise("Low")
    return out.select(
        key, "chars", "sentences", "score", F.least(F.greatest("score", F.lit(3)), F.lit(95)).cast("long").alias("probability"), band.alias("band"), sure.alias("confidence"),
        "total_hits", F.round(F.col("total_hits") / F.greatest(F.col("chars") / 10000, F.lit(1.0)), 3).alias("density"), "top_features",
    )


def surface_scan(docs: DataFrame, key: str, text: str = "text", most: int = 5) -> DataFrame:
    """A row per document and signal type, also with none: n (matches over all lines) and the first lines that match, number and stripped text. One projection."""
    rows = docs.select(key, lines_of(F.col(text)).alias("rows_"))
    rows = rows.withColumn("rows_", F.transform("rows_", lambda x, i: F.struct((i + 1).alias("line"), x.alias("text"))))
    def signal(name: str, pattern: str):
        hit = F.filter("rows_", lambda x: x.text.rlike(pattern))
        n = F.aggregate("rows_", F.lit(0).cast("long"), lambda a, x: a + F.regexp_count(x.text, F.lit(pattern)))
        examples = F.transform(F.slice(hit, 1, most), lambda x: F.struct(x.line.alias("line"), strip(x.text).alias("text")))
        return F.struct(F.lit(name).alias("signal_type"), n.alias("n"), examples.alias("examples"))

    return rows.select(key, F.inline(F.array(*[signal(k, f"(?U){p}") for k, p in rules.SURFACE.items()])))
