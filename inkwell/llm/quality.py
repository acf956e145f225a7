"""Document quality by a generalised additive model with pairwise interactions.

Features are bounded counts and shares of the whole text. Training (on a bounded sample of labelled rows, ``sample_rows``) bins each feature by quantiles
and boosts cyclically: in each cycle every feature in turn gets a shallow tree over its bins (three cuts at most) fitted to the logistic loss's residuals, added to its lookup table at
a small rate. Then the pairs of features whose best two-way cut explains most of what is left get grids, boosted the same way. A score is the
logistic of the intercept and the looked-up bins, added for whole batches.

Defined results: null and empty texts have all-zero features and get a score like any other; without labelled rows, or with one class, every score is the share of label 1 (0.5 if none);
repeated rows are scored row by row; null ids are scored, never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table
from .toxicity import labelled_sample

SAMPLE_ROWS = 20_000
FEATURES = ("words", "word_length", "symbols", "upper", "digits", "pipes", "exclaims", "punctuation", "distinct", "repeats", "line_repeats", "line_length", "non_ascii", "spaces")
BINS = 32
CYCLES = 200
PAIRS = 6
RATE = 0.15

_CLASS = np.zeros((256, 8), np.float64)
for _i, _chars in enumerate((b"#$%&*@^~_=<>\\{}[]+", bytes(range(65, 91)), b"0123456789", b"|", b"!", b".,;:?'\"()-", bytes(range(128, 256)), b" \t\n\r\x0b\x0c")):
    _CLASS[list(_chars), _i] = 1


def features(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        if not text:
            continue
        symbols, upper, digits, pipes, bangs, punct, high, space = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / len(text)
        words, lines = text.split(), text.split(b"\n")
        n = len(words)
        out[i] = (
            np.log1p(n), len(text) / max(1, n), symbols, upper, digits, pipes, bangs, punct, len(set(words)) / max(1, n) * min(1.0, np.log1p(n) / 8 + 0.2), sum(map(eq, words, words[1:])) / max(1, n),
            1 - len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)), high, space,
        )
    return out


class Additive:
    """Lookup tables per feature and per pair of features over common bins."""

    def __init__(self, edges: list[np.ndarray], intercept: float, single: np.ndarray, pairs: dict[tuple[int, int], np.ndarray]):
        self.edges, self.intercept, self.single, self.pairs = edges, intercept, single, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.single):
            z += t[b[:, j]]
        for (j, k), t in self.pairs.items():
            z += t[b[:, j], b[:, k]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, cuts: int = 3) -> np.ndarray:
    """Leaf values by bin: the best cuts one after the other, on sums of gradients and curvatures by bin."""
    parts = [(0, len(g))]
    G, H = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    for _ in range(cuts):
        best = (1e-6, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = _gain(G[m] - G[a], H[m] - H[a]) + _gain(G[b] - G[m], H[b] - H[m]) - _gain(G[b] - G[a], H[b] - H[a])
            i = int(gain.argmax())
            best = max(best, (float(gain[i]), (a, b), int(m[i])), key=lambda x: x[0])
        if best[1] is None:
            break
        (a, b), m = best[1], best[2]
        parts = [p for p in parts if p != (a, b)] + [(a, m), (m, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both features at once: its gain and the leaf values on the grid."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = G[-1, -1], H[-1, -1]
    a = _gain(G, H)
    b = _gain(G[:, -1:] - G, H[:, -1:] - H)
    c = _gain(G[-1:, :] - G, H[-1:, :] - H)
    d = _gain(tg - G[:, -1:] - G[-1:, :] + G, th - H[:, -1:] - H[-1:, :] + H)
    gain = a + b + c + d - _gain(tg, th)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = BINS, cycles: int = CYCLES, pairs: int = PAIRS, rate: float = RATE) -> Additive:
    d = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(d)]
    share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    model = Additive(edges, float(np.log(share / (1 - share))), np.zeros((d, bins + 1)), {})
    if not len(y) or y.min() == y.max():
        return model
    b = model.bins(x)
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for j in range(d):
            g, h = slopes()
            step = rate * np.clip(_tree(np.bincount(b[:, j], g, bins + 1), np.bincount(b[:, j], h, bins + 1)), -4, 4)
            model.single[j] += step
            z += step[b[:, j]]
    grid = lambda j, k, v: np.bincount(b[:, j] * (bins + 1) + b[:, k], v, (bins + 1) ** 2).reshape(bins + 1, bins + 1)
    g, h = slopes()
    ranked = sorted(combinations(range(d), 2), key=lambda jk: -_quadrants(grid(*jk, g), grid(*jk, h))[0])[:pairs]
    model.pairs = {jk: np.zeros((bins + 1, bins + 1)) for jk in ranked}
    for _ in range(cycles // 4):
        for j, k in ranked:
            g, h = slopes()
            step = rate * np.clip(_quadrants(grid(j, k, g), grid(j, k, h))[1], -4, 4)
            model.pairs[j, k] += step
            z += step[b[:, j], b[:, k]]
    return model


def quality_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 4 << 20):
            x = features([t.encode() for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["y", "x"])

    sample = labelled_sample(docs, labels, "quality", "crc32(cast(doc_id as string)) % 4 != 2", sample_rows)
    rows = sample.mapInArrow(run, "y int, x array<double>").collect()  # at most sample_rows, a few numbers each
    rows.sort(key=lambda r: (r.x, r.y))
    return fit(np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r.y for r in rows], float))


def score_quality(docs: DataFrame, model: Additive, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 4 << 20):
            x = features([(t or "").encode("utf-8", "replace") for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(shipped.value.score(x))], ["id", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
