"""Toxic passages by maximum-scoring segments of token log-odds.

Training (on a bounded sample of labelled rows, ``sample_rows``): in how many toxic and other texts each word, and each beginning of a word, occurs. A unit's toxic share has a
Dirichlet (here Beta) prior whose mean is the share of the next shorter beginning, so rare words lean on their stem and frequent ones
on themselves. A token scores the log-odds of its longest known unit over the base rate, less its standard error, less a penalty that makes
ordinary text negative.

Scoring: a linear-time scan over a text's tokens finds all its maximal scoring segments. Under the null model (other texts of the sample) the best segment of n tokens
follows an extreme-value law with lambda from the token scores' moment equation and K from the mean; a segment counts by
``lambda * score - ln(K * n)``, its evidence. A text's evidence (best, and sum over significant segments) goes through a logistic curve fitted on the sample.

Defined results: null, empty and word-less texts have no segment and the score of no evidence; if the sample lacks a class every score is its share of toxic rows;
repeated rows are scored row by row; a label without text, or a text labelled twice, counts as the join gives it; null ids are scored, never learned from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, frugal, staged, table

SAMPLE_ROWS = 20_000
SHORTEST, LONGEST = 3, 10
PRIOR = 4.0
PENALTY = 0.7
LEAST = 1.0  # smaller estimates count as none, or a repeated ordinary word would add up
MOST = 8.0
MEMO = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def units(words: set[str]) -> set[str]:
    """The words and their beginnings, marked by *."""
    out = set(words)
    for w in words:
        out.update(w[:n] + "*" for n in range(SHORTEST, min(LONGEST, len(w) - 1) + 1))
    return out


class Scores(dict):
    """Token scores, kept for tokens met."""

    def __init__(self, table: dict[str, float]):
        super().__init__()
        self.table = table

    def __missing__(self, w: str) -> float:
        s = self.table.get(w)
        for n in range(min(LONGEST, len(w) - 1), SHORTEST - 1, -1):
            if s is not None:
                break
            s = self.table.get(w[:n] + "*")
        s = min(MOST, s or 0.0) - PENALTY
        if len(self) < MEMO:
            self[w] = s
        return s


def log_odds(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int) -> dict[str, float]:
    """Lower estimates of the log-odds of units, each with its shorter beginning's share as prior mean."""
    base = min(1 - 1e-6, max(1e-6, n_toxic / (n_toxic + n_other)))
    share: dict[str, float] = {}
    out = {}

    def mean(unit: str) -> float:
        stem = unit.rstrip("*")
        for n in range(min(LONGEST, len(stem) - 1), SHORTEST - 1, -1):
            up = share.get(stem[:n] + "*")
            if up is not None:
                return up
        return base

    for u in sorted(toxic, key=lambda u: (len(u.rstrip("*")), not u.endswith("*"), u)):
        a, b, prior = toxic[u], other.get(u, 0), mean(u)
        p = share[u] = min(1 - 1e-6, max(1e-6, (a + PRIOR * prior) / (a + b + PRIOR)))
        error = math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        low = math.log(p / (1 - p)) - math.log(base / (1 - base)) - error
        out[u] = low if low >= LEAST else 0.0
    return out


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score), left to right.

    Linear time: each segment keeps the place of the last one before it with a lower left sum, and a search goes from place to place; what it
    passes over is never looked at again, as later searches go round it.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # start, stop, sum before, sum after, last one with a lower sum before
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low, j = i, before, len(stack) - 1
        while j >= 0 and stack[j][2] >= low:
            j = stack[j][4]
        while j >= 0 and stack[j][3] < total:
            start, _, low, _, up = stack[j]
            del stack[j:]
            j = up
        stack.append((start, i + 1, low, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def _origins(text: str, low: str) -> list[int] | None:
    """For each character of the lower-cased text the one it comes from; None where they are the same."""
    if len(low) == len(text):
        return None
    return [i for i, c in enumerate(text) for _ in c.lower()]


def found(words: list[str], scores: Scores) -> list[tuple[int, int, float]]:
    values = list(map(scores.__getitem__, words))
    if not values or max(values) <= 0:
        return []
    # stretches of ordinary tokens all cost the same: a scan over the positive ones with what lies between
    at = [i for i, v in enumerate(values) if v > 0]
    short, last = [], 0
    for i in at:
        short += [-PENALTY * (i - last), values[i]]
        last = i + 1
    return [(at[a // 2], at[(b - 1) // 2] + 1, s) for a, b, s in segments(short)]


def evidence(segs: list[tuple[int, int, float]], n: int, lam: float, k: float) -> tuple[float, float]:
    cut = math.log(max(k * n, 1e-9))
    bits = [lam * s - cut for _, _, s in segs]
    return max(bits, default=-5.0), sum(b for b in bits if b > 0)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalised weights; the first column is the constant. Newton steps, halved until the penalised likelihood gains: it is concave, so they end at its only maximum,
    also where the classes are fully parted."""
    ridge = np.array([1e-3] + [1e-1] * (x.shape[1] - 1))
    loss = lambda w: float(np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * (ridge * w * w).sum())
    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        size = 1.0
        while size > 1e-9 and not loss(w + size * step) < now:
            size /= 2
        if size <= 1e-9 or slope @ step < 1e-9:
            break
        w = w + size * step
        now = loss(w)
    return w


def _features(top: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(top)), np.clip(top, -5, 20) / 5, np.log1p(total)))


class Model:
    def __init__(self, table: dict[str, float], lam: float, k: float, weights: np.ndarray, base: float | None = None):
        self.table, self.lam, self.k, self.weights, self.base = table, lam, k, weights, base

    def probability(self, top: np.ndarray, total: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(top), self.base)
        return 1 / (1 + np.exp(-np.clip(_features(top, total) @ self.weights, -30, 30)))


def train(rows: DataFrame) -> Model:
    """From a bounded sample of (text, y)."""
    sample = staged(rows, "toxicity-sample")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({}, 1.0, 1.0, np.zeros(3), n1 / max(1, n1 + n0))

    def count(batches: Iterator[pa.RecordBatch], most: int = 100_000) -> Iterator[pa.RecordBatch]:
        c1, c0 = Counter(), Counter()

        def counted() -> pa.RecordBatch:
            names = list(c1.keys() | c0.keys())
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([c1[u] for u in names], pa.int64()), pa.array([c0[u] for u in names], pa.int64())], ["unit", "c1", "c0"])
            c1.clear()
            c0.clear()
            return out

        for b in chunks(batches, "text", 1 << 20):
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                (c1 if y else c0).update(units(set(_WORD.findall((text or "").lower()))))
            if len(c1) + len(c0) > most:  # parts of the counts; they are summed up after
                yield counted()
        yield counted()

    totals = sample.mapInArrow(frugal(count), "unit string, c1 long, c0 long").groupBy("unit").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0")).where("c1 >= 3")
    got = totals.toPandas()  # bounded by the sample
    table = log_odds(dict(zip(got.unit, got.c1, strict=True)), dict(zip(got.unit, got.c0, strict=True)), n1, n0)
    # only beginnings and words that score, and words or longer beginnings under them that do not, make a difference
    scoring = {u.rstrip("*") for u, s in table.items() if s > 0 and u.endswith("*")}
    table = {u: s for u, s in table.items() if s > 0 or any(u[:n] in scoring for n in range(SHORTEST, len(u.rstrip("*")) + 1))}
    shipped = sample.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shipped.value)
        for b in chunks(batches, "text", 1 << 20):
            out = []
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                words = _WORD.findall((text or "").lower())
                hist = Counter(round(max(0.0, scores[w] + PENALTY), 1) for w in words) if not y else Counter()
                segs = found(words, scores)
                out.append((y, len(words), [s for _, _, s in segs], list(hist), list(hist.values())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64())), strict=True)] if out else [pa.array([], t) for t in (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()))], ["y", "n", "s", "v", "c"])

    seen = sample.mapInArrow(frugal(scan), "y int, n long, s array<double>, v array<double>, c array<long>").collect()  # a row per text of the sample
    hist: Counter = Counter()
    for r in seen:
        hist.update(dict(zip(r.v, r.c, strict=True)))
    lam = _lambda(hist)
    null = [(max(r.s, default=0.0), r.n) for r in seen if not r.y and r.n]
    k = math.exp(np.mean([lam * s - math.log(n) for s, n in null]) - 0.5772) if null else 1.0
    ev = np.array([evidence([(0, 0, s) for s in r.s], max(1, r.n), lam, k) for r in seen])
    y = np.array([r.y for r in seen], float)
    return Model(table, lam, k, _logistic(_features(ev[:, 0], ev[:, 1]), y))


def _lambda(hist: Counter) -> float:
    """The positive root of E[exp(lambda * score)] = 1 for the null model's tokens."""
    v = np.array([*hist]) - PENALTY
    p = np.array([*hist.values()], float)
    if not len(v) or v.max() <= 0:
        return 1.0
    p /= p.sum()
    if p @ v >= 0:
        return 0.05
    low, high = 1e-6, 1.0
    while p @ np.exp(high * v) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * v) < 1 else (low, mid)
    return high


def score_toxicity(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, passages (character ranges of significant segments, with their evidence)."""
    kind = docs.schema[id_col].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("evidence", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        scores, cut = Scores(m.table), lambda n: math.log(max(m.k * n, 1e-9))
        for part in chunks(batches, "text", 4 << 20):
            tops, totals, passages = [], [], []
            for text in part.column("text").to_pylist():
                text = text or ""
                low = text.lower()
                words = _WORD.findall(low)
                segs = found(words, scores)
                top, total = evidence(segs, max(1, len(words)), m.lam, m.k)
                tops.append(top)
                totals.append(total)
                some = [(a, b, e) for a, b, s in segs if (e := m.lam * s - cut(max(1, len(words)))) > 0]
                if some:
                    spans, origin = [x.span() for x in _WORD.finditer(low)], _origins(text, low)
                    places = [(spans[a][0], spans[b - 1][1], e) for a, b, e in some]
                    some = [{"start": x if origin is None else origin[x], "stop": y if origin is None else origin[y - 1] + 1, "evidence": e} for x, y, e in places]
                passages.append(some)
            p = m.probability(np.array(tops, float), np.array(totals, float)) if tops else np.zeros(0)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p), pa.array(passages, pa.list_(passage))], ["id", "score", "passages"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(frugal(run), f"id {kind}, score double, passages array<struct<start:int,stop:int,evidence:double>>").withColumnRenamed("id", id_col)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: str, rows: int) -> DataFrame:
    """(text, y) of at most `rows` labelled documents that meet `learn`, the first by a hash of the id; few enough to broadcast their labels."""
    some = labels.where(f"doc_id is not null and {label} in (0, 1) and {learn}").select("doc_id", F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "y")


def toxicity_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    return train(labelled_sample(docs, labels, "toxic", "crc32(cast(doc_id as string)) % 5 != 0", sample_rows))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score_toxicity(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
