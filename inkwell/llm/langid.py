"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (made from its code point, so that no table is kept). An n-gram's vector binds (multiplies) its letters'
vectors, each permuted (rotated) by its place; a text's vector bundles (adds) the vectors of its n-grams; a language's prototype bundles
its training texts. Prototypes are normalised and centred (their mean is what all languages share); a text gets the language of the largest cosine.

The table of n-gram counts of a slice of texts is built in pieces of bounded size, for any number of texts and distinct letters. Texts are lower-cased; all that is not a letter parts words and is one boundary symbol. Both passes are plain maps; training sends one integer vector per task
and language, so its sums are exact and do not depend on how the rows are dealt.

Defined results: `und` and score 0 where the text is null or has no letter, or where nothing was learned; rows without a language are not
learned from; equal cosines go to the language that sorts first; a null id counts as not held out and is not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table

DIMENSIONS = 512
GRAM = 3
_U = np.uint64
_tables: dict[str, np.ndarray] = {}


def _letters(n: int = 0x110000) -> np.ndarray:
    if "alpha" not in _tables:
        _tables["alpha"] = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
    return _tables["alpha"]


def letter_vectors(codes: np.ndarray, d: int = DIMENSIONS) -> np.ndarray:
    """A row of +1 and -1 for each code point."""
    x = codes.astype(np.uint64)[:, None] * _U(0x9E3779B97F4A7C15) + np.arange(1, d // 64 + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(by)
    x ^= x >> _U(31)
    return np.unpackbits(x.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def text_vectors(texts: list[str], groups: np.ndarray | None = None, d: int = DIMENSIONS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text (or of each group of texts), and whether it has a letter."""
    groups = np.arange(len(texts)) if groups is None else groups
    n_out = int(groups.max()) + 1 if len(groups) else 0
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(f"{t}\n" for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    alpha = _letters()[points]
    some = np.zeros(n_out, bool)
    some[groups[doc[alpha]]] = True
    points = np.where(alpha, points, 0)
    first = np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0))) & (np.concatenate(([False], doc[1:] == doc[:-1])) | alpha) if len(points) else np.zeros(0, bool)
    # boundaries after the last text too, so that a text's n-grams do not depend on what follows it
    points, doc = np.concatenate((points[first], np.zeros(gram - 1, np.int64))), np.concatenate((doc[first], np.full(gram - 1, len(texts))))
    letters, compact = np.unique(points, return_inverse=True)
    k = len(letters)
    n = len(points) - gram + 1
    owner = groups[doc[:n]]
    # within one text: the last sign of an n-gram may stand behind the text and is then a boundary, whatever follows
    inside = doc[gram - 1 :] == doc[:n]
    closing = ~inside & (doc[gram - 2 : len(points) - 1] == doc[:n])
    use = np.flatnonzero(inside | closing)
    if letters[0] == 0:
        last = np.where(closing, 0, compact[gram - 1 :])
    else:
        last = compact[gram - 1 :]
    columns = [(compact[j : n + j] if j < gram - 1 else last)[use] for j in range(gram)]
    code, size = columns[0], k
    for c in columns[1:]:
        if size * k >= 1 << 62:  # as many numbers as are in use
            held, code = np.unique(code, return_inverse=True)
            size = len(held)
        code, size = code * k + c, size * k
    owner = owner[use]
    order = np.argsort(code, kind="stable")
    code = code[order]
    new = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    ends, head = np.concatenate((new[1:], [len(code)])), order[new]
    out = np.zeros((n_out, d), np.float32)
    own = letter_vectors(letters, d)
    own[letters == 0] = np.abs(own[letters == 0])
    turned = [np.roll(own, gram - 1 - j, axis=1) for j in range(gram)] if k * d <= 1 << 24 else None
    step = max(256, min(8192, (1 << 22) // max(1, n_out)))  # the table of counts is bounded by 32 MB
    for i in range(0, len(new), step):
        vectors = None
        for j in range(gram):
            pick = columns[j][head[i : i + step]]
            v = turned[j][pick] if turned else np.roll(own[pick], gram - 1 - j, axis=1)
            vectors = v if vectors is None else vectors * v
        a, b = new[i], ends[min(i + step, len(new)) - 1]
        place = np.repeat(np.arange(len(vectors)), (ends - new)[i : i + step])
        counts = np.bincount(owner[order[a:b]] * len(vectors) + place, minlength=n_out * len(vectors)).reshape(n_out, len(vectors))
        out += counts.astype(np.float32) @ vectors.astype(np.float32)
    return out, some


def learn(rows: DataFrame, d: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Centred unit prototypes by language from rows of (lang, text). One row of d numbers per language comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in chunks(batches, "text", 1 << 20, rows=16384):
            langs, groups = np.unique(np.array(part.column("lang").to_pylist(), object), return_inverse=True)
            vectors, _ = text_vectors([t or "" for t in part.column("text").to_pylist()], groups, d)
            for lang, v in zip(langs, vectors, strict=True):
                sums[lang] = sums.get(lang, 0) + v.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "v"])

    partial = rows.mapInArrow(run, "lang string, v array<long>")
    total = partial.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v"))
    found = {r.lang: np.array([x.x for x in r.v], np.float64) for r in total.collect()}
    unit = {k: v / (np.linalg.norm(v) or 1.0) for k, v in found.items()}
    if len(unit) > 1:
        mean = np.mean(list(unit.values()), axis=0)
        unit = {k: v - mean for k, v in unit.items()}
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(unit.items())}


def identify(docs: DataFrame, train: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of docs: id, lang_pred, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    learned = learn(train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))
    names = np.array([*learned], object)
    prototypes = np.array([*learned.values()], np.float32).reshape(len(names), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 1 << 19, rows=2048):
            vectors, some = text_vectors([t or "" for t in part.column("text").to_pylist()])
            pred, score = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
            if len(names):
                cosine = vectors @ prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
                pred = np.where(some, names[cosine.argmax(axis=1)], "und")
                score = np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(pred.tolist(), pa.string()), pa.array(score.astype(np.float64))], ["id", "lang_pred", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    out = identify(docs, docs.where(~held))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
