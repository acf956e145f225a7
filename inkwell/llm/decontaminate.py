"""Benchmark decontamination with an FM-index per shard of the training text.

A shard is a slice of a task's documents. Its text is the sequence of word ids over the benchmark's vocabulary: any other word
ends a stretch, and stretches shorter than the shortest window cannot hold one, so they are left out before the index is built.
The index is the usual one: suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix for ranks, every
``SAMPLE``-th suffix position kept. All windows are searched backward at once (numpy arrays of intervals), their occurrences located by
walking to a sampled position, and the word ranges merged to spans. No shuffle; only the benchmark is shipped to the tasks, one
block of ``block_bytes`` of text at a time.

Words: lower-cased A-Z, then runs of ASCII letters, digits and any non-ASCII characters. Defined results: a null or empty
document has no words, no spans and is not contaminated; a null or empty item has no window; an item with a null id still
marks words but is not listed; repeated items count once by id; repeated documents are judged row by row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, frugal, raw, staged

WINDOW = 13
SAMPLE = 8
SHARD_BYTES = 4 << 20
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_END = b"\xff"  # never part of UTF-8


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Prefix doubling: sort (rank, rank at the offset) pairs until all ranks differ."""
    n, k = len(t), 1
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + after
        sa = np.argsort(key, kind="stable")
        key = key[sa]
        rank[sa] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        if n < 2 or rank[sa[-1]] == n - 1:
            return sa
        k *= 2


class Wavelet:
    """Wavelet matrix over small integers: access and rank for arrays of positions."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.levels = []
        for b in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bit = (s >> b) & 1
            ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
            zeros = len(s) - int(ones[-1])
            self.levels.append((b, ones, zeros))
            s = np.concatenate((s[bit == 0], s[bit == 1]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before position i."""
        p, i = np.zeros_like(i), i.copy()
        for b, ones, zeros in self.levels:
            one = ((c >> b) & 1).astype(bool)
            p = np.where(one, zeros + ones[p], p - ones[p])
            i = np.where(one, zeros + ones[i], i - ones[i])
        return i - p

    def access(self, i: np.ndarray) -> np.ndarray:
        c, i = np.zeros_like(i), i.copy()
        for b, ones, zeros in self.levels:
            one = ones[i + 1] - ones[i]
            c |= one << b
            i = np.where(one == 1, zeros + ones[i], i - ones[i])
        return c


class FMIndex:
    """Over a sequence of non-negative ids that ends with its only smallest one."""

    def __init__(self, t: np.ndarray, sigma: int):
        self.n = len(t)
        sa = suffix_array(t)
        self.wavelet = Wavelet(t[sa - 1], sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(t, minlength=sigma))))
        self.sampled = sa % SAMPLE == 0
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = sa[self.sampled]

    def count(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long patterns (rows): the suffix intervals."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for j in reversed(range(patterns.shape[1])):
            c = patterns[alive, j]
            lo[alive] = self.before[c] + self.wavelet.rank(c, lo[alive])
            hi[alive] = self.before[c] + self.wavelet.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return np.where(found, lo, 0), np.where(found, hi, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, out, steps, left = rows.copy(), np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            at = rows[left]
            done = self.sampled[at]
            out[left[done]] = self.positions[self.slot[at[done]]] + steps
            left = left[~done]
            c = self.wavelet.access(rows[left])
            rows[left] = self.before[c] + self.wavelet.rank(c, rows[left])
            steps += 1
        return out


def compile_items(items: list[tuple[str | None, bytes]], window: int) -> tuple[dict, dict, list[set]]:
    """Vocabulary (ids from 3), window matrices by length, and for each window, in the same order, its item ids."""
    vocab: dict[bytes, int] = {}
    owners: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 3) for w in words(text)]
        n = min(window, len(ids))
        for i in range(len(ids) - n + 1 if n else 0):
            owners[tuple(ids[i : i + n])] |= {item} - {None}
    by_length = defaultdict(list)
    for w in owners:
        by_length[len(w)].append(w)
    matrices = {n: np.array(ws, np.int64) for n, ws in sorted(by_length.items())}
    return vocab, matrices, [owners[w] for n in matrices for w in by_length[n]]


def search(texts: list[bytes], compiled) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set]]:
    """For the words of all texts, one after the other: words per text, hit marks, text of each word; for each text its items."""
    vocab, matrices, owners = compiled
    toks = (b" " + _END + b" ").join(t.translate(_KEEP) for t in texts).split()
    vocab = vocab | {_END: -1}
    ids = np.fromiter(map(vocab.get, toks, repeat(0)), np.int64, len(toks))
    end = ids == -1
    doc = np.cumsum(end)[~end]
    ids_all, ids = ids, ids[~end]
    n_words = np.bincount(doc, minlength=len(texts))
    hit, items = np.zeros(len(ids), bool), [set() for _ in texts]
    if not matrices or not len(ids):
        return n_words, hit, doc, items
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids_all > 0).astype(np.int8), [0]))))
    start, stop = edge[::2], edge[1::2]
    keep = stop - start >= min(matrices)
    start, stop = start[keep], stop[keep]
    if not len(start):
        return n_words, hit, doc, items
    width = stop - start + 1
    ends = np.cumsum(width)
    src = np.arange(ends[-1]) - np.repeat(ends - width, width) + np.repeat(start, width)
    t = ids_all[np.minimum(src, len(ids_all) - 1)].copy()
    t[ends - 1] = 1  # between stretches
    t = np.concatenate((t, [0]))
    index = FMIndex(t, max(vocab.values()) + 1)
    place = src - np.cumsum(end)[np.minimum(src, len(ids_all) - 1)]  # among the words
    marks, first = np.zeros(len(ids) + 1, np.int64), 0
    for n, patterns in matrices.items():
        lo, hi = index.count(patterns)
        some = np.flatnonzero(hi > lo)
        if len(some):
            size = hi[some] - lo[some]
            rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[some], size)
            at = place[index.locate(rows)]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + n, -1)
            which = np.repeat(some, size)
            for key in np.unique(doc[at] * len(owners) + which + first):
                items[key // len(owners)] |= owners[key % len(owners)]
        first += len(patterns)
    hit = np.cumsum(marks[:-1]) > 0
    return n_words, hit, doc, items


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Merged character ranges of the marked words."""
    found = [m.span() for m in _WORD.finditer(text.translate(_KEEP))]
    out: list[list[int]] = []
    last = -2
    for i in np.flatnonzero(hit):
        if i == last + 1:
            out[-1][1] = found[i][1]
        else:
            out.append(list(found[i]))
        last = i
    return [{"start": len(text[:a].decode(errors="replace")), "end": len(text[:b].decode(errors="replace"))} for a, b in out]


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_KEYS = ["id", "n_words", "n_hit", "item_ids", "spans"]


def _result(ids: pa.Array, texts: list[bytes], hits: list[np.ndarray], items: list[list[str]]) -> pa.RecordBatch:
    """A row per document from the marks of its words."""
    n_hit = [int(h.sum()) for h in hits]
    spans = [_spans(t, h) if n else [] for t, h, n in zip(texts, hits, n_hit, strict=True)]
    return pa.RecordBatch.from_arrays([ids, pa.array([len(h) for h in hits], pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPAN)], _KEYS)


def _marked(batches: Iterator[pa.RecordBatch], block) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[np.ndarray], list[list[str]]]]:
    """For slices of (id, text, ...): texts, the marks of their words and their items in one block of the benchmark."""
    for part in chunks(batches, "text", SHARD_BYTES):
        texts = raw(part, "text")
        n_words, hit, _, items = search(texts, block.value)
        at = np.concatenate(([0], np.cumsum(n_words)))
        yield part, texts, [hit[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], [sorted(x) for x in items]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = 64 << 20) -> DataFrame:
    """Per document: id, n_words, n_hit, item_ids (sorted), spans (character ranges to remove), contaminated (20 n_hit >= n_words > 0).

    A benchmark of more than block_bytes is taken block by block: one pass over the documents each, whose marks are written to the shared folder before the
    block is dropped everywhere, then merged by document. So driver and tasks hold one block at a time.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).where("t is not null")
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_bytes))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out_type = f"id {kind}, n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,end:int>>"

    def shipped(b: int):
        part = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else bench
        return spark.sparkContext.broadcast(compile_items([(r.i, r.t.encode()) for r in part.toLocalIterator()], window))

    if n == 1:
        block = shipped(0)
        out = source.mapInArrow(frugal(lambda it: (_result(p.column("id"), t, h, i) for p, t, h, i in _marked(it, block))), out_type)
    else:
        parts, hashed = [], source.withColumn("h", F.xxhash64("text"))
        for b in range(n):
            block = shipped(b)

            def one(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
                for part, _, hits, items in _marked(batches, block):
                    some = [i for i, h in enumerate(hits) if h.any()]
                    edges = [np.flatnonzero(np.diff(np.concatenate(([0], hits[i].astype(np.int8), [0])))) for i in some]
                    runs = [[{"start": int(x), "end": int(y)} for x, y in zip(e[::2], e[1::2], strict=True)] for e in edges]
                    pick = pa.array(some, pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column("id").take(pick), part.column("h").take(pick), pa.array(runs, _SPAN), pa.array([items[i] for i in some], pa.list_(pa.string()))], ["id", "h", "runs", "item_ids"])

            parts.append(staged(hashed.mapInArrow(frugal(one), f"id {kind}, h long, runs array<struct<start:int,end:int>>, item_ids array<string>"), "marks"))
            block.destroy()
        every = reduce(DataFrame.union, parts).groupBy(F.struct("id", "h").alias("k")).agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
        merged = hashed.withColumn("k", F.struct("id", "h")).join(every, "k", "left").select("id", "text", "runs", "item_ids")  # equal rows have equal marks

        def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in chunks(batches, "text", SHARD_BYTES):
                texts = raw(part, "text")
                hits = [np.zeros(len(words(t)), bool) for t in texts]
                for h, runs in zip(hits, part.column("runs").to_pylist(), strict=True):
                    for r in runs or ():
                        h[r["start"] : r["end"]] = True
                yield _result(part.column("id"), texts, hits, [x or [] for x in part.column("item_ids").to_pylist()])

        out = merged.mapInArrow(frugal(last), out_type)
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words")).withColumnRenamed("id", id_col)


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM iw WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM wins),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, lens WHERE len(w) >= n)
), occ AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM dwin d JOIN wins w ON d.n = w.n AND d.win = w.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
