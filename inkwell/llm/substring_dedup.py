"""Exact removal of repeated byte strings by distributed prefix doubling over a sparse set of positions.

Every byte covered by a ``length``-byte string that also starts earlier (smaller id, or same document and earlier start) goes.

Positions get names for strings of doubling lengths: the name of 2n bytes at p is made of the pair (name of n bytes at p, name of
n bytes at p + n). Up to ``GRAM`` bytes the pairs are combined where the text is (numpy, 64 bits). From there on Spark sorts
(name, position) pairs, drops what is unique and goes on with the rest at the next offset, up to ``length``. So that not all positions
travel, only *anchors* do: the place of the smallest gram name in each window of ``length`` bytes, leftmost if equal. It depends only on
the window's own bytes, so equal windows have their anchors at equal places and no match is lost. An anchor stands for the contiguous
windows that chose it.

1. Grams: an anchor whose gram name is unique is dropped, as none of its windows repeats.
2. Neighbourhoods: the pair (name of its first window, name of its last) names all bytes of all its windows. The earliest anchor of each
   neighbourhood goes on; every window of the others repeats.
3. Blocks: where neighbourhoods still share a gram, their windows are dealt into blocks of ``BLOCK`` by the anchor's place in them. All windows of a block hold
   its core, the bytes that they have in common; a block whose core's name is unique is dropped. Blocks with the same bytes are settled like neighbourhoods. From here
   on a neighbourhood carries its bytes, about 130, so the text is not read for it again.
4. Windows: where blocks still share a core, their windows are named one by one; all but the earliest of each name repeat.

Each step is a partial aggregate (first position per name) joined back, so a name with a third of all rows is neither
collected nor dealt to one task. The removed ranges then meet their documents. Names that decide equality have 96 bits; they are made of
64-bit names of the window's own pieces.

Defined results: null and empty texts have 0 bytes and keep the empty string. Rows with a null id take no part in matching and stay
whole. Ids are to be unique; rows that share one share the ranges found in any of them. Equal texts under different ids: all but the first are
removed from 100 bytes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, free_shuffles, frugal, joined, staged, table, unstaged

LENGTH = 100
GRAM = 32
BLOCK = 8
SEGMENT = 1 << 18
SLICE = 4 << 20  # bytes of text at a time
_U = np.uint64


def _pair(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    out = a * _U(0x9E3779B97F4A7C15)
    out += b
    out *= _U(0xD6E8FEB86659FD93 + 2 * seed)
    out ^= out >> _U(32)
    return out


_FIRST = _pair(np.arange(1, 257, dtype=np.uint64), np.arange(77, 333, dtype=np.uint64), 9)


def gram_names(text: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Names of all n-byte strings (n a power of two) by doubling."""
    names, k = _FIRST[text], 1
    while k < n:
        names = _pair(names[:-k], names[k:], k)
        k *= 2
    return names


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    k = 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[: len(x) - (w - k)], x[w - k :]) if w > k else x


def window_names(grams: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits for the windows that start at `at`."""
    a, b, c, d = (grams[at + o] for o in (0, gram, length - 2 * gram, length - gram))
    return _pair(_pair(a, b, 101), _pair(c, d, 102), 103), _pair(_pair(a, c, 104), _pair(b, d, 105), 106) >> _U(32)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Over documents that lie one after the other: (document, first window's start in it, windows, the gram's offset from there, gram name, neighbourhood names) by segment.

    An anchor's windows may be cut in two by the end of a segment; steps 3 and 4 handle both parts.
    """
    for s in range(0, len(data) - length + 1, SEGMENT):
        text = data[s : s + SEGMENT + length - 1]
        n = len(text) - length + 1
        fits = np.ones(len(text), bool)
        for e in offsets[np.searchsorted(offsets, s, side="right") : np.searchsorted(offsets, s + len(text), side="right")] - s:
            fits[max(0, e - length + 1) : e] = False
        p = np.flatnonzero(fits[:n])
        if not len(p):
            continue
        grams = gram_names(text, gram)
        mask = _U((1 << len(grams).bit_length()) - 1)
        at = (_window_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & mask).astype(np.int64)[p]
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1))))
        first, last, anchor = p[new], p[np.concatenate((new[1:], [len(p)])) - 1], at[new]
        a1, a2 = window_names(grams, first, length, gram)
        b1, b2 = window_names(grams, last, length, gram)
        shape = ((anchor - first) * 4096 + (last - first)).astype(np.uint64)
        doc = np.searchsorted(offsets, first + s, side="right") - 1
        yield doc, first + s - offsets[doc], last - first + 1, anchor - first, grams[anchor], _pair(_pair(a1, b1, 107), shape, 108), _pair(_pair(a2, b2, 109), shape, 110) >> _U(32)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", SLICE):
        data, offsets = joined(batch, "text")
        for doc, start, n, off, g, n1, n2 in anchors(data, offsets, length, gram):
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(doc)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int16)), pa.array(off.astype(np.int16)), _signed(g), _signed(n1), pa.array(n2.astype(np.uint32).view(np.int32))], ["id", "start", "n", "off", "g", "n1", "n2"])


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, start, stop): byte ranges of (id, text) rows whose every window repeats."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    known = docs.where("id is not null and octet_length(text) >= %d" % length)
    found = known.mapInArrow(frugal(lambda it: _rows(it, length, gram)), f"id {kind}, start int, n smallint, off smallint, g long, n1 long, n2 int")

    # staged, so that it has an exchange of its own and Spark can split a frequent gram's rows in the join
    shared = staged(found.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g"), "grams")
    free_shuffles(spark)
    live = staged(found.join(shared.hint("shuffle_hash"), "g"), "anchors")
    free_shuffles(spark)

    classes = staged(live.groupBy("g", "n1", "n2").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("c"), F.min("n").alias("n"), F.min("off").alias("off")), "neighbourhoods")
    several = classes.where("c > 1").select("g", "n1", "n2", "first")
    copies = staged(live.join(several.hint("shuffle_hash"), ["g", "n1", "n2"]).where("id != first.id or start != first.start").select("id", "start", F.expr(f"start + n + {length - 1}").alias("stop")), "copies")
    unstaged(live)
    free_shuffles(spark)

    unsettled = classes.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("g")
    parts = classes.join(unsettled.hint("shuffle_hash"), "g").groupBy(F.col("first.id").alias("id")).agg(F.collect_list(F.struct(F.col("first.start").alias("start"), F.col("n").cast("int").alias("n"), F.col("off").cast("int").alias("off"))).alias("parts"))
    held = staged(known.join(parts, "id").select("id", "text", "parts").mapInArrow(frugal(lambda it: _held(it, length)), f"id {kind}, start int, n int, off int, held binary"), "held")
    unstaged(classes)
    free_shuffles(spark)

    blocks = held.mapInArrow(frugal(lambda it: _blocks(it, length, gram)), f"id {kind}, base int, start int, n smallint, core long, n1 long, n2 int")
    cores = staged(blocks.groupBy("core").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("core"), "cores")
    live = staged(blocks.join(cores.hint("shuffle_hash"), "core"), "blocks")
    free_shuffles(spark)
    classes = staged(live.groupBy("core", "n1", "n2").agg(F.min(F.struct("id", "start", "base")).alias("first"), F.count(F.lit(1)).alias("c"), F.min("n").alias("n")), "block-classes")
    several = classes.where("c > 1").select("core", "n1", "n2", "first")
    more = staged(live.join(several.hint("shuffle_hash"), ["core", "n1", "n2"]).where("id != first.id or start != first.start").select("id", "start", F.expr(f"start + n + {length - 1}").alias("stop")), "block-copies")
    unstaged(live)
    free_shuffles(spark)

    unsettled = classes.groupBy("core").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("core")
    last = classes.join(unsettled.hint("shuffle_hash"), "core").select(F.col("first.id").alias("id"), F.col("first.base").alias("base"), (F.col("first.start") - F.col("first.base")).alias("skip"), F.col("n").cast("int").alias("n"))
    with_bytes = last.join(held.select("id", F.col("start").alias("base"), "held"), ["id", "base"]).select("id", F.expr("base + skip").alias("start"), F.expr(f"substring(held, skip + 1, n + {length - 1})").alias("held"))
    windows = staged(with_bytes.mapInArrow(frugal(lambda it: _windows(it, length, gram)), f"id {kind}, start int, w1 long, w2 int"), "windows")
    unstaged(classes)
    unstaged(held)
    free_shuffles(spark)
    again = windows.groupBy("w1", "w2").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    later = windows.join(again.hint("shuffle_hash"), ["w1", "w2"]).where("id != first.id or start != first.start").select("id", "start", F.expr(f"start + {length}").alias("stop"))
    return copies.union(more).union(later)


def _held(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each listed neighbourhood."""
    for batch in chunks(batches, "text", SLICE):
        data, offsets = joined(batch, "text")
        lists = batch.column("parts")
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        for i in range(0, len(row), 50_000):
            start, n, off = (flat.field(k).to_numpy(zero_copy_only=False)[i : i + 50_000] for k in range(3))
            r, size = row[i : i + 50_000], n.astype(np.int64) + length - 1
            ends = np.cumsum(size)
            src = np.arange(ends[-1]) + np.repeat(offsets[r] + start - ends + size, size)
            held = pa.BinaryArray.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(data[src])])
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(r)), pa.array(start), pa.array(n), pa.array(off), held], ["id", "start", "n", "off", "held"])


def _blocks(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    size = length - BLOCK + 1  # of a core
    for part in (b.slice(i, 4000) for b in batches for i in range(0, b.num_rows, 4000)):
        data, offsets = joined(part, "held")
        grams = gram_names(data, gram)
        start, n, off = (part.column(c).to_numpy().astype(np.int64) for c in ("start", "n", "off"))
        for j in range(0, length - gram + 1, BLOCK):
            low, high = np.maximum(j, off - n + 1), np.minimum(j + BLOCK - 1, off)
            r = np.flatnonzero(low <= high)
            if not len(r):
                continue
            low, high = low[r], high[r]
            anchor = offsets[r] + off[r]
            c = anchor - j
            core = _pair(_pair(grams[c], grams[c + gram], 130 + j), grams[c + size - gram], 131 + j)
            if size > 3 * gram:
                core = _pair(core, grams[c + 2 * gram], 132 + j)
            a1, a2 = window_names(grams, anchor - high, length, gram)
            b1, b2 = window_names(grams, anchor - low, length, gram)
            shape = (low * 4096 + high).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(r)), pa.array(start[r].astype(np.int32)), pa.array((start[r] + off[r] - high).astype(np.int32)), pa.array((high - low + 1).astype(np.int16)), _signed(core), _signed(_pair(_pair(a1, b1, 107), shape, 108)), pa.array((_pair(_pair(a2, b2, 109), shape, 110) >> _U(32)).astype(np.uint32).view(np.int32))],
                ["id", "base", "start", "n", "core", "n1", "n2"],
            )


def _windows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for part in (b.slice(i, 4000) for b in batches for i in range(0, b.num_rows, 4000)):
        data, offsets = joined(part, "held")
        grams = gram_names(data, gram)
        n = np.diff(offsets) - length + 1
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row = np.repeat(np.arange(part.num_rows), n)
        w1, w2 = window_names(grams, offsets[row] + within, length, gram)
        yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), pa.array((part.column("start").to_numpy()[row] + within).astype(np.int32)), _signed(w1), pa.array(w2.astype(np.uint32).view(np.int32))], ["id", "start", "w1", "w2"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, as_text: bool = False) -> DataFrame:
    """Per row of docs: id, n_bytes, n_removed, spans (maximal removed byte ranges), kept (remaining bytes, binary), row (the other columns of docs).

    as_text: kept as a string instead; a character that was cut into loses its other bytes too.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"))
    row_kind = rows.schema["row"].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ranges = repeated_ranges(source, length, gram)
    per_doc = ranges.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", SLICE):
            out = []
            for text, found in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("ranges"), strict=True):
                text = text or b""
                spans: list[list[int]] = []
                if found.is_valid and len(found.values):
                    a, b = (found.values.field(k).to_numpy() for k in (0, 1))
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.minimum(np.maximum.accumulate(b[order]), len(text))
                    new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
                    spans = [[int(x), int(y)] for x, y in zip(a[new], b[np.concatenate((new[1:], [len(a)])) - 1], strict=True) if x < y]
                kept = b"".join(text[x:y] for x, y in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)], strict=True)) if spans else text
                out.append((len(text), len(text) - len(kept), [{"start": x, "stop": y} for x, y in spans], kept))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array([k.decode("utf-8", "ignore") for k in cols[3]], pa.string()) if as_text else pa.array(cols[3], pa.binary())], ["id", "row", "n_bytes", "n_removed", "spans", "kept"])

    out = rows.join(per_doc, "id", "left").select("id", "text", "row", "ranges").mapInArrow(frugal(cut), f"id {kind}, row {row_kind}, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept {'string' if as_text else 'binary'}")
    return out.withColumnRenamed("id", id_col)


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The contract by a dictionary of all windows, for tests."""
    seen: set[bytes] = set()
    out = {}
    for i, text in sorted(rows):
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(text, np.uint8)[~gone[: len(text)]])
        out[i] = (len(text), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out
