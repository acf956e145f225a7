"""Best-fit packing of tokenized documents by bin completion.

1. One pass over the texts gives the pieces (ids counted, their CRC kept), written to the shared folder.
2. Only the histogram of piece lengths (at most ``capacity`` rows) reaches the driver. There, best-fit decreasing gives the
   incumbent, and bin completion branches on the largest remaining length: all undominated fillings of the rest of its bin, least waste
   first, pruned when the waste exceeds what a better solution may have. Lengths with many pieces are completed many bins at a time, then one by one.
   The search looks at `nodes` fillings at most and then keeps the incumbent; nodes=None goes on to the proof. Column `proved` says whether the number
   of sequences is proved to be the least.
3. The plan (ranges of ranks within a length -> sequence and offset; its rows are bounded by the number of lengths, not by the
   data) is shipped back, and every piece finds its place by its rank within its length. Ranks come from salted groups, so a
   length that holds a third of all pieces is dealt over many tasks.

Defined results: a null text is empty and has the end id only; equal documents are packed one by one; an empty table gives no
rows; a null doc_id is kept as it is.
"""

from __future__ import annotations

import array
import json
import os
import sys
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, frugal, staged, table

CAPACITY = 1024
END_ID = 2
NODES = 20_000
_loaded: dict[str, object] = {}


class _Encoder:
    """Ids of a text as little-endian 32-bit bytes, as ``tokenizers`` gives them for the file.

    Where the file is byte-level BPE whose ids follow the order of its merges (checked on loading), the merges run in tiktoken with the
    file's own ids as ranks, about four times faster for equal ids. Texts that hold a special token's string, and other files, go through ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.fast = self._ranked(path)

    @staticmethod
    def _ranked(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        vocab = model.get("vocab", {})
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec["normalizer"] and not spec["post_processor"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("end_of_word_suffix") or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in printable)}
        ranks = {bytes(shown[c] for c in word): i for word, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def bytes_of(self, texts: list[str]) -> list[bytes]:
        slow = lambda t: self.fast is None or any(s in t for s in self.special)
        return [array.array("I", self.tokenizer.encode(t, add_special_tokens=False).ids if slow(t) else self.fast(t)).tobytes() for t in texts]


def _encoder(path: str) -> _Encoder:
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
    return _loaded[path]


def pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32): documents longer than the capacity are cut, a shorter first piece leading."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = array.array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for part in chunks(batches, "text", 1 << 20):
            texts = [t or "" for t in part.column("text").to_pylist()]
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.bytes_of(texts)):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    to = at + ((n - at - 1) % capacity + 1 if not k else capacity)
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[4 * at : 4 * to]))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(frugal(run), f"id {kind}, piece int, start long, length long, ids_crc32 long")


# -- the plan -----------------------------------------------------------------------------------------------------------------

Plan = list[tuple[tuple[int, ...], int]]  # a bin's lengths, descending, and how many such bins


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram; equal bins are handled together."""
    bins: dict[int, Counter] = defaultdict(Counter)  # by free space
    free: list[int] = []

    def put(space: int, lengths: tuple, n: int) -> None:
        if space not in bins or not bins[space]:
            insort(free, space)
        bins[space][lengths] += n

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(free, size)
            if at < len(free):
                space = free[at]
                lengths, n = next(iter(bins[space].items()))
            else:
                space, lengths, n = capacity, (), left
            per = space // size
            whole = min(n, left // per)
            taken, k = (whole, per) if whole else (1, left)
            if lengths or at < len(free):
                bins[space][lengths] -= taken
                if not bins[space][lengths]:
                    del bins[space][lengths]
                if not bins[space]:
                    free.pop(at)
            put(space - k * size, lengths + (size,) * k, taken)
            left -= taken * k
    return [(lengths, n) for at in bins.values() for lengths, n in at.items()]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and, for each threshold k, bins that hold a piece over capacity - k besides the rest's volume."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for k in range(1, capacity // 2 + 1):
        big = sum(n for s, n in counts.items() if s > capacity - k)
        mid = sum(n for s, n in counts.items() if capacity // 2 < s <= capacity - k)
        room = mid * capacity - sum(s * n for s, n in counts.items() if capacity // 2 < s <= capacity - k)
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity // 2)
        best = max(best, big + mid + max(0, -(-(small - room) // capacity)))
    return best


def fillings(room: int, counts: dict[int, int], sizes: list[int], most_waste: int, seen: list[int] | None = None) -> Iterator[tuple[tuple[int, ...], int]]:
    """All undominated ways to fill `room` with a waste of at most `most_waste`, least waste first, one by one.

    Undominated: no remaining piece fits in the waste, and no piece can give way to a longer remaining one. Which sums the pieces up to a size can reach is
    kept as bits, so only branches that end in the wanted sum are entered. seen[0] counts ways looked at.
    """
    sizes = [s for s in sizes[: bisect_right(sizes, room)] if counts[s]]
    reach, every = [1], (1 << (room + 1)) - 1
    for s in sizes:
        bits, left, k = reach[-1], min(counts[s], room // s), 1
        while left:
            k = min(k, left)
            bits |= (bits << (s * k)) & every
            left, k = left - k, 2 * k
        reach.append(bits)

    def grow(space: int, j: int) -> Iterator[tuple[int, ...]]:
        if not space:
            yield ()
            return
        for i in range(min(j, bisect_right(sizes, space)), 0, -1):
            if not reach[i] >> space & 1:
                return
            s = sizes[i - 1]
            for c in range(min(counts[s], space // s), 0, -1):
                if reach[i - 1] >> (space - c * s) & 1:
                    for rest in grow(space - c * s, i - 1):
                        yield (s,) * c + rest

    for waste in range(min(room, most_waste) + 1):
        for chosen in grow(room - waste, len(sizes)):
            if seen is not None:
                seen[0] += 1
            used = Counter(chosen)
            if any(counts[s] > used[s] for s in sizes[: bisect_right(sizes, waste)]):
                continue
            if any(counts[t] > used[t] for s in used for t in sizes[bisect_right(sizes, s) : bisect_right(sizes, s + waste)]):
                continue
            yield chosen, waste


def solve(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES) -> tuple[Plan, bool]:
    """As few bins as found, and whether that is proved to be the least.

    The incumbent is best-fit decreasing. The search ends when it meets the lower bound, when all branches are done (both are proofs), or after `nodes`
    fillings; the incumbent is then kept. nodes=None is the exact way: it always ends with a proof, in time that may be exponential.
    """
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    size = lambda plan: sum(n for _, n in plan)
    bound, spent = lower_bound(counts, capacity), [0]
    over = lambda: (nodes is not None and spent[0] >= nodes) or size(best) == bound

    def search(left: dict[int, int], sizes: list[int], plan: Plan, waste: int) -> None:
        nonlocal best
        if over():
            return
        if not sizes:
            if size(plan) < size(best):
                best = plan
            return
        tail = best_fit(left, capacity)
        if size(plan) + size(tail) < size(best):
            best = plan + tail
        allowed = (size(best) - 1) * capacity - total - waste
        if allowed < 0:
            return
        top = sizes[-1]
        rest = dict(left)
        rest[top] -= 1
        for chosen, lost in fillings(capacity - top, rest, sizes, allowed, spent):
            need = Counter(chosen + (top,))
            most = min(left[s] // n for s, n in need.items())
            if lost:
                most = min(most, max(1, allowed // lost))
            for times in {most: None, 1: None}:  # many bins at a time, else this bin alone
                after = dict(left)
                for s, n in need.items():
                    after[s] -= n * times
                search(after, [s for s in sizes if after[s]], [*plan, ((top, *chosen), times)], waste + lost * times)
                if over():
                    return
            allowed = (size(best) - 1) * capacity - total - waste
            if lost > allowed:
                return

    old = sys.getrecursionlimit()
    sys.setrecursionlimit(max(old, 30_000))
    try:
        search(counts, sorted(counts), [], 0)
    finally:
        sys.setrecursionlimit(old)
    return best, size(best) == bound or nodes is None or spent[0] < nodes


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES) -> Plan:
    return solve(counts, capacity, nodes)[0]


def ranges(plan: Plan) -> dict[int, dict[str, np.ndarray | list]]:
    """By length: where each run of ranks starts, how many pieces of it a bin has, its first sequence, the offsets within the bin."""
    out: dict[int, dict] = {}
    used: Counter = Counter()
    first = 0
    for lengths, n in plan:
        at, offsets = 0, defaultdict(list)
        for s in lengths:
            offsets[s].append(at)
            at += s
        for s, where in offsets.items():
            r = out.setdefault(s, {"start": [], "per": [], "first": [], "offset_at": [], "offsets": []})
            r["start"].append(used[s])
            r["per"].append(len(where))
            r["first"].append(first)
            r["offset_at"].append(len(r["offsets"]))
            r["offsets"].extend(where)
            used[s] += n * len(where)
        first += n
    return {s: {k: np.array(v, np.int64) for k, v in r.items()} for s, r in out.items()}


def pack(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, nodes: int | None = NODES, rows_per_group: int = 200_000) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset, proved."""
    kind = docs.schema[id_col].dataType.simpleString()
    cut = staged(pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id), "pieces")
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    plan, proved = solve(histogram, capacity, nodes)
    place = docs.sparkSession.sparkContext.broadcast(ranges(plan))
    salts = int(min(4096, max(64, max(histogram.values(), default=0) // rows_per_group)))

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "salt").count()  # at most capacity * salts rows
    before = sizes.select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")) - 1).join(before, ["length", "salt"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for s in np.unique(length):
                r, at = place.value[int(s)], length == s
                q = rank[at]
                j = np.searchsorted(r["start"], q, side="right") - 1
                q = q - r["start"][j]
                sequence[at] = r["first"][j] + q // r["per"][j]
                offset[at] = r["offsets"][r["offset_at"][j] + q % r["per"][j]]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")] + [pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = ranked.mapInArrow(frugal(run), f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col).withColumn("proved", F.lit(proved))


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer=byte_bpe())
