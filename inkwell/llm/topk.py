"""Exact top-k by inner product with no-random-access aggregation over sorted lists.

Candidates stay where they are read: a task packs its rows into blocks, and a block has, for every dimension, its list of candidates sorted by value.
Queries come to the tasks in rounds of at most ``round_bytes`` (64 MB), as broadcasts that are dropped after their round; a task returns the k best of each query,
and these are merged. So nothing of the size of queries times candidates is ever a table, and candidates are not shuffled at all.

Within a block the lists are read slice by slice from the end that a weight's sign prefers. A candidate's lower bound adds the worst value of each list
where it hasn't been met, its upper bound the value last read there. Reading goes on with the candidates that can still qualify only; it stops
when all that was not met, and all but few of what was, stay below the k-th best lower bound. The scores of the rest are then resolved, in whole numbers.

Bounds are sums of floating-point numbers, so they are widened by what rounding may take away. Scores are exact: in 64 bits where no sum can leave them, else in Python's
integers; a component is held at 2**62 and a score at 2**63 - 1.

Defined results: vectors that are null, or hold null or non-finite components, take no part; vectors of another length than the query's neither;
ties go to the smaller id; rows with the query's own id are left out, and repeated rows count once; null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table, unstaged

SCALE = 256
BLOCK = 4096
QUERIES = 256
FEW = 256
ROUND_BYTES = 64 << 20
_MOST = 1 << 62


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class SortedLists:
    """A block of candidates (ids sorted): values, and for each dimension each candidate's place in the list sorted by falling value."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.exact = ids[order], values[order].astype(np.int64)
        self.largest = _largest(self.exact)
        self.values = self.exact.astype(np.float32 if self.largest**2 * values.shape[1] < 1 << 24 else np.float64)
        self.names, self.of = np.unique(self.ids, return_inverse=True)
        self.first = np.flatnonzero(np.concatenate(([True], self.of[1:] != self.of[:-1])))
        by_value = np.argsort(-self.exact, axis=0, kind="stable")
        self.place = np.empty(by_value.shape, np.int32)
        np.put_along_axis(self.place, by_value, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        self.lists = np.take_along_axis(self.values, by_value, axis=0)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's number, ids, scores) of the k best of each query but its own; candidates below its floor may be left out.

        All queries read the lists together, to growing depths; lists are read from the front for positive weights and from the back for negative ones.
        """
        n, d = self.values.shape
        scale = self.largest * _largest(queries) * d
        kind = np.dtype(np.float64 if scale >= 1 << 24 else self.values.dtype)  # whole numbers up to there are exact in 32 bits, also their sums
        slack = 0.0 if scale < 1 << 53 else scale * d * 2.0**-48
        values, lists = self.values.astype(kind, copy=False), self.lists.astype(kind, copy=False)
        spot = np.searchsorted(self.names, own)
        known_id = (spot < len(self.names)) & (self.names[np.minimum(spot, len(self.names) - 1)] == own)
        spot = np.where(known_id, spot, -1)
        left, depth, rows = np.arange(len(queries)), n // 8, np.arange(n)
        while len(left):
            depth = min(n, max(depth, 64))
            q = queries[left].astype(kind).T
            plus, minus = np.maximum(q, 0), np.minimum(q, 0)
            place, held = (self.place, values) if len(rows) == n else (self.place[rows], values[rows])
            front, back = place < depth, place >= n - depth
            seen = np.hstack((front, back)).astype(kind)
            known = np.hstack((held * front, held * back)) @ np.vstack((plus, minus))
            worst = np.vstack((plus * lists[-1][:, None], minus * lists[0][:, None]))
            last = np.vstack((plus * lists[depth - 1][:, None], minus * lists[n - depth][:, None]))
            low = known + (worst.sum(axis=0) - seen @ worst)
            high = known + (last.sum(axis=0) - seen @ last)
            mine = self.of[rows][:, None] == spot[left]
            low[mine] = high[mine] = -np.inf
            bar = floor[left]
            of = self.of[rows]
            first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            if len(first) > k:  # an id with several vectors holds one place, so that the k-th bound counts ids
                each = low if len(first) == len(rows) else np.maximum.reduceat(low, first, axis=0)
                bar = np.maximum(bar, np.partition(each, len(each) - k, axis=0)[len(each) - k] - slack)
            alive = high + slack >= bar
            alive[mine] = False
            done = (alive.sum(axis=0) <= FEW) | (depth == n)
            for j in np.flatnonzero(done):
                rest = rows[alive[:, j]]
                wide = np.int64 if scale < _MOST else object
                score = self.exact[rest].astype(wide) @ queries[left[j]].astype(wide)
                if scale >= _MOST:
                    score = np.array([min((1 << 63) - 1, max(1 - (1 << 63), x)) for x in score], np.int64)
                best = np.lexsort((self.of[rest], -score))
                if len(self.first) < n and len(best):  # vectors of one id with equal scores count once
                    of, to = self.of[rest][best], score[best]
                    best = best[np.concatenate(([True], (of[1:] != of[:-1]) | (to[1:] != to[:-1])))]
                best = best[:k]
                yield int(left[j]), self.ids[rest][best], score[best]
            rows = rows[alive[:, ~done].any(axis=1)]
            left, depth = left[~done], depth * 3


def _packed(batches: Iterator[pa.RecordBatch], per_block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, values) blocks of rows (id, v) with vectors of one length; repeated rows of a block count once."""
    held: dict[int, list] = {}

    def block(parts: list) -> tuple[np.ndarray, np.ndarray]:
        ids, values = (np.concatenate([p[i] for p in parts]) for i in range(2))
        if len(np.unique(ids)) < len(ids):
            code = np.unique(ids, return_inverse=True)[1]
            _, first = np.unique(np.column_stack((code, values)), axis=0, return_index=True)
            ids, values = ids[first], values[first]
        return ids, values

    for b in batches:
        ids, lists = b.column("id").to_numpy(zero_copy_only=False), b.column("v")
        at, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        size = np.diff(at)
        for d in np.unique(size):
            pick = np.flatnonzero(size == d)
            for i in range(0, len(pick), per_block):
                some = pick[i : i + per_block]
                own = held.setdefault(int(d), [])
                own.append((ids[some], flat[(at[some] - at[0])[:, None] + np.arange(d)].reshape(len(some), int(d))))
                if sum(len(x[0]) for x in own) >= per_block:
                    yield block(held.pop(int(d)))
    for d in sorted(held):
        yield block(held[d])


def _best(found: list[tuple[int, object]], k: int) -> list[tuple[int, object]]:
    return sorted(set(found), key=lambda x: (-x[0], x[1]))[:k]


def top_k(vectors: DataFrame, *, k: int = 5, query: str = "vec_id % 50 = 0", id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, block: int = BLOCK, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(query_id, rank, id, score) of the k best other rows for each row that meets `query`, by the inner product of floor(scale * x)."""
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
        rows = rows.where("id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(cast(x as double)) = double('infinity'))")
        return rows.select("id", F.expr(f"transform(v, x -> cast(greatest(-{float(_MOST)}D, least({float(_MOST)}D, floor({scale} * cast(x as double)))) as bigint))").alias("v"))

    asked = usable(vectors.where(query) if query else vectors)
    size = asked.agg(F.sum(8 * F.size("v") + 64).alias("x")).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    if rounds > 1:
        asked = staged(asked.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds))), "queries")
    schema, parts = f"query_id {kind}, id {kind}, score long", []
    rows = usable(vectors)
    for r in range(rounds):
        batches = (asked.where(F.col("round") == r).select("id", "v") if rounds > 1 else asked).toArrow().to_batches()
        shipped = spark.sparkContext.broadcast(list(_packed(batches, QUERIES)))

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            best: dict[int, list[list]] = {}
            floors = {i: np.full(len(ids), -np.inf) for i, (ids, _) in enumerate(shipped.value)}
            id_type = None
            for ids, values in _packed(_typed(batches, kinds := []), block):
                id_type, lists = kinds[0], SortedLists(ids, values)
                for i, (own, asked_values) in enumerate(shipped.value):
                    if asked_values.shape[1] != values.shape[1]:
                        continue
                    held = best.setdefault(i, [[] for _ in own])
                    for j, some, score in lists.search(asked_values, own, k, floors[i]):
                        held[j] = _best([*held[j], *zip(score.tolist(), some.tolist(), strict=True)], k)
                        if len(held[j]) == k:
                            floors[i][j] = held[j][-1][0]
            for i, held in best.items():
                out = [(q, x, s) for q, found in zip(shipped.value[i][0].tolist(), held, strict=True) for s, x in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (id_type, id_type, pa.int64()), strict=True)], ["query_id", "id", "score"])

        found = rows.mapInArrow(search, schema)
        parts.append(staged(found, "best") if rounds > 1 else found)
        if rounds > 1:
            shipped.destroy()
    if rounds > 1:
        unstaged(asked)
    found = parts[0]
    for x in parts[1:]:
        found = found.union(x)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.dropDuplicates(["query_id", "id", "score"]).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _typed(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kinds.append(b.column("id").type) if not kinds else None
        yield b


def op10_exact_topk(spark, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("query_id").cast("long").alias("query_id"), "rank", F.col("id").cast("long").alias("vec_id"), "score")


OP10_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
