"""Set-similarity self-join on word shingles (Jaccard), size-aware: subsets for small sets, inverted lists for large ones.

Documents with equal sets form one class; only one set of each class goes on. Sizes limit partners to
``threshold`` times each other. Classes are parted at a boundary size:

* Light pairs (both sets at most the boundary): for sizes s <= t a link needs ``c(s, t)`` common shingles. Each set enumerates its subsets of exactly that
  size, named with both sizes; a set of size s and one of size t that share one *are* linked, so nothing is verified. Two sets of size t
  that share a subset meant for a smaller s prove nothing and stay apart: each holder goes to the smallest holder of the other size.
* Heavy pairs (the larger set is over the boundary): every set is listed under the first shingles of a fixed global order, as many as guarantee
  that two linked sets share one (prefix filter), and the lists are scanned.

The boundary is where the estimated cost of the subsets (their number over the histogram of sizes) stays below that of the lists. The global order is by
(frequent or not, hash): shingles that many documents share come last, so that lists stay short. Any order gives the same links.

A list is not expanded into all pairs. Its pivot (the smallest class, then, in lists that are still open, others chosen by a hash) is compared with every
other member; links found between components are contracted and make larger ones (star steps over the contracted links; a checked count of at most ``FEW`` is merged
on the driver, as each step takes several shuffles), and a list whose members are in one component is done. In what is left open, members of lighter components are compared with those of heavier ones, along so many of their shortest
lists as must hold a common entry. All links between components are thus found, and no pair within one need be looked at: the components are exact.

Before sets are compared, pairs must share as many entries as two linked sets of these sizes share at least in their prefixes; few others are left.

Sets travel as 64-bit shingle hashes, and only those of classes in candidate pairs.

Defined results: null, empty and word-less texts have an empty set and link with nothing; texts with fewer words than a shingle have
one shingle of all of them; repeated rows are equal sets and link; a null id is its own component (null) and takes no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, counted, free_shuffles, frugal, raw, staged, table, unstaged

SHINGLE = 4
THRESHOLD = (85, 100)
FEW = 100_000  # edges between components: 1.6 MB
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = b" \t\n\x0b\x0c\r"
_END = 0x20
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACE)] = True
_FOLD = np.frombuffer(_LOWER, np.uint8)
_POWERS = np.array([pow(0x5851F42D4C957F2D, i, 1 << 64) for i in range(4096)], np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate((_POWERS, _POWERS * _U(pow(0x5851F42D4C957F2D, len(_POWERS), 1 << 64))))
    return _POWERS[:n]


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after the other, and where each text starts."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _IS_SPACE[data]
    ends = np.cumsum([len(t) + 1 for t in texts])
    # words: hash = sum of byte * power of its place in the word
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    first = np.flatnonzero(edge == -1)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    last = np.flatnonzero(edge == 1)
    last = last[len(last) - len(first) :] if len(last) > len(first) else last
    size = last - first
    src = np.flatnonzero(~space)
    place = np.arange(len(src)) - np.repeat(np.cumsum(size) - size, size)
    value = _BYTE[_FOLD[data[src]]] * _powers(int(size.max()))[place]
    word = _mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))
    doc = np.searchsorted(ends, first, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    # shingles: k words of one document, or all of them where there are fewer
    h = word.copy()
    n = len(word)
    out = np.zeros(n, np.uint64)
    start = np.cumsum(n_words) - n_words
    length = np.minimum(k, np.repeat(n_words, n_words) - (np.arange(n) - start[doc]))
    for j in range(k):
        use = length > j
        moved = np.concatenate((h[j:], np.zeros(min(j, n), np.uint64)))
        out = np.where(use, _mix(out * _U(0x9E3779B97F4A7C15) + moved + _U(j + 1)), out)
    keep = (length == k) | ((np.arange(n) == start[doc]) & (n_words[doc] < k))
    out, doc = out[keep], doc[keep]
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.concatenate(([True], (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])))
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(texts) + 1))


def overlap_needed(s: int, t: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Common shingles that sets of these sizes need: den * o >= num * (s + t - o)."""
    num, den = threshold
    return -(-num * (s + t) // (num + den))


def partners(s: int, threshold: tuple[int, int] = THRESHOLD) -> range:
    num, den = threshold
    return range(-(-num * s // den), den * s // num + 1)


def prefix(s: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """So many first shingles of an ordered set hold one of every linked partner's prefix."""
    num, den = threshold
    return s - -(-num * s // den) + 1


def subset_count(s: int, boundary: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    return sum(math.comb(s, overlap_needed(s, t, threshold)) for t in partners(s, threshold) if t <= boundary and overlap_needed(s, t, threshold) <= min(s, t))


def boundary_by_cost(sizes: dict[int, int], threshold: tuple[int, int] = THRESHOLD, most: int = 24, verify: float = 4.0) -> int:
    """The largest boundary whose subsets cost less than lists: a list entry costs its row and, `verify` rows' worth, its set's verification."""
    best, best_cost = 0, None
    for b in range(most + 1):
        cost = sum(n * subset_count(s, b, threshold) for s, n in sizes.items() if s <= b)
        cost += sum(n * (prefix(s, threshold) + verify) for s, n in sizes.items() if s > b or partners(s, threshold)[-1] > b)
        if best_cost is None or cost <= best_cost:
            best, best_cost = b, cost
    return best


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def stars(edges: DataFrame, name: str) -> DataFrame:
    """(u, v) with v the smallest vertex that u reaches, for every other vertex of the staged edges (u, v), u > v.

    Alternates large-star and small-star steps (each vertex's larger, then smaller, neighbours are linked with its smallest one) until
    nothing changes; logarithmic in the longest path. Every step is one staged table, counted while it is written.
    """
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(m.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m.hint("merge"), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after, found = counted(small.select("e.u", "e.v").where("u != v").distinct(), name, F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("check"))
        unstaged(edges)
        edges = after
        if found == before:
            return edges
        before = found


def few_roots(edges: DataFrame) -> DataFrame:
    """stars() of few staged edges with whole numbers, on the driver: one table instead of some shuffles a step."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = up = root[up]
            x = up
        return x

    got = edges.select("u", "v").toArrow()
    for u, v in zip(got.column("u").to_pylist(), got.column("v").to_pylist(), strict=True):
        x, y = sorted((find(u), find(v)))
        root[y] = x
    moved = [x for x in root if find(x) != x]
    rows = pa.Table.from_arrays([pa.array(moved, got.schema.field("u").type), pa.array([find(x) for x in moved], got.schema.field("v").type)], names=["u", "v"])
    out = staged(edges.sparkSession.createDataFrame(rows, edges.select("u", "v").schema), "roots")
    unstaged(edges)
    return out


def _with_component(rows: DataFrame, of: DataFrame, how: str = "inner", salts: int = 16) -> DataFrame:
    """rows joined with one row per comp: of a component with many rows each task gets a share, as the small side stands under every salt."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    every = of.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every.hint("merge"), ["comp", "salt"], how).drop("salt")


def merged(label: DataFrame, links: DataFrame, name: str = "label") -> DataFrame:
    """The staged label (rep, n, comp) after the links (a, b): only links between components are looked at, contracted to these."""
    ends = label.select("rep", "comp")
    edges = links.join(ends.select(F.col("rep").alias("a"), F.col("comp").alias("u")).hint("merge"), "a").join(ends.select(F.col("rep").alias("b"), F.col("comp").alias("v")).hint("merge"), "b")
    edges, found = counted(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    if not found["n"]:
        return label
    few = found["n"] <= FEW and edges.schema["u"].dataType.simpleString() in ("int", "bigint")
    roots = few_roots(edges) if few else stars(edges, "edges")
    out = staged(_with_component(label, roots.select(F.col("u").alias("comp"), F.col("v").alias("root")), "left").select("rep", "n", F.coalesce("root", "comp").alias("comp")), name)
    for t in (label, roots):
        unstaged(t)
    free_shuffles(label.sparkSession)
    return out


def _sketch(batches: Iterator[pa.RecordBatch], k: int, flush: int = 6_000_000, least: int = 3) -> Iterator[pa.RecordBatch]:
    """A row per text (size and 128-bit name of its set); with some rows, shingles that `least` texts of this task share and how many do."""
    seen: list[np.ndarray] = []

    def counted() -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate(seen) if seen else np.zeros(0, np.uint64)
        seen.clear()
        h.sort()
        often = np.unique(h[least - 1 :][h[least - 1 :] == h[: max(0, len(h) - least + 1)]])  # few: no array of all distinct ones and their counts
        return often, np.searchsorted(h, often, side="right") - np.searchsorted(h, often)

    def rows(ids: pa.Array, n: np.ndarray, s1: np.ndarray, s2: np.ndarray, hot=None) -> pa.RecordBatch:
        lists = [None] * len(n)
        counts = [None] * len(n)
        if hot is not None:
            lists[0], counts[0] = hot[0].view(np.int64), hot[1]
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), _signed(s1), _signed(s2), pa.array(lists, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))], ["id", "n", "s1", "s2", "hot", "hot_n"])

    kind = None
    for part in chunks(batches, "text", 1 << 20):
        kind = part.column("id").type
        sets, at = shingle_sets(raw(part, "text"), k)
        n = np.diff(at)
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(sets + _U(x)), dtype=np.uint64))) for x in (11, 77)]
        seen.append(sets)
        hot = counted() if sum(map(len, seen)) >= flush else None
        yield rows(part.column("id"), n, sums[0][at[1:]] - sums[0][at[:-1]], sums[1][at[1:]] - sums[1][at[:-1]], hot)
    hot = counted()
    if kind is not None and len(hot[0]):
        zero = np.zeros(1, np.uint64)
        yield rows(pa.nulls(1, kind), np.array([-1]), zero, zero, hot)


def _entries(batches: Iterator[pa.RecordBatch], k: int, boundary: int, frequent: np.ndarray, threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(key, id, light): subset keys of small sets, light being the sum of both sizes, and prefix keys (light 0) of those that may have a large partner."""
    choose = {(s, c): np.array(list(combinations(range(s), c)), np.int64) for s in range(1, boundary + 1) for t in partners(s, threshold) if t <= boundary and (c := overlap_needed(s, t, threshold)) <= min(s, t)}
    num, den = threshold
    for part in chunks(batches, "text", 1 << 20):
        sets, at = shingle_sets(raw(part, "text"), k)
        n = np.diff(at)
        doc = np.repeat(np.arange(len(n)), n)
        late = np.zeros(len(sets), np.int64)
        if len(frequent):
            place = np.minimum(np.searchsorted(frequent, sets), len(frequent) - 1)
            late = (frequent[place] == sets).astype(np.int64)
        order = np.argsort(doc * 2 + late, kind="stable")
        size = n[doc]
        rank = np.arange(len(sets)) - at[:-1][doc]
        listed = (rank < size - -(-num * size // den) + 1) & (den * size // num > boundary)
        keys, docs, light = [_mix(sets[order][listed] + _U(1))], [doc[listed]], [np.zeros(int(listed.sum()), np.int32)]
        for s in np.unique(n[(n > 0) & (n <= boundary)]):
            own = np.flatnonzero(n == s)
            values = _mix(sets[at[own][:, None] + np.arange(s)])
            for t in partners(int(s), threshold):
                c = overlap_needed(int(s), t, threshold)
                if (int(s), c) in choose and t <= boundary:
                    found = _mix(values[:, choose[int(s), c]].sum(axis=2, dtype=np.uint64) + _U(min(s, t) * 64 + max(s, t) + 5)).reshape(len(own), -1)
                    keys.append(found.ravel())
                    docs.append(np.repeat(own, found.shape[1]))
                    light.append(np.full(found.size, s + t, np.int32))
        yield pa.RecordBatch.from_arrays([_signed(np.concatenate(keys)), part.column("id").take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(light))], ["key", "id", "light"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text", 1 << 20):
        sets, at = shingle_sets(raw(part, "text"), k)
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _signed(sets))], ["id", "shingles"])


def _needed(threshold: tuple[int, int]) -> tuple[str, str]:
    """SQL for the sizes n and n2: whether they may link, and how many entries their prefixes then share at least."""
    num, den = threshold
    common = f"(({num} * (n + n2) + {num + den - 1}) div {num + den})"
    return f"{den} * least(n, n2) >= {num} * greatest(n, n2)", f"({common} + 1 - greatest(({num} * n + {den - 1}) div {den}, ({num} * n2 + {den - 1}) div {den}))"


def _verified(source: DataFrame, pairs: DataFrame, keys: DataFrame, k: int, threshold: tuple[int, int], broadcast_rows: int = 1_000_000) -> DataFrame | None:
    """Those of the pairs (a, b, n, n2) that link, or None if none does."""
    spark, kind = source.sparkSession, source.schema["id"].dataType.simpleString()
    both = pairs.join(keys.select(F.col("rep").alias("a"), F.col("keys").alias("x")).hint("merge"), "a").join(keys.select(F.col("rep").alias("b"), F.col("keys").alias("y")).hint("merge"), "b")
    close, found = counted(both.where(f"size(array_intersect(x, y)) >= {_needed(threshold)[1]}").select("a", "b"), "close")
    if not found["n"]:
        unstaged(close)
        return None
    needed, found = counted(close.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    needed_ = F.broadcast(needed) if found["n"] <= broadcast_rows else needed.hint("merge")  # 8 MB of ids at most; else both sides are dealt by id
    sets = staged(source.join(needed_, "id", "left_semi").mapInArrow(frugal(lambda it: _sets(it, k)), f"id {kind}, shingles array<long>"), "sets")
    both = close.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).hint("merge"), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")).hint("merge"), "b")
    common = F.size(F.array_intersect("x", "y"))
    linked, found = counted(both.where(threshold[1] * common >= threshold[0] * (F.size("x") + F.size("y") - common)).select("a", "b"), "linked")
    for t in (close, needed, sets):
        unstaged(t)
    free_shuffles(spark)
    return linked if found["n"] else None


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, hints: int = 500_000, boundary: int | None = None, rounds: int = 2, chunk: int = 512) -> DataFrame:
    """Per row of docs: id, n_shingles, component (the smallest id reachable by links).

    hints: so many of the most frequent shingles at most are put last in the order of the lists; others only make longer lists.
    boundary: the largest light size, by cost if not given. rounds: pivots tried for each list before its rest is compared.
    chunk: members of an open list that one join key holds; longer lists are joined chunk by chunk, in as many tasks.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fits, shared = _needed(threshold)

    sketch = staged(source.mapInArrow(frugal(lambda it: _sketch(it, shingle)), f"id {kind}, n long, s1 long, s2 long, hot array<long>, hot_n array<long>"), "sketch")
    hot = sketch.where("hot is not null").select(F.explode(F.arrays_zip("hot", "hot_n")).alias("x")).groupBy("x.hot").agg(F.sum("x.hot_n").alias("c")).orderBy(F.desc("c"), "hot").limit(hints)
    frequent = np.sort(hot.select("hot").toPandas()["hot"].to_numpy(np.int64).view(np.uint64))
    small = {r.n: r["count"] for r in sketch.where("n between 1 and 64").groupBy("n").count().collect()}
    boundary = boundary_by_cost(small, threshold) if boundary is None else boundary
    shipped = spark.sparkContext.broadcast(frequent)

    rows = sketch.where("n >= 0").select("id", "n", "s1", "s2")
    equal = rows.where("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    member = staged(rows.join(equal.hint("merge"), ["s1", "s2", "n"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "member")
    unstaged(sketch)

    listed = source.where("id is not null").mapInArrow(frugal(lambda it: _entries(it, shingle, boundary, shipped.value, threshold)), f"key long, id {kind}, light int")
    several = staged(listed.groupBy("key", "light").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "lists")
    free_shuffles(spark)
    reps = member.where("id is not null and n > 0").select("id", "rep", "n")
    entries = listed.join(several.hint("shuffle_hash"), ["key", "light"]).join(reps.hint("shuffle_hash"), "id")
    entries = staged(entries.groupBy("key", "light", "rep", "n").agg(F.count(F.lit(1)).alias("k")).drop("k"), "entries")
    unstaged(several)
    free_shuffles(spark)

    label = staged(entries.select("rep", "n").distinct().withColumn("comp", F.col("rep")), "label")  # all that can link
    small_sets = entries.where("light > 0")
    first = small_sets.groupBy("key", F.expr("light - n").alias("n")).agg(F.min("rep").alias("a"))  # n: the size that links with those holders
    links, found = counted(small_sets.join(first.hint("merge"), ["key", "n"]).where("rep != a").select("a", F.col("rep").alias("b")).distinct(), "light-links")
    if found["n"]:
        label = merged(label, links)
    heavy = staged(entries.where("light = 0").select("key", "rep", "n"), "heavy")
    keys = staged(heavy.groupBy("rep").agg(F.collect_list("key").alias("keys")), "keys")  # at most a prefix each
    for t in (entries, links):
        unstaged(t)

    def placed() -> DataFrame:
        return staged(heavy.join(label.select("rep", "comp").hint("merge"), "rep").select("key", "rep", "n", "comp"), "placed")

    for t in range(rounds):
        now = placed()
        head = F.struct("rep", "n", "comp")
        lists = now.groupBy("key").agg((F.min_by(head, F.xxhash64("rep", F.lit(t))) if t else F.min(head)).alias("p"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
        pairs = now.join(lists.select("key", "p.comp", "p.rep", "p.n").toDF("key", "comp2", "pivot", "n2").hint("merge"), "key").where(f"comp != comp2 and {fits}")
        pairs, found = counted(pairs.groupBy(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).agg(F.max("n").alias("n"), F.min("n2").alias("n2")), "pairs")
        linked = _verified(source, pairs, keys, shingle, threshold) if found["n"] else None
        unstaged(now)
        unstaged(pairs)
        if linked is None:
            break
        label = merged(label, linked)
        unstaged(linked)

    now = placed()
    weight = label.groupBy("comp").agg(F.count(F.lit(1)).alias("w"))
    now = staged(_with_component(now, weight), "placed")
    lists = now.groupBy("key").agg(F.max(F.struct("w", "comp")).alias("main"), F.count(F.lit(1)).alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    opened, found = counted(now.join(lists.select("key", "main", "size").hint("merge"), "key"), "open")
    unstaged(now)
    free_shuffles(spark)
    if found["n"]:
        # of two components the lighter one's member looks for the other's, in so many of its shortest lists as must hold a common entry
        mine, parts = Window.partitionBy("rep"), F.ceil(F.col("size") / chunk).cast("int")
        outside = opened.withColumn("nth", F.row_number().over(mine.orderBy("size", "key"))).withColumn("held", F.count(F.lit(1)).over(mine))
        outside = outside.where("comp != main.comp").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("main", "size")
        inside = opened.select("key", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"), F.col("rep").alias("rep2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("w").alias("w2"))
        cross = outside.join(inside.hint("merge"), ["key", "part"]).where(f"comp != comp2 and (w < w2 or w = w2 and comp < comp2) and {fits} and nth <= held + 1 - {shared}")
        rest, found = counted(cross.groupBy(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).agg(F.max("n").alias("n"), F.min("n2").alias("n2")), "rest")
        linked = _verified(source, rest, keys, shingle, threshold) if found["n"] else None
        if linked is not None:
            label = merged(label, linked)
    for t in (opened, heavy, keys):
        unstaged(t)
    free_shuffles(spark)
    return member.join(label.select("rep", "comp").hint("merge"), "rep", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.expr("if(n > 0, coalesce(comp, rep), id)").alias("component"))


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("component", "component_id")


def brute_force(rows: list[tuple[int, str]], k: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> dict[int, tuple[int, int]]:
    """The contract by comparing all pairs, for tests."""
    import re

    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(i for i in sets if sets[i]), 2):
        o = len(sets[a] & sets[b])
        if o and threshold[1] * o >= threshold[0] * (len(sets[a]) + len(sets[b]) - o):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) m USING (doc_id)
"""
