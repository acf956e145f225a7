"""Operators against plain versions of themselves, and on odd input: very long texts, ties, repeated rows, empty tables, clashing columns, huge numbers."""

import math
import random
import time
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.llm import common, decontaminate, html_extract, jaccard_join, langid, packing, quality, substring_dedup, token_counts, topk, toxicity

DOCS = "doc_id long, text string"


# -- html


def main_text(page):
    return html_extract.along(html_extract.parse(page), None)


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "post search-result", "entry ad-free", "main-header-wide story", "share-enabled"])
def test_words_in_a_class_do_not_lose_the_article(name):
    rest = '<nav>menu</nav><div class="sidebar"><p>side</p></div><footer>foot</footer>'
    assert main_text(f'<body>{rest}<div class="{name}"><p>Article text here, and some more of it.</p></div></body>') == "Article text here, and some more of it."


def test_long_comments_and_adverts_stay_out():
    page = '<div class="post"><p>The article.</p></div><div class="comments"><p>' + "Nice! " * 200 + '</p></div><div class="ad"><p>Buy now, buy now</p></div>'
    assert main_text(page) == "The article."
    assert main_text("<article><p>short</p></article><div class='ad'>" + "buy " * 50 + "</div>") == "short"


def test_captions_and_broken_quotes():
    assert main_text("<figure><img><figcaption>Cap</figcaption></figure><p>x</p>") == "Cap\n\nx"
    assert main_text('<p title="x>b</p><p>c</p>') == "b\n\nc"


@pytest.mark.parametrize("piece", ['<a "', "<!", '<a "<b" ', '<p title="x>b ', "<div class='\"'", "<div>", "</p>", "<div></p>"])
def test_parsing_is_linear(piece):
    began = time.time()
    html_extract.parse(piece * 60_000)
    assert time.time() - began < 15


def test_extraction_equals_a_plain_reading(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéü&<") for _ in range(rng.randint(1, 8)))
    rows, want = [], {}
    for i in range(60):
        blocks = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(rng.randint(1, 6))]
        body = "".join(f"<p>{b.replace('&', '&amp;').replace('<', '&lt;').replace(' ', rng.choice([' ', chr(10), ' <b></b> ']))}</p>" for b in blocks)
        page = f"<html><head><title>t</title></head><body><nav><a href=x>{word()}</a></nav><!-- {word()} --><article>{body}</article><footer>{word()}</footer></body></html>"
        rows += [(i, f"http://h{i % 3}.x/", page)] * (1 + i % 2)
        want[i] = "\n\n".join(blocks)
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r.text == want[r.page_id] for r in got)


# -- packing


def fewest_bins(sizes, capacity):
    """By dynamic programming over subsets."""
    n = len(sizes)

    @lru_cache(None)
    def best(mask):
        if mask == (1 << n) - 1:
            return (0, 0)
        out = None
        for i in range(n):
            if not mask >> i & 1:
                bins, room = best(mask | 1 << i)
                new = (bins, room - sizes[i]) if room >= sizes[i] else (bins + 1, capacity - sizes[i])
                if out is None or (new[0], -new[1]) < (out[0], -out[1]):
                    out = new
        return out

    return best(0)[0]


def test_packing_is_optimal_on_small_instances():
    rng = random.Random(11)
    for _ in range(120):
        capacity = rng.choice([10, 20, 37, 60])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        counts = Counter(sizes)
        plan, proved = packing.solve(counts, capacity, None)
        assert proved and sum(n for _, n in plan) == fewest_bins(tuple(sizes), capacity)
        placed = Counter()
        for lengths, n in plan:
            assert sum(lengths) <= capacity
            for s in lengths:
                placed[s] += n
        assert placed == counts
        plan, proved = packing.solve(counts, capacity)
        assert proved and sum(n for _, n in plan) == fewest_bins(tuple(sizes), capacity)


def test_fillings_are_all_the_undominated_ones():
    counts = {2: 1, 3: 2, 5: 1, 7: 3}
    got = list(packing.fillings(12, counts, sorted(counts), 12))
    assert len(set(got)) == len(got) and [w for _, w in got] == sorted(w for _, w in got)
    assert ((7, 5), 0) in got and ((7, 3, 2), 0) in got and all(12 - sum(f) == w for f, w in got)
    assert not any(f == (7, 3) for f, _ in got)  # a 2 still fits


# -- toxicity


def maximal_segments(scores):
    """By the definition: the best segment, then the same to its left and right."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 0 and (best is None or s > best[0]):
                best = (s, i, j)
    if not best:
        return []
    s, i, j = best
    return maximal_segments(scores[:i]) + [(i, j, s)] + [(a + j, b + j, x) for a, b, x in maximal_segments(scores[j:])]


def test_segments_equal_their_definition():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-7, -3, -2, -1, 1, 2, 4, 6]) + rng.random() / 8 for _ in range(rng.randint(0, 14))]
        want, got = maximal_segments(scores), toxicity.segments(scores)
        assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


@pytest.mark.parametrize("scores", [[1, -2] * 300_000, [2, -1] * 300_000, [3, -1, 1, -2] * 150_000])
def test_segments_take_linear_time(scores):
    began = time.time()
    toxicity.segments(scores)
    assert time.time() - began < 10


def test_logistic_ends_at_its_maximum_where_classes_are_parted():
    rng = np.random.default_rng(0)
    for shift in (0.5, 3.0, 8.0, 40.0):
        y = (rng.random(4000) < 0.1).astype(float)
        x = np.column_stack((np.ones(4000), rng.normal(-1, 0.01, 4000) + y * shift, y * shift * 0.4))
        w = toxicity._logistic(x, y)
        assert np.isfinite(w).all() and ((x @ w > 0) == (y == 1)).mean() > 0.9 if shift < 3 else ((x @ w > 0) == (y == 1)).all()


def test_passages_have_places_where_lower_case_is_longer(spark):
    model = toxicity.Model({"idiot": 8.0}, 1.0, 0.01, np.zeros(3))
    text = "İİ so it goes İ idiot İ"
    r = toxicity.score_toxicity(spark.createDataFrame([(1, text)], DOCS), model).first()
    assert [text[p.start : p.stop] for p in r.passages] == ["idiot"]


# -- quality


def test_quality_scores_equal_lookups_one_by_one():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, len(quality.FEATURES)))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float))
    for row, score in zip(x[:50], model.score(x)[:50], strict=True):
        b = [int(np.searchsorted(e, v, side="right")) for e, v in zip(model.edges, row, strict=True)]
        if b != list(model.bins(row[None])[0]):
            b = [int(np.searchsorted(e, v)) for e, v in zip(model.edges, row, strict=True)]
        z = model.intercept + sum(model.single[j][k] for j, k in enumerate(b)) + sum(v[b[j], b[k]] for (j, k), v in model.pairs.items())
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-6)


# -- languages


def plain_vector(text, d=langid.DIMENSIONS):
    """Letter by letter: n-grams over words parted and closed by one boundary; the last may end behind the text, with a boundary."""
    run = []
    for c in text.lower() + " ":
        if c.isalpha():
            run.append(ord(c))
        elif run and run[-1]:
            run.append(0)
    total = np.zeros(d)
    letter = {p: langid.letter_vectors(np.array([p]), d)[0].astype(int) for p in {*run, 0}}
    letter[0] = np.abs(letter[0])
    for i in range(len(run) - langid.GRAM + 2):
        v = np.ones(d, int)
        for j, p in enumerate([*run, 0][i : i + langid.GRAM]):
            v = v * np.roll(letter[p], langid.GRAM - 1 - j)
        total += v
    return total


def test_text_vectors_equal_plain_ones():
    texts = ["the cat sat on the mat", "Übergrößen sind schön", "abcdef ghijkl", "", "a", "1 2", "-b c", "ab"]
    for some in ([t] for t in texts):
        assert np.array_equal(langid.text_vectors(some)[0][0], plain_vector(some[0]))
    got, has = langid.text_vectors([*texts, *texts])
    assert np.array_equal(got, [plain_vector(t) for t in [*texts, *texts]]) and list(has[:8]) == [True, True, True, False, True, False, True, True]


def test_any_number_of_letters_and_texts(spark):
    letters = [c for c in range(0x4E00, 0x9FFF)] + [c for c in range(0xAC00, 0xD7A3)] + [c for c in range(0x20000, 0x2A6D0)]
    odd = "".join(map(chr, letters))
    vectors, some = langid.text_vectors([odd, *["der hund und die katze"] * 999])
    assert some.all() and np.isfinite(vectors).all() and np.array_equal(vectors[1], vectors[-1])
    rows = [(0, odd), *((i, "the cat and the dog" if i % 2 else "der hund und die katze") for i in range(1, 5001))]
    train = spark.createDataFrame([("the dog and a cat", "en"), ("der hund und eine katze", "de")], "text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, DOCS), train).collect()}
    assert all(got[i] == ("en" if i % 2 else "de") for i in range(1, 5001))


def test_equal_cosines_go_to_the_first_language(spark):
    train = spark.createDataFrame([("aaa bbb", "zz"), ("aaa bbb", "bb")], "text string, lang string")
    docs = spark.createDataFrame([(1, "aaa bbb"), (1, "aaa bbb")], DOCS)
    assert [r.lang_pred for r in langid.identify(docs, train).collect()] == ["bb", "bb"]


# -- decontamination


def test_blocks_of_the_benchmark_merge(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 13, 20])))) for i in range(40)]
    docs = [(i // 2, " ".join([*(rng.choice(words) for _ in range(40)), items[i % 40][1], *(rng.choice(words) for _ in range(40))])) for i in range(60)] + [(99, None), (None, items[0][1])]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(repr, decontaminate.decontaminate(d, b).collect()))
    assert sorted(map(repr, decontaminate.decontaminate(d, b, block_bytes=300).collect())) == one


# -- near copies


def test_few_links_are_merged_without_star_steps(spark, monkeypatch):
    rng, stars = random.Random(4), jaccard_join.stars
    links = [(rng.randrange(-50, 0), rng.randrange(0, 80)) for _ in range(70)] + [(i, i + 1) for i in range(100, 160)] + [(2**62, 2**62 + 1)]
    ids = sorted({x for e in links for x in e} | {-99})
    label = lambda: common.staged(spark.createDataFrame([(i, 9, i) for i in ids], "rep long, n long, comp long"), "label")
    edges = common.staged(spark.createDataFrame(links, "a long, b long"), "links")
    monkeypatch.setattr(jaccard_join, "FEW", -1)
    want = sorted(map(tuple, jaccard_join.merged(label(), edges).collect()))
    monkeypatch.setattr(jaccard_join, "FEW", 1000)
    monkeypatch.setattr(jaccard_join, "stars", None)
    assert sorted(map(tuple, jaccard_join.merged(label(), edges).collect())) == want and (160, 9, 100) in want and (-99, 9, -99) in want
    monkeypatch.setattr(jaccard_join, "stars", stars)
    named = lambda df: df.select(*[F.format_string("%03d", c).alias(c) if c != "n" else F.col(c) for c in df.columns])
    texts = jaccard_join.merged(common.staged(named(label().where("rep between 0 and 200")), "label"), common.staged(named(edges.where("a between 0 and 200")), "links"))
    assert {r.rep: r.comp for r in texts.collect()}["160"] == "100"


# -- token counts


def test_unigram_scores_of_a_bpe_vocabulary():
    v = token_counts.zipf({"b": -1.0, "a": 0.0, "ab": -2.0})
    assert math.isclose(sum(map(math.exp, v.values())), 1.0) and v["a"] > v["b"] > v["ab"]


def test_only_pieces_that_end_at_a_place_are_looked_at():
    rng = random.Random(9)
    pieces = {"▁": -2.0, "a": -1.0, "ab": -1.5, "aba": -2.5, "b" * 4000 + "c": -1.0, "é": -3.0}
    trie, began = token_counts.Trie(token_counts.Vocabulary(pieces)), time.time()
    assert trie.insert("▁" + "ab" * 4000) == 4001 and time.time() - began < 2
    for _ in range(300):
        word = "".join(rng.choice("abé日") for _ in range(rng.randint(0, 9)))
        assert trie.insert("▁" + word) == token_counts.brute_force(word, pieces) if word else trie.insert("▁") == 1


def test_counts_with_the_query_vocabulary_equal_brute_force(spark):
    import public_tokenizers

    vocabulary = token_counts.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert math.isclose(sum(map(math.exp, vocabulary.pieces.values())), 1.0, rel_tol=1e-6)
    texts = ["the cat sat", "niño über", "zzqx  the", "the the", "日本 the", ""]
    rows = [*enumerate(texts), (0, "the cat sat"), (None, "cat"), (77, "a" * 100_000)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, DOCS), vocabulary=public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id != 77:
            assert r.n_tokens == token_counts.brute_force(dict(rows)[r.doc_id] or "", vocabulary.pieces)


# -- search


def test_search_with_huge_components_and_other_ids(spark):
    df = spark.createDataFrame([(0, [1e7, 1.0]), (50, [1e18, -1e18]), (3, [1.0, 1.0]), (4, [-1e300, 2.0])], "vec_id long, embedding array<double>")
    top = 2**63 - 1
    got = [tuple(r) for r in topk.top_k(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50, top), (0, 2, 3, 256 * 10_000_001 * 256), (0, 3, 4, -top), (50, 1, 0, top), (50, 2, 3, 0), (50, 3, 4, -top)]
    named = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, -1.0]), ("c", [2.0, 1.0]), ("d", [1.0, -1.0])], "vec_id string, embedding array<double>")
    assert [(r.id, r.score) for r in topk.top_k(named, query="vec_id = 'a'").orderBy("rank").collect()] == [("c", 196608), ("b", 0), ("d", 0)]


def test_search_in_rounds_and_small_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = sorted(map(tuple, topk.top_k(df, query="vec_id % 10 = 0").collect()))
    assert len(want) == 150
    for kw in ({"round_bytes": 500}, {"block": 16}, {"block": 7, "round_bytes": 1000}):
        assert sorted(map(tuple, topk.top_k(df, query="vec_id % 10 = 0", **kw).collect())) == want


# -- all


def test_empty_tables_of_the_classifiers(spark):
    docs, labels = spark.createDataFrame([], DOCS + ", lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, labels)).count() == 0
    assert quality.score_quality(docs, quality.quality_model(docs, labels)).count() == 0
    assert langid.identify(docs, docs).count() == 0
    assert token_counts.count_tokens(docs, vocabulary={"a": -1.0}).count() == 0


def test_clashing_columns(spark):
    names = "id key row text h score rep n comp lang item_ids spans".split()
    docs = spark.createDataFrame([(1, "the cat sat on the mat")], DOCS).select("doc_id", "text", *[F.lit("x").alias(c) for c in names if c != "text"])
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    model = toxicity.Model({}, 1.0, 1.0, np.zeros(3))
    for df in (
        packing.pack(docs, tokenizer=packing.byte_bpe()), substring_dedup.remove_repeats(docs), jaccard_join.jaccard_components(docs), decontaminate.decontaminate(docs, bench), toxicity.score_toxicity(docs, model),
        langid.identify(docs, docs), token_counts.count_tokens(docs, vocabulary={"a": -1.0}),
    ):
        assert df.count() == 1
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string").select("*", *[F.lit("x").alias(c) for c in ("text", "host", "row", "path_")])
    assert html_extract.extract(pages).first().text == "x"
    vectors = spark.createDataFrame([(0, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>").select("*", F.lit("x").alias("id"), F.lit("x").alias("v"))
    assert topk.top_k(vectors).count() == 1


@pytest.mark.parametrize("words", ["", "a", "a b", "a b c", "a b c d"])
def test_slices_of_few_words(words):
    for k in (1, 4, 5):
        assert len(jaccard_join.shingle_sets([words.encode()], k)[0]) == (max(1, len(words.split()) - k + 1) if words else 0)


def test_one_very_long_text(spark):
    long = " ".join(f"word{i % 5000}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, long)], DOCS)
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(docs).collect()}
    assert got[3].component == 1 and got[2].component == 2
    assert {r.doc_id: r.n_words for r in decontaminate.decontaminate(docs, spark.createDataFrame([(1, "word1 word2")], "item_id long, text string")).collect()} == {1: 200_000, 2: 1, 3: 200_000}
    cut = {r.doc_id: (r.n_bytes, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect()}
    assert cut[3] == (len(long), len(long)) and cut[2] == (5, 0)


# -- memory of the executors


def held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) / 1024


def test_a_worker_gives_its_memory_back_at_a_tasks_end():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(50_000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(3_000)]  # 8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])

    def left(f):
        common.give_back()
        before = held_mb()
        for _ in f(iter([batch])):
            pass
        return held_mb() - before

    plain = lambda it: jaccard_join._sketch(it, 4)
    assert left(common.frugal(plain)) < min(20, left(plain) / 2)


def test_shared_shingles_and_their_counts():
    texts = ["a b c d"] * 3 + ["e f g h"] * 2 + ["i j k l m"] * 4 + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    for flush in (1, 6_000_000):
        rows = [r for b in jaccard_join._sketch(iter([batch]), 4, flush=flush) for r in b.to_pylist()]
        assert sorted(c for r in rows for c in r["hot_n"] or ()) == [3, 4, 4]


def test_executors_collect_their_garbage(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    full = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "Mark" in b.getName())
    before = full()
    common.free_heaps(spark)
    assert full() > before


def test_toxic_units_are_counted_in_parts(spark):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(300)) for _ in range(1_200)]
    rows = [(i, t + (" vile brute" if i % 4 == 0 else ""), i % 4 == 0) for i, t in enumerate(texts)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], DOCS), spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    table = toxicity.toxicity_model(docs.coalesce(1), labels).table
    assert table["vile"] > 0 and table == toxicity.toxicity_model(docs.repartition(6), labels).table
