"""The training-data operators against brute force, round trips and held-out labels."""

import array
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from inkwell.llm import decontaminate, html_extract, jaccard_join, langid, packing, quality, registry, substring_dedup, token_counts, topk, toxicity

DATA = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, DATA).toPandas(), duck.execute(registry.ORACLES[name]).df()
    cols = sorted(theirs.columns)
    assert sorted(ours.columns) == cols
    assert sorted(map(tuple, ours[cols].values.tolist()), key=repr) == sorted(map(tuple, theirs[cols].values.tolist()), key=repr)


def documents(spark, d=DATA):
    return spark.read.parquet(f"{d}/documents.parquet")


# -- packing


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_packs_all(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 50, 100, 1024])
    counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 40))}
    plan, packed = packing.bin_completion(counts, capacity), {}
    for lengths, n in plan:
        assert sum(lengths) <= capacity
        for s in lengths:
            packed[s] = packed.get(s, 0) + n
    assert packed == counts
    assert packing.lower_bound(counts, capacity) <= sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(counts, capacity))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.byte_bpe())
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + [(9001, None), (9002, ""), (9003, "<|endoftext|> x"), (None, "a b"), (9004, "a b")]
    got = packing.pack(spark.createDataFrame(rows, DOCS), tokenizer=packing.byte_bpe()).toPandas()
    texts = {i: t.encode(x or "", add_special_tokens=False).ids + [2] for i, x in rows}
    by_doc = {None if i != i else int(i): g.sort_values("piece") for i, g in got.groupby("doc_id", dropna=False)}
    assert set(by_doc) == set(texts)
    for i, ids in texts.items():
        g = by_doc[i]
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() == len(ids) and (g.length <= 1024).all() and (g.length.iloc[1:] == 1024).all()
        assert [zlib.crc32(array.array("I", ids[a : a + n]).tobytes()) for a, n in zip(g.start, g.length, strict=True)] == g.ids_crc32.tolist()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 1024


# -- removal of repeats


def test_repeats_equal_brute_force(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("ab") for _ in range(300)) for _ in range(3)] + ["x" * 500, "abc" * 120]
    piece = lambda: rng.choice([rng.choice(base)[rng.randint(0, 150) :][: rng.randint(50, 300)], "é" * rng.randint(1, 60), str(rng.random()), ""])
    rows = [(i, "".join(piece() for _ in range(4))) for i in range(150)] + [(r.doc_id + 1000, r.text) for r in documents(spark).collect()]
    want = substring_dedup.brute_force([(i, t.encode()) for i, t in rows])
    df = spark.createDataFrame([*rows, (None, "q" * 300), (5000, None)], DOCS).withColumn("ranges", F.lit(1)).withColumn("id", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.remove_repeats(df).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "sha2(kept, 256)").collect()}
    assert got.pop(None)[1] == 0 and got.pop(5000)[:3] == (0, 0, 0)
    assert got == want


# -- similarity join


@pytest.mark.parametrize("boundary", [None, 16])
def test_join_equals_brute_force(spark, boundary):
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(40)], []
    for _ in range(50):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 6, 8, 10, 12, 15, 18, 22, 30, 60, 120]))]
        for _ in range(rng.randint(1, 7)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                p = rng.randrange(len(t))
                t[p : p + rng.randint(0, 1)] = [rng.choice(words) for _ in range(rng.randint(0, 1))]
                t = t or ["x"]
            rows.append((len(rows) * 3, " ".join(t).upper() if rng.random() < 0.3 else "\t".join(t)))
    rows += [(9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "One ")]
    want = jaccard_join.brute_force(rows)
    got = {r[0]: tuple(r)[1:] for r in jaccard_join.jaccard_components(spark.createDataFrame([*rows, (None, "a b c d e")], DOCS), boundary=boundary).collect()}
    assert got.pop(None) == (2, None)
    assert got == want


@pytest.mark.parametrize(("boundary", "shingle", "threshold"), [(7, 4, (85, 100)), (16, 4, (85, 100)), (5, 5, (80, 100)), (16, 5, (80, 100))])
def test_light_links_need_both_sizes(spark, boundary, shingle, threshold):
    words, rows = "abcdefghij", []
    for size in range(4, 9):  # texts that differ in the last word, without and with the shorter text that links them
        for shorter in (False, True):
            texts = [" ".join(f"{w}{len(rows)}" for w in words[: size + shingle - 1])]
            texts.append(texts[0].rsplit(" ", 1)[0] + " other")
            texts += [texts[0].rsplit(" ", 1)[0]] if shorter else []
            rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
    got = {r[0]: tuple(r)[1:] for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS), shingle=shingle, threshold=threshold, boundary=boundary).collect()}
    assert got == jaccard_join.brute_force(rows, shingle, threshold)


# -- decontamination


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(0)
    t = np.concatenate((rng.integers(1, 5, 400), [0]))
    index = decontaminate.FMIndex(t, 5)
    patterns = np.array([t[i : i + 3] for i in range(100)])
    lo, hi = index.count(patterns)
    for p, a, b in zip(patterns, lo, hi, strict=True):
        want = [i for i in range(len(t) - 2) if (t[i : i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_contamination_cases(spark):
    item = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([("a", item), ("b", "short Item"), ("c", None), (None, "lone"), ("d", ""), ("a", item)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, "a SHORT, item here"), (3, None), (4, ""), (5, "w0 w1 w2"), (6, "lone " + "z " * 30)], DOCS).withColumn("n_hit", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (22, 20, ["a"], True), 2: (4, 2, ["b"], True), 3: (0, 0, [], False), 4: (0, 0, [], False), 5: (3, 0, [], False), 6: (31, 1, [], False)}
    assert {r.doc_id: r.spans for r in decontaminate.decontaminate(docs, bench, block_bytes=60).collect()}[1][0].asDict() == {"start": 2, "end": 2 + len(item)}


# -- search


def test_top_k_edge_cases(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, [1.0, -1.0]), (50, [1.0, -1.0]), (3, [1.0, -1.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [0.0, 0.0]), (None, [1.0, 1.0]), (8, [2.0]), (100, [])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 131072), (0, 2, 50, 131072), (0, 3, 7, 0), (50, 1, 0, 131072), (50, 2, 3, 131072), (50, 3, 7, 0)]


def test_top_k_counts_repeated_rows_once(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-9, 9) / 4 for _ in range(6)]) for i in range(60)]
    rows += [(i, [-x for x in v]) for i, v in rows if i % 7 == 0] + [(60 + i % 3, [2.0] * i + [2.5] + [2.0] * (5 - i)) for i in range(6)]  # ids with several vectors, some of equal scores
    scores = {(q, c, int(sum(256 * x * 256 * y for x, y in zip(a, b)))) for q, a in rows if q % 10 == 0 for c, b in rows if q != c}
    want = [(q, n + 1, c, -s) for q in range(0, 61, 10) for n, (s, c) in enumerate(sorted((-s, c) for p, c, s in scores if p == q)[:5])]
    for times, block in ((1, 4096), (2, 4096), (9, 4096), (2, 16), (300, 64)):
        df = spark.createDataFrame(rows * times, "vec_id long, embedding array<float>")
        assert [tuple(r) for r in topk.top_k(df, query="vec_id % 10 = 0", block=block).orderBy("query_id", "rank").collect()] == want


def test_search_is_exact_for_queries_of_large_norm():
    rng = np.random.default_rng(4)
    for _ in range(5):
        values = np.full((3000, 64), 133, np.int32)
        for row in values:  # scores differ by less than 32 bits can tell
            row[rng.choice(64, 2, replace=False)] += [1, -1]
        queries = (40_000 + rng.integers(0, 9, (4, 64))).astype(np.int32)
        lists, ids = topk.SortedLists(np.arange(3000), values), np.arange(3000)
        assert lists.values.dtype == np.float32
        for j, found, scores in lists.search(queries, np.full(4, -1), 5, np.full(4, -np.inf)):
            want = values.astype(np.int64) @ queries[j].astype(np.int64)
            best = np.lexsort((ids, -want))[:5]
            assert found.tolist() == best.tolist() and scores.tolist() == want[best].tolist()


# -- token counts


def test_token_counts_equal_brute_force(spark):
    rng = random.Random(2)
    pieces = {"▁": -3.0, "▁a": -1.0, "b": -2.0, "ab": -1.5, "c": -2.0, "bc": -1.7, "▁ab": -2.2, "abc": -1.9, "é": -4.0}
    rows = [(i, " ".join("".join(rng.choice("abcéz") for _ in range(rng.randint(0, 7))) for _ in range(5))) for i in range(60)] + [(99, None)]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(spark.createDataFrame(rows, DOCS), vocabulary=pieces).collect()}
    assert got == {i: token_counts.brute_force(t or "", pieces) for i, t in rows}


# -- html


def test_extraction(spark):
    page = """<html><body><div id="page"><div class="site-header">Top</div><div class="post post-17"><h2>T &lt; 1</h2><p>One<p>Two <a href=x>l</a>
    <ul><li>a<li>b</ul><div class="comments"><p>Nice</p></div><form><p>f</p></form><script>var x="</p>"</script></div><div class="sidebar">s</div></div>"""
    df = spark.createDataFrame([(1, "http://a.b/c", page, "x"), (2, None, None, "y"), (3, "http://a.b/d", "", "z"), (4, "zz", "<p", "q")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {1: "T < 1\n\nOne\n\nTwo l\n\na\n\nb", 2: "", 3: "", 4: "<p"}
    # the host's path decides where a page alone would choose another container
    common, odd = "<div class=post><p>{}</p></div><div class=junk><p>{}</p></div>".format, "http://h.x/"
    rows = [(i, odd, common("long text " * 9, "s")) for i in range(5)] + [(9, odd, common("short", "very long other text " * 9))]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short"


def test_extraction_keeps_whole_articles(spark):
    short, long = "intro " * 50, "body text " * 100
    cell = f"<tr><td>{long}</td></tr>"
    whole = [
        f"<article><h1>T</h1><p>{short}</p><section><p>{long}</p></section></article>", f"<article><h1>T</h1><div class=body><p>{long}</p></div></article>", f"<article><section class=a><p>{long}</p></section><section class=b><p>{short}</p></section></article>",
        f"<article><p>{short}</p><table>{cell}{cell}</table></article>", f"<div class=post><h1>T</h1><div class=body><p>{long}</p></div></div>", f"<div class=post><p>{short}</p><div><div><p>{long}</p></div></div></div>",
    ]
    page = "<html><body><div class=junk><p>unmarked</p></div>{}</body></html>".format
    rows = [(i, f"http://h{i}.x/", page(x)) for i, x in enumerate(whole)]
    want = {i: " ".join(re.sub("<[^>]*>", " ", x).split()) for i, x in enumerate(whole)}
    # a page whose article is elsewhere than on its host's other pages
    rows += [(100 + i, "http://h.x/", page(f"<div class=post><p>{long}</p></div>")) for i in range(5)] + [(200, "http://h.x/", page(f"<div class=post><p>teaser</p></div><div class=story><p>{long}</p></div>"))]
    want |= dict.fromkeys([*range(100, 105), 200], long.strip())
    got = {r.page_id: " ".join(r.text.split()) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_extraction_of_containers_with_marked_words():
    inner, away = "<p>The text</p><div class=site-header>Top</div>", "<div class=sidebar>side</div>"
    for open_, close in (("<main class='has-sidebar'>", "</main>"), ("<article class='post share-enabled'>", "</article>"), ("<div id='content' class='with-header'>", "</div>"), ("<article class='post search'>", "</article>")):
        blocks = html_extract.parse(f"<html class='no-sidebar'><body>{open_}{inner}{close}{away}</body></html>")
        assert [b[1] for b in blocks] == ["The text"]
    assert [b[1] for b in html_extract.parse("<body><div class='comments'><p>All there is</p></div><nav>n</nav></body>")] == ["All there is"]


# -- classifiers


def test_segments_are_maximal():
    assert toxicity.segments([1, -2, 3, 1, -1, 4, -9, 2]) == [(0, 1, 1), (2, 6, 7), (7, 8, 2)]
    assert toxicity.segments([]) == [] and toxicity.segments([-1, -1]) == []


def held_out_accuracy(spark, query, label):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = query(spark, SMALL).where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(got) > 40
    return sum(r.predicted == r[label] for r in got) / len(got)


def test_held_out_labels(spark):
    assert held_out_accuracy(spark, toxicity.op5_toxicity, "toxic") > 0.93
    assert held_out_accuracy(spark, quality.op2_quality_classifier, "quality") > 0.93


def test_held_out_languages(spark):
    got = langid.op7_language_id(spark, SMALL).where("held_out").join(documents(spark, SMALL), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123"), (None, "der die das")], DOCS)
    train = spark.createDataFrame([("the of and", "en"), ("der die das", "de"), (None, "fr")], "text string, lang string")
    assert {r.doc_id: r.lang_pred for r in langid.identify(odd, train).collect()} == {1: "und", 2: "und", 3: "und", None: "de"}


def test_classifiers_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (None, "word"), (3, "word")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, none)).count() == 5
    assert [r.score for r in quality.score_quality(docs, quality.quality_model(docs, none)).collect()] == [0.5] * 5


def test_empty_tables(spark):
    docs, vectors = spark.createDataFrame([], DOCS), spark.createDataFrame([], "vec_id long, embedding array<float>")
    pages, bench = spark.createDataFrame([], "page_id long, url string, html string"), spark.createDataFrame([], "item_id long, text string")
    for df in (packing.pack(docs, tokenizer=packing.byte_bpe()), substring_dedup.remove_repeats(docs), jaccard_join.jaccard_components(docs), decontaminate.decontaminate(docs, bench), topk.top_k(vectors), html_extract.extract(pages)):
        assert df.count() == 0


# -- pipeline


def test_pipeline_stages(spark):
    docs = documents(spark)
    kept = corpus_pipeline.toxicity(spark, docs, DATA)
    assert kept.columns == docs.columns
    model = toxicity.toxicity_model(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxicity.score_toxicity(docs, model).where("score < 0.5").collect()}
    want = jaccard_join.brute_force([(r.doc_id, r.text) for r in kept.collect()], 5, (80, 100))
    kept = corpus_pipeline.near_duplicates(spark, kept, DATA).cache()
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}
    want = substring_dedup.brute_force([(r.doc_id, r.text.encode()) for r in kept.collect()])
    cut = corpus_pipeline.substring_dedup(spark, kept, DATA).cache()
    assert cut.columns == docs.columns and cut.count() == kept.count()
    assert all(0 <= want[r.doc_id][0] - want[r.doc_id][1] - len(r.text.encode()) < 8 * (1 + want[r.doc_id][2]) for r in cut.collect())
    clean = corpus_pipeline.benchmark_decontamination(spark, cut, DATA)
    bad = decontaminate.decontaminate(cut, spark.read.parquet(f"{DATA}/benchmark.parquet")).where("contaminated")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in cut.collect()} - {r.doc_id for r in bad.collect()}
    assert corpus_pipeline.best_fit_packing(spark, clean, DATA).select("doc_id").distinct().count() == clean.count()
