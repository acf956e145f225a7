"""Operators on fixtures, and the named queries against their SQL at the smallest scale."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from inkwell.functions import text as fn
from inkwell.operators import integrity, metrics, review, rules, segment
from inkwell.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = catalogue.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    cols = sorted(ours.columns)
    rows = lambda df: sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=repr)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries())


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(("value", "want"), [("a...b", "a…b"), ("....", "…"), (".....", "……"), ("…...", "……"), ("..", ".."), ("", "")])
def test_ellipsis(spark, value, want):
    assert one(spark, value, fn.ellipsis) == want


@pytest.mark.parametrize(("value", "want"), [('"a" "b"', "“a” “b”"), ("don't 'x'", "don't ‘x’"), ("", "")])
def test_curly_quotes(spark, value, want):
    assert one(spark, value, fn.curly_quotes) == want


def test_small_functions(spark):
    assert one(spark, "a'b'c 'd'", fn.style_quotes) == 2
    assert one(spark, "a\r\nb\n", fn.lines_of) == ["a", "b"]
    assert one(spark, "", fn.lines_of) == [] and one(spark, None, fn.lines_of) == []
    assert one(spark, "가나다 ab", fn.hangul_ratio) == 0.6
    assert one(spark, "abcabcab", lambda c: fn.occurrences(c, "ab")) == [0, 3, 6]
    assert one(spark, "aaaa", lambda c: fn.occurrences(c, "aa")) == [0, 2]
    keys = [one(spark, v, fn.natural_key) for v in ("a10", "A2", "a1")]
    assert sorted(keys) == [keys[2], keys[1], keys[0]]


def test_chapters(spark):
    text = "앞\nⓚ제1화 시작\n첫째 줄\n둘째\nⓚ제2화\n셋째\nⓚ제1화 다시\n끝"
    got = segment.chapters(spark.createDataFrame([("w", text), ("x", "no heading"), ("y", None)], "work_id string, text string")).orderBy("work_id", "chapter_no").collect()
    assert [(r.work_id, r.episode, r.base_episode, r.title, r.text) for r in got] == [
        ("w", "001", "001", "시작", "\n첫째 줄\n둘째\n"), ("w", "002", "002", "", "\n셋째\n"), ("w", "001_2", "001", "다시", "\n끝"), ("x", "001", "001", "", "no heading"), ("y", "001", "001", "", ""),
    ]


def test_facts_and_flags(spark):
    df = spark.createDataFrame([(1, "2024년 3월 5일 오전 9시 30분\n가격은 3억 원, 12.5%"), (2, None)], "id int, text string")
    got = {(r.kind, r.value, r.line_no) for r in review.facts(df, rules.FACTS).collect()}
    assert got == {("absolute_date", "2024년 3월 5일", 1), ("date", "2024년 3월 5일", 1), ("time", "오전 9시 30분", 1), ("money", "3억 원", 2), ("percent", "12.5%", 2)}
    df = spark.createDataFrame([(1, "김철수 팀장이 민수 형님께 물었다"), (2, "A사가 (제 3화 끝) 20XX")], "id int, text string")
    assert {(r.kind, r.value) for r in review.facts(df, {k: rules.FACTS[k] for k in ("title_or_role", "kin_title")}).collect()} == {("title_or_role", "김철수 팀장"), ("kin_title", "민수 형님")}
    assert {r.rule for r in review.flags(df, rules.SURFACE).collect()} == {"placeholder_surface", "chapter_end_meta"}
    df = spark.createDataFrame([(1, "@메모 고칠 것\n# 제목\n<s>x</s> &amp;\nⓐ{가|나}")], "id int, text string")
    assert [(r.line_no, r.rule) for r in review.flags(df, rules.HYGIENE).orderBy("line_no", "rule").collect()] == [(1, "author_note_marker"), (2, "markdown_header"), (3, "html_entity"), (3, "strike_marker"), (4, "correction_marker")]


def test_edits_and_gaps(spark):
    df = spark.createDataFrame([("abcdef", [(1, 2, "X"), (3, 5, "")]), ("q", None)], "text string, edits array<struct<start:int,stop:int,replacement:string>>")
    assert [r.text for r in integrity.apply_edits(df).collect()] == ["aXcf", "q"]
    df = spark.createDataFrame([("w", 1), ("w", 4), ("w", 4), ("v", None)], "work string, n long")
    assert {(r.work, r.n) for r in integrity.missing_episodes(df, "work", "n").collect()} == {("w", 2), ("w", 3)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert metrics.chapter_metrics(empty).count() == 0 and review.replay(empty, "source", "doc_id").count() == 0 and segment.sentences(empty).count() == 0


def test_change_contexts_report_gives_three_matches(spark):
    want = set()
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        at = [m.start() for m in re.finditer("tion", r.text or "")]
        want |= {(r.doc_id, n, r.text[max(0, p - 360) : p] + "[[tion]]" + r.text[p + 4 : p + 364]) for n, p in enumerate(at[:3], 1)}
    got = catalogue.QUERIES["change_contexts_report"](spark, DATA).select("doc_id", "nth", "context").collect()
    assert {n for _, n, _ in want} == {1, 2, 3} and len(got) == len(want) and {tuple(r) for r in got} == want
