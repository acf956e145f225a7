"""Bracket lines, subtitles, action states, change lists, markers and ledgers on fixtures."""

import pytest
from pyspark.sql import functions as F

from inkwell.operators import changes, narrative


def test_bracket_lines(spark):
    text = "[TODO 여기 보강]\n본문\n본문\n\n뉴스 화면이 켜졌다\n\n[유가 급등]\n가\n나\n다\n라\n[문이 열린다]\n마"
    got = [(r.line_no, r.classification, r.blocks, r.confidence, r.terms) for r in narrative.bracket_lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")).orderBy("line_no").collect()]
    assert got == [(1, "authorial_or_editing_note", True, "high", ["TODO", "보강", "여기"]), (7, "storyworld_artifact", False, "high", ["뉴스", "화면", "유가"]), (12, "possible_stage_cue", True, "medium", [])]


def test_subtitles(spark):
    rows = [("w", 1, "시작", "본문이다."), ("w", 2, "", "\n짧은 제목\n본문"), ("w", 3, None, "그는 말했다."), ("v", 1, "", None)]
    out = narrative.subtitles(spark.createDataFrame(rows, "work string, n int, title string, text string"))
    assert [(r.work, r.n, r.subtitle_source, r.subtitle) for r in out.orderBy("work", "n").collect()] == [("v", 1, "none", ""), ("w", 1, "marker", "시작"), ("w", 2, "body", "짧은 제목"), ("w", 3, "none", "")]
    assert [(r.work, r.n, r.action, r.examples) for r in narrative.subtitle_flags(out, "work", "n").collect()] == [("w", 3, "consider_adding_missing_subtitle", "시작\n짧은 제목")]


def test_action_conflicts(spark):
    text = "오늘 보고했다.\n보고하지 않았다.\n" + "줄\n" * 170 + "보고는 없었다\n내일 계약을 승인했다\n승인은 아직 없다"
    df = spark.createDataFrame([(1, text), (2, None)], "id int, text string")
    got = {(r.anchor, r.action, r.first_line, r.second_line, r.first_polarity) for r in narrative.action_conflicts(df, "id").collect()}
    assert got == {("오늘", "report", 1, 2, "affirmed")}
    assert [(r.line_no, r.anchor, r.actions) for r in narrative.state_traces(df, "id").orderBy("line_no").collect()] == [(1, "오늘", "report"), (174, "내일", "trade_order,approval"), (175, "내일", "approval")]


@pytest.mark.parametrize(
    ("given", "want", "applied", "blocked"),
    [
        ([(0, "abcde", "X", "replace", None), (1, "bc", "Y", "insert_after", None)], "X", [0], [1]),
        ([(0, "abc", "X", "replace", None), (1, "abc", "A", "insert_before", None), (2, "abc", "B", "insert_after", None)], "AXBde", [0, 1, 2], []),
        ([(0, "zz", "X", "replace", None), (1, "d", "D", "replace", 2), (2, "e", "", "delete", 1)], "abcd", [2], [0, 1]),
        ([], "abcde", [], []),
    ],
)
def test_apply_changes(spark, given, want, applied, blocked):
    listed = spark.createDataFrame([(1, *g) for g in given], "id int, index int, find string, replace string, operation string, occurrence int")
    got = changes.apply_changes(spark.createDataFrame([(1, "abcde")], "id int, text string"), listed, "id").first()
    assert (got.text, got.applied, got.blocked) == (want, applied, blocked)


def test_ambiguous_anchor_and_null_text(spark):
    listed = spark.createDataFrame([(1, 0, "a", "X", "replace", None), (1, 1, "a", "Y", "replace", 2), (2, 0, "a", "X", "replace", 1), (None, 0, "a", "b", "replace", 1)], "id int, index int, find string, replace string, operation string, occurrence int")
    got = changes.apply_changes(spark.createDataFrame([(1, "a.a"), (2, None), (None, "a")], "id int, text string"), listed, "id")
    assert {(r.id, r.text, tuple(r.applied), tuple(r.blocked)) for r in got.collect()} == {(1, "a.Y", (1,), (0,)), (2, None, (), (0,)), (None, "a", (), ())}


def test_change_issues(spark):
    df = spark.createDataFrame([(1, "11자", "일자", "ⓐ", "replace", "이유"), (2, "가", "판단 필요", "ⓐⓐ", "replace", None), (3, None, None, "x", "move", None), (4, "가", "나", "ⓐ", None, None)], "id int, find string, replace string, marker string, operation string, reason string")
    got = {}
    for r in changes.change_issues(df, "id").collect():
        got.setdefault(r.id, []).append(r.field)
    assert got == {1: ["reading_basis", "context", "confidence_percent", "alternative_interpretation"], 2: ["replace"], 3: ["find", "replace", "marker", "operation"]}


def test_markers(spark):
    df = spark.createDataFrame([("원문A", "교정A", "replace", "ⓐ", None), ("앵커", "후보", "replace", None, "까닭"), ("앵커", "글", "insert_after", "ⓐ", ""), ("글", None, "delete", "ⓐ", None)], "f string, r string, o string, m string, why string")
    assert [r.x for r in df.select(changes.marker_text(*[F.col(c) for c in ("f", "r", "o", "m", "why")]).alias("x")).collect()] == ["ⓐ{원문A|교정A}", "ⓐⓐ{앵커|후보}[수정 판단: 까닭]", "ⓐ{|글}", "ⓐ{글|}"]
    df = spark.createDataFrame([("ⓐ{가|나} ⓐⓐ{다|라}[수정 판단: 왜] 끝",)], "t string")
    c = F.col("t")
    assert tuple(df.select(*changes.marker_counts(c), changes.finalize_markers(c, False), changes.finalize_markers(c, True)).first()) == (1, 1, "나 다 끝", "나 라 끝")


def test_approved(spark):
    df = spark.createDataFrame([(1, "ⓐ", None), (2, "ⓐ", "Rejected"), (3, "ⓐⓐ", None), (4, "ⓐⓐ", "승인"), (5, None, "철회")], "id int, marker string, status string")
    assert [r.id for r in changes.approved(df).collect()] == [1, 4] and [r.id for r in changes.approved(df, True).collect()] == [1, 3, 4]
