"""Headings, format, contracts, reports, source integrity and sinks on small cases."""

from pyspark.sql import functions as F

from inkwell.functions.text import natural_key, no_space_length
from inkwell.operators import author, catalog, contracts, gate, headings, metrics, protocol, reports, sourcecheck, style, typos
from inkwell.sinks import files
from inkwell.sources import collections


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "work_id long, text string")


def one(spark, text, column):
    return texts(spark, text).select(column.alias("x")).first().x


def test_markers(spark):
    m = one(spark, "ⓚ제1화\n완벽한 11자의 틈새.\n다음 줄\n", headings.heading_markers(F.col("text")))
    assert [(x.episode, x.start, x.stop) for x in m] == [("001", 0, 4)]
    rows = headings.chapters(texts(spark, "# 10일 후의 일\n본문", "## Chapter 2 Long\na\nⓚ Chapter 1000\nb\nchapter 1001\nc", "　제3화\n머리", "# Title one\n\nfoo\n## Two\nbar", None)).orderBy("work_id", "chapter_no").collect()
    assert [(r.work_id, r.episode, r.title, r.text) for r in rows] == [
        (0, "001", "10일 후의 일", "\n본문"), (1, "002", "Long", "\na\n"), (1, "1000", "", "\nb\n"), (1, "1001", "", "\nc"), (2, "003", "", "\n머리"), (3, "001", "Title one", "\nfoo\n"), (3, "002", "Two", "\nbar"), (4, "001", "", ""),
    ]


def test_heading_forms(spark):
    form = lambda t: one(spark, t, headings.normalize_headings(F.col("text")))
    assert form("ⓚ제 18화") == "ⓚ제18화" and form("# 제 18화 - 소제목") == "ⓚ제18화 소제목"
    assert form("126.\n첫 줄\n127.\n다음 줄\n") == "ⓚ126.\n첫 줄\nⓚ127.\n다음 줄\n" and form("126.\n첫 줄") == "126.\n첫 줄"
    assert form("# 처음\nx\n## 둘째") == "ⓚ제1화 처음\nx\nⓚ제2화 둘째"


def test_formatter(spark):
    text = "\n".join(["Episode 1. 제목", "", "지문", "", "지문2", "“대사”", "", "“대사2 with 'inner'... ”", "", "", "지문3"])
    want = "ⓚEpisode 1. 제목\n\n\n\n지문\n지문2\n\n“대사”\n“대사2 with ‘inner’… ”\n\n지문3\n"
    done = headings.format_manuscript(texts(spark, text))
    assert done.first().text == want
    assert headings.format_manuscript(done).first().text == want and headings.format_flags(done).count() == 0
    kinds = {r.subtype for r in headings.format_flags(texts(spark, "1화\n\n“a”\nb 'x' ... \"y\"\n")).collect()}
    assert kinds == {"chapter_heading_missing_k", "chapter_heading_blank_lines", "straight_double_quote", "straight_single_quote", "ascii_ellipsis", "dialogue_narration_spacing"}


def test_white_space_is_unicode(spark):
    text = "a　b\n　\n\t\nc d e "
    m = metrics.chapter_metrics(texts(spark, text)).first()
    assert (m.chars_no_space, m.non_empty_lines) == (5, 2) and one(spark, text, no_space_length(F.col("text"))) == 5


def test_natural_keys_of_long_numbers(spark):
    names = ["a1", "a2", "a10", "a" + "9" * 20, "a1" + "0" * 20, "a1" + "0" * 19 + "1", "a" + "0" * 30 + "3"]
    keys = {r.text: r.k for r in texts(spark, *names).select("text", natural_key(F.col("text")).alias("k")).collect()}
    assert len(set(keys.values())) == len(names)
    assert sorted(names, key=keys.get) == ["a1", "a2", "a" + "0" * 30 + "3", "a10", "a" + "9" * 20, "a1" + "0" * 20, "a1" + "0" * 19 + "1"]


def test_typos(spark):
    text = "그 11자 틈새 펜촉\n11자 틈새\n순간 숙식간 피난 주에도\n책임의무게 말하지마요\n제품에 끌어안고 튀어 나왔다.......\n“열린"
    got = {(r.line_no, r.subtype): (r.severity, r.replacement) for r in typos.contextual_typos(texts(spark, text)).collect()}
    assert got[1, "numeric_shape_homograph"][0] == "P2" and got[2, "numeric_shape_homograph"][0] == "P3" and got[5, "product_vs_chest"] == ("P2", "품에")
    assert got[5, "ascii_ellipsis"][1] == "……" and got[5, "compound_spacing"][1] == "튀어나왔다" and (6, "quote_balance") in got and (3, "surface_typo") in got


def test_surface_scan(spark):
    text = "(제 3 화 끝)\n김철수(구 이름) TODO\nA사는 OOO\nGPT-4 인공지능이 작성\nhello there(안녕하세요)\n" + "TODO\n" * 9
    got = {r.signal_type: (r.n, len(r.examples)) for r in style.surface_scan(texts(spark, text), "work_id").collect()}
    assert got["internal_memo_surface"] == (10, 5) and got["ai_tool_surface"][0] == 2 and got["placeholder_surface"][0] == 2 and got["chapter_end_meta"] == (1, 1) and got["part_end_meta"] == (0, 0)


def test_sources(spark):
    text = "ⓚ제53화\n전 회차의 마지막 문장.54화\n다음 회차 첫 줄\n다음 회차 마지막 문장.55화\n세 번째\n다른 99화\n"
    r = sourcecheck.split_tails(texts(spark, text)).first()
    assert [(s.line, s.from_episode, s.to_episode) for s in r.splits] == [(2, 53, 54), (4, 54, 55)]
    assert r.text == "ⓚ제53화\n전 회차의 마지막 문장.\nⓚ제54화\n다음 회차 첫 줄\n다음 회차 마지막 문장.\nⓚ제55화\n세 번째\n다른 99화"
    rows = sourcecheck.blocked_issues(texts(spark, "ⓚ1화\na\nⓚ3화\nb\nⓚ3화\n/끝 3화 끝 x)\n/또 4화 끝) y"), ["work_id"]).orderBy("id").collect()
    assert [(r.id, r.operation, r.episode, r.line) for r in rows] == [("SRC-BLOCK-001", "missing_episode", "002", None), ("SRC-BLOCK-002", "duplicate_episode", "003", None), ("SRC-BLOCK-005", "ambiguous_tail_label", None, 6), ("SRC-BLOCK-006", "ambiguous_tail_label", None, 7)]
    before = spark.createDataFrame([(1, 1, "001"), (1, 2, "003"), (1, 3, "002")], "work_id int, chapter_no int, episode string")
    after = spark.createDataFrame([(1, 1, "001"), (1, 2, "002"), (1, 3, "003"), (1, 4, "004")], "work_id int, chapter_no int, episode string")
    assert {(r.episode, r.change) for r in sourcecheck.sequence_diff(before, after, ["work_id"]).collect()} == {("002", "moved"), ("003", "moved"), ("004", "added")}


def test_folders_and_hwp(spark):
    rows = [("w", "2.txt", "둘째"), ("w", "10.txt", "ⓚ제9화\n열"), ("w", "1.txt", " "), ("x", "a.txt", "126.\nt")]
    got = {r.work: (r.text, r.documents) for r in collections.folder_texts(spark.createDataFrame(rows, "work string, name string, text string"), "work", "name").collect()}
    assert got == {"w": ("ⓚ제2화\n둘째\n\nⓚ제9화\n열", 3), "x": ("126.\nt", 1)}
    xml = '<HwpDoc><BodyText><Paragraph><LineSeg><Text>가</Text><ControlChar name="LINE_BREAK"/><Text>나</Text></LineSeg></Paragraph><Paragraph><ControlChar name="PARAGRAPH_BREAK"/></Paragraph><Paragraph><Text>다</Text></Paragraph></BodyText></HwpDoc>'
    assert [r.x for r in texts(spark, xml, "<broken", "<a/>", None).select("work_id", collections.hwp_xml_text("text").alias("x")).orderBy("work_id").collect()] == ["가\n나\n\n다", None, "", None]


def test_review_contracts(spark):
    base = dict.fromkeys(contracts.FINDING_FIELDS, None) | {"priority": "P1", "status": "open", "category": "numeric", "claim": "c", "rationale": "r"}
    found = {"decision": "확정", "final_priority": "P1", "confidence_percent": "96", "fix_hint": "f", "reader_risk": "r", "evidence": "e", "story_state_before": "b", "story_state_after": "a", "story_internal_impact": "i"}
    rows = [{"k": 0, **base}, {"k": 1, **base, **found}, {"k": 2, **base, **found, "counter_evidence": "c"}, {"k": 3, **base, **found, "disposition": "accepted_world_premise"}]
    schema = "k int, " + ", ".join(f"{c} string" for c in contracts.FINDING_FIELDS)
    df = spark.createDataFrame([tuple(r[c] for c in ["k", *contracts.FINDING_FIELDS]) for r in rows], schema)
    got = {}
    for r in contracts.finding_issues(df, ["k"]).collect():
        got.setdefault(r.k, set()).add(r.field)
    assert 1 not in got and got[2] == {"counter_evidence", "final_priority"} and got[3] == {"disposition"} and {"decision", "confidence_percent", "evidence", "story_state_before"} <= got[0]
    assert contracts.finding_issues(df.limit(0), ["k"]).count() == 0
    empty = spark.sql("select 1 as k").select("k", F.from_json(F.lit('{"status":"complete","gate_profile":"proofread"}'), contracts.SUBMISSION).alias("d")).select("k", "d.*")
    r = contracts.validate_submissions(empty, ["k"]).first()
    assert not r.ready and r.profile == "proofread" and r.blockers == ["manual_review_axes_not_complete"] and "final_summary" in {i.field for i in r.issues}
    queue = protocol.review_queue(spark.sql("select 1 as w, 'proofread' as p"), "p")
    assert queue.where("required").count() == 5 + 2 and queue.where("phase = 'blind_consistency_review' and status = 'skipped'").count() == 9


def test_reports(spark):
    ko = "이 보고서는 원고 전체의 정합성과 표현을 검토한 결과를 정리한 것입니다. " * 4
    rows = ["주장: 날짜가 다르다\n근거: 3화\n" + ko, "| 주장 | 근거 |\n|---|---|\n| 날짜 | |\n| | 3화 |\n| a | b |\n" + ko, "english only", "# 작품 최종 개선 보고서\n" + ko, ""]
    got = {r.work_id: ([i.code for i in r.issues], r.pairs, r.ready) for r in reports.validate_reports(texts(spark, *rows)).collect()}
    assert got[0] == ([], 1, True) and got[1] == (["table_claim_without_evidence", "empty_table_claim"], 1, False)
    assert got[2][0] == ["too_little_korean", "not_korean_facing", "missing_claim_evidence_pair"] and got[3][0].count("missing_final_report_section") == 5 and not got[4][2]


def test_catalogue(spark):
    runs = spark.sql("select 1 as w, 1 as r, array(struct('a' as stage, 'Done' as status), struct('b' as stage, 'pending' as status)) as stages")
    r = catalog.list_runs(runs).first()
    assert (r.pending_stage_count, r.next_stage) == (1, "b")
    done = catalog.mark_stage(runs, "b", "done").first()
    assert catalog.list_runs(spark.createDataFrame([done], catalog.mark_stage(runs, "b", "done").schema)).first().pending_stage_count == 0 and catalog.mark_stage(runs, "z", "done").first().rejected
    title = lambda stem, *rows: spark.createDataFrame([(stem, list(rows))], "s string, r array<string>").select(catalog.infer_title(F.col("s"), F.col("r"), ("untitled",)).alias("x")).first().x
    assert title("긴_밤-최종 (2)", "x") == "긴 밤" and title("untitled", "", "ⓚ12", "제3화 시작", "그는 갔다", "# 제목: 긴 밤") == "긴 밤" and title("", "끝났다") == "untitled-work"
    assert one(spark, "p1 문체", catalog.hold_bucket(F.col("text"))) == "blocking"
    assert one(spark, "about 97%", author.confidence(F.col("text"))) == 97 and one(spark, "-5 or 400", author.confidence(F.col("text"))) == 0


def test_sinks(spark, tmp_path):
    chapters = headings.chapters(texts(spark, "ⓚ1화\na\nⓚ1화\nb", "c"))
    for _ in range(2):  # stale files go
        files.write_chapters(chapters, f"file://{tmp_path}/chapters")
    found = {str(p.parent.relative_to(tmp_path / "chapters")): p.read_text() for p in (tmp_path / "chapters").rglob("*.txt")}
    assert found == {"work_id=0/episode=001": "a\n", "work_id=0/episode=001_2": "b\n", "work_id=1/episode=001": "c\n"}
    files.write_jsonl(spark.sql("select 1 as a, cast(null as string) as b"), f"file://{tmp_path}/rows")
    assert spark.read.text(f"file://{tmp_path}/rows").first().value == '{"a":1,"b":null}'
    report = lambda t: one(spark, t, files.upsert_section(F.col("text"), F.lit("new $1"), "<!--A-->", "<!--B-->", ("## n",)))
    assert report("x\n## n\ny") == "x\n\n<!--A-->\nnew $1\n<!--B-->\n## n\ny" and report(report("x\n")) == "x\n\n<!--A-->\nnew $1\n<!--B-->\n"


def test_gate_refresh(spark):
    held = spark.sql("select array('b', 'human_report_missing', 'a', 'a') as h, array('c') as now")
    assert held.select(gate.refresh(F.col("h"), gate.REPORT_BLOCKERS, F.col("now")).alias("x")).first().x == ["a", "b", "c"]
