"""Checks of reports for readers: language, remains of the workshop, sections, claims and their evidence. Each report is one row; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, lines_of, strip

# Labels, terms and sections of reports.
CLAIM = r"(?:^|[\s\-*])(?:주장|판정|문제|리스크)\s*[:：]\s*(.+)"
EVIDENCE = r"(?:^|[\s\-*])(?:근거|증거|원문|위치|수치|예시)\s*[:：]\s*(.+)"
PLACEHOLDER = r"\bTBD\b|작성 필요|분석 전|없음 또는 항목 작성|미정"
INTERNAL = r"\b(?:llm-facing|task_brief|manual_review|run_manifest|schema_version|prompt)\b|프롬프트"
TITLE = r"(?m)^#\s+.{0,120}최종\s*개선\s*보고서\s*$"
SECTIONS = ("루프 결과 요약", "개선 요약", "주요 해결 항목", "루프별 개선 이력", "누락 금지 이슈")
FILLED_SECTIONS = ("루프별 개선 이력", "누락 금지 이슈")
CLAIM_HEADERS = ("주장", "판정", "문제", "리스크")
EVIDENCE_HEADERS = ("근거", "증거", "원문", "위치", "수치")
LEAST_HANGUL, LEAST_RATIO, NEAR = 80, 0.55, 4
# End of the fixed values.

_SEPARATOR = r"^:?-{3,}:?$"


def is_blank(value: Column) -> Column:
    """Nothing but tags, or a placeholder."""
    return let(strip(F.regexp_replace(F.coalesce(value, F.lit("")), "<[^>]+>", "")), lambda v: (v == "") | v.rlike(f"(?iU){PLACEHOLDER}"))


def without_noise(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "(?s)```.*?```", ""), "(?s)<!--.*?-->", ""), "`[^`]*`", "")


def korean_stats(text: Column) -> tuple[Column, Column]:
    """(Hangul syllables, their share of Hangul and Latin letters), code and comments left out."""
    bare = without_noise(text)
    hangul, latin = F.regexp_count(bare, F.lit("[가-힣]")), F.regexp_count(bare, F.lit("[A-Za-z]"))
    return hangul.cast("long"), F.round(hangul / F.greatest(hangul + latin, F.lit(1)), 3)


def cells_of(line: Column) -> Column:
    """The cells of a table row; none if the line is not one."""
    s = strip(line)
    row = s.startswith("|") & s.endswith("|")
    return F.when(row, F.transform(F.split(F.regexp_replace(s, r"^\|+|\|+$", ""), r"\|"), strip)).otherwise(F.array().cast("array<string>"))


def is_separator(cells: Column) -> Column:
    return (F.size(cells) > 0) & F.forall(cells, lambda c: c.rlike(_SEPARATOR))


def _header(cells: Column, names: tuple[str, ...]) -> Column:
    """Place of the first cell that holds one of the names, from 0; -1 if none."""
    return F.array_position(F.transform(cells, lambda c: c.rlike("|".join(names))), True).cast("int") - 1


def _table_rows(rows: Column) -> Column:
    """Rows of claim tables: array<struct<code, line>>, code pair, empty_table_claim or table_claim_without_evidence. A fold over lines that are table rows or end a table."""
    kind = "array<struct<code:string,line:int>>"
    start = F.struct(F.lit(0).alias("mode"), F.lit(-1).alias("c"), F.lit(-1).alias("e"), F.array().cast(kind).alias("out"))
    state = lambda mode, c, e, out: F.struct(mode.cast("int").alias("mode"), c.cast("int").alias("c"), e.cast("int").alias("e"), out.alias("out"))

    def step(a: Column, x: Column) -> Column:
        c, e = _header(x.cells, CLAIM_HEADERS), _header(x.cells, EVIDENCE_HEADERS)
        fresh = F.when(x.bar & (c >= 0) & (e >= 0), state(F.lit(1), c, e, a.out)).otherwise(state(F.lit(0), F.lit(-1), F.lit(-1), a.out))
        no_claim, no_proof = is_blank(F.get(x.cells, a.c)), is_blank(F.get(x.cells, a.e))
        code = F.when(no_claim & no_proof, F.lit(None)).when(no_claim, "empty_table_claim").when(no_proof, "table_claim_without_evidence").otherwise("pair")
        out = F.when((F.size(x.cells) > 0) & code.isNotNull(), F.concat(a.out, F.array(F.struct(code.alias("code"), x.line.cast("int").alias("line"))))).otherwise(a.out)
        body = F.when((a.mode == 1) & is_separator(x.cells), state(F.lit(2), a.c, a.e, a.out)).otherwise(state(F.lit(2), a.c, a.e, out))
        return F.when((a.mode > 0) & x.bar, body).otherwise(fresh)

    seen = F.transform(rows, lambda x, i: F.struct((i + 1).alias("line"), x.contains("|").alias("bar"), cells_of(x).alias("cells")))
    return F.aggregate(seen, start, step, lambda a: a.out)


def _sections(rows: Column) -> Column:
    """array<struct<title, line>> of Markdown headings."""
    title = lambda x: strip(F.regexp_replace(F.regexp_extract(x, r"^#{1,6}\s+(.+?)\s*$", 1), "`([^`]*)`", "$1"))
    return F.filter(F.transform(rows, lambda x, i: F.struct(F.when(x.rlike(r"^#{1,6}\s+\S"), title(x)).alias("title"), (i + 1).alias("line"))), lambda x: x.title.isNotNull())


def _filled(body: Column) -> Column:
    """Whether a section's table has a filled row below its separator."""
    state = lambda seen, sep, ok: F.struct(seen.alias("seen"), sep.alias("sep"), ok.alias("ok"))
    no = F.lit(False)

    def step(a: Column, x: Column) -> Column:
        def row(cells: Column) -> Column:
            full = ~F.exists(cells, is_blank) & ~F.forall(cells, lambda c: c.rlike("^[-: ]+$")) & F.exists(cells, lambda c: c.rlike("[가-힣A-Za-z0-9]"))
            return (
                F.when(F.size(cells) < 2, a).when(~a.seen, state(F.lit(True), a.sep, a.ok)).when(is_separator(cells), state(a.seen, F.lit(True), a.ok)).otherwise(state(a.seen, a.sep, a.ok | (a.sep & full)))
            )

        return let(F.when(x.contains("|"), cells_of(x)).otherwise(F.array().cast("array<string>")), row)

    return F.aggregate(body, state(no, no, no), step, lambda a: a.ok)


def validate_reports(reports: DataFrame, text: str = "text") -> DataFrame:
    """Columns of reports without the text, hangul, korean_ratio, pairs (of claim and evidence), issues (array of code and line; null where an issue has none), ready."""
    rest = [c for c in reports.columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    hangul, ratio = korean_stats(F.col("t_"))
    rows = reports.withColumn("t_", t).withColumn("rows_", lines_of(F.col("t_"))).withColumn("hangul", hangul).withColumn("korean_ratio", ratio)
    rows = rows.withColumn("table_", _table_rows(F.col("rows_"))).withColumn("sections_", _sections(F.col("rows_")))
    rows = rows.withColumn("proof_", F.transform("rows_", lambda x: let(F.regexp_extract(x, f"(?U){EVIDENCE}", 1), lambda v: ~is_blank(v))))
    rows = rows.withColumn("shape_", F.col("t_").rlike(TITLE) | (F.contains("t_", F.lit("## 루프 결과 요약")) & F.contains("t_", F.lit("## 개선 요약"))))
    issue = lambda code, line: F.struct(F.lit(code).alias("code"), (F.lit(None) if line is None else line).cast("int").alias("line"))

    def of_line(x: Column, i: Column) -> Column:
        claim, at = F.regexp_extract(x, f"(?U){CLAIM}", 1), i + 1
        near = F.exists(F.slice("proof_", at, NEAR), lambda ok: ok)
        return F.array_compact(
            F.array(
                F.when(x.rlike(f"(?iU){INTERNAL}"), issue("internal_artifact_leak", at)),
                F.when(x.rlike(f"(?iU){PLACEHOLDER}"), issue("placeholder_left", at)),
                F.when(x.rlike(f"(?U){CLAIM}") & is_blank(claim), issue("empty_claim", at)),
                F.when(x.rlike(f"(?U){CLAIM}") & ~is_blank(claim) & ~near, issue("claim_without_evidence", at)),
                F.when(x.rlike(f"(?U){CLAIM}") & ~is_blank(claim) & near, issue("pair", at)),
            )
        )

    rows = rows.withColumn("found_", F.concat(F.flatten(F.transform("rows_", of_line)), "table_")).withColumn("pairs", F.size(F.filter("found_", lambda x: x.code == "pair")).cast("long"))
    names = F.transform("sections_", lambda x: x.title)
    shape = [F.when(F.col("shape_") & ~F.array_contains(names, s), issue("missing_final_report_section", None)) for s in SECTIONS]
    for s in FILLED_SECTIONS:
        at = F.element_at(F.transform(F.filter("sections_", _titled(s)), lambda x: x.line), -1)
        start = F.when(F.col("shape_") & F.array_contains(names, s), at)
        after = F.get(F.transform(F.filter("sections_", lambda x: x.line > start), lambda x: x.line), F.lit(0))
        body = F.slice("rows_", start + 1, F.greatest(F.coalesce(after - 1, F.size("rows_")) - start, F.lit(0)))
        shape.append(F.when(start.isNotNull() & ~F.coalesce(_filled(body), F.lit(False)), issue("empty_final_report_section", start)))
    whole = [
        F.when(F.col("hangul") < LEAST_HANGUL, issue("too_little_korean", None)),
        F.when(F.col("korean_ratio") < LEAST_RATIO, issue("not_korean_facing", None)),
        *shape,
        F.when(F.col("pairs") == 0, issue("missing_claim_evidence_pair", None)),
    ]
    rows = rows.withColumn("issues", F.concat(F.array_compact(F.array(*whole)), F.filter("found_", lambda x: x.code != "pair")))
    return rows.select(*rest, "hangul", "korean_ratio", "pairs", "issues", (F.size("issues") == 0).alias("ready"))


def _titled(name: str):
    return lambda x: x.title == name
