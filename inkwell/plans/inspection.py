"""Queries on whole inspections, ledger totals and review markers, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..operators import inspection, markers
from . import manuscript
from .reviews import _sql

LEDGER = """SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'issue' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'hold' ELSE '' END AS record_type, CASE WHEN o_orderkey % 7 > 0 THEN 'x' END AS id,
  CASE o_custkey % 4 WHEN 0 THEN 'confirmed_error' WHEN 1 THEN 'odd' WHEN 2 THEN 'sealed' END AS status, 'x' AS source, CASE WHEN o_custkey % 3 > 0 THEN 'x' END AS target, 'x' AS reason, 'x' AS action, 'x' AS type, 'x' AS episode FROM {orders}"""


def _inspect(spark, d):
    out = inspection.inspect_texts(manuscript._docs(spark, d), "doc_id")
    shown = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e.key, F.lit(":"), e.value.cast("string"))), ",").alias(c)
    return out.select(*[c for c in out.columns if c not in ("chapter_chars", "chapter_chars_no_space", "under_minimum")], shown("chapter_chars"), shown("under_minimum"))


def _marked(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.concat(F.lit("머리\nⓚ제1화\n\n\n"), "text", F.lit("\n끝 말")).alias("text"))
    rows = [(0, "ⓚ제1화", "소제목", "", "insert_after", None, "판단"), (1, "머리", "앞", "ⓐ", "replace", 1, None), (2, "끝 말", "", "ⓐ", "", 0, None), (3, "말", "x", "ⓐ", "replace", 1, None), (4, "없다", "x", "ⓐ", "replace", 1, None), (5, "끝", "", "", "delete", 9, None)]
    names = ("order", "find", "replace", "marker", "operation", "occurrence", "opinion")
    one = F.array(*[F.struct(*[(F.lit(v).cast("int") if n in ("order", "occurrence") else F.lit(v).cast("string")).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    changes = docs.select("doc_id", F.inline(one)).withColumn("id", F.concat(F.lit("c"), F.col("order").cast("string")))
    return docs, markers.marker_events(docs, changes, "doc_id")


def _events(spark, d):
    return _marked(spark, d)[1].select("doc_id", "id", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "marked", "issue").where("order <> 3 and order <> 5")


def _applied(spark, d):
    docs, events = _marked(spark, d)
    out = markers.apply_events(docs, events.where("order < 3"), "doc_id")
    return out.select("doc_id", F.sha2("text", 256).alias("sha256"), F.array_join("skipped", ",").alias("skipped"))


QUERIES = {
    "text_inspection_full": _inspect,
    "ledger_totals": lambda s, d: inspection.ledger_totals(_sql(s, d, LEDGER, "orders"), "o_custkey", "o_orderkey"),
    "ledger_counts": lambda s, d: inspection.value_counts(_sql(s, d, LEDGER, "orders"), "o_custkey", "record_type", "(missing)"),
    "marker_events": _events,
    "marker_apply": _applied,
    "marker_paragraphs": lambda s, d: markers.paragraphs(s.read.parquet(f"{d}/documents.parquet"), "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("paragraphs"), F.sum(F.length("text").cast("long")).alias("chars")),
}

_SRC, _Q = manuscript._SRC, manuscript._q
_LINES = f"CASE WHEN ends_with(text, chr(10)) OR text = '' THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END"
_KEPT = f"list_filter({_LINES}, lambda x: regexp_matches(x, '[^{SPACE}]'))"
_STYLE = manuscript._STYLE.replace("line", "text")
_BAD = "record_type = '' OR id IS NULL OR status = 'odd' OR (record_type IN ('confirmed', 'hold') AND status IS NULL) OR (record_type = 'confirmed' AND target IS NULL) OR (record_type = 'issue' AND (status IS NULL OR (status = 'confirmed_error' AND target IS NULL)))"
_LEDGER = LEDGER.replace("{orders}", "orders")
_TEXT = "'머리' || chr(10) || 'ⓚ제1화' || chr(10) || chr(10) || chr(10) || text || chr(10) || '끝 말'"

ORACLES = {
    "text_inspection_full": f"""
WITH s AS ({_SRC}), c AS ({manuscript.ORACLES["chapter_split"]}), h AS (SELECT doc_id, count(*) AS chapters FROM ({manuscript.ORACLES["heading_markers"]}) GROUP BY doc_id), f AS (SELECT doc_id, count(*) AS n, count(*) FILTER (subtype = 'chapter_heading_missing_k') AS k, count(*) FILTER (subtype = 'chapter_heading_blank_lines') AS b, count(*) FILTER (subtype = 'dialogue_narration_spacing') AS d FROM ({manuscript.ORACLES["format_flags"]}) GROUP BY doc_id),
m AS (SELECT c.doc_id, string_agg(episode || ':' || stop_offset - start_offset, ',' ORDER BY episode) AS a, coalesce(string_agg(episode || ':' || stop_offset - start_offset, ',' ORDER BY episode) FILTER (stop_offset - start_offset < 4000), '') AS u FROM c JOIN h USING (doc_id) GROUP BY c.doc_id)
SELECT s.doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(length(regexp_replace(text, '[{SPACE}]+', '', 'g')) AS BIGINT) AS chars_no_space, CAST(len({_LINES}) AS BIGINT) AS lines, CAST(len({_KEPT}) AS BIGINT) AS non_empty_lines,
  CASE WHEN len({_KEPT}) > 0 THEN round(CAST(list_sum(list_transform({_KEPT}, lambda x: length(x))) AS DOUBLE) / len({_KEPT}), 1) ELSE 0.0::DOUBLE END AS mean_line, {", ".join(f"CAST(len(list_filter({_KEPT}, lambda x: length(x) >= {n})) AS BIGINT) AS lines_{n}" for n in (80, 120, 200))},
  CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS bangs, CAST(length(text) - length(replace(text, '?', '')) AS BIGINT) AS questions, CAST(len(regexp_extract_all(text, {_Q(f"(?m)^#{{1,6}}[{SPACE}]+")})) AS BIGINT) AS markdown_headers, coalesce(h.chapters, 0) AS chapters,
  CAST(length(text) - length(replace(text, '"', '')) AS BIGINT) AS double_quotes, CAST(length({_STYLE}) - length(replace({_STYLE}, '''', '')) AS BIGINT) AS single_quotes, CAST(len(regexp_extract_all(text, '[.]{{3,}}')) AS BIGINT) AS ellipses, CAST(0 AS BIGINT) AS stage_cues, CAST(0 AS BIGINT) AS stage_cue_candidates,
  coalesce(f.k, 0) AS headings_without_k, coalesce(f.b, 0) AS heading_spacing, coalesce(f.d, 0) AS dialogue_spacing, coalesce(f.n, 0) AS format_violations, CAST(0 AS BIGINT) AS stage_cues_allowed, coalesce(m.a, '') AS chapter_chars, coalesce(m.u, '') AS under_minimum
FROM s LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "ledger_totals": f"SELECT o_custkey, count(*) AS total, count(*) FILTER (NOT coalesce({_BAD}, false)) AS valid, count(*) FILTER (coalesce({_BAD}, false)) AS invalid FROM ({_LEDGER}) GROUP BY o_custkey",
    "ledger_counts": f"SELECT o_custkey, CASE WHEN record_type = '' THEN '(missing)' ELSE record_type END AS value, count(*) AS n FROM ({_LEDGER}) GROUP BY ALL",
    "marker_events": f"""WITH t AS (SELECT doc_id, {_TEXT} AS t FROM documents)
SELECT doc_id, 'c0' AS id, CAST(10 + length(regexp_extract(substr(t, 11), '^(?:[ \\t]*\\n)*')) AS BIGINT) AS start, CAST(10 + length(regexp_extract(substr(t, 11), '^(?:[ \\t]*\\n)*')) AS BIGINT) AS stop, 'ⓐⓐ{{|소제목}}[판단]' || chr(10) || chr(10) AS marked, CAST(NULL AS VARCHAR) AS issue FROM t
UNION ALL SELECT doc_id, 'c1', 0, 2, 'ⓐ{{머리|앞}}', NULL FROM t UNION ALL SELECT doc_id, 'c2', length(t) - 3, length(t), 'ⓐ{{끝 말|}}', NULL FROM t UNION ALL SELECT doc_id, 'c4', NULL, NULL, NULL, 'anchor not found' FROM t""",
    "marker_apply": """WITH t AS (SELECT doc_id, regexp_extract(chr(10) || chr(10) || text || chr(10), '^(?:[ \\t]*\\n)*') AS gap, text FROM documents)
SELECT doc_id, sha256('ⓐ{머리|앞}' || chr(10) || 'ⓚ제1화' || chr(10) || gap || 'ⓐⓐ{|소제목}[판단]' || chr(10) || chr(10) || substr(chr(10) || chr(10) || text || chr(10), length(gap) + 1) || 'ⓐ{끝 말|}') AS sha256, '' AS skipped FROM t""",
    "marker_paragraphs": "SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS paragraphs, CAST(length(replace(text, chr(10), '')) AS BIGINT) AS chars FROM documents",
}
