"""Command line over the operators: python -m inkwell.cli COMMAND. Tables are printed as JSON lines; --out writes Parquet instead."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import curly_quotes, ellipsis
from .operators import author, changes, contracts, facts, gate, headings, metrics, narrative, protocol, reports, review, rules, segment, sourcecheck, style, typos
from .sinks import files
from .sources import collections, documents, packages


def _texts(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """(work_id, text): all manuscripts in a folder, or the one named, plain or packed."""
    plain, packed = documents.text_files(spark, a.input), packages.package_files(spark, a.input).where("text is not null")
    return plain.unionByName(packed.select(*plain.columns)).select(F.col("path").alias("work_id"), "text")


def _chapters(spark, a) -> DataFrame:
    return segment.chapters(_texts(spark, a)).select("work_id", "chapter_no", "episode", "title", "text")


def _listed(spark, a) -> DataFrame:
    """A change list: a JSON array of objects, numbered from 0 in their order."""
    schema = "array<struct<id:string,find:string,replace:string,marker:string,operation:string,occurrence:string,confidence_percent:string,edit_class:string,requires_context:boolean,reason:string,reading_basis:string,context_before:string,context_after:string,context_window:string,evidence_snippet:string,location:string,status:string,alternative_interpretation:string,counter_evidence:string,rejected_interpretation:string,rejection_basis:string,ai_slop_signal:string>>"
    rows = spark.read.text(a.changes, wholetext=True).select(F.posexplode(F.from_json("value", schema)).alias("index", "c"))
    return rows.select("index", "c.*")


def _applied(spark, a) -> DataFrame:
    chosen = changes.approved(_listed(spark, a), a.accept_judged).withColumn("occurrence", F.expr("try_cast(occurrence as int)"))
    # one list for every text given: a single aggregated row, read as a value
    return changes.apply_gathered(_texts(spark, a).withColumn("listed", chosen.agg(changes.gathered()).scalar()), "listed")


def _submissions(spark, a) -> DataFrame:
    """(path, columns of a submission): one JSON document per file."""
    rows = spark.read.text(a.input, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", contracts.SUBMISSION).alias("d"))
    return rows.select("path", "d.*")


def _findings(spark, a) -> DataFrame:
    """The findings of submissions, numbered, for author and re-audit reports."""
    rows = _submissions(spark, a).select("path", F.posexplode("findings").alias("pos", "f"))
    return rows.select("path", (F.col("pos") + 1).alias("number"), "f.*")


def _folders(spark, a) -> DataFrame:
    """Each folder below the input as one work; its own files as another."""
    path = F.col("work_id")
    return collections.folder_texts(_texts(spark, a).select(F.regexp_replace(path, "/[^/]*$", "").alias("work"), path.alias("name"), "text"), "work", "name")


def _gate_counts(spark, a) -> DataFrame:
    works = _texts(spark, a)
    return gate.evidence(works, "work_id").withColumn("gate_profile", protocol.gate_profile(F.lit(a.profile)))


def _written(spark, a) -> DataFrame:
    if not a.out:
        raise SystemExit("write-chapters needs --out")
    files.write_chapters(_chapters(spark, a), a.out)
    a.out = None
    return _chapters(spark, a).groupBy("work_id").agg(F.count(F.lit(1)).alias("chapters"))


COMMANDS: dict[str, Callable[[SparkSession, argparse.Namespace], DataFrame]] = {
    "inspect-text": lambda s, a: metrics.text_inspection(metrics.chapter_metrics(_chapters(s, a)), "work_id"),
    "chapter-metrics": lambda s, a: metrics.chapter_metrics(_chapters(s, a)),
    "facts": lambda s, a: review.facts(_chapters(s, a), rules.FACTS),
    "hygiene": lambda s, a: review.flags(_chapters(s, a), rules.HYGIENE),
    "analyze-run": _gate_counts,
    "list-chapters": lambda s, a: segment.chapters(_texts(s, a)).drop("text"),
    "write-chapters": _written,
    "read-folders": _folders,
    "normalize-manuscript-format": lambda s, a: headings.format_manuscript(_texts(s, a)),
    "format-flags": lambda s, a: headings.format_flags(_texts(s, a)),
    "contextual-typos": lambda s, a: typos.contextual_typos(_chapters(s, a)),
    "enriched-facts": lambda s, a: facts.enrich(review.facts(_chapters(s, a), rules.FACTS)),
    "timeline": lambda s, a: facts.timeline(_chapters(s, a)),
    "character-titles": lambda s, a: facts.title_matrix(_chapters(s, a), "work_id", "chapter_no"),
    "style-features": lambda s, a: style.style_features(_texts(s, a), "work_id"),
    "style-summary": lambda s, a: style.style_summary(_texts(s, a), "work_id"),
    "scan-ai-slop": lambda s, a: style.surface_scan(_texts(s, a), "work_id"),
    "plan-source-repair": lambda s, a: sourcecheck.split_tails(_texts(s, a)).select("work_id", "splits", "text"),
    "blocked-sources": lambda s, a: sourcecheck.blocked_issues(_texts(s, a), ["work_id"]),
    "validate-submission": lambda s, a: contracts.validate_submissions(_submissions(s, a), ["path"]),
    "validate-report": lambda s, a: reports.validate_reports(_texts(s, a)),
    "render-author-final-report": lambda s, a: author.author_findings(_findings(s, a), "path", "number"),
    "render-reaudit-report": lambda s, a: author.reaudit_groups(_findings(s, a), "path", "number"),
    "review-queue": lambda s, a: protocol.review_queue(_texts(s, a).select("work_id", F.lit(a.profile).alias("profile")), "profile"),
    "scan-surface": lambda s, a: review.flags(_texts(s, a), rules.SURFACE),
    "brackets": lambda s, a: narrative.bracket_lines(_chapters(s, a)),
    "conflicts": lambda s, a: narrative.action_conflicts(_chapters(s, a).select(F.struct("work_id", "episode").alias("chapter"), "text"), "chapter"),
    "subtitles": lambda s, a: narrative.subtitles(_chapters(s, a)),
    "normalize-typography": lambda s, a: _texts(s, a).withColumn("text", curly_quotes(ellipsis(F.col("text")))),
    "validate-changes": lambda s, a: changes.change_issues(_listed(s, a), "index", "id"),
    "apply-changes-text": _applied,
    "finalize-markers": lambda s, a: _texts(s, a).withColumn("text", changes.finalize_markers(F.col("text"), a.accept_judged)),
    "validate-ledger": lambda s, a: changes.ledger_issues(s.read.json(a.input).withColumn("row", F.monotonically_increasing_id()), "row"),
    "inspect-epub-package": lambda s, a: packages.epub_findings(packages.epub_packages(s, a.input)),
}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="inkwell", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("input", help="file or folder")
    p.add_argument("--changes", help="JSON change list")
    p.add_argument("--accept-judged", action="store_true", help="take judged changes too")
    p.add_argument("--profile", default="delivery", help="gate profile or an alias of one")
    p.add_argument("--out", help="write Parquet here rather than print")
    a = p.parse_args(argv)
    if a.command == "validate-changes":
        a.changes = a.changes or a.input
    found = COMMANDS[a.command](SparkSession.builder.appName("inkwell").getOrCreate(), a)
    if a.out:
        found.write.mode("overwrite").parquet(a.out)
    else:
        for line in found.toJSON().toLocalIterator():
            print(json.dumps(json.loads(line), ensure_ascii=False))


if __name__ == "__main__":
    main()
