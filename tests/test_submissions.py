"""Readers of validated submissions: a filter on a result, or a generator that brings one, leaves the plan as it is."""

import re

import pytest
from pyspark.sql import functions as F

from inkwell.operators import contracts

DOCS = ['{"status":"complete","gate_profile":"proofread"}', '{"status":"complete","gate_profile":"delivery","checked_axes":[{"axis":"odd","status":"skipped"}],"final_summary":"s"}', "{}"]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "k int, doc string").select("k", F.from_json("doc", contracts.SUBMISSION).alias("d"))
    return contracts.validate_submissions(docs.select("k", "d.*"), ["k"])


def filters(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if re.match(r"[ :+\-]*Filter ", x)]


def test_issues_one_by_one(rows):
    for df in (rows.where("ready"), rows.select("k", F.inline("issues"))):
        assert [x for x in filters(df) if len(x) > 120] == []
    want = {(r.k, i.field, i.message) for r in rows.collect() for i in r.issues}
    got = rows.select("k", F.inline("issues")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and (0, "checked_axes", "must be an array") in want


def test_blockers_one_by_one(rows):
    df = rows.select("k", F.explode("blockers").alias("blocker"))
    assert [x for x in filters(df) if len(x) > 120] == []
    want = sorted((r.k, b) for r in rows.collect() for b in r.blockers)
    assert sorted(map(tuple, df.collect())) == want and (0, "manual_review_axes_not_complete") in want and {k for k, _ in want} == {0, 1, 2}
