"""Fingerprints without a link meet no join on their missing root, which would deal them all to one task."""

import re

from fieldwatch.llm import simhash


def test_no_outer_join_on_roots(spark):
    docs = spark.createDataFrame([(k, f"text number {k} of its own {k * k}") for k in range(20)] + [(20, "text number 1 of its own 1")], "doc_id bigint, text string")
    found = simhash.near_duplicates(docs)
    assert not re.search(r"Join LeftOuter, \(root", found._jdf.queryExecution().optimizedPlan().toString())
    assert {r.doc_id: r.component_id for r in found.collect()}[20] == 1
