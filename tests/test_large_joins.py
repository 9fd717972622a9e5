"""Joins that return many times the rows they read: these are dealt out before, and not shuffled after."""

import pytest

from strataflow.plans import catalogue

SF = "/root/testdata/sf0.001"


def last_join_reads(df) -> str:
    """The left input of the topmost join; between it and the result nothing but projections may lie."""
    lines = [line.lstrip(" :+-") for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    at = next(i for i, line in enumerate(lines) if line.startswith("Join"))
    assert all(line.startswith("Project") for line in lines[:at])
    return lines[at + 1]


@pytest.mark.parametrize("name", ["relation_candidates", "relation_hypotheses", "entity_hypotheses", "mention_candidates", "or_join_rewrite"])
def test_last_join_is_dealt_out(spark, name):
    assert last_join_reads(catalogue.queries()[name](spark, SF)).startswith("Repartition")


@pytest.mark.parametrize("name", ["relation_candidates", "relation_hypotheses", "mention_candidates", "entity_hypotheses"])
def test_rows_are_judged_before_the_last_join(spark, name):
    lines = [line.lstrip(" :+-") for line in catalogue.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    above = "".join(lines[: next(i for i, line in enumerate(lines) if line.startswith("Join"))])
    assert "least" not in above and "array_" not in above and "CASE" not in above


def test_resolutions_count_candidates_before_mentions_meet_them(spark):
    lines = catalogue.queries()["mention_resolutions"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Join"))
    right = [i for i in range(at + 1, len(lines)) if depth(lines[i]) == depth(lines[at + 1])][1]
    assert "Aggregate [entity_type" in lines[right] and "count(" in lines[right]
