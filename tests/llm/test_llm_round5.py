"""Findings of the latest round: what Spark may broadcast or keep, and what is paired."""

from tripwise.llm import collocations


def test_joins_of_phrase_counts_broadcast_none_of_them(spark):
    """However small Spark takes the counts to be: copies of each word's count make them many times as large."""
    texts = [f"w{i % 7} x{i % 5} y{i % 3} w{i % 7} x{i % 5}" for i in range(200)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    counts = collocations.flows(docs, least=2)
    joined = collocations.scored(counts).join(collocations._merged(collocations.covered(counts)), ["lang", "phrase"], "left_anti")
    assert joined.count() > 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    best = collocations.collocations(docs, least=2)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == 4


def test_bounds_of_ranges_come_in_order(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}{j}" for j in range(20)), "en") for i in range(40)], "text string, lang string")
    bounds = collocations._range_bounds(docs, 8, 4)
    assert len(bounds) == 7 and bounds == sorted(bounds) and all(0 < len(b) <= collocations.HEAD for b in bounds)
    assert collocations._range_bounds(docs.limit(0), 8, 4) == []
