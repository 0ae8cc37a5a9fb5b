"""Rounds of the component search leave nothing with the driver."""

from tidemark.llm.graph import _hung


def test_small_sides_are_not_broadcast(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2)], "node long, near long")
    least, met = _hung(edges, "node", "near", "m")
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text
    assert sorted(map(tuple, met.collect())) == [(1, 2, 2), (2, 1, 1), (2, 3, 1), (3, 2, 2)]
    assert sorted(map(tuple, least.collect())) == [(1, 2), (2, 1), (3, 2)]
