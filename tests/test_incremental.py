"""Nodes over new edges: equal to nodes from scratch, and from stored tables alone."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import layers
from ledgerloom.operators import nodes
from ledgerloom.plans import incremental
from ledgerloom.sinks.bucketed import read_bucketed, write_bucketed

EDGES = "src string, dst string, week_start string"


def random_edges(rng, n, names, weeks):
    return sorted({(rng.choice(names), rng.choice(names), f"2024-01-{rng.choice(weeks):02d}") for _ in range(n)})


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def parts(rng):
    """Edges of a base and two deltas; the weeks overlap, so some edges come again."""
    first = random_edges(rng, 60, "abcdefgh", (1, 8))
    second = random_edges(rng, 40, "efghijkl", (8, 15))
    third = random_edges(rng, 30, "aeijmn", (15, 22)) + [("H", "a", "2024-01-22"), ("h", "a", "2024-01-22")]
    return first, second, third


@pytest.mark.parametrize("mode", ["edge_rows", "distinct"])
@pytest.mark.parametrize("percentile", [50.0, 90.0])
def test_base_and_deltas_equal_nodes_from_scratch(spark, tmp_path, mode, percentile):
    rng, folder = random.Random(len(mode)), str(tmp_path / "state")
    known = spark.createDataFrame([("a",), ("h",), ("m",), ("zz",)], "address string")
    labels = spark.createDataFrame([("zz",), ("b",)], "address string")
    seen = []
    for n, delta in enumerate(parts(rng)):
        stored = spark.createDataFrame(seen, EDGES)
        fresh = incremental.unseen_edges(spark.createDataFrame(delta, EDGES), stored, mode)
        seen = sorted({*seen, *delta})
        more = labels if n == 1 else None
        version = incremental.apply_edges(spark, folder, fresh, f"part-{n}", more, known, mode=mode, buckets=4)
        assert version.number == n + 1
        every = spark.createDataFrame(seen, EDGES)
        whole = nodes.build_nodes(every, labels if n else None, known, percentile=percentile, mode=mode)
        assert rows(incremental.nodes_of(spark, folder, percentile)) == rows(whole)
        counted = nodes.degree_histogram(nodes.degrees(every, mode=mode))
        assert rows(incremental.read_histogram(spark, folder)) == rows(counted)
    # A delta that comes again changes nothing.
    again = incremental.apply_edges(spark, folder, spark.createDataFrame(delta, EDGES), "part-2")
    assert again == version == layers.latest(spark, folder)


def test_a_crash_leaves_the_version_before(spark, tmp_path, monkeypatch):
    folder, edges = str(tmp_path / "state"), spark.createDataFrame([("a", "b", "2024-01-01")], EDGES)
    incremental.apply_edges(spark, folder, edges, "one", buckets=2)
    before = rows(incremental.nodes_of(spark, folder))
    more = spark.createDataFrame([("a", "c", "2024-01-01")], EDGES)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.apply_edges(spark, folder, more, "two")
    assert rows(incremental.nodes_of(spark, folder)) == before
    incremental.apply_edges(spark, folder, more, "two")
    assert {r.address: r.degree_out for r in incremental.nodes_of(spark, folder).collect()}["a"] == 2


def test_empty_state(spark, tmp_path):
    folder = str(tmp_path / "state")
    assert incremental.nodes_of(spark, folder).count() == incremental.unresolved_of(spark, folder).count() == 0
    none = spark.createDataFrame([], EDGES)
    incremental.apply_edges(spark, folder, none, "none", buckets=2)
    assert incremental.nodes_of(spark, folder).count() == 0


def test_plans_read_only_the_state_and_the_delta(spark, tmp_path):
    rng, folder, lists = random.Random(9), str(tmp_path / "state"), {}
    for n, delta in enumerate(parts(rng)):
        path = str(tmp_path / f"edges-{n}")
        spark.createDataFrame(delta, EDGES).write.parquet(path)
        lists[n] = spark.read.parquet(path)
    incremental.apply_edges(spark, folder, lists[0], "0", buckets=4)
    version = incremental.apply_edges(spark, folder, lists[1], "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = incremental.nodes_of(spark, folder)
        kept = (version.facts["state"], version.facts["histogram"])
        assert all(any(k in f for k in kept) for f in result.inputFiles())
        # Degrees and flags come straight from the buckets: only the histogram is exchanged.
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Subquery")[0]
        state = incremental.read_state(spark, folder)
        change = nodes.degrees(lists[2]).withColumnRenamed("address", "_address")
        joined = state.join(change.select("_address"), F.col("address") == F.col("_address"), "full_outer")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        stored, delta = plan.split("FullOuter")[1].split("BucketedScan" if "BucketedScan" in plan else "Bucketed: true")[:2]
        assert "Exchange" not in stored
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


STATUS = "address string, is_contract boolean, resolved_at timestamp"


def test_status_changes_touch_named_addresses(spark, tmp_path):
    folder = str(tmp_path / "state")
    edges = spark.createDataFrame([("a", "b", "1"), ("C", "d", "1")], EDGES)
    day = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    status = spark.createDataFrame([("a", True, None), ("d", False, None)], STATUS).withColumn("resolved_at", day(1))
    incremental.apply_edges(spark, folder, edges, "one", status=status, buckets=2)
    assert rows(incremental.unresolved_of(spark, folder)) == [("C",), ("b",)]
    newer = spark.createDataFrame([("c", True, None), ("a", False, None), ("zz", True, None)], STATUS)
    newer = newer.withColumn("resolved_at", day(2))
    incremental.apply_status(spark, folder, newer, "status-2")
    whole = nodes.build_nodes(edges, status=status.unionByName(newer))
    assert rows(incremental.nodes_of(spark, folder)) == rows(whole)
    assert rows(incremental.unresolved_of(spark, folder)) == [("b",)]


def test_a_bucketed_table_is_read_by_its_path(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(spark.range(100).selectExpr("cast(id as string) as k", "id"), path, "k", 4)
    for name in spark.catalog.listTables():
        if name.name.startswith("ledgerloom_"):
            spark.sql(f"DROP TABLE {name.name}")
    table = read_bucketed(spark, path, "k string, id bigint", "k", 4)
    assert table.count() == 100
    counted = table.groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
