"""Layers, their merges, and the streams that store layers."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom import layers
from ledgerloom.operators import labeling
from ledgerloom.operators.cleaning import merge_transactions
from ledgerloom.operators.edges import aggregate_edges
from ledgerloom.operators.nodes import latest_status
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources.contracts import read_status_table
from ledgerloom.streaming import jobs


def total(spark, folder):
    rows = layers.read_layers(spark, folder)
    return {r.k: r.n for r in add(rows).collect()} if rows is not None else {}


def add(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def numbers(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, n long")


def test_many_batches_leave_few_folders(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert layers.read_layers(spark, folder) is None
    for n in range(100):
        layers.write_layer(numbers(spark, ("a", 1), (f"b{n % 3}", 2)).coalesce(1), folder, layers.batch_layer(n))
        if n % 20 == 19:
            layers.merge_layers(spark, folder, add)
            assert len(layers.child_names(spark, f"{folder}/layers")) <= 43
    assert total(spark, folder) == {"a": 100, "b0": 68, "b1": 66, "b2": 66}
    layers.merge_layers(spark, folder, add, least=1)
    assert len(layers.child_names(spark, f"{folder}/layers")) <= 3
    assert total(spark, folder)["a"] == 100


def test_a_replayed_batch_counts_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in (0, 1):
        layers.write_layer(numbers(spark, ("a", 1)), folder, layers.batch_layer(n))
    layers.merge_layers(spark, folder, add)
    layers.write_layer(numbers(spark, ("a", 1)), folder, layers.batch_layer(1))
    layers.write_layer(numbers(spark, ("a", 5)), folder, layers.batch_layer(2))
    layers.write_layer(numbers(spark, ("a", 5)), folder, layers.batch_layer(2))
    assert total(spark, folder) == {"a": 7}
    for _ in range(3):
        layers.merge_layers(spark, folder, add)
        assert total(spark, folder) == {"a": 7}


@pytest.mark.parametrize("step", ["write_layer", "commit", "_clear", "remove"])
def test_a_crash_at_any_step_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    folder = str(tmp_path / "t")
    for n in range(3):
        layers.write_layer(numbers(spark, ("a", n)), folder, layers.batch_layer(n))
    layers.write_layer(numbers(spark, ("a", 10)), folder)
    layers.merge_layers(spark, folder, add)
    layers.write_layer(numbers(spark, ("a", 20)), folder)
    layers.write_layer(numbers(spark, ("a", 30)), folder, layers.batch_layer(3))
    real = getattr(layers, step)

    def fails(*args, **options):
        if step == "write_layer":
            # Half a merged layer: files, but no mark that it is whole.
            real(*args, **options)
            layers.remove(spark, f"{folder}/layers/layer={args[2]}/_SUCCESS")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(layers, step, fails)
        with pytest.raises(RuntimeError, match="lost"):
            layers.merge_layers(spark, folder, add)
    assert total(spark, folder) == {"a": 63}
    for n in range(4, 8):
        layers.write_layer(numbers(spark, ("a", 1)), folder, layers.batch_layer(n))
        layers.merge_layers(spark, folder, add)
        assert total(spark, folder) == {"a": 60 + n}
    assert len(layers.child_names(spark, f"{folder}/layers")) <= 4


def test_two_mergers_do_not_both_win(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    for n in range(2):
        layers.write_layer(numbers(spark, ("a", 1)), folder, layers.batch_layer(n))

    def other_first(rows):
        layers.merge_layers(spark, folder, add)
        return add(rows)

    with pytest.raises(layers.CommitConflict):
        layers.merge_layers(spark, folder, other_first)
    assert total(spark, folder) == {"a": 2}
    before = layers.latest(spark, folder)
    monkeypatch.setattr(layers, "latest", lambda *_: layers.Version())
    monkeypatch.setattr(layers, "child_names", lambda *_: [])
    with pytest.raises(layers.CommitConflict):
        layers.commit(spark, folder, layers.Version(), {})
    monkeypatch.undo()
    assert layers.latest(spark, folder) == before


def test_a_torn_record_is_no_version(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in range(2):
        layers.write_layer(numbers(spark, ("a", 1)), folder, layers.batch_layer(n))
    (tmp_path / "t" / "_versions").mkdir()
    (tmp_path / "t" / "_versions" / "00000001.json").write_text('{"merged": "x')
    assert total(spark, folder) == {"a": 2}
    assert layers.merge_layers(spark, folder, add).number == 2
    assert total(spark, folder) == {"a": 2}


LAYOUT = (
    "tx_hash string, block_timestamp timestamp, from_address string, to_address string, "
    "value_wei string, rank_wei string, block_number long, category string"
)


def moved(rng, at, repeats):
    """Transfers around day `at`; some of them stand among `repeats` already."""
    rows = []
    for k in range(12):
        when = datetime(2024, 1, 1) + timedelta(days=at, hours=rng.randrange(60))
        row = (f"0x{at}{k}", when, rng.choice("abc"), rng.choice("xyz"), str(rng.randrange(10**30)), "0", 1, "external")
        rows.append(rng.choice(repeats) if repeats and rng.random() < 0.4 else row)
    # Two versions of one transfer.
    rows.append(("0xtwo", datetime(2024, 1, 1) + timedelta(days=at), "a", str(at), "7", "0", 1, "external"))
    return rows


OFFSETS = [0, 10, 30, 5, 28, 60, 20, 59, 90, 1, 91, 0]


def test_state_store_keeps_one_of_repeats_and_loses_no_late_row(spark, tmp_path):
    rng, source, path = random.Random(3), tmp_path / "cleaned", str(tmp_path / "unique")
    every = []
    for n, at in enumerate(OFFSETS):
        rows = moved(rng, at, every)
        every += rows
        frame = spark.createDataFrame(rows, LAYOUT).withColumn("reject_reason", F.lit(None).cast("string"))
        frame = frame.withColumn("raw", F.lit(None).cast("string")).withColumn("outcome", F.lit("accepted"))
        frame = frame.withColumn("block_month", F.trunc("block_timestamp", "month")).coalesce(1)
        frame.write.mode("append").partitionBy("outcome", "block_month").parquet(str(source))
        if n % 5 == 4 or n == len(OFFSETS) - 1:
            for _ in range(2):
                jobs.stream_unique(spark, str(source), path, str(tmp_path / "marks"), "7 days", 1).awaitTermination()
        if n == 9:
            jobs.merge_unique(spark, path)
    jobs.merge_unique(spark, path)
    columns = ["tx_hash", "block_timestamp", "from_address", "to_address", "value_wei"]
    expected = merge_transactions([spark.createDataFrame(every, LAYOUT)]).select(columns).collect()
    assert sorted(jobs.read_unique(spark, path).select(columns).collect()) == sorted(expected)
    late, stored = jobs.read_late(spark, path).count(), layers.read_layers(spark, path)
    assert 0 < late < len(every)
    unique = stored.filter("kind = 'unique'").drop("kind")
    assert unique.count() == unique.distinct().count() < len(every) - late


def test_weeks_with_late_rows_equal_the_batch_result(spark, tmp_path):
    rng, source, path = random.Random(4), str(tmp_path / "tx"), str(tmp_path / "weeks")
    every = []
    for n, at in enumerate(OFFSETS):
        rows = moved(rng, at, every) + [(f"0xn{n}", None, "a", "x", "3", "0", 1, "external")]
        every += rows
        spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(source)
        if n in (3, 8, 11):
            stream = spark.readStream.schema(LAYOUT).option("maxFilesPerTrigger", 1).parquet(source)
            jobs.stream_weeks(stream, path, str(tmp_path / "marks"), "7 days").awaitTermination()
            found = jobs.read_weeks(spark, path).collect()
            expected = aggregate_edges(spark.createDataFrame(every, LAYOUT)).collect()
            assert sorted(map(str, found)) == sorted(map(str, expected))
            if n == 8:
                jobs.merge_weeks(spark, path)
                assert len(layers.live_layers(spark, path)) == 1
    late = layers.read_layers(spark, path).filter("kind = 'late' and week_start is not null")
    assert late.count() > 0
    assert {r.d for r in late.select(F.dayofweek("week_start").alias("d")).collect()} == {2}
    jobs.merge_weeks(spark, path)
    assert sorted(map(str, jobs.read_weeks(spark, path).collect())) == sorted(map(str, expected))


def test_merged_edge_sums(spark, tmp_path):
    rng, source, path = random.Random(5), str(tmp_path / "tx"), str(tmp_path / "edges")
    every = []
    for n in range(6):
        every += (rows := moved(rng, 7 * n, every))
        spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LAYOUT).parquet(source)
        jobs.stream_edges(stream, path, str(tmp_path / "marks")).awaitTermination()
        if n % 2:
            jobs.merge_stream_edges(spark, path)
    expected = aggregate_edges(spark.createDataFrame(every, LAYOUT)).collect()
    assert sorted(map(str, jobs.read_stream_edges(spark, path).collect())) == sorted(map(str, expected))


STATUS = "address string, is_contract boolean, resolved_at timestamp"


def test_status_snapshot_has_a_row_an_address(spark, tmp_path):
    path, day = str(tmp_path / "status"), lambda d: datetime(2024, 1, d)
    every = [("0xA", True, day(1)), ("0xb", False, day(1)), ("0xa", False, day(2)), ("0xb", True, day(1)), ("0xc", None, day(3))]
    for k in range(0, 5, 2):
        assert sinks.append_status(spark.createDataFrame(every[k : k + 2], STATUS), path) == min(2, 5 - k)
    whole = spark.createDataFrame(every, STATUS)
    before = sorted(map(str, latest_status(read_status_table(spark, path)).collect()))
    assert before == sorted(map(str, latest_status(whole).collect()))
    sinks.merge_status(spark, path)
    merged = read_status_table(spark, path)
    assert sorted(r.address for r in merged.collect()) == ["0xa", "0xb", "0xc"]
    assert sorted(map(str, latest_status(merged).collect())) == before
    sinks.append_status(spark.createDataFrame([("0xC", True, day(4))], STATUS), path)
    assert {r.key: r.is_contract for r in latest_status(read_status_table(spark, path)).collect()} == {
        "0xa": False, "0xb": True, "0xc": True,
    }


def test_checksums_are_made_once_for_all_runs(spark, tmp_path):
    folder = str(tmp_path / "checksums")

    def shown(*numbers):
        layout = "a string, b string"
        rows = spark.createDataFrame([(f"0x{n:040x}", "no address") for n in numbers], layout)
        out = labeling.show_checksums(rows, "a", "b", folder=folder).collect()
        expected = labeling.show_checksums(rows, "a", "b").collect()
        assert sorted(out) == sorted(expected)
        return layers.live_layers(spark, folder)

    assert len(shown(1, 2, 0xABCDEF, 0xABCDEF)) == 1
    assert len(shown(2, 1)) == 1
    added = shown(2, 0xFEDCBA, 1)[-1]
    assert layers.read_layers(spark, folder, names=[added]).count() == 1
    # Two runs at once may add the same key.
    layers.write_layer(layers.read_layers(spark, folder), folder)
    shown(1, 0xFEDCBA, 3)
    labeling.merge_checksums(spark, folder)
    rows = layers.read_layers(spark, folder)
    assert rows.count() == rows.select("key").distinct().count() == 5
    shown(1, 0xFEDCBA, 3)


def test_runs_at_once_take_folders_of_their_own(tmp_path):
    names = [layers.unique_name("run") for _ in range(1000)]
    assert len(set(names)) == 1000 and [n[:30] for n in names] == sorted(n[:30] for n in names)


def test_merging_unique_rows_shuffles_once(spark, tmp_path):
    rows = [r for at in (0, 40, 0) for r in moved(random.Random(at), at, [])]
    frame = spark.createDataFrame(rows, LAYOUT).withColumn("block_month", F.trunc("block_timestamp", "month"))
    path = str(tmp_path / "unique")
    for n, kind in enumerate(("unique", "late")):
        layers.write_layer(frame.withColumn("kind", F.lit(kind)), path, layers.batch_layer(n), ("kind", "block_month"))
    before = layers.read_layers(spark, path)
    wanted = sorted(before.distinct().collect())
    assert len(wanted) < before.count()
    plan = jobs._distinct_by_month(before)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    jobs.merge_unique(spark, path)
    assert sorted(layers.read_layers(spark, path).select(before.columns).collect()) == wanted
    merged = layers.live_layers(spark, path)
    assert [n for n in merged if n.startswith("merged-")] == merged and len(merged) == 1


def test_writes_remove_their_shuffles(spark, tmp_path):
    def kept():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(str(f.getName()).endswith(".data") for f in iterate(blocks.getAllFiles().iterator()))

    def iterate(found):
        while found.hasNext():
            yield found.next()

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    before = kept()
    rows = spark.range(1000).withColumn("p", F.col("id") % 3).repartition(3, "id")
    layers.write_layer(rows, str(tmp_path / "t"), partition_by=("p",))
    assert kept() <= before
    assert layers.read_layers(spark, str(tmp_path / "t")).count() == 1000
    assert spark.conf.get(name) == setting
