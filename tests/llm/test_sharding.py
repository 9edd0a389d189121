import zlib

from pyspark.sql import functions as F

from ledgerloom.llm import sharding
from ledgerloom.session import scratch_path


def test_rows_sizes_and_slots(make):
    rows = [(i, "x" * (i % 50)) for i in range(3000)] + [(5, "again"), (5, "again"), (None, None), (7000, "é" * 5000), (7001, "")]
    got = sharding.shard(make(rows), shards=8, slots=512).toPandas()
    assert len(got) == len(rows)
    expected = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    found = sorted((i != i, 0 if i != i else int(i), s, c) for i, s, c in zip(got["doc_id"], got["size"], got["text_crc32"]))
    assert found == expected
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() <= 16 + 10_000 and loads.drop(got.loc[got["size"].idxmax(), "shard"]).std() < 50
    assert got.groupby("virtual_slot")["shard"].nunique().max() == 1


def test_dealing_is_greedy(llm):
    sizes = [(k, 1, (k * 37) % 101) for k in range(64)]
    table = llm.createDataFrame(sizes, "virtual_slot int, n_rows long, n_bytes long")
    loads, chosen = [0] * 5, {}
    for slot, _, size in sorted(sizes, key=lambda r: (-r[2], -r[0])):
        chosen[slot] = loads.index(min(loads))
        loads[chosen[slot]] += max(size, sharding.ROW_BYTES)
    assert {r["virtual_slot"]: r["shard"] for r in sharding.deal_slots(table, 5).collect()} == chosen


def test_growing_moves_rows_into_the_new_shard_only(llm, make):
    records = sharding.record_slots(make([(i, "x" * (i % 90)) for i in range(4000)]), 1024)
    sizes = sharding.slot_sizes(llm, records, 1024)
    root = scratch_path(llm, "map-test")
    first = sharding.store_map(sharding.deal_slots(sizes, 10), root, 1)
    second = sharding.store_map(sharding.grow(sizes, first, 10), root, 2)
    moved = first.join(second.withColumnRenamed("shard", "new"), "virtual_slot").join(sizes, "virtual_slot")
    moved = moved.filter("shard != new")
    assert moved.filter("new != 10").count() == 0 and moved.count() > 0
    loads = [r[0] for r in second.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("n_bytes")).select("sum(n_bytes)").collect()]
    assert len(loads) == 11 and max(loads) < 1.15 * min(loads)
    latest = {tuple(r) for r in sharding.read_map(llm, root).collect()}
    assert latest == {tuple(r) for r in second.collect()} != {tuple(r) for r in sharding.read_map(llm, root, 1).collect()}


def test_null_and_repeated_ids_are_spread(make):
    rows = [(None, "same")] * 1500 + [(7, f"text {i}") for i in range(1500)]
    got = sharding.shard(make(rows), shards=4, slots=512).toPandas()
    for part in (got[got["doc_id"].isna()], got[got["doc_id"] == 7]):
        counts = part.groupby("shard").size()
        assert len(counts) == 4 and counts.min() > 250
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() < 1.02 * loads.min()


def test_equal_texts_go_to_all_shards(make):
    rows = [(i, "one text for all") for i in range(2000)]
    got = sharding.shard(make(rows), shards=4, slots=512).toPandas()
    assert got.groupby("shard").size().min() > 450


def test_a_large_slot_is_numbered_in_portions(make):
    rows = [(5, "a row and its copies")] * 900 + [(i, "x") for i in range(300)]
    got = sharding.shard(make(rows).repartition(6), shards=3, slots=16, portion_rows=50).toPandas()
    assert len(got) == 1200 and got.groupby("virtual_slot").size().max() > 900
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_the_new_shard_takes_its_part_of_slots_and_bytes(llm):
    documents = llm.read.parquet("/root/testdata/sf0.1/documents.parquet")
    records = sharding.record_slots(documents)
    sizes = sharding.slot_sizes(llm, records).cache()
    first = sharding.deal_slots(sizes, 40).cache()
    grown = sharding.grow(sizes, first, 40).join(sizes, "virtual_slot").toPandas()
    new = grown[grown["shard"] == 40]
    for share in (len(new) / len(grown), new["n_bytes"].sum() / grown["n_bytes"].sum()):
        assert 0.5 / 41 < share < 2 / 41
    empty = (grown["n_bytes"] == 0).mean()
    held = first.join(sizes.filter("n_bytes = 0"), "virtual_slot").groupBy("shard").count().toPandas()["count"]
    assert len(held) == 40 and held.max() < 2 * held.min()
    assert abs((new["n_bytes"] == 0).mean() - empty) < 0.15
    assert new["n_bytes"].count() == grown.merge(first.toPandas(), on="virtual_slot").query("shard_x != shard_y").shape[0]


def test_empty_table(make):
    assert sharding.shard(make([]), shards=3, slots=16).count() == 0


def test_rows_follow_the_map_that_grew(llm, make):
    root = scratch_path(llm, "grown-map-test")
    got = sharding.shard(make([(i, "x" * (i % 90)) for i in range(4000)]), 10, 1024, root).toPandas()
    latest = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(llm, root).collect()}
    first = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(llm, root, 1).collect()}
    assert (got["rebalanced_shard"] == got["virtual_slot"].map(latest)).all()
    assert (got["shard"] == got["virtual_slot"].map(first)).all()
    moved = got[got["rebalanced_shard"] != got["shard"]]
    assert len(moved) and set(moved["rebalanced_shard"]) == {10}
    loads = got.groupby("rebalanced_shard")["size"].sum()
    assert len(loads) == 11 and loads.max() < 1.15 * loads.min()
