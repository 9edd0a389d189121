"""Operators on small hand-made cases, checked against plain Python."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning, labeling, nodes, quality, ranking, selecting
from ledgerloom.operators.edges import aggregate_edges
from ledgerloom.operators.keysets import _likely, flag_members, key_set, touching, without_members

TX = "tx_hash string, block_timestamp timestamp, from_address string, to_address string, value_wei string"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def tx_frame(spark, rows):
    return spark.createDataFrame(rows, TX)


def values(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_weekly_edges_by_hand(spark):
    rows = [
        ("a", at(3), "x", "y", "5"),
        ("b", at(7, 23), "x", "y", "+7"),
        ("c", at(8), "x", "y", "bad"),
        ("d", at(3), None, "y", "1"),
        ("e", at(3), "y", "x", None),
    ]
    found = values(
        aggregate_edges(tx_frame(spark, rows)),
        "src", "dst", F.col("week_start").cast("string"), "tx_count", "total_value_wei",
    )
    assert found == [
        ("", "y", "2024-01-01", 1, "1"),
        ("x", "y", "2024-01-01", 2, "12"),
        ("x", "y", "2024-01-08", 1, "0"),
        ("y", "x", "2024-01-01", 1, "0"),
    ]


def test_sample_is_the_earliest_value(spark):
    rows = [("b", at(3), "x", "y", "1"), ("a", at(3), "x", "y", "2"), (None, at(4), "x", "y", "3")]
    edge = aggregate_edges(tx_frame(spark, rows), "month", total=False, sample=True).collect()
    assert [(e.tx_count, e.sample_value) for e in edge] == [(2, "2")]


@pytest.mark.parametrize("n", [1, 2, 10, 999, 1000, 1001])
@pytest.mark.parametrize("percentile", [50.0, 99.0, 99.9, 100.0])
def test_hub_threshold_is_the_sorted_position(spark, n, percentile):
    rng = random.Random(n)
    totals = [rng.randrange(1, 40) for _ in range(n)]
    frame = spark.createDataFrame(
        [(str(i), t, 0) for i, t in enumerate(totals)] + [("unseen", 0, 0)],
        "address string, degree_in bigint, degree_out bigint",
    )
    position = min(int((percentile / 100.0) * n), n - 1)
    assert nodes.hub_threshold(frame, percentile).collect()[0][0] == sorted(totals)[position]


def test_hub_threshold_literal_and_empty(spark):
    frame = spark.range(1000).select(
        F.col("id").cast("string").alias("address"),
        F.col("id").alias("degree_in"),
        (F.col("id") * 2).alias("degree_out"),
    )
    # The address of degree 0 does not count here: 999 addresses, position 998.
    assert nodes.hub_threshold(frame).collect()[0][0] == 2997
    assert nodes.hub_threshold(frame.limit(0)).collect()[0][0] == nodes.NO_HUBS


def edges_frame(spark, pairs):
    rows = [(s, d, f"2024-01-{w:02d}", 1, "1") for s, d, w in pairs]
    layout = "src string, dst string, week_start string, tx_count bigint, total_value_wei string"
    return spark.createDataFrame(rows, layout)


def test_degrees_count_rows_or_partners(spark):
    edges = edges_frame(spark, [("a", "b", 1), ("a", "b", 8), ("a", "c", 1), ("a", "a", 1)])
    labels = spark.createDataFrame([("z",), ("a",), (None,)], "address string")
    shown = ("address", "degree_in", "degree_out")
    assert values(nodes.degrees(edges, labels), *shown) == [
        ("a", 1, 4), ("b", 2, 0), ("c", 1, 0), ("z", 0, 0),
    ]
    assert values(nodes.degrees(edges, mode="distinct"), *shown) == [
        ("a", 1, 3), ("b", 1, 0), ("c", 1, 0),
    ]


def test_node_classes(spark):
    edges = edges_frame(spark, [("Hub", f"n{i}", 1) for i in range(5)])
    known = spark.createDataFrame([("hub",), ("n1",), ("n1",), ("other",)], "address string")
    labels = spark.createDataFrame([("lone",)], "address string")
    table = nodes.build_nodes(edges, labels, known=known, percentile=99.9)
    found = {r.address: (r.is_contract, r.node_type) for r in table.collect()}
    assert found["Hub"] == (True, "hub")
    assert found["n1"] == (True, "contract")
    assert found["lone"] == found["n2"] == (False, "eoa")
    assert len(found) == 7


def test_no_edges_no_hubs(spark):
    labels = spark.createDataFrame([("lone",)], "address string")
    table = nodes.build_nodes(edges_frame(spark, []), labels).collect()
    assert [(r.address, r.degree_in, r.node_type) for r in table] == [("lone", 0, "eoa")]


def test_status_newest_wins_and_unknown_stays_open(spark):
    status = spark.createDataFrame(
        [("0xA", True, at(1)), ("0xa", False, at(2)), ("0xb", True, at(1))],
        "address string, is_contract boolean, resolved_at timestamp",
    )
    every = spark.createDataFrame([("0xa",), ("0xB",), ("0xc",)], "address string")
    resolved = nodes.resolve_contracts(every, status=status)
    assert {r.address: r.is_contract for r in resolved.collect()} == {
        "0xa": False, "0xB": True, "0xc": None,
    }
    assert values(nodes.unresolved_addresses(resolved), "address") == [("0xc",)]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_touching_both_ways(spark, limit):
    rng = random.Random(3)
    names = [f"0xA{i}" for i in range(30)]
    rows = [
        (f"h{i}", at(1), rng.choice(names), rng.choice([*names, None]), "1") for i in range(500)
    ]
    # One address on a third of all rows.
    rows += [(f"hot{i}", at(1), "0xHOT", rng.choice(names), "1") for i in range(250)]
    labeled = ["0xa1", "0xA2", "0xhot", None, ""]
    keys = key_set(spark.createDataFrame([(a,) for a in labeled], "address string"))
    assert keys.rows == 3
    found = touching(tx_frame(spark, rows), keys, limit)
    wanted = {"0xa1", "0xa2", "0xhot"}
    expected = sorted(
        (h, f.lower() in wanted, (t or "").lower() in wanted)
        for h, _, f, t, _ in rows
        if f.lower() in wanted or (t or "").lower() in wanted
    )
    assert values(found, "tx_hash", "from_hit", "to_hit") == expected
    rest = without_members(tx_frame(spark, rows), "from_address", keys, limit)
    assert rest.count() == sum(r[2].lower() not in wanted for r in rows)


def test_large_key_sets_are_not_broadcast(spark):
    keys = key_set(spark.createDataFrame([("0xa",)], "address string"))
    rows = tx_frame(spark, [("h", at(1), "0xa", "0xb", "1")])
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        large = touching(rows, keys, limit=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    small = touching(rows, keys)._jdf.queryExecution().executedPlan().toString()
    # The two broadcasts are the pieces of the key filter, below the joins that shuffle.
    assert large.count("SortMergeJoin") == 2 and large.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in small and "Exchange hashpartitioning" not in small


def test_key_filter_passes_all_matches_and_few_others(spark):
    keys = key_set(spark.range(3000).select(F.concat(F.lit("0xK"), "id").alias("address")))
    rows = spark.range(60_000).select(
        F.concat(F.lit("0xk"), "id").alias("from_address"), F.lit(None).cast("string").alias("to_address")
    )
    passed = _likely(rows, keys, 0, "from_address", "to_address")
    assert passed.columns == rows.columns
    number = F.substring("from_address", 4, 9).cast("int")
    assert passed.filter(number < 3000).count() == 3000
    assert passed.count() < 4000


def test_hot_address_is_split_in_large_joins(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("tx_hash"),
        F.lit(at(1)).alias("block_timestamp"),
        F.when(F.col("id") % 3 == 0, "0xhot").otherwise(F.concat(F.lit("0x"), F.col("id"))).alias(
            "from_address"
        ),
        F.concat(F.lit("0xto"), F.col("id")).alias("to_address"),
        F.lit("1").alias("value_wei"),
    )
    keys = key_set(spark.createDataFrame([("0xhot",), ("0x1",)], "address string"))
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = touching(rows, keys, limit=0)
        assert len(found.collect()) == len(range(0, 200_000, 3)) + 1
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "isSkew=true" in plan or "skewed" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def expected_stats(rows, labeled):
    stats = {}
    for _, ts, sender, receiver, value in rows:
        ends = (sender or "").lower(), (receiver or "").lower()
        hits = [e in labeled for e in ends]
        if hits[0] == hits[1] or "" in ends:
            continue
        pair = ends if hits[0] else ends[::-1]
        total, count, latest = stats.get(pair, (0, 0, None))
        latest = ts if latest is None or (ts is not None and ts > latest) else latest
        stats[pair] = (total + int(value), count + 1, latest)
    return stats


@pytest.mark.parametrize("by", ["total_value", "transaction_count", "most_recent"])
@pytest.mark.parametrize("k", [1, 3, 100, 1500])
def test_top_counterparties_match_python(spark, by, k):
    rng = random.Random(11)
    names = [f"0xc{i:02d}" for i in range(40)]
    rows = [
        (
            f"h{i}",
            rng.choice([None, at(rng.randrange(1, 28))]),
            rng.choice(names),
            rng.choice([*names, "", None]),
            str(rng.choice([1, 2, 10**30])),
        )
        for i in range(900)
    ]
    labeled = {"0xc00", "0xc01", "0xc02"}
    keys = key_set(spark.createDataFrame([(a,) for a in labeled], "address string"))
    stats = ranking.counterparty_stats(tx_frame(spark, rows), keys, amount="value_wei")
    index = {"total_value": 0, "transaction_count": 1, "most_recent": 2}[by]

    def order(item):
        (_, name), measures = item
        score = measures[index]
        if by == "most_recent":
            return (score is None, -(score.timestamp() if score else 0), name)
        return (-score, name)

    expected = []
    for label in sorted(labeled):
        pairs = [i for i in expected_stats(rows, labeled).items() if i[0][0] == label]
        expected += [
            (label, pair[1], n + 1) for n, (pair, _) in enumerate(sorted(pairs, key=order)[:k])
        ]
    top = ranking.top_counterparties(stats, k, by)
    assert values(top, "labeled", "counterparty", "rank") == sorted(expected)


def test_excluded_picks_leave_their_slot_empty(spark):
    rows = [("a", at(1), "l", "x", "9"), ("b", at(1), "l", "y", "8"), ("c", at(1), "l", "z", "7")]
    keys = key_set(spark.createDataFrame([("l",)], "address string"))
    exclude = key_set(spark.createDataFrame([("X",)], "address string"))
    stats = ranking.counterparty_stats(tx_frame(spark, rows), keys, amount="value_wei")
    chosen = ranking.selected_counterparties(ranking.top_counterparties(stats, 2), exclude)
    assert values(chosen, "address") == [("y",)]


def test_first_per_hash_and_merge_priority(spark):
    first = tx_frame(spark, [("h", at(5), "a", "b", "1"), ("i", at(1), "a", "b", "1")])
    second = tx_frame(
        spark,
        [("h", at(1), "a", "b", "2"), ("j", at(2), "b", "c", "3"), ("j", at(2), "b", "b", "4")],
    )
    merged = cleaning.merge_transactions([first, second])
    shown = ("tx_hash", "to_address", "value_wei")
    assert values(merged, *shown) == [("h", "b", "1"), ("i", "b", "1"), ("j", "b", "4")]
    by_pair = cleaning.merge_transactions([first, second], ("tx_hash", "to_address"))
    assert by_pair.count() == 4
    counts = cleaning.repeat_counts(first.unionByName(second)).collect()[0]
    assert tuple(counts) == (5, 3, 2)


def test_many_copies_leave_the_map_side_as_one_row(spark):
    copies = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("tx_hash"),
        F.lit(at(1)).alias("block_timestamp"),
        F.lit("a").alias("from_address"),
        F.lit("b").alias("to_address"),
        F.col("id").cast("string").alias("value_wei"),
    )
    kept = cleaning.drop_repeats(copies, ("tx_hash",), ("block_timestamp",))
    assert kept.filter("tx_hash = 'hot'").select("value_wei").collect()[0][0] == "0"
    assert kept.count() == 20_000 - 20_000 // 3
    assert "partial_min" in kept._jdf.queryExecution().executedPlan().toString()


RAW = (
    "address string, direction string, hash string, `from` string, `to` string, value double, "
    "asset string, category string, block_number bigint, block_timestamp string, "
    "value_wei_text string"
)


def raw(spark, **changes):
    row = dict(
        address="q", direction="from", hash="h", **{"from": "a", "to": "b"}, value=1.5,
        asset="ETH", category="external", block_number=1,
        block_timestamp="2024-01-03T12:00:00Z", value_wei_text=None,
    )
    row.update(changes)
    return spark.createDataFrame([tuple(row.values())], RAW)


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        ({"category": "erc20"}, "category"),
        ({"category": None}, "category"),
        ({"value": 0.0}, "zero_value"),
        ({"value": None}, None),
        ({"to": None}, "empty_to"),
        ({"to": None, "direction": "to"}, None),
        ({"to": "", "direction": "to", "address": None}, "empty_to"),
        ({"from": ""}, "empty_from"),
        ({"block_timestamp": "soon"}, "bad_timestamp"),
    ],
)
def test_classification(spark, changes, reason):
    classified = cleaning.classify_transfers(cleaning.fill_recipient(raw(spark, **changes)))
    assert [r.reject_reason for r in classified.collect()] == [reason]


def test_exact_amount_wins_and_bad_time_can_fail(spark):
    row = cleaning.classify_transfers(raw(spark, value_wei_text="1500000000000000001")).first()
    assert (row.value_wei, row.rank_wei) == ("1500000000000000001",) * 2
    failing = cleaning.classify_transfers(raw(spark, block_timestamp="soon"), on_bad_ts="fail")
    with pytest.raises(Exception, match="bad timestamp"):
        failing.collect()


def test_invalid_address_text_is_kept(spark):
    accepted = cleaning.accepted(cleaning.classify_transfers(raw(spark, **{"to": "0x" + "AB" * 20})))
    row = cleaning.to_transactions(accepted).first()
    assert row.from_address == "a"
    assert row.to_address.lower() == "0x" + "ab" * 20 and row.to_address != row.to_address.lower()


@pytest.mark.parametrize("size", [1, 2, 5, 7, 100])
def test_oversized_groups_are_reported(spark, size):
    rng = random.Random(size)
    rows = [
        (f"h{i}", rng.choice("ab"), rng.choice(["from", "to"]), rng.randrange(0, 40))
        for i in range(120)
    ]
    frame = spark.createDataFrame(
        rows, "tx_hash string, address string, direction string, block_number bigint"
    )
    totals = {}
    for row in rows:
        key = (row[1], row[2], row[3] // 10)
        totals[key] = totals.get(key, 0) + 1
    report = selecting.oversized_groups(frame, size, block_chunk=10).collect()
    found = {(r.address, r.direction, r.chunk): (r.total, r.above) for r in report}
    assert found == {k: (n, n - size) for k, n in totals.items() if n > size}


def test_window_bounds(spark):
    end = datetime(2024, 1, 8, tzinfo=timezone.utc)
    start, _ = selecting.window_bounds(end, 1)
    rows = tx_frame(
        spark, [(str(d), at(d), "a", "b", "1") for d in (1, 7, 8)] + [("n", None, "a", "b", "1")]
    )
    assert values(selecting.select_window(rows, start, end), "tx_hash") == [("1",), ("7",)]
    # No number of weeks is too many, and none at all reaches back to the first block.
    late = datetime(2030, 1, 1, tzinfo=timezone.utc)
    assert (late - selecting.window_bounds(late, 700)[0]).days == 4900
    assert selecting.window_bounds(late) == (selecting.GENESIS, late)


def test_label_bounds(spark):
    labels = spark.createDataFrame([(c,) for c in "dbca"], "address string")
    assert selecting.bound_labels(labels).count() == 4
    assert selecting.bound_labels(labels, 1, 4).count() == 4
    with pytest.raises(ValueError, match="at most 2"):
        selecting.bound_labels(labels, 1, 2)
    with pytest.raises(ValueError, match="at least 5"):
        selecting.bound_labels(labels, minimum=5)


def test_labels_are_validated_and_deduplicated(spark):
    mixed = "0xd8dA6BF26964aF9D7eEd9e03E53415D37aA96045"
    found = spark.createDataFrame(
        [(mixed, "s2"), (mixed.lower(), "s1"), ("0x" + "0" * 40, "s1"), ("0xinvalid", "s1")],
        "raw_address string, source_url string",
    )
    rows = labeling.build_label_table(found).collect()
    assert [(r.address, r.label, r.label_source, r.source_url) for r in rows] == [
        (mixed, 1, "OFAC_SDN", "s1")
    ]
    dimension = labeling.address_dimension(found, "raw_address").collect()
    assert {r.key: r.checksum for r in dimension}[mixed.lower()] == mixed


@pytest.mark.parametrize(
    "count, strict, expected",
    [(5, True, "exceeded"), (5, False, "warning"), (1, True, "below_target"), (3, True, "ok")],
)
def test_verdicts(spark, count, strict, expected):
    limits = quality.ScaleLimits(max_nodes=4, min_nodes_target=2, max_edges=4, min_edges_target=2)
    report = quality.scale_report(spark.range(count), None, limits, strict)
    found = {r.subject: r.verdict for r in report.collect()}
    assert found == {"nodes": expected, "edges": "below_target"}
    if expected == "exceeded":
        with pytest.raises(quality.ScaleExceeded):
            quality.enforce(report)
    else:
        quality.enforce(report)


def test_runtime_filters_of_spark_do_not_serve_both_ends(spark, tmp_path):
    names = [(f"0x{k:040x}", f"0x{k + 1:040x}") for k in range(2000)]
    spark.createDataFrame(names, "from_address string, to_address string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    keys = key_set(rows.limit(50).select(F.col("from_address").alias("address")))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        plain = rows
        for column in ("from_address", "to_address"):
            plain = flag_members(plain, column, keys, f"hit_{column}", limit=0)
        plain = plain.filter("hit_from_address or hit_to_address")
        plan = plain._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" not in plan and "bloom" not in plan.lower()
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert touching(rows, keys, limit=0).count() == plain.count() > 0
