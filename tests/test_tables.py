"""Readers, writers, stages and streams on files."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning, quality
from ledgerloom.plans import stages
from ledgerloom.session import scratch_path, shared_dir
from ledgerloom.sinks import metadata as run_notes
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import contracts, sanctions
from ledgerloom.sources import tables as sources
from ledgerloom.sources.transfers import read_transfer_pages
from ledgerloom.streaming.jobs import (
    read_accepted,
    read_rejected,
    read_stream_edges,
    stream_clean,
    stream_edges,
)

VITALIK = "0xd8dA6BF26964aF9D7eEd9e03E53415D37aA96045"


def address(number):
    return f"0x{number:040x}"


def page(hash_, sender, receiver, day=3, value=1.5, category="external", **more):
    stamp = f"2024-01-{day:02d}T12:00:00.000Z"
    return {
        "address": receiver,
        "direction": "to",
        "transfers": [
            {
                "hash": hash_, "from": sender, "to": receiver, "value": value, "asset": "ETH",
                "category": category, "blockNum": hex(day * 7200),
                "metadata": {"blockTimestamp": stamp}, **more,
            }
        ],
    }


def land(folder, name, pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(p) + "\n" for p in pages))


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_pages_are_exploded(spark, tmp_path):
    two = page("0x1", address(1), address(2))
    two["transfers"] += page("0x2", address(1), None, valueWei="7")["transfers"]
    land(tmp_path / "in", "a.json", [two, {"address": "x", "direction": "to", "transfers": []}])
    rows = read_transfer_pages(spark, str(tmp_path / "in")).orderBy("hash").collect()
    assert [(r.hash, r.block_number, r.value_wei_text) for r in rows] == [
        ("0x1", 21600, None), ("0x2", 21600, "7"),
    ]


def test_writers_sort_count_and_refuse_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "tx")
    tx = spark.range(2000).select(
        F.concat(F.lit("h"), F.col("id") % 1500).alias("tx_hash"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id") % 700)).alias("block_timestamp"),
        F.when(F.col("id") % 100 != 0, "a").otherwise("").alias("from_address"),
        F.lit("b").alias("to_address"),
        F.lit("1").alias("value_wei"),
    )
    kept = len({i % 1500 for i in range(2000) if i % 100})
    assert sinks.write_transactions(tx, path) == kept
    stored = spark.read.parquet(path)
    assert stored.count() == kept and dict(stored.dtypes)["block_timestamp"] == "string"
    with pytest.raises(Exception, match="already exists"):
        sinks.write_transactions(tx, path)


def test_readers_demand_their_columns(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.range(1).select(F.lit("a").alias("src")).write.parquet(path)
    with pytest.raises(ValueError, match="dst, week_start"):
        sources.read_edges(spark, path)


def test_scan_pushes_filters_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "tx")
    spark.createDataFrame([("h", "t", "a", "b", "1")], sources.TRANSACTIONS_DISK).write.parquet(path)
    scan = sources.scan_transactions(spark, path).filter("from_address = 'a'").select("tx_hash")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(from_address,a)" in plan and "value_wei" not in plan


def test_chunks_with_missing_inputs(spark, tmp_path):
    labeled, chunks = str(tmp_path / "labeled"), str(tmp_path / "chunks")
    layout = sources.TRANSACTIONS_DISK
    row = ("h", "2024-01-01T00:00:00Z", "a", "b", "1")
    for name in ("chunk_0000", "chunk_0001"):
        spark.createDataFrame([("x", *row[1:]), (name, *row[1:])], layout).write.parquet(
            f"{chunks}/{name}.parquet"
        )
    assert len(sources.read_chunks(spark, labeled, None)) == 0
    only = sources.read_chunks(spark, labeled, chunks)
    assert [f.count() for f in only] == [4]
    spark.createDataFrame([("x", *row[1:4], "9")], layout).write.parquet(labeled)
    frames = sources.read_chunks(spark, labeled, chunks)
    merged = cleaning.merge_transactions(frames).collect()
    assert {r.tx_hash: r.value_wei for r in merged} == {
        "x": "9", "chunk_0000": "1", "chunk_0001": "1",
    }


def test_contract_list_and_cache(spark, tmp_path):
    folder = tmp_path / "contracts"
    folder.mkdir()
    (folder / "a.csv").write_text(f"address,block\n{address(10).upper().replace('X', 'x')},5\n0x12,1\n")
    (folder / "b.csv").write_text(f" {address(10)} ,7\n{address(11)}\n")
    (folder / "c.txt").write_text(f"{address(12)}\n")
    found = contracts.read_contract_list(spark, str(folder)).collect()
    assert {r.address for r in found} == {address(10), address(11)}
    cache = tmp_path / "cache.csv"
    cache.write_text("a,1\nb,0\na,0\nc,yes\nB,1\nnothing\nd,1,x\n")
    status = {r.address: r.is_contract for r in contracts.read_status_cache(spark, str(cache)).collect()}
    assert status == {"a": False, "b": True, "c": False, "d": False}


def test_exchange_list(spark):
    listed = [r.address for r in contracts.known_exchanges(spark).collect()]
    assert len(set(listed)) == 31
    assert all(len(a) == 42 and a == a.lower() for a in listed)


SDN = f"""<?xml version="1.0"?>
<sdnList>
  <sdnEntry><uid>1</uid><sdnType>Individual</sdnType><idList>
    <id><idType>Digital Currency Address - ETH</idType><idNumber>{VITALIK}</idNumber></id>
    <id><idType>Passport</idType><idNumber>{address(77)}</idNumber></id>
  </idList></sdnEntry>
  <sdnEntry><uid>2</uid><sdnType>Entity</sdnType></sdnEntry>
</sdnList>
"""
ADVANCED = f"""<?xml version="1.0"?>
<Sanctions>
  <DistinctParty><Feature><FeatureType>Digital Currency Address - ETH</FeatureType>
    <VersionDetail><DetailValue>{address(5)}</DetailValue></VersionDetail>
    <VersionDetail><DetailValue>{"ab" * 32}</DetailValue></VersionDetail></Feature>
    <Feature><FeatureType>Website</FeatureType>
    <VersionDetail><DetailValue>{address(78)}</DetailValue></VersionDetail></Feature>
  </DistinctParty>
</Sanctions>
"""


def documents(tmp_path):
    paths = [tmp_path / "sdn.xml", tmp_path / "advanced.xml", tmp_path / "list.csv"]
    for path, text in zip(paths, (SDN, ADVANCED, f"9,x,{address(6)}\n")):
        path.write_text(text)
    layouts = ("sdn_xml", "advanced_xml", "csv")
    return [(str(p), layout) for p, layout in zip(paths, layouts)]


def test_sanctions_loose_and_strict(spark, tmp_path):
    found = sanctions.read_sanctions(spark, documents(tmp_path))
    keys = {r.raw_address.lower() for r in found.collect()}
    structured = {VITALIK.lower(), address(5), address(6)}
    assert keys == structured | {address(77), address(78), "0x" + "ab" * 20}
    strict = sanctions.read_sanctions(spark, documents(tmp_path), strict=True)
    assert {r.raw_address.lower() for r in strict.collect()} == structured


def sdn(uid, number, end="</sdnEntry>", start="<sdnEntry>", kind="Digital Currency Address - ETH"):
    return f"{start}<uid>{uid}</uid><idList><id><idType>{kind}</idType><idNumber>{number}</idNumber></id></idList>{end}"


def test_broken_entries_are_rejected_one_by_one(spark, tmp_path):
    good = [sdn(k, address(k)) for k in (1, 2, 3)]
    good += [sdn(4, address(4), start="<sdnEntry a='>' b=\"x/>\">"), sdn(5, address(5)) + "<other/>"]
    entries = [
        good[0], sdn(11, address(11), end="</sdnEntr>"), good[1], sdn("x", address(12)),
        sdn(13, address(13), end="").replace("</id>", "") + "</sdnEntry>", good[2],
        sdn(14, address(14), start="<sdnEntry "), "<sdnEntry/>", "<sdnEntry></sdnEntry>", good[3],
        sdn(15, address(15), end=""), good[4], sdn(16, address(16), start="<sdnEntry <"), "<sdnEntry>",
    ]
    for sep in ("\n  ", ""):
        folder = tmp_path / f"sdn{len(sep)}"
        folder.mkdir()
        (folder / "a.xml").write_text("\ufeff<?xml version='1.0'?>\n<sdnList xmlns='x'>" + sep.join(entries))
        rows = sanctions.classify_entries(spark, str(folder), "sdnEntry", sanctions.SDN_ENTRY).collect()
        assert len(rows) == len(entries)
        assert {r.uid for r in rows if r.reject_reason is None} == {1, 2, 3, 4, 5, None}
        assert sum(r.reject_reason is None for r in rows) == 7
        reasons = {k: next(r.reject_reason for r in rows if r.raw and address(k) in r.raw) for k in range(11, 17)}
        assert reasons == {
            11: "unclosed_entry", 12: "malformed_entry", 13: "malformed_entry",
            14: "malformed_tag", 15: "unclosed_entry", 16: "malformed_tag",
        }
        strict = sanctions.read_sanctions(spark, [(str(folder), "sdn_xml")], strict=True)
        assert sorted(r.raw_address for r in strict.collect()) == [address(k) for k in range(1, 6)]
        loose = sanctions.read_sanctions(spark, [(str(folder), "sdn_xml")])
        assert {address(k) for k in range(11, 17)} < {r.raw_address for r in loose.collect()}


def test_entries_cut_by_splits(spark, tmp_path):
    text = "<sdnList>" + "\n".join(sdn(k, address(k), end="</sdnEntry>" if k % 7 else "") for k in range(1, 400))
    (tmp_path / "a.xml").write_text(text + "</sdnList>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = sanctions.classify_entries(spark, str(tmp_path), "sdnEntry", sanctions.SDN_ENTRY)
        assert rows.rdd.getNumPartitions() > 5
        rows = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.uid for r in rows if r.reject_reason is None) == [k for k in range(1, 400) if k % 7]
    assert sum(r.reject_reason == "unclosed_entry" for r in rows) == 57


def test_sources_without_entries(spark, tmp_path):
    (tmp_path / "page.xml").write_text("<html><body>503 try later</body></html>")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "none.xml").write_text("<?xml version='1.0'?><Sanctions></Sanctions>")
    (tmp_path / "sdn.xml").write_text(SDN)
    (tmp_path / "cut.xml").write_text(SDN[: SDN.rindex("</sdnList>")])
    names = (("page", "sdn_xml"), ("empty", "sdn_xml"), ("none", "advanced_xml"), ("sdn", "sdn_xml"), ("gone", "csv"))
    names += (("cut", "sdn_xml"),)
    listed = [(str(tmp_path / f"{n}.xml"), layout) for n, layout in names]
    found = {r.source.rsplit("/")[-1]: r.reject_reason for r in sanctions.read_sanction_rejects(spark, listed).collect()}
    none = "no_entries"
    assert found == {
        "page.xml": "malformed_tag", "empty.xml": none, "none.xml": none, "gone.xml": "missing_source", "cut.xml": "cut_document"
    }
    counts = sanctions.sanction_counts(spark, listed).collect()
    assert sorted((r.outcome, r.n_entries) for r in counts) == [("accepted", 2)] * 2 + [("malformed_tag", 1)]


def test_label_stage_writes_rejects(spark, tmp_path):
    source, out = tmp_path / "sdn.xml", tmp_path / "out"
    source.write_text("<l>" + sdn(1, address(1)) + sdn(2, address(2), end="") + "</l>")
    listed = [(str(source), "sdn_xml"), (str(tmp_path / "gone.xml"), "advanced_xml")]
    paths = [str(out / n) for n in ("labels", "rejects", "counts")]
    assert stages.extract_labels(spark, listed, paths[0], True, rejects_path=paths[1], counts_path=paths[2]) == 1
    rejects = spark.read.parquet(paths[1]).collect()
    assert sorted(r.reject_reason for r in rejects) == ["missing_source", "unclosed_entry"]
    assert any(r.raw and address(2) in r.raw and r.source_url.endswith("sdn.xml") for r in rejects)
    counts = {r.outcome: r.n_entries for r in spark.read.json(paths[2]).collect()}
    assert counts == {"accepted": 1, "unclosed_entry": 1}


def test_unreadable_sources(spark, tmp_path):
    missing = (str(tmp_path / "missing.xml"), "sdn_xml")
    found = sanctions.read_sanctions(spark, [missing, *documents(tmp_path)])
    assert found.count() > 0
    with pytest.raises(ValueError, match="no sanctions source"):
        sanctions.read_sanctions(spark, [missing])
    empty = tmp_path / "empty.csv"
    empty.write_text("nothing here\n")
    with pytest.raises(ValueError, match="no address"):
        stages.extract_labels(spark, [(str(empty), "csv")], str(tmp_path / "labels"))


def test_metadata_and_status(spark, tmp_path):
    path = str(tmp_path / "notes")
    start, end = (F.lit(datetime(2024, 1, d, tzinfo=timezone.utc)) for d in (1, 8))
    run_notes.write_metadata(run_notes.run_metadata(spark, start, end, {"nodes": 3}), path)
    note = spark.read.json(path).first()
    assert (note.schema_version, note.record_counts.nodes) == ("1.0.0", 3)
    assert (note.window_start, note.window_end) == (
        "2024-01-01T00:00:00+00:00", "2024-01-08T00:00:00+00:00",
    )
    with pytest.raises(ValueError):
        run_notes.run_metadata(spark, start, end, {"other": 1})
    table = str(tmp_path / "table")
    spark.range(50_000).write.parquet(table)
    report = quality.table_status(spark, {"a": table, "b": table + "x"}, {"n": path})
    found = {r.name: (r.found, r.n_records) for r in report.collect()}
    assert found == {"a": (True, 50_000), "b": (False, None), "n": (True, 1)}
    assert report.filter("name = 'a'").first().size_kb > 0


def run_stream(spark, tmp_path, **options):
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    stream_clean(spark, str(tmp_path / "in"), out, marks, **options).awaitTermination()
    return read_accepted(spark, out)


def test_stream_resumes_without_repeats(spark, tmp_path):
    land(tmp_path / "in", "a.json", [page("0x1", address(1), address(2)), page("0x2", address(1), address(2), category="erc20")])
    assert run_stream(spark, tmp_path).count() == 1
    land(tmp_path / "in", "b.json", [page("0x1", address(1), address(2)), page("0x3", address(1), address(2), day=4)])
    rows = run_stream(spark, tmp_path)
    assert sorted(r.tx_hash for r in rows.collect()) == ["0x1", "0x3"]
    assert run_stream(spark, tmp_path).count() == 2
    assert {str(r.block_month) for r in rows.collect()} == {"2024-01-01"}


def test_stream_keeps_rows_whatever_the_landing_order(spark, tmp_path):
    for name, day in (("a", 20), ("b", 2), ("c", 25), ("d", 1)):
        land(tmp_path / "in", f"{name}.json", [page(f"0x{name}", address(1), address(2), day=day), page("0xsame", address(1), address(day), day=day)])
        rows = run_stream(spark, tmp_path)
    found = {r.tx_hash: (r.block_timestamp.day, r.to_address) for r in rows.collect()}
    assert found == {"0xa": (20, address(2)), "0xb": (2, address(2)), "0xc": (25, address(2)), "0xd": (1, address(2)), "0xsame": (1, address(1))}


def test_stream_rejects_malformed_input_with_its_text(spark, tmp_path):
    land(tmp_path / "in", "a.json", [page("0x1", address(1), address(2)), page("0x2", address(1), address(2), value=0.0)])
    good = (tmp_path / "in" / "a.json").read_text().splitlines()[0]
    lines = [good[:40], good.replace("0x1", "0x9").replace('"value": 1.5', '"value": "oops"'), '{"address": "0xa", "transfers": [null]}', '{"address": "0xa", "transfers": []}', "no json"]
    (tmp_path / "in" / "b.json").write_text("\n".join(lines) + "\n")
    assert run_stream(spark, tmp_path).count() == 1
    rows = read_rejected(spark, str(tmp_path / "out")).collect()
    assert sorted((r.reject_reason, r.tx_hash) for r in rows if r.tx_hash) == [("malformed_value", "0x9"), ("zero_value", "0x2")]
    assert sorted(str(r.raw) for r in rows if r.reject_reason == "malformed_page") == sorted([good[:40], "no json"])
    assert sorted(r.reject_reason for r in rows) == ["malformed_page", "malformed_page", "malformed_transfer", "malformed_value", "zero_value"]


def test_stream_edges_are_complete_after_every_run(spark, tmp_path):
    source, out = tmp_path / "tx", str(tmp_path / "out")
    layout = "tx_hash string, block_timestamp timestamp, from_address string, to_address string, value_wei string"

    def add(name, *days):
        rows = [(f"{name}{d}", datetime(2024, 1, d, 23), "a", "b", "5") for d in days]
        spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema(layout).parquet(str(source))
        stream_edges(stream, out, str(tmp_path / "marks")).awaitTermination()
        rows = read_stream_edges(spark, out).collect()
        return sorted((str(r.week_start), r.tx_count, r.total_value_wei) for r in rows)

    add("x", 1, 7, 8)
    assert run() == [("2024-01-01", 2, "10"), ("2024-01-08", 1, "5")]
    add("y", 7, 30)
    add("late", 2)
    expected = [("2024-01-01", 4, "20"), ("2024-01-08", 1, "5"), ("2024-01-29", 1, "5")]
    assert run() == expected and run() == expected


def test_build_graph_end_to_end(spark, tmp_path):
    labeled, friend, far = VITALIK, address(50), address(60)
    pages = [
        page("0x1", labeled.lower(), friend, day=2),
        page("0x2", friend, far, day=9),
        page("0x3", far, address(61), day=9),
        page("0x4", labeled.lower(), address(70), day=2, value=0.001),
        page("0x5", address(70), address(71), day=2),
        page("0x6", friend, far, day=9, valueWei="7"),
    ]
    land(tmp_path / "in", "a.json", pages)
    transfers = run_stream(spark, tmp_path)
    sdn = tmp_path / "list.csv"
    sdn.write_text(f"1,{labeled}\n")
    report = stages.build_graph(
        spark,
        [(str(sdn), "csv")],
        transfers,
        str(tmp_path / "graph"),
        end=datetime(2024, 2, 1, tzinfo=timezone.utc),
        weeks=8,
        k=1,
    )
    assert {(r.name, r.kind): r.n_records for r in report.collect()} == {
        ("labels", "table"): 1, ("transactions", "table"): 4, ("edges", "table"): 3,
        ("nodes", "table"): 4, ("labels", "metadata"): 1, ("transactions", "metadata"): 1,
        ("edges", "metadata"): 1, ("nodes", "metadata"): 1,
    }
    folder = stages.latest_tables(spark, str(tmp_path / "graph"))
    hashes = {r.tx_hash for r in sources.read_transactions(spark, folder["transactions"]).collect()}
    # The weaker counterparty (k = 1) keeps its own transfer to the label only.
    assert hashes == {"0x1", "0x2", "0x4", "0x6"}
    edges = {(r.src, r.dst): r.total_value_wei for r in sources.read_edges(spark, folder["edges"]).collect()}
    assert edges[(friend, far)] == str(1500000000000000000 + 7)
    assert (labeled, friend) in edges  # checksum form
    nodes = {r.address: (r.degree_in, r.degree_out) for r in sources.read_nodes(spark, folder["nodes"]).collect()}
    assert nodes[labeled] == (0, 2) and nodes[friend] == (1, 1)


@pytest.mark.parametrize("skip_transactions, skip_nodes", [(True, False), (False, True), (True, True)])
def test_build_graph_runs_again(spark, tmp_path, skip_transactions, skip_nodes):
    land(tmp_path / "in", "a.json", [page("0x1", VITALIK.lower(), address(50), day=2)])
    sdn, folder = tmp_path / "list.csv", str(tmp_path / "graph")

    def run(**options):
        sdn.write_text(f"1,{VITALIK}\n2,{address(90)}\n" if options else f"1,{VITALIK}\n")
        return stages.build_graph(
            spark,
            [(str(sdn), "csv")],
            run_stream(spark, tmp_path),
            folder,
            end=datetime(2024, 2, 1, tzinfo=timezone.utc),
            granularity="month",
            degree_mode="distinct",
            **options,
        )

    run()
    land(tmp_path / "in", "b.json", [page("0x2", VITALIK.lower(), address(51), day=3)])
    report = run(skip_transactions=skip_transactions, skip_nodes=skip_nodes)
    found = {(r.name, r.kind): r.n_records for r in report.collect()}
    assert found["labels", "table"] == 2 and found["edges", "table"] == (1 if skip_transactions else 2)
    assert found["nodes", "table"] == (None if skip_nodes else 3 if skip_transactions else 4)
    tables = stages.latest_tables(spark, folder)
    first, second = stages.run_folders(spark, folder)
    assert (first in tables["transactions"]) == skip_transactions
    assert (first in tables["nodes"]) == skip_nodes
    # The first run's tables are untouched.
    assert sources.read_labels(spark, f"{first}/labels").count() == 1


def test_strict_scale_stops_the_slice(spark, tmp_path):
    land(tmp_path / "in", "a.json", [page(f"0x{i}", VITALIK.lower(), address(50 + i)) for i in range(5)])
    transfers = run_stream(spark, tmp_path)
    labels = spark.createDataFrame([(VITALIK,)], "address string")
    limits = quality.ScaleLimits(max_nodes=3)
    with pytest.raises(quality.ScaleExceeded, match="counterparties"):
        stages.collect_slice(transfers, labels, limits=limits, strict=True)
    part = stages.collect_slice(transfers, labels, limits=limits)
    assert part.verdict.first().verdict == "warning" and part.counterparties.rows == 5


def test_slice_without_counterparties(spark):
    layout = "tx_hash string, block_timestamp timestamp, from_address string, to_address string, value_wei string, rank_wei string"
    rows = [("h", datetime(2024, 1, 1), "", "a", "1", "1"), ("h", datetime(2024, 1, 2), "a", "b", "1", "1")]
    transfers = spark.createDataFrame(rows, layout)
    labels = spark.createDataFrame([("a",), ("b",)], "address string")
    part = stages.collect_slice(transfers, labels)
    assert part.counterparties.rows == 0
    merged = stages.merged_slice(transfers, part).collect()
    assert [(r.tx_hash, r.from_address) for r in merged] == [("h", "a")]
    with pytest.raises(ValueError, match="0 labeled"):
        stages.collect_slice(transfers, labels.limit(0))


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
