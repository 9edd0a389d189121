"""Queries on tables that go on from what is stored: node states, statuses, checksums, months."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ledgerloom.operators import labeling, nodes
from ledgerloom.operators.edges import aggregate_edges
from ledgerloom.plans import incremental, stages
from ledgerloom.session import scratch_path, write_scratch
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import contracts, tables as sources
from workload.flows import _SHOWN, shown
from workload.graph import _LATEST_SQL, _NODE_SQL, dated
from workload.keccak import checksum_sql
from workload.registry import query
from workload.standins import (
    PERCENTILE,
    check_sql,
    contract_addresses,
    customer_address,
    labeled_addresses,
    status_rows,
    table,
    transactions,
)

#: Wednesdays: the weeks of both are cut, so some edges stand on either side.
CUTS = ("1994-06-01", "1996-11-06")


def edge_portions(spark, sf_dir):
    """The edges of the transactions up to the first cut, between the cuts, and after."""
    rows = write_scratch(transactions(spark, sf_dir), "rows")
    bounds = ("0001-01-01", *CUTS, "9999-01-01")
    when = F.to_date("block_timestamp")
    for low, high in zip(bounds, bounds[1:]):
        yield write_scratch(aggregate_edges(rows.filter((when >= low) & (when < high))), "portion")


def grown_state(spark, sf_dir, **lookups):
    """A state that has taken the portions one after another; labels come with the second."""
    folder, stored = scratch_path(spark, "state"), None
    for number, portion in enumerate(edge_portions(spark, sf_dir)):
        fresh = portion if stored is None else incremental.unseen_edges(portion, stored)
        labels = labeled_addresses(spark, sf_dir).select("address") if number == 1 else None
        incremental.apply_edges(spark, folder, fresh, f"portion-{number}", labels, **lookups)
        stored = portion if stored is None else stored.unionByName(portion)
    return folder


@query("C5_incremental_nodes", check_sql(_NODE_SQL, "nodes"))
def incremental_nodes(spark, sf_dir):
    folder = grown_state(spark, sf_dir, known=contract_addresses(spark, sf_dir))
    return incremental.nodes_of(spark, folder, PERCENTILE)


@query(
    "A5_merged_histogram",
    check_sql(
        "SELECT degree_in + degree_out AS total, count(*) AS n_addresses FROM degrees "
        "WHERE degree_in + degree_out > 0 GROUP BY 1",
        "degrees",
    ),
)
def merged_histogram(spark, sf_dir):
    return incremental.read_histogram(spark, grown_state(spark, sf_dir))


@query("A5_threshold_of_histogram", check_sql("SELECT threshold FROM threshold", "threshold"))
def stored_threshold(spark, sf_dir):
    stored = incremental.read_histogram(spark, grown_state(spark, sf_dir))
    return nodes.threshold_of(stored, PERCENTILE)


@query(
    "J8_status_changes",
    check_sql(
        "SELECT d.address, coalesce(CAST(s.is_contract AS VARCHAR), 'unknown') AS is_contract, "
        f"degree_in, degree_out FROM degrees d LEFT JOIN {_LATEST_SQL} s ON d.address = s.address",
        "degrees",
        "status",
    ),
)
def status_changes(spark, sf_dir):
    # Statuses up to a day come with the edges, newer ones change what they name.
    every = status_rows(spark, sf_dir)
    old = F.col("resolved_at") < F.lit("1995-01-01").cast("timestamp")
    folder = grown_state(spark, sf_dir, status=every.filter(old))
    incremental.apply_status(spark, folder, every.filter(~old), "newer")
    known = F.coalesce(F.col("is_contract").cast("string"), F.lit("unknown"))
    rows = incremental.read_state(spark, folder)
    return rows.select("address", known.alias("is_contract"), "degree_in", "degree_out")


def month_table(spark, sf_dir):
    """Transactions merged into a month table in two portions that share months and rows."""
    path, rows = scratch_path(spark, "months"), transactions(spark, sf_dir)
    when = F.to_date("block_timestamp")
    sinks.merge_months(rows.filter(when < CUTS[0]), path)
    sinks.merge_months(rows.filter(when >= "1994-05-01"), path)
    return path


@query("K2_month_table", check_sql(f"SELECT {_SHOWN} FROM uniq", "uniq"))
def merged_months(spark, sf_dir):
    return shown(sources.read_transactions(spark, month_table(spark, sf_dir)))


WINDOW = datetime(1995, 3, 20, tzinfo=timezone.utc), datetime(1995, 4, 17, tzinfo=timezone.utc)
_WINDOW_SQL = "block_timestamp >= TIMESTAMP '1995-03-20' AND block_timestamp < TIMESTAMP '1995-04-17'"


@query("F5_month_window", check_sql(f"SELECT {_SHOWN} FROM uniq WHERE {_WINDOW_SQL}", "uniq"))
def month_window(spark, sf_dir):
    return shown(sources.read_months(spark, month_table(spark, sf_dir), *WINDOW))


@query(
    "C4_window_edges",
    check_sql(
        "SELECT from_address AS src, to_address AS dst, CAST(CAST(date_trunc('week', block_timestamp) "
        "AS DATE) AS VARCHAR) AS week_start, count(*) AS tx_count, CAST(sum(CAST(value_wei AS "
        f"HUGEINT)) AS VARCHAR) AS total_value_wei FROM uniq WHERE {_WINDOW_SQL} GROUP BY 1, 2, 3",
        "uniq",
    ),
)
def window_edges(spark, sf_dir):
    path = scratch_path(spark, "edges")
    stages.edges_stage(spark, month_table(spark, sf_dir), path, window=WINDOW)
    return dated(sources.read_edges(spark, path))


@query(
    "K6_status_snapshot",
    check_sql(
        "SELECT address, arg_max(is_contract, resolved_at) AS is_contract, "
        "strftime(max(resolved_at), '%Y-%m-%d') AS resolved_at FROM status GROUP BY address",
        "status",
    ),
)
def status_snapshot(spark, sf_dir):
    path, every = scratch_path(spark, "status"), status_rows(spark, sf_dir)
    for portion in range(4):
        sinks.append_status(every.filter(F.year("resolved_at") % 4 == portion), path)
        if portion == 1:
            sinks.merge_status(spark, path)
    sinks.merge_status(spark, path)
    day = F.date_format("resolved_at", "yyyy-MM-dd").alias("resolved_at")
    return contracts.read_status_table(spark, path).select("address", "is_contract", day)


@query(
    "P2_stored_checksums",
    checksum_sql(
        "SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key FROM customer",
        "SELECT key, checksum FROM checksums",
    ),
)
def stored_checksums(spark, sf_dir):
    # The second run meets the first one's addresses and hashes the others only.
    folder = scratch_path(spark, "checksums")
    keys = table(spark, sf_dir, "customer").select(customer_address("c_custkey").alias("key"))
    labeling.stored_checksums(keys.filter(F.hash("key") % 3 != 0), folder)
    return labeling.stored_checksums(keys, folder)
