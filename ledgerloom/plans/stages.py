"""Label, slice, edge and node stages, and the run that chains them.

A stage writes its result to a new path and returns the row count. Between stages only
written tables are passed on, so a lost executor never recomputes an earlier stage.
"""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.layers import child_names, unique_name
from ledgerloom.operators import cleaning, quality, ranking, selecting
from ledgerloom.operators.edges import aggregate_edges
from ledgerloom.operators.keysets import KeySet, key_set, touching
from ledgerloom.operators.labeling import LABEL_SOURCE, build_label_table
from ledgerloom.operators.nodes import (
    HUB_PERCENTILE,
    classify_degrees,
    degrees,
    hub_threshold,
    resolve_contracts,
    unresolved_addresses,
)
from ledgerloom.session import use_utc, write_scratch
from ledgerloom.sinks import tables as sinks
from ledgerloom.sinks.metadata import run_metadata, write_metadata
from ledgerloom.sources import tables as sources
from ledgerloom.sources.contracts import (
    known_exchanges,
    read_contract_list,
    read_status_cache,
    read_status_table,
)
from ledgerloom.sources.sanctions import (
    read_sanction_rejects,
    read_sanctions,
    sanction_counts,
)


@dataclass(frozen=True)
class Slice:
    """Transfers around the labels, and the counterparties chosen from them."""

    transfers: DataFrame
    counterparties: KeySet
    verdict: DataFrame


def extract_labels(
    spark: SparkSession,
    documents: list[tuple[str, str]],
    path: str,
    strict: bool = False,
    source_name: str = LABEL_SOURCE,
    rejects_path: str | None = None,
    counts_path: str | None = None,
) -> int:
    """Sanctions documents to the label table.

    `rejects_path` gets the elements that could not be read, with their text, and sources that
    are missing or hold no element; `counts_path` the elements of each source per outcome.
    """
    use_utc(spark)
    if rejects_path is not None:
        rejects = read_sanction_rejects(spark, documents)
        rejects.write.option("compression", "zstd").parquet(rejects_path)
    if counts_path is not None:
        sanction_counts(spark, documents).write.json(counts_path)
    labels = build_label_table(read_sanctions(spark, documents, strict), source_name=source_name)
    labels = write_scratch(labels, "labels")
    count = sinks.write_labels(labels, path)
    if count == 0:
        raise ValueError("no address found in any sanctions source")
    return count


def collect_slice(
    transfers: DataFrame,
    labels: DataFrame,
    k: int = ranking.TOP_K,
    by: str = "total_value",
    exclude: KeySet | None = None,
    limits=quality.ScaleLimits(),
    strict: bool = False,
    max_labels: int | None = None,
) -> Slice:
    """Transfers touching the labels and the top counterparties among them.

    `transfers` are accepted, typed transfers of the wanted window. The touching rows, a
    small part of all transfers, are written once and serve both ranking and merge.
    """
    labeled = key_set(selecting.bound_labels(labels, maximum=max_labels))
    touched = write_scratch(touching(transfers, labeled), "touched")
    stats = ranking.stats_of_touched(touched)
    ranked = ranking.top_counterparties(stats, k, by)
    chosen = key_set(ranking.selected_counterparties(ranked, exclude))
    verdict = quality.counterparty_verdict(chosen.table, limits, strict)
    return Slice(touched, chosen, quality.enforce(verdict) if strict else verdict)


def merged_slice(transfers: DataFrame, part: Slice) -> DataFrame:
    """Labeled slice plus every transfer of the counterparties, one row per hash.

    `copies` counts the rows of each hash. Rows without both ends go before deduplication, so that none of them stands for a hash.
    """
    frames = [part.transfers]
    if part.counterparties.rows:
        frames.append(touching(transfers, part.counterparties))
    usable = [f.filter(cleaning.has_both_ends()) for f in frames]
    return cleaning.merge_transactions(usable, copies="copies")


def expand_and_merge(
    transfers: DataFrame,
    labels: DataFrame,
    path: str,
    k: int = ranking.TOP_K,
    by: str = "total_value",
    exclude: KeySet | None = None,
    limits=quality.ScaleLimits(),
    strict: bool = False,
    checksum: bool = True,
    max_labels: int | None = None,
    counts_path: str | None = None,
    checksums_path: str | None = None,
) -> int:
    """Typed transfers and labels to the transaction table.

    `counts_path` gets one row about deduplication: rows_seen, rows_kept, rows_removed.
    """
    part = collect_slice(transfers, labels, k, by, exclude, limits, strict, max_labels)
    merged = write_scratch(merged_slice(transfers, part), "merged")
    if counts_path is not None:
        seen, kept = F.coalesce(F.sum("copies"), F.lit(0)), F.count(F.lit(1))
        counts = merged.agg(
            seen.alias("rows_seen"), kept.alias("rows_kept"), (seen - kept).alias("rows_removed")
        )
        counts.write.json(counts_path)
    return sinks.write_transactions(
        merged, path, deduplicate=False, checksum=checksum, checksums_path=checksums_path
    )


def split_times(transactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows whose time is missing or malformed)."""
    missing = F.col("block_timestamp").isNull()
    return transactions.filter(~missing), transactions.filter(missing)


def edges_stage(
    spark: SparkSession,
    transactions_path: str,
    path: str,
    granularity: str = "week",
    rejects_path: str | None = None,
    window: tuple[datetime, datetime] | None = None,
) -> int:
    """Transaction table to edge table; rows without usable time go to `rejects_path`.

    Without that path such rows are an error. Tables written by this package have none,
    tables from elsewhere may. With a `window` (start, end) the table is one by month, of which
    only the window's months are read.
    """
    use_utc(spark)
    if window is not None:
        rows = sources.read_months(spark, transactions_path, *window)
        return sinks.write_edges(aggregate_edges(rows, granularity, ordered=True), path, ordered=True)
    usable, unusable = split_times(sources.read_transactions(spark, transactions_path))
    if rejects_path is not None:
        unusable.write.option("compression", "zstd").parquet(rejects_path)
    elif not unusable.isEmpty():
        raise ValueError(f"{transactions_path} has rows without usable time; give a rejects_path")
    return sinks.write_edges(aggregate_edges(usable, granularity, ordered=True), path, ordered=True)


def nodes_stage(
    spark: SparkSession,
    edges_path: str,
    labels_path: str | None,
    path: str,
    contracts_dir: str | None = None,
    status_path: str | None = None,
    percentile: float = HUB_PERCENTILE,
    mode: str = "edge_rows",
    cache_path: str | None = None,
    unresolved_path: str | None = None,
) -> int:
    """Edge and label tables to node table; contracts from a list, a status table or neither.

    `cache_path` is a file of resolved contracts that is appended to the status table first.
    Addresses that no list or table resolves go to `unresolved_path`, for the next
    resolution run. Resolved degrees are written once: open addresses, threshold and
    classification all need them.
    """
    use_utc(spark)
    edges = sources.read_edges(spark, edges_path)
    labels = None
    if labels_path is not None and quality.table_exists(spark, labels_path):
        labels = sources.read_labels(spark, labels_path)
    known = read_contract_list(spark, contracts_dir) if contracts_dir else None
    if cache_path and status_path:
        cached = read_status_cache(spark, cache_path)
        sinks.append_status(cached.withColumn("resolved_at", F.current_timestamp()), status_path)
    status = read_status_table(spark, status_path) if status_path else None
    resolved = resolve_contracts(degrees(edges, labels, mode), known, status)
    resolved = write_scratch(resolved, "resolved")
    if unresolved_path is not None:
        open_addresses = unresolved_addresses(resolved)
        open_addresses.write.option("compression", "zstd").parquet(unresolved_path)
    threshold = hub_threshold(resolved, percentile).scalar()
    return sinks.write_nodes(classify_degrees(resolved, threshold), path)


TABLES = ("labels", "transactions", "edges", "nodes")


def run_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders of the runs below `folder`, by the time they were begun."""
    return [f"{folder}/{name}" for name in child_names(spark, folder) if name.startswith("run-")]


def latest_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """The newest written table of each name; a run that skipped a stage has none of it."""
    found = {}
    for run in run_folders(spark, folder):
        for name in TABLES:
            if quality.table_exists(spark, f"{run}/{name}/_SUCCESS"):
                found[name] = f"{run}/{name}"
    return found


def build_graph(
    spark: SparkSession,
    documents: list[tuple[str, str]],
    transfers: DataFrame,
    folder: str,
    end: datetime,
    weeks: int | None = None,
    k: int = ranking.TOP_K,
    by: str = "total_value",
    exclude: DataFrame | None = None,
    contracts_dir: str | None = None,
    status_path: str | None = None,
    cache_path: str | None = None,
    skip_transactions: bool = False,
    skip_nodes: bool = False,
    limits=quality.ScaleLimits(),
    strict: bool = False,
    git_commit: str | None = None,
    strict_sanctions: bool = False,
    max_labels: int | None = None,
    checksum: bool = True,
    granularity: str = "week",
    percentile: float = HUB_PERCENTILE,
    degree_mode: str = "edge_rows",
) -> DataFrame:
    """All stages in a new run folder below `folder`; returns the status of its tables.

    `transfers` are classified transfers (see `cleaning` and `streaming`), ideally a written
    table partitioned by month: accepted rows go on, and the run writes how many rows were
    rejected for which reason. Frames without `reject_reason` count as accepted.

    Nothing that exists is replaced: every run has a folder of its own that no other run takes,
    runs share a table of address checksums, to which they add, and a skipped stage
    is read from the newest run that has it (transactions under `skip_transactions`; no
    nodes are built under `skip_nodes`).
    """
    use_utc(spark)
    before = latest_tables(spark, folder)
    run = f"{folder}/{unique_name('run')}"
    paths = {name: f"{run}/{name}" for name in TABLES}
    notes = {name: f"{run}/metadata/{name}" for name in TABLES}
    start, end = selecting.window_bounds(end, weeks)

    def note(table: str, counted: str, rows: int) -> None:
        bounds = F.lit(start), F.lit(end)
        write_metadata(run_metadata(spark, *bounds, {counted: rows}, git_commit), notes[table])

    found = extract_labels(
        spark,
        documents,
        paths["labels"],
        strict_sanctions,
        rejects_path=f"{run}/rejects/sanctions",
        counts_path=f"{run}/counts/sanctions",
    )
    note("labels", "labeled_addresses", found)
    if skip_transactions and "transactions" in before:
        paths["transactions"] = before["transactions"]
    else:
        if "reject_reason" in transfers.columns:
            cleaning.rejection_counts(transfers).write.json(f"{run}/counts/outcomes")
            transfers = cleaning.accepted(transfers)
        exchanges = key_set(known_exchanges(spark) if exclude is None else exclude)
        rows = expand_and_merge(
            selecting.select_window(transfers, start, end),
            sources.read_labels(spark, paths["labels"]),
            paths["transactions"],
            k,
            by,
            exchanges,
            limits,
            strict,
            checksum,
            max_labels,
            f"{run}/counts/repeats",
            f"{folder}/checksums",
        )
        note("transactions", "raw_transactions", rows)
    rows = edges_stage(
        spark, paths["transactions"], paths["edges"], granularity, f"{run}/rejects/edges"
    )
    note("edges", "weekly_edges", rows)
    if not skip_nodes:
        rows = nodes_stage(
            spark,
            paths["edges"],
            paths["labels"],
            paths["nodes"],
            contracts_dir,
            status_path,
            percentile,
            degree_mode,
            cache_path,
            f"{run}/unresolved",
        )
        note("nodes", "nodes", rows)
    nodes = None if skip_nodes else sources.read_nodes(spark, paths["nodes"])
    report = quality.scale_report(nodes, sources.read_edges(spark, paths["edges"]), limits, strict)
    if strict:
        quality.enforce(report)
    return quality.table_status(spark, paths, notes)
