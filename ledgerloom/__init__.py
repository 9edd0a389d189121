"""Transaction graphs on Spark: labels, slices, edges and nodes as composable operators."""

from ledgerloom.operators.cleaning import classify_transfers, merge_transactions
from ledgerloom.operators.edges import aggregate_edges, wide_sum
from ledgerloom.operators.keysets import KeySet, key_set, touching
from ledgerloom.operators.labeling import build_label_table, extract_addresses
from ledgerloom.operators.nodes import build_nodes, degrees, hub_threshold, resolve_contracts
from ledgerloom.operators.quality import scale_report, table_status
from ledgerloom.operators.ranking import counterparty_stats, top_counterparties
from ledgerloom.plans.stages import build_graph
from ledgerloom.session import build_session

__all__ = [
    "KeySet",
    "aggregate_edges",
    "build_graph",
    "build_label_table",
    "build_nodes",
    "build_session",
    "classify_transfers",
    "counterparty_stats",
    "degrees",
    "extract_addresses",
    "hub_threshold",
    "key_set",
    "merge_transactions",
    "resolve_contracts",
    "scale_report",
    "table_status",
    "top_counterparties",
    "touching",
    "wide_sum",
]
