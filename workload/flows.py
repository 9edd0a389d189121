"""Queries on transfers: filters, membership joins, ranking, merging."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ledgerloom.functions.times import format_rfc3339
from ledgerloom.operators import cleaning, labeling, quality, ranking, selecting
from ledgerloom.operators.keysets import incoming, key_set, outgoing, touching, without_members
from ledgerloom.plans.stages import Slice, collect_slice, merged_slice
from ledgerloom.sinks.tables import order_transactions
from ledgerloom.sources.contracts import known_exchanges
from workload.columns import messy_addresses
from workload.registry import query
from workload.standins import (
    address_of,
    block_transactions,
    check_sql,
    contract_addresses,
    exchange_addresses,
    labeled_addresses,
    lines,
    raw_transfers,
    table,
    transactions,
)

_SHOWN = (
    "tx_hash, strftime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp, "
    "from_address, to_address, value_wei"
)


def shown(df, *more):
    """Transaction columns with the time as text, as the check SQL shows them."""
    return df.select(
        "tx_hash",
        format_rfc3339(F.col("block_timestamp")).alias("stamp"),
        "from_address",
        "to_address",
        "value_wei",
        *more,
    )


def labels_of(spark, sf_dir):
    return key_set(labeled_addresses(spark, sf_dir))


@query(
    "F1_native_nonzero",
    check_sql(
        "SELECT hash, category, value FROM raw WHERE category IN ('external', 'internal') "
        "AND (value_wei_text IS NOT NULL OR value IS NULL OR value <> 0)",
        "raw",
    ),
)
def native(spark, sf_dir):
    kept = raw_transfers(spark, sf_dir).filter(cleaning.is_native_transfer())
    return kept.select("hash", "category", "value")


@query(
    "F2_both_ends",
    check_sql(
        "SELECT hash, \"from\", \"to\" FROM raw WHERE coalesce(\"from\", '') <> '' "
        "AND coalesce(\"to\", '') <> ''",
        "raw",
    ),
)
def both_ends(spark, sf_dir):
    kept = raw_transfers(spark, sf_dir).filter(cleaning.has_both_ends("from", "to"))
    return kept.select("hash", "from", "to")


@query(
    "F3_direction",
    check_sql(
        f"SELECT 'from' AS direction, {_SHOWN} FROM tx JOIN labeled ON from_address = address "
        f"UNION ALL SELECT 'to', {_SHOWN} FROM tx JOIN labeled ON to_address = address",
        "tx",
        "labeled",
    ),
)
def directions(spark, sf_dir):
    # Each row once per direction it matches, from one scan.
    hits = touching(transactions(spark, sf_dir), labels_of(spark, sf_dir))
    found = F.array_compact(
        F.array(F.when(F.col("from_hit"), F.lit("from")), F.when(F.col("to_hit"), F.lit("to")))
    )
    return shown(hits.withColumn("direction", F.explode(found)), "direction")


@query(
    "F4_block_range",
    check_sql(
        "SELECT tx_hash, block_number FROM tx WHERE block_number BETWEEN 3000000 AND 9000000",
        "tx",
    ),
)
def block_range(spark, sf_dir):
    kept = selecting.select_blocks(block_transactions(spark, sf_dir), 3_000_000, 9_000_000)
    return kept.select("tx_hash", "block_number")


@query(
    "F5_time_window",
    check_sql(
        f"SELECT {_SHOWN} FROM tx WHERE block_timestamp >= TIMESTAMP '1997-01-03 06:00:00' "
        "AND block_timestamp < TIMESTAMP '1999-01-01 06:00:00'",
        "tx",
    ),
)
def time_window(spark, sf_dir):
    end = datetime(1999, 1, 1, 6, tzinfo=timezone.utc)
    start, end = selecting.window_bounds(end, weeks=104)
    return shown(selecting.select_window(transactions(spark, sf_dir), start, end))


@query(
    "F6_drop_zero_address",
    check_sql(
        "SELECT DISTINCT address AS key FROM (SELECT '0x' || lpad(lower(to_hex(o_custkey % 50)), "
        "40, '0') AS address FROM orders) WHERE address <> '0x' || repeat('0', 40)"
    ),
)
def drop_zero(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(address_of(F.col("o_custkey") % 50).alias("key"))
    return labeling.drop_zero_address(keys).distinct()


@query(
    "F7_label_bounds",
    check_sql("SELECT address FROM labeled", "labeled"),
)
def label_bounds(spark, sf_dir):
    return selecting.bound_labels(labeled_addresses(spark, sf_dir).select("address"), minimum=1)


@query(
    "F7_label_bound_errors",
    check_sql(
        "SELECT 'at least' AS bound, count(*) || ' labeled addresses found, at least ' || (count(*) + 1) "
        "|| ' needed' AS error FROM labeled UNION ALL SELECT 'at most', count(*) || ' labeled addresses "
        "found, at most ' || (count(*) - 1) || ' allowed' FROM labeled UNION ALL "
        "SELECT 'both', NULL",
        "labeled",
    ),
)
def label_bound_errors(spark, sf_dir):
    labels = labeled_addresses(spark, sf_dir).select("address")
    n, rows = labels.count(), []
    for bound, low, high in (("at least", n + 1, None), ("at most", 1, n - 1), ("both", n, n)):
        try:
            selecting.bound_labels(labels, low, high)
            rows.append((bound, None))
        except ValueError as error:
            rows.append((bound, str(error)))
    return spark.createDataFrame(rows, "bound string, error string")


_DIRECTED_SQL = """
SELECT tx_hash, block_number, from_address AS address, 'from' AS direction FROM tx
UNION ALL SELECT tx_hash, block_number, to_address, 'to' FROM tx"""

def directed(spark, sf_dir):
    tx = block_transactions(spark, sf_dir)
    ends = F.array(
        F.struct(F.col("from_address").alias("address"), F.lit("from").alias("direction")),
        F.struct(F.col("to_address").alias("address"), F.lit("to").alias("direction")),
    )
    return tx.select("tx_hash", "block_number", F.inline(ends))


@query(
    "F8_oversized_groups",
    check_sql(
        "SELECT address, direction, CAST(floor(block_number / 500000) AS BIGINT) AS chunk, "
        f"count(*) AS total, count(*) - 20 AS above FROM ({_DIRECTED_SQL}) GROUP BY 1, 2, 3 "
        "HAVING count(*) > 20",
        "tx",
    ),
)
def oversized(spark, sf_dir):
    return selecting.oversized_groups(directed(spark, sf_dir), size=20)


@query(
    "J1_outgoing",
    check_sql(f"SELECT {_SHOWN} FROM tx JOIN labeled ON from_address = address", "tx", "labeled"),
)
def join_outgoing(spark, sf_dir):
    return shown(outgoing(transactions(spark, sf_dir), labels_of(spark, sf_dir)))


@query(
    "J2_incoming",
    check_sql(f"SELECT {_SHOWN} FROM tx JOIN labeled ON to_address = address", "tx", "labeled"),
)
def join_incoming(spark, sf_dir):
    return shown(incoming(transactions(spark, sf_dir), labels_of(spark, sf_dir)))


@query(
    "J1_J2_touching",
    check_sql(f"SELECT {_SHOWN}, from_hit, to_hit FROM touched", "touched"),
)
def join_touching(spark, sf_dir):
    hits = touching(transactions(spark, sf_dir), labels_of(spark, sf_dir))
    return shown(hits, "from_hit", "to_hit")


@query(
    "J1_J2_touching_by_shuffle",
    check_sql(f"SELECT {_SHOWN}, from_hit, to_hit FROM touched", "touched"),
)
def join_touching_shuffled(spark, sf_dir):
    # The way taken when the key set is too large to broadcast.
    hits = touching(transactions(spark, sf_dir), labels_of(spark, sf_dir), limit=0)
    return shown(hits, "from_hit", "to_hit")


@query(
    "J3_unlabeled_counterparty",
    check_sql(
        "SELECT tx_hash, CASE WHEN from_hit THEN from_address ELSE to_address END AS labeled, "
        "CASE WHEN from_hit THEN to_address ELSE from_address END AS counterparty FROM touched "
        "WHERE from_hit <> to_hit",
        "touched",
    ),
)
def unlabeled(spark, sf_dir):
    hits = touching(transactions(spark, sf_dir), labels_of(spark, sf_dir))
    return ranking.counterparty_pairs(hits).select("tx_hash", "labeled", "counterparty")


def stats_of(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return ranking.counterparty_stats(tx, labels_of(spark, sf_dir), amount="value_wei")


@query(
    "A3_counterparty_stats",
    check_sql(
        "SELECT labeled, counterparty, CAST(total AS VARCHAR) AS total_value, tx_count, "
        "strftime(most_recent, '%Y-%m-%dT%H:%M:%S+00:00') AS most_recent FROM stats",
        "stats",
    ),
)
def stats(spark, sf_dir):
    return stats_of(spark, sf_dir).withColumn(
        "most_recent", format_rfc3339(F.col("most_recent"))
    )


def _top_sql(order, k):
    return check_sql(
        "SELECT labeled, counterparty, n AS rank FROM (SELECT *, row_number() OVER (PARTITION "
        f"BY labeled ORDER BY {order}, counterparty) AS n FROM stats) WHERE n <= {k}",
        "stats",
    )


def _top(spark, sf_dir, k, by):
    top = ranking.top_counterparties(stats_of(spark, sf_dir), k, by)
    return top.select("labeled", "counterparty", F.col("rank").cast("bigint").alias("rank"))


@query(
    "W1_selected_counterparties",
    check_sql(
        "SELECT DISTINCT counterparty AS address FROM (SELECT *, row_number() OVER (PARTITION "
        "BY labeled ORDER BY total DESC, counterparty) AS n FROM stats) WHERE n <= 3",
        "stats",
    ),
)
def top_selected(spark, sf_dir):
    return ranking.selected_counterparties(ranking.top_counterparties(stats_of(spark, sf_dir), 3))


@query("W2_rank_by_total_value", _top_sql("total DESC", 5))
def top_by_value(spark, sf_dir):
    return _top(spark, sf_dir, 5, "total_value")


@query("W3_rank_by_transaction_count", _top_sql("tx_count DESC", 4))
def top_by_count(spark, sf_dir):
    return _top(spark, sf_dir, 4, "transaction_count")


@query("W4_rank_by_most_recent", _top_sql("most_recent DESC NULLS LAST", 4))
def top_by_time(spark, sf_dir):
    return _top(spark, sf_dir, 4, "most_recent")


@query("W1_sliced_top_k", _top_sql("total DESC", 1200))
def top_sliced(spark, sf_dir):
    # Beyond the native group limit the ranking is cut inside hash slices first.
    return _top(spark, sf_dir, 1200, "total_value")


@query("J4_without_exchanges", check_sql("SELECT address FROM chosen", "chosen"))
def no_exchanges(spark, sf_dir):
    top = ranking.top_counterparties(stats_of(spark, sf_dir), 5)
    return ranking.selected_counterparties(top, key_set(exchange_addresses(spark, sf_dir)))


def slice_of(spark, sf_dir) -> Slice:
    return collect_slice(
        transactions(spark, sf_dir).withColumn("rank_wei", F.col("value_wei")),
        labeled_addresses(spark, sf_dir),
        k=5,
        exclude=key_set(exchange_addresses(spark, sf_dir)),
    )


@query(
    "J5_one_hop_expansion",
    check_sql(
        f"SELECT {_SHOWN} FROM tx WHERE from_address IN (SELECT address FROM chosen) "
        "OR to_address IN (SELECT address FROM chosen)",
        "chosen",
    ),
)
def one_hop(spark, sf_dir):
    chosen = slice_of(spark, sf_dir).counterparties
    return shown(touching(transactions(spark, sf_dir), chosen))


@query("C2_collect_slice", check_sql(f"SELECT {_SHOWN} FROM touched", "touched"))
def collected(spark, sf_dir):
    return shown(slice_of(spark, sf_dir).transfers)


@query("U4_merge", check_sql(f"SELECT {_SHOWN} FROM merged", "merged"))
def merged(spark, sf_dir):
    return shown(merged_slice(transactions(spark, sf_dir), slice_of(spark, sf_dir)))


@query("U3_first_per_hash", check_sql(f"SELECT {_SHOWN} FROM uniq", "uniq"))
def first_per_hash(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return shown(cleaning.drop_repeats(tx, ("tx_hash",), ("block_timestamp",)))


@query(
    "U3_first_per_wider_key",
    check_sql(
        f"SELECT {_SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY tx_hash, from_address, "
        "to_address ORDER BY block_timestamp, value_wei) AS n FROM tx) WHERE n = 1",
        "tx",
    ),
)
def first_per_wider_key(spark, sf_dir):
    key = ("tx_hash", "from_address", "to_address")
    return shown(cleaning.drop_repeats(transactions(spark, sf_dir), key, ("block_timestamp",)))


@query(
    "U1_union_distinct",
    check_sql(
        "SELECT address FROM labeled UNION SELECT address FROM exchanges "
        "UNION SELECT address FROM contracts",
        "labeled",
        "exchanges",
        "contracts",
    ),
)
def union_distinct(spark, sf_dir):
    found = labeled_addresses(spark, sf_dir).select("address")
    for other in (exchange_addresses, contract_addresses):
        found = found.unionByName(other(spark, sf_dir))
    return found.distinct()


@query(
    "U2_validate_and_dedupe",
    check_sql(
        "SELECT DISTINCT key FROM (SELECT CASE WHEN regexp_full_match(trim(messy), "
        "'(0[xX])?[0-9a-fA-F]{40}') THEN '0x' || lower(right(trim(messy), 40)) END AS key FROM "
        "(SELECT CASE WHEN l_partkey % 7 = 0 THEN '  ' || upper(sender) || ' ' WHEN l_partkey % 7 "
        "= 1 THEN substr(sender, 3) WHEN l_partkey % 7 = 2 THEN substr(sender, 1, 41) WHEN "
        "l_partkey % 7 = 3 THEN replace(sender, '0x00', '0xzz') WHEN l_partkey % 7 = 4 THEN NULL "
        "WHEN l_partkey % 7 = 5 THEN '0x' || repeat('0', 40) ELSE sender END AS messy FROM "
        "lines)) WHERE key IS NOT NULL AND key <> '0x' || repeat('0', 40)",
        "lines",
    ),
)
def validated(spark, sf_dir):
    return labeling.validate_and_dedupe(messy_addresses(spark, sf_dir), "messy")


@query(
    "A7_rejection_counts",
    check_sql(
        "SELECT coalesce(reject_reason, 'accepted') AS reason, count(*) AS n_rows "
        "FROM classified GROUP BY 1",
        "classified",
    ),
)
def rejections(spark, sf_dir):
    filled = cleaning.fill_recipient(raw_transfers(spark, sf_dir))
    return cleaning.rejection_counts(cleaning.classify_transfers(filled))


@query(
    "A7_repeat_counts",
    check_sql(
        "SELECT count(*) AS rows_seen, count(DISTINCT tx_hash) AS rows_kept, "
        "count(*) - count(DISTINCT tx_hash) AS rows_removed FROM lines",
        "lines",
    ),
)
def repeats(spark, sf_dir):
    return cleaning.repeat_counts(lines(spark, sf_dir).select("tx_hash"))


@query(
    "V4_counterparty_verdict",
    check_sql(
        "SELECT 'counterparties' AS subject, count(*) AS n_rows, CASE WHEN count(*) > 50 THEN "
        "'warning' ELSE 'ok' END AS verdict FROM chosen",
        "chosen",
    ),
)
def counterparty_limit(spark, sf_dir):
    chosen = slice_of(spark, sf_dir).counterparties
    return quality.counterparty_verdict(chosen.table, quality.ScaleLimits(max_nodes=50))


@query("O2_transactions_in_order", check_sql(f"SELECT {_SHOWN} FROM uniq ORDER BY 2, 1", "uniq"))
def ordered(spark, sf_dir):
    tx = cleaning.drop_repeats(transactions(spark, sf_dir), ("tx_hash",), ("block_timestamp",))
    return shown(order_transactions(tx))


@query("O5_limits", _top_sql("total DESC", 1))
def first_ranked(spark, sf_dir):
    return _top(spark, sf_dir, 1, "total_value")


@query(
    "S13_exchange_list",
    check_sql(
        "SELECT to_address AS address, count(*) AS n_transfers FROM tx WHERE to_address IN "
        "(SELECT address FROM exchanges) GROUP BY 1",
        "tx",
        "exchanges",
    ),
)
def exchange_traffic(spark, sf_dir):
    listed = known_exchanges(spark).unionByName(exchange_addresses(spark, sf_dir))
    hits = incoming(transactions(spark, sf_dir), key_set(listed))
    return hits.groupBy(F.col("to_address").alias("address")).agg(
        F.count(F.lit(1)).alias("n_transfers")
    )


@query(
    "J4_anti_join",
    check_sql(
        f"SELECT {_SHOWN} FROM tx WHERE to_address NOT IN (SELECT address FROM exchanges)",
        "tx",
        "exchanges",
    ),
)
def not_to_exchanges(spark, sf_dir):
    exchanges = key_set(exchange_addresses(spark, sf_dir))
    return shown(without_members(transactions(spark, sf_dir), "to_address", exchanges))
