"""Sorted Parquet writers. Each returns the number of rows written, without a re-scan.

The count is observed above the sort: below it the range sampling of the sort would be
counted too.
"""

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom.functions.times import format_rfc3339, period_start
from ledgerloom.operators.cleaning import (
    TRANSACTION_COLUMNS,
    drop_repeats,
    has_both_ends,
    merge_transactions,
)
from ledgerloom.layers import merge_layers, write_layer
from ledgerloom.operators.labeling import show_checksums
from ledgerloom.operators.nodes import newest_status
from ledgerloom.operators.quality import table_exists
from ledgerloom.session import write_scratch
from ledgerloom.sources.tables import type_transactions


def _write(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode(mode).option("compression", "zstd").parquet(path)
    return seen.get["n_rows"]


def write_labels(labels: DataFrame, path: str) -> int:
    """Label table by address, times as text. `labels` is read twice: by sampling, and to sort."""
    shown = labels.withColumn("retrieved_at", format_rfc3339(F.col("retrieved_at")))
    return _write(shown.orderBy("address"), path)


def order_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.orderBy("block_timestamp", "tx_hash")


def transactions_to_store(transactions: DataFrame, key_cols=("tx_hash",)) -> DataFrame:
    """Rows with both ends, one per key, by (block_timestamp, tx_hash); still typed."""
    usable = transactions.select(*TRANSACTION_COLUMNS).filter(has_both_ends())
    return order_transactions(drop_repeats(usable, key_cols, ("block_timestamp",)))


def write_transactions(
    transactions: DataFrame,
    path: str,
    key_cols=("tx_hash",),
    deduplicate: bool = True,
    checksum: bool = False,
    checksums_path: str | None = None,
) -> int:
    """Transaction table, times as text. `deduplicate=False` is for rows already unique.

    Checksums are made once per distinct address, from rows written before; with
    `checksums_path`, once for all runs that share it.
    """
    rows = transactions.select(*TRANSACTION_COLUMNS).filter(has_both_ends())
    if deduplicate:
        rows = drop_repeats(rows, key_cols, ("block_timestamp",))
    if checksum:
        rows = write_scratch(rows, "unique") if deduplicate else rows
        rows = show_checksums(rows, "from_address", "to_address", folder=checksums_path)
    rows = order_transactions(rows)
    return _write(
        rows.withColumn("block_timestamp", format_rfc3339(F.col("block_timestamp"))), path
    )


def months_of(rows: DataFrame) -> DataFrame:
    """Typed transactions with the month they are stored under."""
    return rows.withColumn("block_month", period_start(F.col("block_timestamp"), "month"))


def write_months(
    transactions: DataFrame, path: str, key_cols=("tx_hash",), deduplicate: bool = True
) -> int:
    """Transaction table in a folder per month, by time within; returns the number of rows.

    Months that the rows are in are replaced as a whole, others stay. Stopped half-way, the
    same call replaces the same months again. `transactions` must not be a scan of `path`.
    """
    rows = transactions.select(*TRANSACTION_COLUMNS).filter(has_both_ends())
    if deduplicate:
        rows = drop_repeats(rows, key_cols, ("block_timestamp",))
    seen = Observation()
    ordered = order_transactions(months_of(rows)).observe(seen, F.count(F.lit(1)).alias("n_rows"))
    shown = ordered.withColumn("block_timestamp", format_rfc3339(F.col("block_timestamp")))
    writer = shown.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy("block_month").parquet(path)
    return seen.get["n_rows"]


def merge_months(transactions: DataFrame, path: str, key_cols=("tx_hash",)) -> int:
    """Merge transactions into a month table; only the months they are in are read and replaced.

    Stored rows win over new ones of the same key. A key has one time: its versions in
    different months are not compared. Returns the number of rows of the replaced months.
    """
    spark = transactions.sparkSession
    new = transactions.select(*TRANSACTION_COLUMNS).filter(has_both_ends())
    new = write_scratch(months_of(new).filter("block_month is not null"), "new-months")
    months = [r[0] for r in new.select("block_month").distinct().collect()]
    if not months:
        return 0
    frames = [new]
    if table_exists(spark, path):
        stored = type_transactions(spark.read.parquet(path).filter(F.col("block_month").isin(months)))
        frames.insert(0, stored)
    merged = write_scratch(merge_transactions(frames, key_cols), "merged-months")
    return write_months(merged, path, deduplicate=False)


def write_edges(edges: DataFrame, path: str, ordered: bool = False) -> int:
    """Edge table by (src, dst, week_start), dates as text.

    `ordered` edges have that order already, see `aggregate_edges`.
    """
    rows = edges if ordered else edges.orderBy("src", "dst", "week_start")
    return _write(rows.withColumn("week_start", F.col("week_start").cast("string")), path)


def write_nodes(nodes: DataFrame, path: str) -> int:
    return _write(nodes.orderBy("address"), path)


def append_status(status: DataFrame, path: str) -> int:
    """Add resolved contract statuses to the status table, as a layer of its own."""
    seen = Observation()
    rows = status.select("address", "is_contract", "resolved_at")
    write_layer(rows.observe(seen, F.count(F.lit(1)).alias("n_rows")), path)
    return seen.get["n_rows"]


def merge_status(spark, path: str):
    """Fold the status table into a snapshot: the newest row of every lowercase address."""
    return merge_layers(spark, path, newest_status, least=1)
