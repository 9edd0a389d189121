"""Directed edges per period with exact totals."""

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.times import period_start
from ledgerloom.functions.wide_int import fold_limbs, limb_sums, padded_u128


def wide_sum(
    df: DataFrame, group_cols: list, value_col: str, name: str = "total_value"
) -> DataFrame:
    """Exact capped u128 sum of decimal text per group."""
    padded = df.select(*group_cols, padded_u128(F.col(value_col)).alias("_padded"))
    sums = padded.groupBy(*group_cols).agg(*limb_sums(F.col("_padded"), "_w"))
    return fold_limbs(sums, "_w", name)


def edge_keys(transactions: DataFrame) -> DataFrame:
    """(src, dst, block_timestamp, _padded) of transactions, ready for exact sums."""
    return transactions.select(
        F.coalesce("from_address", F.lit("")).alias("src"),
        F.coalesce("to_address", F.lit("")).alias("dst"),
        "block_timestamp",
        padded_u128(F.col("value_wei")).alias("_padded"),
    )


def edge_parts(transactions: DataFrame, granularity: str = "week") -> DataFrame:
    """Counts and limb sums per (src, dst, period) of some of the transactions."""
    period = period_start(F.col("block_timestamp"), granularity).alias("week_start")
    keyed = edge_keys(transactions).select("src", "dst", period, "_padded")
    return keyed.groupBy("src", "dst", "week_start").agg(
        F.count(F.lit(1)).alias("tx_count"), *limb_sums(F.col("_padded"), "limb_")
    )


def add_parts(parts: DataFrame) -> DataFrame:
    """One row per edge of parts from any number of layers; sums of parts are exact."""
    limbs = [c for c in parts.columns if c.startswith("limb_")]
    return parts.groupBy("src", "dst", "week_start").agg(
        F.sum("tx_count").alias("tx_count"), *(F.sum(c).alias(c) for c in limbs)
    )


def fold_parts(parts: DataFrame) -> DataFrame:
    """Edges of the parts of all transactions."""
    return fold_limbs(add_parts(parts), "limb_", "total_value_wei").select(
        "src", "dst", "week_start", "tx_count", "total_value_wei"
    )


def aggregate_edges(
    transactions: DataFrame,
    granularity: str = "week",
    total: bool = True,
    sample: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """One row per (src, dst, period): count and, if asked, exact total and sample value.

    The period column is `week_start` for every granularity, as in the edge table. A missing
    address becomes "". The sample is the value of the earliest transaction, so it does not
    depend on partitioning; with it the count is of non-null hashes.

    `ordered` edges come by (src, dst, week_start). They are sorted before totals become text,
    since a sort makes its input twice, first to sample it.
    """
    keyed = transactions.select(
        F.coalesce("from_address", F.lit("")).alias("src"),
        F.coalesce("to_address", F.lit("")).alias("dst"),
        period_start(F.col("block_timestamp"), granularity).alias("week_start"),
        "value_wei",
        padded_u128(F.col("value_wei")).alias("_padded"),
        "tx_hash",
        "block_timestamp",
    )
    counted = F.count("tx_hash") if sample else F.count(F.lit(1))
    aggregates = [counted.alias("tx_count")]
    shown = ["src", "dst", "week_start", "tx_count"]
    if total:
        aggregates += limb_sums(F.col("_padded"), "_w")
        shown.append("total_value_wei")
    if sample:
        earliest = F.struct("block_timestamp", "tx_hash", "value_wei")
        aggregates.append(F.min(earliest).alias("_first"))
        shown.append(F.col("_first.value_wei").alias("sample_value"))
    edges = keyed.groupBy("src", "dst", "week_start").agg(*aggregates)
    if ordered:
        edges = edges.orderBy("src", "dst", "week_start")
    return (fold_limbs(edges, "_w", "total_value_wei") if total else edges).select(*shown)
