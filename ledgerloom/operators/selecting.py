"""Choosing rows by time, by block, and by the collection limits."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.times import period_start

# The first block's time, and the defaults of a collection run.
GENESIS = datetime(2015, 7, 30, 15, 26, 13, tzinfo=timezone.utc)
MIN_LABELS = 1
BLOCK_CHUNK = 500_000
TRANSFERS_PER_CHUNK = 100 * 1000


def window_bounds(end: datetime, weeks: int | None = None):
    """(start, end) of the last `weeks` weeks; without `weeks` the window starts at genesis."""
    return (GENESIS if weeks is None else end - timedelta(weeks=weeks)), end


def select_window(df: DataFrame, start, end, column: str = "block_timestamp") -> DataFrame:
    """Rows with start <= time < end.

    Plain comparisons, so the scan can skip row groups; a table partitioned by `block_month`
    also skips whole partitions.
    """
    ts, first, last = F.col(column), F.lit(start), F.lit(end)
    kept = df.filter((ts >= first) & (ts < last))
    if "block_month" in df.columns:
        months = [period_start(bound, "month") for bound in (first, last)]
        kept = kept.filter(F.col("block_month").between(*months))
    return kept


def select_blocks(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows in the inclusive block range."""
    return df.filter(F.col("block_number").between(first, last))


def bound_labels(
    labels: DataFrame, minimum: int = MIN_LABELS, maximum: int | None = None
) -> DataFrame:
    """Fail below `minimum` labels or above `maximum` (no bound by default); never cut."""
    count = labels.count()
    if count < minimum:
        raise ValueError(f"{count} labeled addresses found, at least {minimum} needed")
    if maximum is not None and count > maximum:
        raise ValueError(f"{count} labeled addresses found, at most {maximum} allowed")
    return labels


def oversized_groups(
    rows: DataFrame,
    size: int = TRANSFERS_PER_CHUNK,
    block_chunk: int = BLOCK_CHUNK,
    first_block: int = 0,
) -> DataFrame:
    """(address, direction, chunk, total, above) of the groups with more than `size` rows.

    A provider that pages at most `size` transfers per address, direction and block chunk
    would have cut these groups. Nothing is cut here.
    """
    chunk = F.floor((F.col("block_number") - F.lit(first_block)) / F.lit(block_chunk))
    counted = rows.groupBy("address", "direction", chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("total")
    )
    return counted.filter(F.col("total") > size).withColumn("above", F.col("total") - F.lit(size))
