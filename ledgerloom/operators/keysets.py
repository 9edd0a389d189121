"""Address sets and membership tests against them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.bitmaps import bitmap_of, with_hit
from ledgerloom.session import write_scratch

# A broadcast set holds at most this many 42-character keys, about 200 MB once hashed.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class KeySet:
    """Distinct lowercase addresses (column `key`) with their counted number."""

    table: DataFrame
    rows: int

    def fits_broadcast(self, limit: int = BROADCAST_KEYS) -> bool:
        return self.rows <= limit


def key_set(df: DataFrame, column: str = "address") -> KeySet:
    """Collapse `column` to a key set.

    The set is written once to the shared folder: it is used by several joins, and its
    size must be known before any of them may broadcast it.
    """
    keys = df.select(F.lower(F.col(column)).alias("key"))
    table = write_scratch(keys.filter("key is not null and key != ''").distinct(), "keys")
    return KeySet(table, table.count())


def _placed(side: DataFrame, keys: KeySet, limit: int) -> DataFrame:
    """Broadcast a set within the limit; beyond it the join strategy is left to Spark."""
    return F.broadcast(side) if keys.fits_broadcast(limit) else side


def flag_members(
    rows: DataFrame, column: str, keys: KeySet, flag: str, limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Add boolean `flag`: is the lowercase `column` in the set?

    A set within the limit is broadcast, so `rows` is not shuffled. A larger one is joined
    by shuffle; its keys are unique, so a hot address is skewed only on the `rows` side,
    which adaptive execution splits by map range.
    """
    side = keys.table.select(F.col("key").alias("_member"), F.lit(True).alias("_hit"))
    side = _placed(side, keys, limit)
    joined = rows.join(side, F.lower(rows[column]) == side["_member"], "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_member", "_hit")


def touching(
    transfers: DataFrame, keys: KeySet, limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Transfers from or to the set, each once, with flags `from_hit` and `to_hit`.

    One scan serves both directions. Beyond the broadcast limit a compact filter of the keys
    goes first, so that (almost) only matching rows are shuffled.
    """
    rows = _likely(transfers, keys, limit, "from_address", "to_address")
    flagged = flag_members(rows, "from_address", keys, "from_hit", limit)
    flagged = flag_members(flagged, "to_address", keys, "to_hit", limit)
    return flagged.filter("from_hit or to_hit")


def _likely(rows: DataFrame, keys: KeySet, limit: int, *columns: str) -> DataFrame:
    """Rows with a key in one of the columns, and a few others; all of them if the set is
    small enough to broadcast. The bitmap's size is bounded, and it misses no key."""
    if keys.fits_broadcast(limit):
        return rows
    bitmap = bitmap_of(keys.table, F.xxhash64("key"), keys.rows)
    flags = [f"_likely{number}" for number in range(len(columns))]
    for column, flag in zip(columns, flags):
        rows = with_hit(rows, F.xxhash64(F.lower(F.col(column))), bitmap, flag)
    found = F.col(flags[0])
    for flag in flags[1:]:
        found = found | F.col(flag)
    return rows.filter(found).drop(*flags)


def outgoing(transfers: DataFrame, keys: KeySet, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Transfers whose sender is in the set."""
    rows = _likely(transfers, keys, limit, "from_address")
    return rows.join(_placed(keys.table, keys, limit), F.lower(rows["from_address"]) == F.col("key"), "left_semi")


def incoming(transfers: DataFrame, keys: KeySet, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Transfers whose receiver is in the set."""
    rows = _likely(transfers, keys, limit, "to_address")
    return rows.join(_placed(keys.table, keys, limit), F.lower(rows["to_address"]) == F.col("key"), "left_semi")


def without_members(
    rows: DataFrame, column: str, keys: KeySet, limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Rows whose lowercase `column` is not in the set."""
    side = _placed(keys.table, keys, limit)
    return rows.join(side, F.lower(rows[column]) == side["key"], "left_anti")
