"""From raw transfer records to transaction rows: filling, filtering, typing, deduping."""

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.addresses import address_key
from ledgerloom.functions.checksum import checksum_address
from ledgerloom.functions.times import parse_rfc3339, parse_rfc3339_strict
from ledgerloom.functions.wide_int import (
    canonical_u128,
    ether_to_rank_wei,
    ether_to_wei,
    with_wide_wei,
)

# The transfer categories that move the native coin.
NATIVE_CATEGORIES = ("external", "internal")

TRANSACTION_COLUMNS = ("tx_hash", "block_timestamp", "from_address", "to_address", "value_wei")


def exact_amount():
    """The canonical text of the exact amount; null where there is none."""
    exact = F.col("value_wei_text")
    return F.when(exact.isNotNull(), canonical_u128(exact))


def is_zero_value(exact=None):
    """The amount is known and zero; an exact amount wins over the double.

    `exact` is the column of `exact_amount`, where that is at hand.
    """
    exact = exact_amount() if exact is None else exact
    return F.coalesce(
        F.when(exact.isNotNull(), exact == "0").otherwise(F.col("value") == 0), F.lit(False)
    )


def is_native_transfer():
    """Category is native and the value is not zero; an unknown value passes."""
    return F.col("category").isin(*NATIVE_CATEGORIES) & ~is_zero_value()


def has_both_ends(sender: str = "from_address", receiver: str = "to_address"):
    """Neither end is null or empty."""
    blank = F.lit("")
    return (F.coalesce(F.col(sender), blank) != "") & (F.coalesce(F.col(receiver), blank) != "")


def fill_recipient(transfers: DataFrame) -> DataFrame:
    """Missing `to` of a page that answers an incoming query is the queried address."""
    filled = F.coalesce(
        F.nullif("to", F.lit("")), F.when(F.col("direction") == "to", F.col("address"))
    )
    return transfers.withColumn("to", filled)


def classify_transfers(transfers: DataFrame, on_bad_ts: str = "reject") -> DataFrame:
    """Type raw transfers and add `reject_reason` (null = accepted).

    Both outcomes stay in one frame, so a caller that wants the two tables and the counts
    reads the input once. `on_bad_ts="fail"` stops the job at malformed timestamp text.
    Where the reader marks rows as `malformed`, that is the reason, and `raw` keeps the text.
    """
    if on_bad_ts not in ("reject", "fail"):
        raise ValueError(f"unknown on_bad_ts: {on_bad_ts}")
    parse = parse_rfc3339_strict if on_bad_ts == "fail" else parse_rfc3339
    blank = F.lit("")
    reason = (
        F.when(~F.coalesce(F.col("category").isin(*NATIVE_CATEGORIES), F.lit(False)), "category")
        .when(is_zero_value(F.col("_exact")), "zero_value")
        .when(F.coalesce(F.col("to"), blank) == "", "empty_to")
        .when(F.coalesce(F.col("from"), blank) == "", "empty_from")
        .when(F.col("block_timestamp").isNull(), "bad_timestamp")
    )
    marked = "malformed" in transfers.columns
    if marked:
        reason = F.coalesce("malformed", reason)
    # What several columns need is a column first, so that it is made once.
    typed = with_wide_wei(transfers, "value", "_wide").withColumns(
        {"block_timestamp": parse(F.col("block_timestamp")), "_exact": exact_amount()}
    )
    value, wide = F.col("value"), F.col("_wide")
    return typed.select(
        F.col("hash").alias("tx_hash"),
        "block_timestamp",
        F.col("from").alias("from_address"),
        F.col("to").alias("to_address"),
        F.coalesce("_exact", ether_to_wei(value, wide)).alias("value_wei"),
        F.coalesce("_exact", ether_to_rank_wei(value, wide)).alias("rank_wei"),
        "block_number",
        "category",
        reason.alias("reject_reason"),
        *(["raw"] if marked else []),
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter("reject_reason is null").drop("reject_reason", "raw")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter("reject_reason is not null")


def rejection_counts(classified: DataFrame) -> DataFrame:
    """Rows per outcome: `accepted` or the reject reason."""
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("reason")
    return classified.groupBy(outcome).agg(F.count(F.lit(1)).alias("n_rows"))


def with_checksums(df: DataFrame, *columns: str) -> DataFrame:
    """Show well-formed addresses in checksum form; other text stays as it is."""
    shown = {
        name: F.coalesce(checksum_address(address_key(F.col(name))), F.col(name))
        for name in columns
    }
    return df.withColumns(shown)


def to_transactions(transfers: DataFrame, checksum: bool = True) -> DataFrame:
    """The five transaction columns of accepted transfers."""
    rows = transfers.select(*TRANSACTION_COLUMNS)
    return with_checksums(rows, "from_address", "to_address") if checksum else rows


def drop_repeats(
    df: DataFrame, key_cols=("tx_hash",), precedence=(), copies: str | None = None
) -> DataFrame:
    """One row per key: the smallest by `precedence`, then by all other columns.

    `copies` names a column for the number of rows of the key.

    "First seen" needs a total order to be repeatable; nulls come first in it. The minimum
    is combined on the map side, so a key with very many copies leaves each task as one row.
    """
    rest = [c for c in df.columns if c not in key_cols]
    order = [*precedence, *(c for c in rest if c not in precedence)]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    kept = df.groupBy(*key_cols).agg(F.min(F.struct(*order)).alias("_first"), *counted)
    shown = kept.select(
        *key_cols, *(F.col("_first")[c].alias(c) for c in rest), *([copies] if copies else [])
    )
    return shown.select(*df.columns, *([copies] if copies else []))


def merge_transactions(
    frames: list[DataFrame], key_cols=("tx_hash",), copies: str | None = None
) -> DataFrame:
    """Union in priority order, then one row per key; an earlier frame wins."""
    ranked = [
        frame.select(*TRANSACTION_COLUMNS).withColumn("origin_rank", F.lit(rank))
        for rank, frame in enumerate(frames)
    ]
    merged = ranked[0]
    for frame in ranked[1:]:
        merged = merged.unionByName(frame)
    first = drop_repeats(merged, key_cols, ("origin_rank", "block_timestamp"), copies)
    return first.drop("origin_rank")


def repeat_counts(df: DataFrame, key_cols=("tx_hash",)) -> DataFrame:
    """One row: rows seen, rows kept after deduplication, rows removed."""
    per_key = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_seen"),
        F.count(F.lit(1)).alias("rows_kept"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count(F.lit(1))).alias("rows_removed"),
    )
