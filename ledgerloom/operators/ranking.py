"""Counterparty statistics and top-k selection around a labeled set."""

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.wide_int import fold_limbs, limb_sums, numeric_desc, padded_u128
from ledgerloom.operators.keysets import BROADCAST_KEYS, KeySet, touching, without_members
from ledgerloom.schemas import Ranking

TOP_K = 500  # Fixed value: default number of counterparties per labeled address.

# Catalyst trims ranks before the shuffle only up to this k (windowGroupLimitThreshold).
_NATIVE_GROUP_LIMIT = 1000
_RANK_SLICES = 256


def counterparty_pairs(touched: DataFrame) -> DataFrame:
    """(labeled, counterparty) of transfers with exactly one labeled end.

    `touched` carries the flags of `touching`. A counterparty that is labeled itself is
    dropped here, which is the anti join against the labels without another join.
    """
    outgoing = F.col("from_hit")
    one_side = touched.filter("from_hit != to_hit")
    sender, receiver = F.lower("from_address"), F.lower("to_address")
    return one_side.withColumns(
        {
            "labeled": F.when(outgoing, sender).otherwise(receiver),
            "counterparty": F.when(outgoing, receiver).otherwise(sender),
        }
    ).filter("labeled != '' and counterparty != ''")


def counterparty_stats(
    transfers: DataFrame, labels: KeySet, amount: str = "rank_wei", limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Total, count and latest time per (labeled, counterparty), both directions.

    Transfers are counted before deduplication.
    """
    return stats_of_touched(touching(transfers, labels, limit), amount)


def stats_of_touched(touched: DataFrame, amount: str = "rank_wei") -> DataFrame:
    pairs = counterparty_pairs(touched).select(
        "labeled",
        "counterparty",
        padded_u128(F.col(amount)).alias("_padded"),
        "block_timestamp",
    )
    sums = pairs.groupBy("labeled", "counterparty").agg(
        *limb_sums(F.col("_padded"), "_w"),
        F.count(F.lit(1)).alias("tx_count"),
        F.max("block_timestamp").alias("most_recent"),
    )
    return fold_limbs(sums, "_w", "total_value")


def ranking_order(ranking: str) -> list:
    """Sort keys of a ranking, best first; ties go to the smaller address."""
    ranking = Ranking(ranking)
    if ranking is Ranking.TOTAL_VALUE:
        keys = numeric_desc(F.col("total_value"))
    elif ranking is Ranking.TRANSACTION_COUNT:
        keys = [F.col("tx_count").desc()]
    else:
        keys = [F.col("most_recent").desc_nulls_last()]
    return [*keys, F.col("counterparty").asc()]


def top_counterparties(
    stats: DataFrame, k: int = TOP_K, ranking: str = "total_value"
) -> DataFrame:
    """The k best counterparties of each labeled address, with their `rank`.

    Up to k = 1000 Catalyst cuts each map task's groups to k rows before the shuffle. For a
    larger k the groups are first cut inside hash slices; the overall best k are always
    among the best k of their slices.
    """
    order = ranking_order(ranking)
    candidates = stats
    if k > _NATIVE_GROUP_LIMIT:
        part = F.pmod(F.xxhash64("counterparty"), F.lit(_RANK_SLICES)).alias("_slice")
        sliced = Window.partitionBy("labeled", "_slice").orderBy(*order)
        candidates = (
            stats.select("*", part)
            .withColumn("_n", F.row_number().over(sliced))
            .filter(F.col("_n") <= k)
            .drop("_n", "_slice")
        )
    whole = Window.partitionBy("labeled").orderBy(*order)
    return candidates.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def selected_counterparties(
    ranked: DataFrame, exclude: KeySet | None = None, limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Distinct picks (column `address`) without the excluded ones.

    Exclusion comes after the top-k cut, so the slots of excluded picks stay empty.
    """
    picks = ranked.select(F.col("counterparty").alias("address")).distinct()
    return without_members(picks, "address", exclude, limit) if exclude else picks
