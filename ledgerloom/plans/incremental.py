"""Nodes that go on from what exists: stored degrees, contract flags and degree histogram.

A graph state is a folder of versions. Each version has a table of addresses (degrees and
contract flag), bucketed by address, and the histogram of degrees. A delta of edges is
aggregated on its own and joined to the stored table on its buckets, so only the delta is
shuffled; the histogram gives up the old totals of the changed addresses and takes the new
ones. New addresses alone are looked up in contract lists, and a change of contract statuses
touches only the addresses it names. Node classes follow from one scan of the table and the
threshold of the histogram.

A version counts once its record is committed (see `layers`): a crash leaves the version
before it, and a delta that is applied again changes nothing.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.layers import Version, commit, latest, unique_name
from ledgerloom.operators.keysets import BROADCAST_KEYS
from ledgerloom.operators.nodes import (
    HUB_PERCENTILE,
    classify_degrees,
    degree_histogram,
    degrees,
    latest_status,
    resolve_contracts,
    threshold_of,
)
from ledgerloom.session import use_utc, write_scratch
from ledgerloom.sinks.bucketed import read_bucketed, write_bucketed

BUCKETS = 64
STATE = (
    "address string, degree_in bigint, degree_out bigint, is_contract boolean, before bigint"
)
HISTOGRAM = "total bigint, n_addresses bigint"


def unseen_edges(edges: DataFrame, stored: DataFrame, mode: str = "edge_rows") -> DataFrame:
    """The edge rows of a delta that add to degrees: those whose key is not stored yet.

    The key is (src, dst, week_start), or (src, dst) under `mode="distinct"`. Of the stored
    edges only the delta's weeks are read under `edge_rows`.
    """
    if mode == "distinct":
        key = ["src", "dst"]
    else:
        key = ["src", "dst", "week_start"]
        weeks = edges.agg(F.min("week_start").alias("a"), F.max("week_start").alias("b")).first()
        stored = stored.filter(F.col("week_start").between(weeks.a, weeks.b))
    return edges.dropDuplicates(key).join(stored.select(*key).distinct(), key, "left_anti")


def read_state(spark: SparkSession, folder: str, version: Version | None = None) -> DataFrame:
    """Addresses with degrees and contract flag (null: unknown); empty before the first delta."""
    version = version or latest(spark, folder)
    if not version.number:
        return spark.createDataFrame([], STATE)
    path = f"{folder}/{version.facts['state']}"
    return read_bucketed(spark, path, STATE, "address", version.facts["buckets"])


def read_histogram(spark: SparkSession, folder: str, version: Version | None = None) -> DataFrame:
    """How many addresses have each total degree above zero."""
    version = version or latest(spark, folder)
    if not version.number:
        return spark.createDataFrame([], HISTOGRAM)
    return spark.read.schema(HISTOGRAM).parquet(f"{folder}/{version.facts['histogram']}")


def apply_edges(
    spark: SparkSession,
    folder: str,
    edges: DataFrame,
    delta: str,
    labels: DataFrame | None = None,
    known: DataFrame | None = None,
    status: DataFrame | None = None,
    mode: str = "edge_rows",
    buckets: int = BUCKETS,
) -> Version:
    """Add edge rows that are not in the state yet (see `unseen_edges`); returns the version.

    `delta` names them: a name that was applied before changes nothing. `labels` are addresses
    to list even without edges. `known` or `status` resolve the contract flag of new addresses.
    """
    use_utc(spark)
    base = latest(spark, folder)
    if delta in base.facts.get("deltas", ()):
        return base
    buckets = base.facts.get("buckets", buckets)
    change = resolve_contracts(degrees(edges, labels, mode), known, status)
    change = change.select(
        F.col("address").alias("_address"),
        F.col("degree_in").alias("more_in"),
        F.col("degree_out").alias("more_out"),
        F.col("is_contract").alias("_contract"),
    )
    stored = read_state(spark, folder, base).drop("before")
    both = stored.join(change, F.col("address") == F.col("_address"), "full_outer")
    none = F.lit(0).cast("bigint")
    total = F.coalesce("degree_in", none) + F.coalesce("degree_out", none)
    merged = both.select(
        F.coalesce("address", "_address").alias("address"),
        (F.coalesce("degree_in", none) + F.coalesce("more_in", none)).alias("degree_in"),
        (F.coalesce("degree_out", none) + F.coalesce("more_out", none)).alias("degree_out"),
        F.when(F.col("address").isNull(), F.col("_contract"))
        .otherwise(F.col("is_contract"))
        .alias("is_contract"),
        # The total before this delta, of the addresses that it touches.
        F.when(F.col("_address").isNotNull(), total).alias("before"),
    )
    state = unique_name("state")
    write_bucketed(merged, f"{folder}/{state}", "address", buckets)
    written = read_bucketed(spark, f"{folder}/{state}", STATE, "address", buckets)
    after = F.col("degree_in") + F.col("degree_out")
    moves = written.filter((F.col("before") != after)).select(
        F.inline(
            F.array(
                F.struct(F.col("before").alias("total"), F.lit(-1).cast("bigint").alias("n_addresses")),
                F.struct(after.alias("total"), F.lit(1).cast("bigint").alias("n_addresses")),
            )
        )
    )
    counts = read_histogram(spark, folder, base).unionByName(moves).filter("total > 0")
    counts = counts.groupBy("total").agg(F.sum("n_addresses").alias("n_addresses"))
    histogram = unique_name("histogram")
    counts.filter("n_addresses != 0").write.parquet(f"{folder}/{histogram}")
    facts = {"state": state, "histogram": histogram, "buckets": buckets}
    return commit(spark, folder, base, {**facts, "deltas": [*base.facts.get("deltas", ()), delta]})


def apply_status(spark: SparkSession, folder: str, status: DataFrame, delta: str) -> Version:
    """Take over newer contract statuses of the addresses they name; degrees stay.

    Few statuses are broadcast, so that the stored table is read and written in its buckets.
    """
    use_utc(spark)
    base = latest(spark, folder)
    if delta in base.facts.get("deltas", ()) or not base.number:
        return base
    newest = latest_status(status).select(F.col("key").alias("_key"), F.col("is_contract").alias("_new"))
    newest = write_scratch(newest, "newest-status")
    few = newest.count() <= BROADCAST_KEYS
    stored = read_state(spark, folder, base).drop("before")
    joined = stored.join(
        F.broadcast(newest) if few else newest, F.lower("address") == F.col("_key"), "left"
    )
    changed = joined.select(
        "address",
        "degree_in",
        "degree_out",
        F.coalesce("_new", "is_contract").alias("is_contract"),
        F.lit(None).cast("bigint").alias("before"),
    )
    state, buckets = unique_name("state"), base.facts["buckets"]
    write_bucketed(changed, f"{folder}/{state}", "address", buckets)
    return commit(
        spark, folder, base, {**base.facts, "state": state, "deltas": [*base.facts["deltas"], delta]}
    )


def nodes_of(
    spark: SparkSession,
    folder: str,
    percentile: float = HUB_PERCENTILE,
    version: Version | None = None,
) -> DataFrame:
    """The node table of a state: one scan, and the threshold from the stored histogram."""
    version = version or latest(spark, folder)
    threshold = threshold_of(read_histogram(spark, folder, version), percentile).scalar()
    return classify_degrees(read_state(spark, folder, version).drop("before"), threshold)


def unresolved_of(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses whose contract status is unknown; feed for the next resolution run."""
    return read_state(spark, folder).filter("is_contract is null").select("address")


def rebuild_state(
    spark: SparkSession, folder: str, degree_table: DataFrame, delta: str, buckets: int = BUCKETS
) -> Version:
    """Start a state from a resolved degree table (address, degrees, is_contract)."""
    base = latest(spark, folder)
    if delta in base.facts.get("deltas", ()):
        return base
    state, histogram = unique_name("state"), unique_name("histogram")
    rows = degree_table.select(
        "address", "degree_in", "degree_out", "is_contract", F.lit(None).cast("bigint").alias("before")
    )
    write_bucketed(rows, f"{folder}/{state}", "address", buckets)
    written = read_bucketed(spark, f"{folder}/{state}", STATE, "address", buckets)
    degree_histogram(written).write.parquet(f"{folder}/{histogram}")
    facts = {"state": state, "histogram": histogram, "buckets": buckets, "deltas": [delta]}
    return commit(spark, folder, base, facts)
