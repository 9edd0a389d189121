"""Node table: degrees, contract flags, hub threshold and class."""

from pyspark.sql import Column, DataFrame, Window, functions as F

HUB_PERCENTILE = 99.9  # Fixed value: default percentile of the hub threshold.
NO_HUBS = 2**63 - 1  # Fixed value: threshold when there is no edge at all.


def degrees(
    edges: DataFrame, labels: DataFrame | None = None, mode: str = "edge_rows"
) -> DataFrame:
    """In- and out-degree per address; labeled addresses without edges get zeros.

    `edge_rows` counts edge rows (a pair active in three periods counts three times),
    `distinct` counts different partners. Edge ends and label addresses meet in a single
    aggregation, combined on the map side, so a hot address costs one row per task.
    """
    if mode not in ("edge_rows", "distinct"):
        raise ValueError(f"unknown degree mode: {mode}")
    pairs = edges.select(
        F.coalesce("src", F.lit("")).alias("src"), F.coalesce("dst", F.lit("")).alias("dst")
    )
    if mode == "distinct":
        pairs = pairs.distinct()
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("address"), none.alias("d_in"), one.alias("d_out")),
                F.struct(F.col("dst").alias("address"), one.alias("d_in"), none.alias("d_out")),
            )
        )
    )
    if labels is not None:
        ends = ends.unionByName(
            labels.filter("address is not null").select(
                "address", none.alias("d_in"), none.alias("d_out")
            )
        )
    return ends.groupBy("address").agg(
        F.sum("d_in").alias("degree_in"), F.sum("d_out").alias("degree_out")
    )


def hub_threshold(degree_table: DataFrame, percentile: float = HUB_PERCENTILE) -> DataFrame:
    """One row `threshold`: the degree at sorted position floor(p/100 * n), 0-based.

    Addresses without edges do not count. Instead of sorting all degrees, the position is
    looked up in the histogram of degrees. E edges have at most about 2 * sqrt(E) different
    degrees, so the running sum over the histogram is small whatever the graph.
    """
    return threshold_of(degree_histogram(degree_table), percentile)


def degree_histogram(degree_table: DataFrame) -> DataFrame:
    """(total, n_addresses): how many addresses have each total degree above zero."""
    total = (F.col("degree_in") + F.col("degree_out")).alias("total")
    positive = degree_table.select(total).filter("total > 0")
    return positive.groupBy("total").agg(F.count(F.lit(1)).alias("n_addresses"))


def threshold_of(histogram: DataFrame, percentile: float = HUB_PERCENTILE) -> DataFrame:
    """The hub threshold of a degree histogram, see `hub_threshold`."""
    everything = Window.partitionBy(F.lit(0))
    count = F.sum("n_addresses").over(everything)
    upto = F.sum("n_addresses").over(everything.orderBy("total"))
    # Double arithmetic on purpose: the position is defined by its rounding.
    position = F.least(
        F.floor(F.lit(percentile / 100.0) * F.col("count").cast("double")), F.col("count") - 1
    )
    placed = histogram.withColumn("count", count).withColumn("upto", upto)
    return placed.filter(F.col("upto") > position).agg(
        F.coalesce(F.min("total"), F.lit(NO_HUBS)).alias("threshold")
    )


def node_class(total: Column, is_contract: Column, threshold: Column) -> Column:
    """hub, contract or eoa; a contract above the threshold is a hub."""
    return (
        F.when(total >= threshold, "hub").when(is_contract, "contract").otherwise("eoa")
    )


def parse_node_type(text: Column) -> Column:
    """Known class text; anything else is eoa."""
    return F.when(text.isin("hub", "contract"), text).otherwise("eoa")


def newest_status(status: DataFrame) -> DataFrame:
    """The newest row per lowercase address: `resolved_at`, then true, decides.

    Maxima of plain times and flags, since that of a struct would sort all rows. A row without
    time is older than any other, one without flag yields to all of its time.
    """
    resolved, flag = F.col("resolved_at"), F.col("is_contract")
    rows = status.groupBy(F.lower("address").alias("address")).agg(
        F.max(resolved).alias("resolved_at"),
        F.max(flag).alias("_any"),
        F.max(F.when(flag, resolved)).alias("_yes"),
        F.max(F.when(~flag, resolved)).alias("_no"),
    )
    newest = (
        F.when(resolved.isNull(), F.col("_any"))
        .when(F.col("_yes") == resolved, True)
        .when(F.col("_no") == resolved, False)
    )
    return rows.select("address", newest.alias("is_contract"), "resolved_at")


def latest_status(status: DataFrame) -> DataFrame:
    """Newest contract status per lowercase address, as `key` and `is_contract`."""
    return newest_status(status).select(F.col("address").alias("key"), "is_contract")


def resolve_contracts(
    addresses: DataFrame, known: DataFrame | None = None, status: DataFrame | None = None
) -> DataFrame:
    """Add `is_contract` from a contract list, a status table, or neither.

    With a list every address is resolved (member or not). With a status table an address
    without entry stays null: unknown. With neither (offline) all are false. Both sides have
    unique keys and the lists can be large, so the join strategy is left to Spark.
    """
    if known is not None:
        side = known.select(F.lower("address").alias("_key")).distinct()
        side = side.withColumn("_hit", F.lit(True))
        joined = addresses.join(side, F.lower(addresses["address"]) == side["_key"], "left")
        return joined.withColumn("is_contract", F.coalesce("_hit", F.lit(False))).drop(
            "_key", "_hit"
        )
    if status is not None:
        side = latest_status(status).select(F.col("key").alias("_key"), "is_contract")
        return addresses.join(
            side, F.lower(addresses["address"]) == side["_key"], "left"
        ).drop("_key")
    return addresses.withColumn("is_contract", F.lit(False))


def unresolved_addresses(resolved: DataFrame) -> DataFrame:
    """Addresses a status table had no entry for; feed for the next resolution run."""
    return resolved.filter("is_contract is null").select("address")


def build_nodes(
    edges: DataFrame,
    labels: DataFrame | None = None,
    known: DataFrame | None = None,
    status: DataFrame | None = None,
    percentile: float = HUB_PERCENTILE,
    mode: str = "edge_rows",
) -> DataFrame:
    """The node table of an edge table and its labels."""
    degree_table = degrees(edges, labels, mode)
    return classify_nodes(degree_table, known, status, percentile)


def classify_nodes(
    degree_table: DataFrame,
    known: DataFrame | None = None,
    status: DataFrame | None = None,
    percentile: float = HUB_PERCENTILE,
) -> DataFrame:
    """Node rows of a degree table. The threshold is one value, read as scalar subquery."""
    threshold = hub_threshold(degree_table, percentile).scalar()
    return classify_degrees(resolve_contracts(degree_table, known, status), threshold)


def classify_degrees(resolved: DataFrame, threshold: Column) -> DataFrame:
    """Node rows of degrees with contract flags."""
    is_contract = F.coalesce("is_contract", F.lit(False))
    total = F.col("degree_in") + F.col("degree_out")
    return resolved.select(
        "address",
        is_contract.alias("is_contract"),
        "degree_in",
        "degree_out",
        node_class(total, is_contract, threshold).alias("node_type"),
    )
