"""The label table: addresses found in sanctions documents, validated and deduplicated."""

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.addresses import (
    address_key,
    is_zero_address,
    loose_addresses,
    prefixed_addresses,
)
from ledgerloom.functions.checksum import checksum_address
from ledgerloom.layers import merge_layers, read_layers, write_layer
from ledgerloom.operators.keysets import BROADCAST_KEYS
from ledgerloom.session import write_scratch

LABEL_SANCTIONED = 1  # Fixed value: the label of a sanctioned address.
LABEL_SOURCE = "OFAC_SDN"  # Fixed value: default source name of the label table.

# The texts that mark a crypto identifier in the two XML layouts.
ID_TYPE_MARKS = ("Digital Currency", "Ethereum", "Crypto")
FEATURE_TYPE_MARKS = ("Digital Currency", "Ethereum", "ETH")


def contains_any(text: Column, marks) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return F.coalesce(found, F.lit(False))


def extract_addresses(
    docs: DataFrame,
    text_col: str,
    id_cols=(),
    require_prefix: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """One row (id columns, `raw_address`) per address in the text, repeats included."""
    text = F.col(text_col)
    found = prefixed_addresses(text) if require_prefix else loose_addresses(text, bounded)
    return docs.select(*id_cols, F.explode(found).alias("raw_address"))


def sdn_identifiers(entries: DataFrame, id_cols=()) -> DataFrame:
    """`text` of the crypto identifiers of SDN entries."""
    ids = entries.select(*id_cols, F.explode("idList.id").alias("id"))
    crypto = ids.filter(contains_any(F.col("id.idType"), ID_TYPE_MARKS))
    return crypto.select(*id_cols, F.col("id.idNumber").alias("text"))


def party_details(parties: DataFrame, id_cols=()) -> DataFrame:
    """`text` of the crypto feature details of distinct parties (advanced layout)."""
    features = parties.select(*id_cols, F.explode("Feature").alias("feature"))
    crypto = features.filter(contains_any(F.col("feature.FeatureType"), FEATURE_TYPE_MARKS))
    details = crypto.select(*id_cols, F.explode("feature.VersionDetail").alias("detail"))
    return details.select(*id_cols, F.col("detail.DetailValue").alias("text"))


def normalize_addresses(df: DataFrame, column: str, checksum: bool = False) -> DataFrame:
    """Add `key` (lowercase or null), `is_zero` and, if asked, `checksum`."""
    keyed = df.withColumn("key", address_key(F.col(column)))
    keyed = keyed.withColumn("is_zero", F.coalesce(is_zero_address(F.col("key")), F.lit(False)))
    return keyed.withColumn("checksum", checksum_address(F.col("key"))) if checksum else keyed


def address_dimension(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct valid addresses of the columns: `key` and `checksum`, hashed once each."""
    return distinct_keys(df, *columns).withColumn("checksum", checksum_address(F.col("key")))


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct valid addresses of the columns, as `key`."""
    every = df.select(F.explode(F.array(*(address_key(F.col(c)) for c in columns))).alias("key"))
    return every.filter("key is not null").distinct()


def stored_checksums(keys: DataFrame, folder: str) -> DataFrame:
    """`key` and `checksum` of distinct keys, from a table that outlives the run.

    Only keys that the table lacks are hashed, and they are added to it as a layer. Two runs
    at once may both add a key; that is as good as one.
    """
    spark, known = keys.sparkSession, read_layers(keys.sparkSession, folder)
    if known is None:
        known = spark.createDataFrame([], "key string, checksum string")
    found = keys.select("key").join(known, "key", "left").dropDuplicates(["key"])
    found = write_scratch(found, "known-checksums")
    fresh = found.filter("checksum is null")
    if fresh.isEmpty():
        return found
    added = write_layer(fresh.select("key", checksum_address(F.col("key")).alias("checksum")), folder)
    return found.filter("checksum is not null").unionByName(read_layers(spark, folder, names=[added]))


def merge_checksums(spark, folder: str):
    """Fold the layers of a checksum table into one row per key."""
    return merge_layers(spark, folder, lambda rows: rows.dropDuplicates(["key"]))


def show_checksums(rows: DataFrame, *columns: str, folder: str | None = None) -> DataFrame:
    """Well-formed addresses of the columns in checksum form; other text stays as it is.

    Every distinct address is hashed once, into a table that is written and joined back
    (broadcast while it is small); with `folder`, once for all runs that share it. `rows` is
    read twice: pass a written table.
    """
    if folder is None:
        dimension = write_scratch(address_dimension(rows, *columns), "checksums")
    else:
        dimension = stored_checksums(distinct_keys(rows, *columns), folder)
    few = dimension.count() <= BROADCAST_KEYS
    shown = rows
    for number, column in enumerate(columns):
        side = dimension.select(
            F.col("key").alias(f"_key{number}"), F.col("checksum").alias(f"_shown{number}")
        )
        key = address_key(F.col(column))
        shown = shown.join(F.broadcast(side) if few else side, key == F.col(f"_key{number}"), "left")
        shown = shown.withColumn(column, F.coalesce(f"_shown{number}", column))
    return shown.select(*rows.columns)


def drop_zero_address(df: DataFrame, column: str = "key") -> DataFrame:
    return df.filter(~is_zero_address(F.col(column)))


def validate_and_dedupe(found: DataFrame, column: str = "raw_address") -> DataFrame:
    """Distinct valid non-zero addresses: `key`, and the smallest `source_url` if present."""
    keyed = normalize_addresses(found, column).filter("key is not null and not is_zero")
    if "source_url" in found.columns:
        return keyed.groupBy("key").agg(F.min("source_url").alias("source_url"))
    return keyed.select("key").distinct()


def build_label_table(
    found: DataFrame,
    retrieved_at: Column | None = None,
    label: int = LABEL_SANCTIONED,
    source_name: str = LABEL_SOURCE,
) -> DataFrame:
    """Label rows of the addresses found (`raw_address`, `source_url`)."""
    valid = validate_and_dedupe(found)
    return valid.select(
        checksum_address(F.col("key")).alias("address"),
        F.lit(label).alias("label"),
        F.lit(source_name).alias("label_source"),
        "source_url",
        (F.current_timestamp() if retrieved_at is None else retrieved_at).alias("retrieved_at"),
    )
