"""Declared table layouts.

Every table has two layouts: the one on disk (`*_DISK`, where times and wide integers
are text) and the typed one the operators work on (`*_TYPED`). Readers pass the disk
layout to Spark, so nothing is ever inferred.
"""

from enum import Enum

from pyspark.sql import types as T

# The layout and release versions written to run metadata.
SCHEMA_VERSION = "1.0.0"
PIPELINE_VERSION = "0.1.0"

LABELS_DISK = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("label_source", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("retrieved_at", T.StringType()),
    ]
)

TRANSACTIONS_DISK = T.StructType(
    [
        T.StructField("tx_hash", T.StringType()),
        T.StructField("block_timestamp", T.StringType()),
        T.StructField("from_address", T.StringType()),
        T.StructField("to_address", T.StringType()),
        T.StructField("value_wei", T.StringType()),
    ]
)

EDGES_DISK = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("week_start", T.StringType()),
        T.StructField("tx_count", T.LongType()),
        T.StructField("total_value_wei", T.StringType()),
    ]
)

NODES_DISK = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("is_contract", T.BooleanType()),
        T.StructField("degree_in", T.LongType()),
        T.StructField("degree_out", T.LongType()),
        T.StructField("node_type", T.StringType()),
    ]
)

CONTRACT_STATUS = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("is_contract", T.BooleanType()),
        T.StructField("resolved_at", T.TimestampType()),
    ]
)

CORRUPT = "_corrupt_record"

TRANSFER = T.StructType(
    [
        T.StructField("hash", T.StringType()),
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        # Read as text, so that a value of the wrong type is seen and not just null.
        T.StructField("value", T.StringType()),
        T.StructField("asset", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("blockNum", T.StringType()),
        T.StructField(
            "metadata", T.StructType([T.StructField("blockTimestamp", T.StringType())])
        ),
        # Optional exact amount; absent in most feeds, wins over the double when present.
        T.StructField("valueWei", T.StringType()),
    ]
)

# One landed page. `address` and `direction` record which query the page answers.
TRANSFER_PAGE = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("transfers", T.ArrayType(TRANSFER)),
        T.StructField("pageKey", T.StringType()),
        # The text of a page that is not of this form, by Spark's JSON reader.
        T.StructField(CORRUPT, T.StringType()),
    ]
)

SDN_ENTRY = T.StructType(
    [
        T.StructField("uid", T.LongType()),
        T.StructField("sdnType", T.StringType()),
        T.StructField(
            "idList",
            T.StructType(
                [
                    T.StructField(
                        "id",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("idType", T.StringType()),
                                    T.StructField("idNumber", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)

DISTINCT_PARTY = T.StructType(
    [
        T.StructField(
            "Feature",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("FeatureType", T.StringType()),
                        T.StructField(
                            "VersionDetail",
                            T.ArrayType(
                                T.StructType([T.StructField("DetailValue", T.StringType())])
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


class Ranking(str, Enum):
    TOTAL_VALUE = "total_value"
    TRANSACTION_COUNT = "transaction_count"
    MOST_RECENT = "most_recent"
