"""Streaming queries: each runs to the end of its input and returns what it wrote."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ledgerloom.functions.times import format_rfc3339
from ledgerloom.session import scratch_path
from ledgerloom.streaming.jobs import (
    merge_stream_edges,
    merge_unique,
    read_accepted,
    read_rejected,
    read_stream_edges,
    read_unique,
    read_weeks,
    stream_clean,
    stream_edges,
    stream_unique,
    stream_weeks,
)
from workload.graph import LANDED_DEFECTS, dated, landed_pages
from workload.registry import query
from workload.standins import address_of, check_sql, table

_FIRST_SQL = check_sql(
    "SELECT tx_hash, strftime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS block_timestamp, "
    "from_address, to_address, value_wei, block_number, category FROM (SELECT *, row_number() "
    "OVER (PARTITION BY tx_hash ORDER BY block_timestamp, from_address, to_address, value_wei, "
    "block_number, category) AS n FROM classified WHERE reject_reason IS NULL) WHERE n = 1",
    "classified",
)


@contextmanager
def state_partitions(spark, n=8):
    """Few partitions of state for inputs of this size; a stream keeps the number it starts with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _shown(rows):
    return rows.select(
        "tx_hash",
        format_rfc3339(F.col("block_timestamp")).alias("block_timestamp"),
        "from_address",
        "to_address",
        "value_wei",
        "block_number",
        "category",
    )


@query("T1_stream_clean", _FIRST_SQL)
def cleaned(spark, sf_dir):
    path, marks = scratch_path(spark, "cleaned"), scratch_path(spark, "marks")
    stream_clean(spark, landed_pages(spark, sf_dir), path, marks).awaitTermination()
    return _shown(read_accepted(spark, path))


@query("K5_incremental_write", _FIRST_SQL)
def incremental(spark, sf_dir):
    # Two runs over the same folder: the second finds nothing new and repeats nothing. Three
    # compressed files make a batch; their pages are spread over all cores.
    source, path = landed_pages(spark, sf_dir), scratch_path(spark, "cleaned")
    marks, cores = scratch_path(spark, "marks"), spark.sparkContext.defaultParallelism
    for _ in range(2):
        stream_clean(spark, source, path, marks, max_files_per_trigger=3, spread=cores).awaitTermination()
    return _shown(read_accepted(spark, path))


@query(
    "T1_stream_rejects",
    check_sql(
        "SELECT reject_reason, count(*) AS n_rows FROM (SELECT reject_reason FROM classified "
        "WHERE reject_reason IS NOT NULL UNION ALL SELECT 'category' FROM raw UNION ALL "
        f"SELECT malformed FROM ({LANDED_DEFECTS})) GROUP BY 1",
        "classified",
    ),
)
def reject_stream(spark, sf_dir):
    path, marks = scratch_path(spark, "cleaned"), scratch_path(spark, "marks")
    stream_clean(spark, landed_pages(spark, sf_dir), path, marks).awaitTermination()
    rows = read_rejected(spark, path)
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("T1_state_unique", _FIRST_SQL)
def state_unique(spark, sf_dir):
    # Repeats are dropped by the state store, late rows are stored beside; batches are merged.
    names = ("cleaned", "marks", "unique", "marks")
    cleaned, marks, path, more_marks = (scratch_path(spark, n) for n in names)
    stream_clean(spark, landed_pages(spark, sf_dir), cleaned, marks).awaitTermination()
    with state_partitions(spark):
        stream_unique(spark, cleaned, path, more_marks, "30 days", max_files_per_trigger=800).awaitTermination()
    merge_unique(spark, path)
    return _shown(read_unique(spark, path))


_WEEKS_SQL = """
SELECT '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS src, event_type AS dst,
  CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week_start, count(*) AS tx_count,
  CAST(sum(CAST(round(value * 100) AS HUGEINT)) AS VARCHAR) AS total_value_wei
FROM events
GROUP BY 1, 2, 3"""


def landed_events(spark, sf_dir):
    """Events as transactions, landed as files in no order of time."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("tx_hash"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
        address_of(F.col("user_id")).alias("from_address"),
        F.col("event_type").alias("to_address"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("value_wei"),
    )
    path = scratch_path(spark, "events")
    days = F.datediff("block_timestamp", F.lit("1970-01-01").cast("date"))
    events.repartition(6, F.hash(days)).write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("T2_week_windows", _WEEKS_SQL)
def week_windows(spark, sf_dir):
    # Weeks close on the way: what comes after that is late and still counted.
    path, marks = scratch_path(spark, "weeks"), scratch_path(spark, "marks")
    with state_partitions(spark):
        stream_weeks(landed_events(spark, sf_dir), path, marks, delay="1 day").awaitTermination()
    return dated(read_weeks(spark, path))


@query("T2_merged_batches", _WEEKS_SQL)
def merged_batches(spark, sf_dir):
    path, marks = scratch_path(spark, "edges"), scratch_path(spark, "marks")
    stream_edges(landed_events(spark, sf_dir), path, marks).awaitTermination()
    merge_stream_edges(spark, path)
    return dated(read_stream_edges(spark, path))


@query("T2_stream_edges", _WEEKS_SQL)
def edge_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    rows = events.select(
        F.col("event_id").cast("string").alias("tx_hash"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
        address_of(F.col("user_id")).alias("from_address"),
        F.col("event_type").alias("to_address"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("value_wei"),
    )
    path, marks = scratch_path(spark, "edges"), scratch_path(spark, "marks")
    stream_edges(rows, path, marks).awaitTermination()
    return dated(read_stream_edges(spark, path))
