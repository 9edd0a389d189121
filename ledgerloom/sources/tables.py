"""Readers of the four tables and of incremental chunk folders.

All readers pass the declared layout, so columns are found by name and nothing is inferred.
Missing cells get the documented defaults; malformed times become null, never "now".
"""

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.times import parse_rfc3339
from ledgerloom.operators.nodes import parse_node_type
from ledgerloom.operators.selecting import select_window
from ledgerloom.schemas import EDGES_DISK, LABELS_DISK, NODES_DISK, TRANSACTIONS_DISK


def _text(name: str):
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _count(name: str):
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _checked(spark: SparkSession, path: str, layout) -> DataFrame:
    """Scan with the declared layout; a column the files lack is an error, not nulls."""
    found = set(spark.read.parquet(path).columns)
    missing = [name for name in layout.names if name not in found]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return spark.read.schema(layout).parquet(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    raw = _checked(spark, path, LABELS_DISK)
    return raw.select(
        _text("address"),
        _count("label"),
        _text("label_source"),
        _text("source_url"),
        parse_rfc3339(F.col("retrieved_at")).alias("retrieved_at"),
    )


def scan_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions as stored (all text); filters and column choices reach the scan."""
    return _checked(spark, path, TRANSACTIONS_DISK)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return type_transactions(scan_transactions(spark, path))


def read_months(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Transactions of a month table from `start` up to, not including, `end` (aware times).

    Only the folders of these months are listed for reading; within them the days prune row
    groups, since times are stored as text that sorts by day.
    """
    start, end = (t.astimezone(timezone.utc) for t in (start, end))
    months = F.col("block_month").between(F.lit(start.date().replace(day=1)), F.lit(end.date()))
    last = (end.date() + timedelta(days=1)).isoformat()
    days = F.col("block_timestamp").between(F.lit(start.date().isoformat()), F.lit(last))
    raw = _checked(spark, path, TRANSACTIONS_DISK)
    return select_window(type_transactions(raw.filter(months & days)), start, end)


def type_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("tx_hash"),
        parse_rfc3339(F.col("block_timestamp")).alias("block_timestamp"),
        _text("from_address"),
        _text("to_address"),
        _text("value_wei"),
    )


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    raw = _checked(spark, path, EDGES_DISK)
    day = F.when(
        F.col("week_start").rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), F.try_to_date("week_start")
    )
    return raw.select(
        _text("src"),
        _text("dst"),
        F.coalesce(day, F.lit("1970-01-01").cast("date")).alias("week_start"),
        _count("tx_count"),
        _text("total_value_wei"),
    )


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    raw = _checked(spark, path, NODES_DISK)
    return raw.select(
        _text("address"),
        F.coalesce("is_contract", F.lit(False)).alias("is_contract"),
        _count("degree_in"),
        _count("degree_out"),
        parse_node_type(F.col("node_type")).alias("node_type"),
    )


def read_chunks(
    spark: SparkSession, labeled_path: str | None, chunks_path: str | None
) -> list[DataFrame]:
    """The existing inputs of a merge in priority order, as stored; missing ones are skipped.

    All chunk files are one scan: Spark plans their tasks together.
    """
    frames = []
    for path in (labeled_path, chunks_path):
        if path is None:
            continue
        try:
            reader = spark.read.schema(TRANSACTIONS_DISK).option("recursiveFileLookup", "true")
            frames.append(reader.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return frames


def ranked_chunks(frames: list[DataFrame]) -> DataFrame | None:
    """Union of the inputs with `origin_rank`, 0 for the first."""
    merged = None
    for rank, frame in enumerate(frames):
        ranked = frame.withColumn("origin_rank", F.lit(rank))
        merged = ranked if merged is None else merged.unionByName(ranked)
    return merged
