"""Resumable cleaning of landed pages, and edges over a stream.

Two jobs keep no state between batches and no watermark: `stream_clean` appends cleaned rows as
they come, to be made unique on reading, and `stream_edges` stores sums per batch, to be added
up on reading. Two keep keyed state by event time: `stream_unique` remembers rows and stores
repeats once, `stream_weeks` keeps the edges of open weeks. What comes behind their watermark
is stored beside, so nothing is lost in any of them. Finished batches are folded together by
the merge jobs, which may run at any time.
"""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.times import period_start
from ledgerloom.operators.cleaning import (
    accepted,
    classify_transfers,
    drop_repeats,
    fill_recipient,
    rejected,
)
from ledgerloom.functions.wide_int import limb_sums
from ledgerloom.layers import batch_layer, merge_layers, read_file, read_layers, write_layer
from ledgerloom.operators.edges import add_parts, edge_keys, edge_parts, fold_parts
from ledgerloom.session import use_utc
from ledgerloom.sources.transfers import stream_transfer_pages


def clean_pages(pages: DataFrame) -> DataFrame:
    return classify_transfers(fill_recipient(pages))


def stream_clean(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    spread: int | None = None,
):
    """Start a run over the pages landed so far; returns the query.

    Accepted and rejected rows come from one pass and one checkpoint, partitioned by outcome
    and month, so each row is in exactly one of them. The checkpoint records finished files:
    a restart after a crash continues where the last run ended and repeats nothing. `spread` is
    a number of tasks for batches of few files that cannot be cut, as compressed ones.
    """
    use_utc(spark)
    rows = clean_pages(stream_transfer_pages(spark, source, max_files_per_trigger, spread))
    outcome = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    return (
        rows.withColumn("outcome", outcome)
        .withColumn("block_month", period_start(F.col("block_timestamp"), "month"))
        .writeStream.format("parquet")
        .option("path", path)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .partitionBy("outcome", "block_month")
        .trigger(availableNow=True)
        .start()
    )


def read_accepted(spark: SparkSession, path: str, key_cols=("tx_hash",)) -> DataFrame:
    """One accepted row per key, the earliest (then the smallest), whatever landed first."""
    rows = accepted(spark.read.parquet(path).filter("outcome = 'accepted'")).drop("outcome")
    return drop_repeats(rows, key_cols, ("block_timestamp",))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Every rejected row with its reason, and the raw text where it could not be read."""
    rows = spark.read.parquet(path).filter("outcome = 'rejected'")
    return rejected(rows).drop("outcome", "block_month")


def _watermark_before(spark, checkpoint, number):
    """The watermark in microseconds that batch `number` drops late rows by.

    That is the one its predecessor began with, as the checkpoint records it.
    """
    if number == 0:
        return 0
    lines = read_file(spark, f"{checkpoint}/offsets/{number - 1}").splitlines()
    return json.loads(lines[1])["batchWatermarkMs"] * 1000


def stream_unique(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    delay: str = "14 days",
    max_files_per_trigger: int | None = None,
):
    """Start a run that stores the accepted rows of `stream_clean` without repeats.

    A row is remembered in the state store until the watermark, `delay` behind the newest time,
    has passed it by `delay`; a repeat that comes until then is not stored again. Rows behind
    the watermark are stored as late, so none is lost. State holds the rows of about two delays.
    """
    use_utc(spark)
    layout = spark.read.parquet(source).schema
    reader = spark.readStream.schema(layout)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = accepted(reader.parquet(source).filter("outcome = 'accepted'")).drop("outcome")
    first = rows.withWatermark("block_timestamp", delay).dropDuplicatesWithinWatermark(rows.columns)
    # The same rows once more: what the state store drops as late is seen only beside it.
    both = first.withColumn("kind", F.lit("unique")).unionByName(rows.withColumn("kind", F.lit("late")))

    def store(batch, number):
        behind = F.unix_micros("block_timestamp") <= _watermark_before(spark, checkpoint, number)
        kept = batch.filter((F.col("kind") == "unique") | behind)
        write_layer(kept, path, batch_layer(number), ("kind", "block_month"))

    return (
        both.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read_kinds(spark, path):
    rows = read_layers(spark, path)
    if rows is None:
        raise ValueError(f"{path} has no layers yet")
    return rows


def read_unique(spark: SparkSession, path: str, key_cols=("tx_hash",)) -> DataFrame:
    """One row per key of `stream_unique`, late rows included: the earliest, then the smallest."""
    return drop_repeats(_read_kinds(spark, path).drop("kind"), key_cols, ("block_timestamp",))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came behind the watermark."""
    return _read_kinds(spark, path).filter("kind = 'late'").drop("kind")


# Fixed value: files of a month and kind in a merged layer, at most.
_UNIQUE_SLICES = 4


def _distinct_by_month(rows):
    """Each row once. The shuffle that finds repeats also gathers the rows by kind and month."""
    part = F.pmod(F.xxhash64("tx_hash"), F.lit(_UNIQUE_SLICES)).alias("_slice")
    placed = rows.select("*", part).repartition("kind", "block_month", "_slice")
    return placed.distinct().drop("_slice")


def merge_unique(spark: SparkSession, path: str):
    """Fold the finished batches of `stream_unique` into one layer, without repeated rows."""
    return merge_layers(spark, path, _distinct_by_month, ("kind", "block_month"), gathered=True)


def stream_edges(
    transactions: DataFrame, path: str, checkpoint: str, granularity: str = "week"
):
    """Start a run that stores the edge sums of every batch; returns the query.

    A batch that runs again after a crash replaces its own sums.
    """
    use_utc(transactions.sparkSession)

    def store(batch, number):
        write_layer(edge_parts(batch, granularity), path, batch_layer(number))

    return (
        transactions.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edges of everything stored so far, open periods included."""
    return fold_parts(_read_kinds(spark, path))


def merge_stream_edges(spark: SparkSession, path: str):
    """Fold the sums of the finished batches into one layer."""
    return merge_layers(spark, path, add_parts)


def stream_weeks(
    transactions: DataFrame, path: str, checkpoint: str, delay: str = "14 days"
):
    """Start a run that keeps the edges of open weeks in the state store; returns the query.

    Weeks are event-time windows from Monday to Monday. Every batch stores the new totals of
    the edges it changed; a week is let go once the watermark has passed its end. Rows that
    come after that are stored as late sums, which reading adds. Rows without time are late.
    """
    spark = transactions.sparkSession
    use_utc(spark)
    keyed = edge_keys(transactions)
    week = F.window("block_timestamp", "7 days", "7 days", "4 days").alias("week")
    sums = [F.count(F.lit(1)).alias("tx_count"), *limb_sums(F.col("_padded"), "limb_")]
    open_weeks = keyed.withWatermark("block_timestamp", delay).groupBy(week, "src", "dst").agg(*sums)
    totals = open_weeks.select(
        F.lit("total").alias("kind"),
        F.col("week.start").cast("timestamp").alias("block_timestamp"),
        "src",
        "dst",
        "tx_count",
        F.struct(*(c for c in open_weeks.columns if c.startswith("limb_"))).alias("limbs"),
        F.lit(None).cast("string").alias("_padded"),
    )
    no_limbs = F.lit(None).cast(totals.schema["limbs"].dataType)
    rows = keyed.select(
        F.lit("late").alias("kind"),
        "block_timestamp",
        "src",
        "dst",
        F.lit(1).cast("long").alias("tx_count"),
        no_limbs.alias("limbs"),
        "_padded",
    )

    def store(batch, number):
        start = period_start(F.col("block_timestamp"), "week")
        ended = F.unix_micros((F.date_add(start, 7)).cast("timestamp"))
        behind = F.col("block_timestamp").isNull() | (
            ended <= _watermark_before(spark, checkpoint, number)
        )
        group = ("kind", "src", "dst", F.col("week_start"))
        dated = batch.withColumn("week_start", start).withColumn("batch", F.lit(number).cast("long"))
        new = dated.filter("kind = 'total'").select(*group, "batch", "tx_count", "limbs.*")
        late = dated.filter((F.col("kind") == "late") & behind).groupBy(*group)
        late = late.agg(F.lit(number).cast("long").alias("batch"), *sums)
        write_layer(new.unionByName(late), path, batch_layer(number), ("kind",))

    return (
        totals.unionByName(rows)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _fold_weeks(rows):
    """The newest totals of every edge, and the sums of its late rows."""
    limbs = [c for c in rows.columns if c.startswith("limb_")]
    key, values = ("kind", "src", "dst", "week_start"), ("batch", "tx_count", *limbs)
    newest = rows.filter("kind = 'total'").groupBy(*key).agg(F.max(F.struct(*values)).alias("v"))
    newest = newest.select(*key, "v.*")
    late = rows.filter("kind = 'late'").groupBy(*key)
    late = late.agg(F.max("batch").alias("batch"), *(F.sum(c).alias(c) for c in values[1:]))
    return newest.unionByName(late)


def read_weeks(spark: SparkSession, path: str) -> DataFrame:
    """Edges of everything stored so far by `stream_weeks`, late rows and open weeks included."""
    return fold_parts(_fold_weeks(_read_kinds(spark, path)))


def merge_weeks(spark: SparkSession, path: str):
    """Fold the finished batches of `stream_weeks` into one layer."""
    return merge_layers(spark, path, _fold_weeks, ("kind",))
