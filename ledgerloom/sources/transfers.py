"""Landed transfer pages (JSON), as a batch or as a stream.

A line that is no page, an empty place in a page's list and a value that is no number stay
in the frame with a reason in `malformed`, so that cleaning can reject and count them.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.times import hex_quantity
from ledgerloom.schemas import CORRUPT, TRANSFER_PAGE


def _reader(reader):
    return reader.schema(TRANSFER_PAGE).option("columnNameOfCorruptRecord", CORRUPT)


def read_transfer_pages(spark: SparkSession, path: str) -> DataFrame:
    return explode_pages(_reader(spark.read).json(path))


def stream_transfer_pages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Pages as they land. With `spread` they are parsed by that many tasks, however few files a
    batch has and whether or not these can be cut."""
    reader = spark.readStream if spread else _reader(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not spread:
        return explode_pages(reader.json(path))
    return explode_pages(parse_lines(reader.text(path).repartition(spread, F.xxhash64("value"))))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Pages from lines of text (`value`), as the JSON reader has them; a blank line is all null,
    which has no rows. A filter here would go below a shuffle and parse every line there too.

    A list of pages in one line, which the JSON reader takes apart, is a page that cannot be read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    page = F.from_json("value", TRANSFER_PAGE, options)
    return lines.select(page.alias("page")).select("page.*")


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per transfer, with the query (`address`, `direction`) its page answers.

    A page that cannot be read is one row with its text in `raw` and no transfer: reading
    it in part could lose a transfer unseen. A page with an empty list has no rows.
    """
    broken = F.col(CORRUPT).isNotNull()
    listed = F.when(~broken, F.col("transfers"))
    each = pages.select(
        "address", "direction", F.col(CORRUPT).alias("raw"), F.posexplode_outer(listed).alias("n", "t")
    ).filter("n is not null or raw is not null")
    number = F.expr("try_cast(t.value as double)")
    malformed = (
        F.when(F.col("raw").isNotNull(), "malformed_page")
        .when(F.col("t").isNull(), "malformed_transfer")
        .when(F.col("t.value").isNotNull() & number.isNull(), "malformed_value")
    )
    return each.select(
        "address",
        "direction",
        "t.hash",
        "t.from",
        "t.to",
        number.alias("value"),
        "t.asset",
        "t.category",
        hex_quantity(F.col("t.blockNum")).alias("block_number"),
        F.col("t.metadata.blockTimestamp").alias("block_timestamp"),
        F.col("t.valueWei").alias("value_wei_text"),
        malformed.alias("malformed"),
        F.coalesce("raw", F.when(malformed.isNotNull(), F.to_json("t"))).alias("raw"),
    )
