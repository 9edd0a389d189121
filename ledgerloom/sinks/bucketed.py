"""Tables bucketed and sorted by a key: joins and groups on it need no shuffle of them.

Spark keeps the bucket layout in its catalog, not in the files. A reader states it again, so
a table can be read in any session by its path.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession, types as T


def _name(path: str) -> str:
    return "ledgerloom_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(rows: DataFrame, path: str, column: str, buckets: int) -> None:
    """Write to a new path, a file a bucket, rows sorted by `column`."""
    spark, name = rows.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = rows.repartition(buckets, column)
    writer = dealt.write.bucketBy(buckets, column).sortBy(column).option("compression", "zstd")
    writer.option("path", path).format("parquet").saveAsTable(name)


def read_bucketed(
    spark: SparkSession, path: str, schema: str | T.StructType, column: str, buckets: int
) -> DataFrame:
    """A table of `write_bucketed`, with its layout known to Spark."""
    layout = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(_name(path))
