"""Helpers of the operators: inputs as bytes, shared intermediate tables, label splits."""

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.bitmaps import bitmap_of, with_hit
from ledgerloom.session import use_utc, write_scratch

#: Rows of one Arrow batch; whole texts can be long.
BATCH_ROWS = 1024
_STORE = "_ledgerloom_llm_process"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the registered queries: UTC and Arrow batches of few rows."""
    use_utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front while `df` has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(column: str) -> Column:
    """A text column as its UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from there."""
    return write_scratch(df, name)


def parted(rows: DataFrame, hashed: Column, losers: DataFrame, losing: Column):
    """`rows` in two: those that are no losers for certain, and those that have to be looked at.

    Losers are known by a hash that rows have as well. Only their part, and a few rows that hit
    the bitmap by chance, goes to the second frame, so whole texts of all others stay where
    they are. `rows` is read twice.
    """
    name = free_name(rows, "may_lose")
    bitmap = bitmap_of(losers, losing, losers.count())
    marked = with_hit(rows, hashed, bitmap, name)
    return marked.filter(~F.col(name)).drop(name), marked.filter(name).drop(name)


def held_out(column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves remainder 2 modulo 4. A null id is never held out."""
    rest = F.crc32(F.col(column).cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def training_labels(labels: DataFrame, target: str, max_rows: int, seed: int = 11) -> DataFrame:
    """(doc_id, label) to learn from: labeled, not held out, about `max_rows` rows at most.

    Repeated ids count once (label 1 if most of their labels are 1). Beyond `max_rows`
    a hash of the id chooses rows with equal chance, so the bound holds in expectation.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    known = known.filter(~held_out()).groupBy("doc_id")
    known = known.agg((F.avg(F.col(target).cast("double")) >= 0.5).cast("int").alias("label"))
    known = keep(known, f"labels-{target}")
    n = known.count()
    if n <= max_rows:
        return known
    share = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000))
    return known.filter(share < int(1_000_000 * max_rows / n))


def kept_in_process(key, make):
    """`make()`, once for each key in a worker process.

    Modules of this folder travel by value, so their globals begin anew in every task; what a
    process keeps lies in a module of its own that only `sys.modules` knows.
    """
    store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
