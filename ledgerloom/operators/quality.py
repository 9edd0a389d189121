"""Size verdicts, table status and counts."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class ScaleLimits:
    # Default limits and targets of a graph.
    max_nodes: int = 500_000
    max_edges: int = 50_000_000
    min_nodes_target: int = 50_000
    min_edges_target: int = 1_000_000


class ScaleExceeded(ValueError):
    pass


def verdict(count, maximum, target, strict: bool):
    """exceeded (strict) or warning above the maximum, below_target, else ok."""
    return (
        F.when(count > maximum, "exceeded" if strict else "warning")
        .when(count < target, "below_target")
        .otherwise("ok")
    )


def node_verdict(nodes: DataFrame, limits=ScaleLimits(), strict: bool = False) -> DataFrame:
    return _verdict_row(nodes, "nodes", limits.max_nodes, limits.min_nodes_target, strict)


def edge_verdict(edges: DataFrame, limits=ScaleLimits(), strict: bool = False) -> DataFrame:
    return _verdict_row(edges, "edges", limits.max_edges, limits.min_edges_target, strict)


def counterparty_verdict(
    counterparties: DataFrame, limits=ScaleLimits(), strict: bool = False
) -> DataFrame:
    return _verdict_row(counterparties, "counterparties", limits.max_nodes, 0, strict)


def _verdict_row(df, subject, maximum, target, strict):
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        F.lit(subject).alias("subject"),
        "n_rows",
        verdict(F.col("n_rows"), F.lit(maximum), F.lit(target), strict).alias("verdict"),
    )


def scale_report(
    nodes: DataFrame | None,
    edges: DataFrame | None,
    limits=ScaleLimits(),
    strict: bool = False,
) -> DataFrame:
    """Verdict rows for nodes and edges; a missing table counts 0 rows."""
    spark = SparkSession.active() if nodes is None and edges is None else (
        nodes if nodes is not None else edges
    ).sparkSession
    nothing = spark.range(0)
    return node_verdict(nothing if nodes is None else nodes, limits, strict).unionByName(
        edge_verdict(nothing if edges is None else edges, limits, strict)
    )


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a verdict row says exceeded; the report has one row per table."""
    for row in report.collect():
        if row["verdict"] == "exceeded":
            raise ScaleExceeded(f"{row['subject']}: {row['n_rows']} rows exceed the limit")
    return report


def contract_counts(nodes: DataFrame) -> DataFrame:
    """One row: addresses, contracts, other accounts, hubs."""
    return nodes.agg(
        F.count(F.lit(1)).alias("n_addresses"),
        F.count_if("is_contract").alias("n_contracts"),
        F.count_if(~F.col("is_contract")).alias("n_accounts"),
        F.count_if(F.col("node_type") == "hub").alias("n_hubs"),
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def table_status(
    spark: SparkSession, tables: dict[str, str], metadata: dict[str, str] | None = None
) -> DataFrame:
    """One row per table and metadata file: exists, record count, size in KB.

    Counts come from Parquet footers; sizes from the file listing, without file contents.
    """
    layout = "name string, kind string, found boolean, n_records bigint, size_kb bigint"
    report = None
    for kind, paths in (("table", tables), ("metadata", metadata or {})):
        for name, path in paths.items():
            if not table_exists(spark, path):
                row = spark.createDataFrame([(name, kind, False, None, None)], layout)
            else:
                row = _present_row(spark, name, kind, path)
            report = row if report is None else report.unionByName(row)
    return report


def _present_row(spark, name, kind, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = files.filter("path like '%.parquet' or path like '%.json'").agg(
        F.call_function("div", F.coalesce(F.sum("length"), F.lit(0)), F.lit(1024)).alias("size_kb")
    )
    if kind == "table":
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_records"))
    else:
        rows = spark.read.text(path).agg(F.count(F.lit(1)).alias("n_records"))
    return rows.select(
        F.lit(name).alias("name"),
        F.lit(kind).alias("kind"),
        F.lit(True).alias("found"),
        "n_records",
        size.scalar().alias("size_kb"),
    )
