"""Queries on edges and nodes, table readers and writers, and the stages."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ledgerloom.functions.times import format_rfc3339
from ledgerloom.operators import labeling, nodes, quality
from ledgerloom.operators.cleaning import (
    TRANSACTION_COLUMNS,
    classify_transfers,
    fill_recipient,
)
from ledgerloom.operators.edges import aggregate_edges, wide_sum
from ledgerloom.operators.keysets import key_set
from ledgerloom.plans import stages
from ledgerloom.session import scratch_path, shuffles_removed, write_scratch
from ledgerloom.sinks import metadata as run_notes
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import contracts, sanctions
from ledgerloom.sources import tables as sources
from ledgerloom.sources.transfers import read_transfer_pages
from workload.columns import wide_texts
from workload.flows import _SHOWN, shown, slice_of
from workload.keccak import checksum_sql
from workload.registry import query
from workload.standins import (
    PERCENTILE,
    check_sql,
    contract_addresses,
    customer_address,
    exchange_addresses,
    labeled_addresses,
    lines,
    named_sql,
    raw_transfers,
    status_rows,
    table,
    transactions,
)

_EDGE_SQL = (
    "SELECT src, dst, CAST(week_start AS VARCHAR) AS week_start, tx_count, total_value_wei "
    "FROM edges"
)


def dated(edges):
    """Edges with the date as text, as the check SQL shows it."""
    return edges.withColumn("week_start", F.col("week_start").cast("string"))


def edges_of(spark, sf_dir):
    return aggregate_edges(transactions(spark, sf_dir))


def write_edges_of(spark, sf_dir, path):
    edges = aggregate_edges(transactions(spark, sf_dir), ordered=True)
    sinks.write_edges(edges, path, ordered=True)


def labels_of(spark, sf_dir):
    return labeled_addresses(spark, sf_dir).select("address")


def _period_sql(unit):
    return check_sql(
        "SELECT from_address AS src, to_address AS dst, CAST(CAST(date_trunc('"
        + unit
        + "', block_timestamp) AS DATE) AS VARCHAR) AS week_start, count(tx_hash) AS tx_count, "
        "CAST(sum(CAST(value_wei AS HUGEINT)) AS VARCHAR) AS total_value_wei, "
        "arg_min(value_wei, (block_timestamp, tx_hash, value_wei)) AS sample_value "
        "FROM tx GROUP BY 1, 2, 3",
        "tx",
    )


@query("A1_weekly_edges", check_sql(_EDGE_SQL, "edges"))
def weekly_edges(spark, sf_dir):
    return dated(edges_of(spark, sf_dir))


@query("A2_daily_edges", _period_sql("day"))
def daily_edges(spark, sf_dir):
    return dated(aggregate_edges(transactions(spark, sf_dir), "day", sample=True))


@query("A2_weekly_edges_with_sample", _period_sql("week"))
def sampled_edges(spark, sf_dir):
    return dated(aggregate_edges(transactions(spark, sf_dir), "week", sample=True))


@query("A2_monthly_edges", _period_sql("month"))
def monthly_edges(spark, sf_dir):
    return dated(aggregate_edges(transactions(spark, sf_dir), "month", sample=True))


@query(
    "A1_capped_wide_sum",
    check_sql(
        "SELECT n, CASE WHEN high >= 18446744073709551616 THEN "
        "'340282366920938463463374607431768211455' ELSE CAST(CAST(high AS UHUGEINT) * "
        "CAST(18446744073709551616 AS UHUGEINT) + CAST(low AS UHUGEINT) AS VARCHAR) END AS total "
        "FROM (SELECT n, sum_high + sum_low // 18446744073709551616 AS high, "
        "sum_low % 18446744073709551616 AS low FROM ("
        "SELECT n, sum(CAST(amount // 18446744073709551616 AS HUGEINT)) AS sum_high, "
        "sum(CAST(amount % 18446744073709551616 AS HUGEINT)) AS sum_low FROM ("
        "SELECT l_linenumber AS n, CASE l_linenumber WHEN 5 THEN coalesce(TRY_CAST("
        "'34028236692093846346337460743' || lpad(CAST(cents * 100 AS VARCHAR), 10, '0') AS "
        "UHUGEINT), 0) WHEN 4 THEN CAST(CAST(cents AS VARCHAR) || repeat('9', 29) AS UHUGEINT) "
        "WHEN 1 THEN CAST(cents AS UHUGEINT) ELSE CAST(0 AS UHUGEINT) END AS amount FROM lines) "
        "GROUP BY n))",
        "lines",
    ),
)
def capped_sum(spark, sf_dir):
    texts = wide_texts(spark, sf_dir).withColumn(
        "n", F.substring_index("tx_hash", "-", -1).cast("int")
    )
    return wide_sum(texts, ["n"], "wide", "total")


@query(
    "A4_degrees",
    check_sql(
        "SELECT address, degree_in, degree_out FROM degrees "
        "WHERE degree_in + degree_out > 0",
        "degrees",
    ),
)
def edge_degrees(spark, sf_dir):
    return nodes.degrees(edges_of(spark, sf_dir))


@query(
    "A4_distinct_degrees",
    check_sql(
        "SELECT address, CAST(sum(i) AS BIGINT) AS degree_in, CAST(sum(o) AS BIGINT) AS "
        "degree_out FROM (SELECT src AS address, 0 AS i, 1 AS o FROM (SELECT DISTINCT src, dst "
        "FROM edges) UNION ALL SELECT dst, 1, 0 FROM (SELECT DISTINCT src, dst FROM edges)) "
        "GROUP BY address",
        "edges",
    ),
)
def distinct_degrees(spark, sf_dir):
    return nodes.degrees(edges_of(spark, sf_dir), mode="distinct")


@query("A5_hub_threshold", check_sql("SELECT threshold FROM threshold", "threshold"))
def threshold(spark, sf_dir):
    return nodes.hub_threshold(nodes.degrees(edges_of(spark, sf_dir)), PERCENTILE)


@query(
    "J6_degrees_with_labels",
    check_sql("SELECT address, degree_in, degree_out FROM degrees", "degrees"),
)
def labeled_degrees(spark, sf_dir):
    return nodes.degrees(edges_of(spark, sf_dir), labels_of(spark, sf_dir))


@query(
    "U5_all_addresses",
    check_sql(
        "SELECT src AS address FROM edges UNION SELECT dst FROM edges "
        "UNION SELECT address FROM labeled",
        "edges",
        "labeled",
    ),
)
def all_addresses(spark, sf_dir):
    return nodes.degrees(edges_of(spark, sf_dir), labels_of(spark, sf_dir)).select("address")


@query(
    "J7_contract_list",
    check_sql(
        "SELECT d.address, c.address IS NOT NULL AS is_contract FROM degrees d "
        "LEFT JOIN contracts c ON d.address = c.address",
        "degrees",
        "contracts",
    ),
)
def list_lookup(spark, sf_dir):
    every = nodes.degrees(edges_of(spark, sf_dir), labels_of(spark, sf_dir)).select("address")
    return nodes.resolve_contracts(every, known=contract_addresses(spark, sf_dir))


_LATEST_SQL = (
    "(SELECT address, arg_max(is_contract, resolved_at) AS is_contract FROM status GROUP BY 1)"
)


@query(
    "J8_contract_status",
    check_sql(
        "SELECT d.address, coalesce(CAST(s.is_contract AS VARCHAR), 'unknown') AS is_contract "
        f"FROM degrees d LEFT JOIN {_LATEST_SQL} s "
        "ON d.address = s.address",
        "degrees",
        "status",
    ),
)
def status_lookup(spark, sf_dir):
    found = F.coalesce(F.col("is_contract").cast("string"), F.lit("unknown"))
    return resolved_by_status(spark, sf_dir).withColumn("is_contract", found)


def resolved_by_status(spark, sf_dir):
    every = nodes.degrees(edges_of(spark, sf_dir), labels_of(spark, sf_dir)).select("address")
    return nodes.resolve_contracts(every, status=status_rows(spark, sf_dir))


@query(
    "J8_unresolved_addresses",
    check_sql(
        "SELECT address FROM degrees WHERE address NOT IN (SELECT address FROM status)",
        "degrees",
        "status",
    ),
)
def unresolved(spark, sf_dir):
    return nodes.unresolved_addresses(resolved_by_status(spark, sf_dir))


_NODE_SQL = "SELECT address, is_contract, degree_in, degree_out, node_type FROM nodes"


def nodes_of(spark, sf_dir):
    return nodes.build_nodes(
        edges_of(spark, sf_dir),
        labels_of(spark, sf_dir),
        known=contract_addresses(spark, sf_dir),
        percentile=PERCENTILE,
    )


@query("C5_build_nodes", check_sql(_NODE_SQL, "nodes"))
def node_table(spark, sf_dir):
    return nodes_of(spark, sf_dir)


@query(
    "A6_contract_counts",
    check_sql(
        "SELECT count(*) AS n_addresses, count(*) FILTER (is_contract) AS n_contracts, "
        "count(*) FILTER (NOT is_contract) AS n_accounts, "
        "count(*) FILTER (node_type = 'hub') AS n_hubs FROM nodes",
        "nodes",
    ),
)
def counts(spark, sf_dir):
    return quality.contract_counts(nodes_of(spark, sf_dir))


def _verdict_sql(subject, source, maximum, target, word):
    return (
        f"SELECT '{subject}' AS subject, count(*) AS n_rows, CASE WHEN count(*) > {maximum} THEN "
        f"'{word}' WHEN count(*) < {target} THEN 'below_target' ELSE 'ok' END AS verdict "
        f"FROM {source}"
    )


@query("V1_node_verdict", check_sql(_verdict_sql("nodes", "nodes", 1000, 50000, "warning"), "nodes"))
def node_limit(spark, sf_dir):
    return quality.node_verdict(nodes_of(spark, sf_dir), quality.ScaleLimits(max_nodes=1000))


@query(
    "V2_edge_verdict",
    check_sql(_verdict_sql("edges", "edges", 50000000, 1000000, "warning"), "edges"),
)
def edge_limit(spark, sf_dir):
    return quality.edge_verdict(edges_of(spark, sf_dir))


@query(
    "V3_scale_report",
    check_sql(
        _verdict_sql("nodes", "nodes", 500000, 50000, "exceeded")
        + " UNION ALL "
        + _verdict_sql("edges", "edges", 10000, 1000000, "exceeded"),
        "nodes",
        "edges",
    ),
)
def scale(spark, sf_dir):
    limits = quality.ScaleLimits(max_edges=10_000)
    return quality.scale_report(
        nodes_of(spark, sf_dir), edges_of(spark, sf_dir), limits, strict=True
    )


@query("O3_edges_in_order", check_sql(_EDGE_SQL + " ORDER BY 1, 2, 3", "edges"))
def ordered_edges(spark, sf_dir):
    return dated(edges_of(spark, sf_dir).orderBy("src", "dst", "week_start"))


@query("O4_nodes_in_order", check_sql(_NODE_SQL + " ORDER BY address", "nodes"))
def ordered_nodes(spark, sf_dir):
    return nodes_of(spark, sf_dir).orderBy("address")


@query("O1_labels_in_order", check_sql("SELECT address FROM labeled ORDER BY 1", "labeled"))
def ordered_labels(spark, sf_dir):
    return labels_of(spark, sf_dir).orderBy("address")


# Readers: stored tables with missing and malformed cells.


def stored_labels(spark, sf_dir):
    number = F.col("number")
    raw = labeled_addresses(spark, sf_dir).select(
        F.when(number % 17 != 0, F.col("address")).alias("address"),
        F.when(number % 7 != 0, F.lit(1)).alias("label"),
        F.when(number % 5 != 0, "list").alias("label_source"),
        F.concat(F.lit("u"), number.cast("string")).alias("source_url"),
        F.when(number % 3 != 0, "2024-05-01T00:00:00+00:00")
        .otherwise("yesterday")
        .alias("retrieved_at"),
    )
    path = scratch_path(spark, "labels")
    raw.write.parquet(path)
    return path


@query(
    "S1_read_labels",
    check_sql(
        "SELECT CASE WHEN number % 17 <> 0 THEN address ELSE '' END AS address, "
        "CASE WHEN number % 7 <> 0 THEN 1 ELSE 0 END AS label, "
        "CASE WHEN number % 5 <> 0 THEN 'list' ELSE '' END AS label_source, "
        "'u' || number AS source_url, CASE WHEN number % 3 <> 0 THEN "
        "'2024-05-01T00:00:00+00:00' END AS retrieved_at FROM labeled",
        "labeled",
    ),
)
def read_labels(spark, sf_dir):
    labels = sources.read_labels(spark, stored_labels(spark, sf_dir))
    return labels.withColumn("retrieved_at", format_rfc3339(F.col("retrieved_at")))


def stored_transactions(spark, sf_dir):
    raw = raw_transfers(spark, sf_dir).select(
        F.col("hash").alias("tx_hash"),
        "block_timestamp",
        F.nullif("from", F.lit("")).alias("from_address"),
        F.col("to").alias("to_address"),
        F.col("value_wei_text").alias("value_wei"),
    )
    path = scratch_path(spark, "transactions")
    raw.write.option("compression", "zstd").parquet(path)
    return path


@query(
    "S2_read_transactions",
    check_sql(
        "SELECT hash AS tx_hash, CASE WHEN block_timestamp <> 'soon' THEN block_timestamp END "
        "AS stamp, \"from\" AS from_address, coalesce(\"to\", '') AS to_address, "
        "coalesce(value_wei_text, '') AS value_wei FROM raw",
        "raw",
    ),
)
def read_transactions(spark, sf_dir):
    return shown(sources.read_transactions(spark, stored_transactions(spark, sf_dir)))


@query(
    "S3_scan_transactions",
    check_sql(
        "SELECT \"from\" AS from_address, count(*) AS n_rows FROM raw WHERE value_wei_text IS NOT "
        "NULL AND block_timestamp >= '1998' AND \"from\" <> '' GROUP BY 1",
        "raw",
    ),
)
def scan_transactions(spark, sf_dir):
    scan = sources.scan_transactions(spark, stored_transactions(spark, sf_dir))
    kept = scan.filter(
        "value_wei is not null and block_timestamp >= '1998' and from_address is not null"
    )
    return kept.groupBy("from_address").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "S4_read_edges",
    check_sql(
        "SELECT src, dst, CASE WHEN day(week_start) = 1 THEN '1970-01-01' ELSE CAST(week_start AS "
        "VARCHAR) END AS week_start, CASE WHEN day(week_start) = 2 THEN 0 ELSE tx_count END AS tx_count, "
        "total_value_wei FROM edges",
        "edges",
    ),
)
def read_edges(spark, sf_dir):
    day = F.dayofmonth("week_start")
    raw = edges_of(spark, sf_dir).withColumns(
        {
            "tx_count": F.when(day != 2, F.col("tx_count")),
            "week_start": F.when(day == 1, "no date").otherwise(
                F.col("week_start").cast("string")
            ),
        }
    )
    path = scratch_path(spark, "edges")
    raw.write.parquet(path)
    return dated(sources.read_edges(spark, path))


@query(
    "S5_read_nodes",
    check_sql(
        "SELECT address, is_contract AND degree_in % 3 <> 0 AS is_contract, CASE WHEN degree_in "
        "% 5 = 0 THEN 0 ELSE degree_in END AS degree_in, degree_out, CASE WHEN degree_in % 7 = 0 "
        "THEN 'eoa' ELSE node_type END AS node_type FROM nodes",
        "nodes",
    ),
)
def read_nodes(spark, sf_dir):
    count = F.col("degree_in")
    raw = nodes_of(spark, sf_dir).withColumns(
        {
            "is_contract": F.when(count % 3 != 0, F.col("is_contract")),
            "degree_in": F.when(count % 5 != 0, count),
            "node_type": F.when(count % 7 == 0, "whale").otherwise(F.col("node_type")),
        }
    )
    path = scratch_path(spark, "nodes")
    raw.write.parquet(path)
    return sources.read_nodes(spark, path)


@query(
    "S6_read_chunks",
    check_sql(
        "SELECT origin_rank, tx_hash, strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') AS "
        "block_timestamp, from_address, to_address, value_wei FROM (SELECT 0 AS origin_rank, * "
        "EXCLUDE (from_hit, to_hit) FROM touched UNION ALL SELECT 1, * FROM tx)",
        "touched",
    ),
)
def read_chunks(spark, sf_dir):
    part = slice_of(spark, sf_dir)
    labeled, chunks = scratch_path(spark, "labeled"), scratch_path(spark, "chunks")
    stored = "tx_hash", "cast(block_timestamp as string)", "from_address", "to_address", "value_wei"
    part.transfers.selectExpr(*stored).write.parquet(labeled)
    by_year = transactions(spark, sf_dir).withColumn("chunk", F.year("block_timestamp"))
    by_year.selectExpr(*stored, "chunk").write.partitionBy("chunk").parquet(chunks)
    frames = sources.read_chunks(spark, labeled, chunks)
    frames += sources.read_chunks(spark, labeled + "-missing", None)
    return sources.ranked_chunks(frames).select("origin_rank", *TRANSACTION_COLUMNS)


@query("S7_contract_list", check_sql("SELECT DISTINCT address FROM contracts", "contracts"))
def contract_list(spark, sf_dir):
    folder = scratch_path(spark, "contracts")
    rows = contract_addresses(spark, sf_dir).select(
        F.inline(
            F.array(
                F.struct(F.concat(F.upper("address"), F.lit(",2020"))),
                F.struct(F.concat(F.lit(" "), F.col("address"), F.lit(" ,x"))),
                F.struct(F.concat(F.substring("address", 1, 41), F.lit(",short"))),
                F.struct(F.lit("address,created")),
            )
        ).alias("value")
    )
    rows.write.option("compression", "none").format("csv").option("quote", "").option(
        "sep", "\t"
    ).save(folder)
    return contracts.read_contract_list(spark, folder)


@query("S8_status_table", check_sql(f"SELECT * FROM {_LATEST_SQL}", "status"))
def latest(spark, sf_dir):
    path = scratch_path(spark, "status")
    sinks.append_status(status_rows(spark, sf_dir), path)
    newest = nodes.latest_status(contracts.read_status_table(spark, path))
    return newest.select(F.col("key").alias("address"), "is_contract")


@query(
    "S8_status_cache",
    check_sql(
        "SELECT address, arg_max(is_contract, resolved_at) AS is_contract FROM status GROUP BY 1",
        "status",
    ),
)
def cache_file(spark, sf_dir):
    # Sorted by time over all part files, so the last line of an address is its newest.
    path = scratch_path(spark, "cache")
    flag = F.when(F.col("is_contract"), "1").otherwise("0")
    ordered = status_rows(spark, sf_dir).orderBy("resolved_at", "address")
    ordered.select(F.concat_ws(",", "address", flag).alias("value")).write.text(path)
    return contracts.read_status_cache(spark, path)


def landed_pages(spark, sf_dir, compression="gzip"):
    """Transfer pages as JSON files, one page per order line with the transfer and a token move.

    Compressed pages take a twelfth of the disk. Such a file is read by one task, so none has
    more than a million pages; plain ones are cut where they are read.
    """
    raw = raw_transfers(spark, sf_dir)

    def transfer(category):
        return F.struct(
            "hash",
            "from",
            "to",
            "value",
            "asset",
            category.alias("category"),
            F.concat(F.lit("0x"), F.lower(F.hex("block_number"))).alias("blockNum"),
            F.struct(F.col("block_timestamp").alias("blockTimestamp")).alias("metadata"),
            F.col("value_wei_text").alias("valueWei"),
        )

    pages = raw.select(
        "address",
        "direction",
        F.array(transfer(F.col("category")), transfer(F.lit("erc721"))).alias("transfers"),
        F.when(F.col("block_number") % 2 == 0, "next").alias("pageKey"),
    )
    path = scratch_path(spark, "pages")
    sizes = {} if compression == "none" else {"maxRecordsPerFile": 1_000_000}
    with shuffles_removed(spark):
        pages.write.options(compression=compression, **sizes).json(path)
    # Lines that end too early, and transfers whose value is no number.
    order = table(spark, sf_dir, "orders")
    cut = order.filter("o_orderkey % 97 = 0").select(
        F.concat(F.lit('{"address": "0x'), F.col("o_orderkey"), F.lit('", "transfers": [{"hash": "'))
    )
    odd = order.filter("o_orderkey % 89 = 0").select(
        F.format_string(
            '{"address": "0xa", "direction": "from", "transfers": [{"hash": "odd-%d", "from": "0xa", '
            '"to": "0xb", "value": "oops", "category": "external", "blockNum": "0x10"}]}',
            "o_orderkey",
        )
    )
    for lines_of in (cut, odd):
        lines_of.toDF("value").write.mode("append").option("compression", compression).text(path)
    return path


# What the defective lines become.
LANDED_DEFECTS = """
SELECT CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS direction,
  CAST(NULL AS VARCHAR) AS hash, CAST(NULL AS VARCHAR) AS "from", CAST(NULL AS VARCHAR) AS "to",
  CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS block_number,
  'malformed_page' AS malformed
FROM orders WHERE o_orderkey % 97 = 0
UNION ALL SELECT '0xa', 'from', 'odd-' || o_orderkey, '0xa', '0xb', 'external', 16, 'malformed_value'
FROM orders WHERE o_orderkey % 89 = 0"""


@query(
    "S9_landed_transfers",
    check_sql(
        "SELECT address, direction, hash, \"from\", \"to\", value, asset, c AS category, "
        "block_number, block_timestamp, value_wei_text, NULL AS malformed FROM raw, "
        "LATERAL (SELECT unnest([category, 'erc721']) AS c) UNION ALL SELECT address, direction, "
        'hash, "from", "to", NULL, NULL, category, block_number, NULL, NULL, malformed '
        f"FROM ({LANDED_DEFECTS})",
        "raw",
    ),
)
def landed(spark, sf_dir):
    return read_transfer_pages(spark, landed_pages(spark, sf_dir)).drop("raw")


# Sanctions documents written from customers: SDN XML, advanced XML, CSV.


def sanction_documents(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    address, kind = customer_address("c_custkey"), F.col("c_nationkey") % 4
    number = (
        F.when(F.col("c_custkey") % 3 == 0, F.upper(F.substring(address, 3, 40)))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("ETH "), address, F.lit(";")))
        .otherwise(address)
    )
    id_type = (
        F.when(kind == 0, "Digital Currency Address - ETH")
        .when(kind == 1, "Passport")
        .when(kind == 2, "Crypto wallet")
        .otherwise("Tax ID")
    )
    sdn, advanced, flat = (scratch_path(spark, n) for n in ("sdn", "advanced", "flat"))
    entry = customer.select(
        F.col("c_custkey").alias("uid"),
        F.lit("Individual").alias("sdnType"),
        F.struct(
            F.array(
                F.struct(id_type.alias("idType"), number.alias("idNumber")),
                F.struct(F.lit("Gender").alias("idType"), F.lit("Male").alias("idNumber")),
            ).alias("id")
        ).alias("idList"),
    )
    entry.write.format("xml").option("rootTag", "sdnList").option("rowTag", "sdnEntry").save(sdn)
    supplier = table(spark, sf_dir, "supplier")
    wallet = F.lower(F.hex(F.col("s_suppkey") + 1_000_000))
    feature_type = (
        F.when(F.col("s_nationkey") % 3 == 0, "Digital Currency Address - ETH")
        .when(F.col("s_nationkey") % 3 == 1, "Ethereum")
        .otherwise("Website")
    )
    party = supplier.select(
        F.array(
            F.struct(
                feature_type.alias("FeatureType"),
                F.array(
                    F.struct(
                        F.concat(F.lit("0x"), F.lpad(wallet, 40, "0")).alias("DetailValue")
                    ),
                    F.struct(F.lit("none").alias("DetailValue")),
                ).alias("VersionDetail"),
            )
        ).alias("Feature")
    )
    party.write.format("xml").option("rootTag", "Sanctions").option(
        "rowTag", "DistinctParty"
    ).save(advanced)
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.col("o_orderkey"), F.lit("SDN"), customer_address("o_custkey"))
    )
    rows.toDF("value").write.text(flat)
    return [(advanced, "advanced_xml"), (sdn, "sdn_xml"), (flat, "csv")]


_ALL_FOUND_SQL = """
SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key FROM customer
UNION SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0') FROM supplier
UNION SELECT '0x' || lpad(lower(to_hex(o_custkey + 1)), 40, '0') FROM orders"""


@query("S10_sanction_sources", f"SELECT DISTINCT key FROM ({_ALL_FOUND_SQL})")
def sanction_sources(spark, sf_dir):
    documents = [*sanction_documents(spark, sf_dir), ("/nowhere/missing.csv", "csv")]
    return labeling.validate_and_dedupe(
        sanctions.read_sanctions(spark, documents).select("raw_address")
    )


@query(
    "S10_strict_sources",
    """
SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key FROM customer
  WHERE c_nationkey % 4 IN (0, 2)
UNION SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0') FROM supplier
  WHERE s_nationkey % 3 IN (0, 1)
UNION SELECT '0x' || lpad(lower(to_hex(o_custkey + 1)), 40, '0') FROM orders""",
)
def strict_sources(spark, sf_dir):
    found = sanctions.read_sanctions(spark, sanction_documents(spark, sf_dir), strict=True)
    return labeling.validate_and_dedupe(found.select("raw_address"))


def broken_sdn(spark, sf_dir):
    """An SDN document with a customer an entry, of which many are broken in four ways."""
    key, address = F.col("c_custkey"), customer_address("c_custkey")
    kind = F.when(F.col("c_nationkey") % 4 == 0, "Digital Currency Address - ETH").otherwise("Tax ID")
    entry = F.concat(
        F.when(key % 11 == 2, "<sdnEntry <uid>").otherwise("<sdnEntry><uid>"),
        F.when(key % 11 == 3, "n").otherwise(""),
        key,
        F.lit("</uid><idList><id><idType>"),
        kind,
        F.when(key % 11 == 4, "</idNumber>").otherwise("</idType>"),
        F.lit("<idNumber>"),
        address,
        F.lit("</idNumber></id></idList>"),
        F.when(key % 11 == 5, "</sdnEntr>").otherwise("</sdnEntry>"),
    )
    path = scratch_path(spark, "broken-sdn")
    table(spark, sf_dir, "customer").select(entry.alias("value")).write.text(path)
    return path


@query(
    "S10_sanction_rejects",
    "SELECT CASE c_custkey % 11 WHEN 2 THEN 'malformed_tag' WHEN 5 THEN 'unclosed_entry' ELSE "
    "'malformed_entry' END AS reject_reason, '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key "
    "FROM customer WHERE c_custkey % 11 IN (2, 3, 4, 5) UNION ALL SELECT 'missing_source', NULL",
)
def sanction_rejects(spark, sf_dir):
    listed = [(broken_sdn(spark, sf_dir), "sdn_xml"), ("/nowhere/missing.xml", "advanced_xml")]
    rejects = sanctions.read_sanction_rejects(spark, listed)
    key = F.nullif(F.regexp_extract("raw", "0x[0-9a-f]{40}", 0), F.lit(""))
    return rejects.select("reject_reason", key.alias("key"))


@query(
    "S10_broken_strict_source",
    "SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key FROM customer "
    "WHERE c_nationkey % 4 = 0 AND c_custkey % 11 NOT IN (2, 3, 4, 5)",
)
def broken_strict_source(spark, sf_dir):
    found = sanctions.read_sanctions(spark, [(broken_sdn(spark, sf_dir), "sdn_xml")], strict=True)
    return labeling.validate_and_dedupe(found.select("raw_address"))


@query(
    "C1_label_counts",
    "SELECT CASE c_custkey % 11 WHEN 2 THEN 'malformed_tag' WHEN 5 THEN 'unclosed_entry' WHEN 3 THEN "
    "'malformed_entry' WHEN 4 THEN 'malformed_entry' ELSE 'accepted' END AS outcome, "
    "count(*) AS n_entries FROM customer GROUP BY 1",
)
def label_counts(spark, sf_dir):
    names = ("labels", "rejects", "counts")
    labels, rejects, counts = (scratch_path(spark, n) for n in names)
    listed = [(broken_sdn(spark, sf_dir), "sdn_xml")]
    stages.extract_labels(spark, listed, labels, rejects_path=rejects, counts_path=counts)
    return spark.read.json(counts).select("outcome", "n_entries")


@query(
    "S11_sdn_identifiers",
    "SELECT c_custkey AS uid, CASE c_custkey % 3 WHEN 0 THEN lpad(to_hex(c_custkey + 1), 40, '0') "
    "WHEN 1 THEN 'ETH 0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') || ';' ELSE '0x' || "
    "lpad(lower(to_hex(c_custkey + 1)), 40, '0') END AS text FROM customer "
    "WHERE c_nationkey % 4 IN (0, 2)",
)
def sdn_ids(spark, sf_dir):
    path = dict((layout, p) for p, layout in sanction_documents(spark, sf_dir))["sdn_xml"]
    return labeling.sdn_identifiers(sanctions.read_sdn_entries(spark, path), ["uid"])


@query(
    "S12_party_details",
    "SELECT text, count(*) AS n_rows FROM (SELECT unnest(['0x' || lpad(lower(to_hex(s_suppkey + "
    "1000000)), 40, '0'), 'none']) AS text FROM supplier WHERE s_nationkey % 3 IN (0, 1)) "
    "GROUP BY text",
)
def party_texts(spark, sf_dir):
    path = dict((layout, p) for p, layout in sanction_documents(spark, sf_dir))["advanced_xml"]
    details = labeling.party_details(sanctions.read_parties(spark, path))
    return details.groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "C1_extract_labels",
    checksum_sql(
        _ALL_FOUND_SQL,
        "SELECT checksum AS address, 1 AS label, 'OFAC_SDN' AS label_source, true AS has_url "
        "FROM checksums",
    ),
)
def label_stage(spark, sf_dir):
    path = scratch_path(spark, "labels")
    stages.extract_labels(spark, sanction_documents(spark, sf_dir), path)
    labels = sources.read_labels(spark, path)
    known = F.col("source_url").startswith("file:")
    return labels.select("address", "label", "label_source", known.alias("has_url"))


# Writers, read back with the readers.


@query(
    "K1_write_labels",
    check_sql(
        "SELECT address, 1 AS label, 'list' AS label_source, 'u' || number AS source_url, "
        "'2024-05-01T00:00:00+00:00' AS retrieved_at FROM labeled",
        "labeled",
    ),
)
def write_labels(spark, sf_dir):
    labels = labeled_addresses(spark, sf_dir).select(
        "address",
        F.lit(1).alias("label"),
        F.lit("list").alias("label_source"),
        F.concat(F.lit("u"), F.col("number").cast("string")).alias("source_url"),
        F.lit("2024-05-01T00:00:00Z").cast("timestamp").alias("retrieved_at"),
    )
    path = scratch_path(spark, "labels")
    sinks.write_labels(labels, path)
    return spark.read.schema(sources.LABELS_DISK).parquet(path)


@query("K2_write_transactions", check_sql(f"SELECT {_SHOWN} FROM uniq", "uniq"))
def write_transactions(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    sinks.write_transactions(transactions(spark, sf_dir), path)
    return shown(sources.read_transactions(spark, path))


@query("K3_write_edges", check_sql(_EDGE_SQL, "edges"))
def write_edges(spark, sf_dir):
    path = scratch_path(spark, "edges")
    write_edges_of(spark, sf_dir, path)
    return dated(sources.read_edges(spark, path))


@query("K4_write_nodes", check_sql(_NODE_SQL, "nodes"))
def write_nodes(spark, sf_dir):
    path = scratch_path(spark, "nodes")
    sinks.write_nodes(nodes_of(spark, sf_dir), path)
    return sources.read_nodes(spark, path)


@query(
    "K6_append_status",
    check_sql(
        "SELECT address, count(*) AS n_rows FROM status GROUP BY address",
        "status",
    ),
)
def append_status(spark, sf_dir):
    path = scratch_path(spark, "status")
    rows = status_rows(spark, sf_dir)
    old = F.col("resolved_at") < F.lit("1998-01-01").cast("timestamp")
    sinks.append_status(rows.filter(old), path)
    sinks.append_status(rows.filter(~old), path)
    stored = contracts.read_status_table(spark, path)
    return stored.groupBy("address").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "K7_run_metadata",
    check_sql(
        "SELECT '1.0.0' AS schema_version, (SELECT strftime(min(block_timestamp), "
        "'%Y-%m-%dT%H:%M:%S+00:00') FROM tx) AS window_start, (SELECT strftime("
        "max(block_timestamp), '%Y-%m-%dT%H:%M:%S+00:00') FROM tx) AS window_end, "
        "(SELECT count(*) FROM labeled) AS labeled_addresses, (SELECT count(*) FROM uniq) AS "
        "raw_transactions, (SELECT count(*) FROM edges) AS weekly_edges, CAST(0 AS BIGINT) AS "
        "nodes",
        "uniq",
        "edges",
        "labeled",
    ),
)
def metadata(spark, sf_dir):
    tx = write_scratch(transactions(spark, sf_dir), "rows")
    counts = {
        "labeled_addresses": labels_of(spark, sf_dir).count(),
        "raw_transactions": sinks.write_transactions(tx, scratch_path(spark, "transactions")),
        "weekly_edges": sinks.write_edges(aggregate_edges(tx), scratch_path(spark, "edges")),
    }
    first = tx.agg(F.min("block_timestamp")).scalar()
    last = tx.agg(F.max("block_timestamp")).scalar()
    path = scratch_path(spark, "run")
    run_notes.write_metadata(run_notes.run_metadata(spark, first, last, counts), path)
    return spark.read.json(path).select(
        "schema_version", "window_start", "window_end", "record_counts.*"
    )


@query(
    "A8_table_status",
    check_sql(
        "SELECT 'transactions' AS name, 'table' AS kind, true AS found, CAST((SELECT count(*) "
        "FROM uniq) AS VARCHAR) AS n_records UNION ALL SELECT 'edges', 'table', true, "
        "CAST((SELECT count(*) FROM edges) AS VARCHAR) "
        "UNION ALL SELECT 'nodes', 'table', false, 'none' "
        "UNION ALL SELECT 'nodes', 'metadata', false, 'none'",
        "uniq",
        "edges",
    ),
)
def status_of_tables(spark, sf_dir):
    paths = {n: scratch_path(spark, n) for n in ("transactions", "edges", "nodes")}
    tx = write_scratch(transactions(spark, sf_dir), "rows")
    sinks.write_transactions(tx, paths["transactions"])
    sinks.write_edges(aggregate_edges(tx), paths["edges"])
    report = quality.table_status(spark, paths, {"nodes": paths["nodes"] + "-notes"})
    counted = F.coalesce(F.col("n_records").cast("string"), F.lit("none"))
    return report.select("name", "kind", "found", counted.alias("n_records"))


# Stages.


def typed_transfers(spark, sf_dir):
    return transactions(spark, sf_dir).withColumn("rank_wei", F.col("value_wei"))


@query(
    "C3_expand_and_merge",
    checksum_sql(
        "SELECT from_address AS key FROM merged UNION ALL SELECT to_address FROM merged",
        "SELECT tx_hash, strftime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp, "
        "f.checksum AS from_address, t.checksum AS to_address, value_wei FROM merged "
        "JOIN checksums f ON from_address = f.key JOIN checksums t ON to_address = t.key",
        *named_sql("merged"),
    ),
)
def expand_stage(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    stages.expand_and_merge(
        write_scratch(typed_transfers(spark, sf_dir), "rows"),
        labeled_addresses(spark, sf_dir),
        path,
        k=5,
        exclude=key_set(exchange_addresses(spark, sf_dir)),
    )
    return shown(sources.read_transactions(spark, path))


@query(
    "C4_edges_stage",
    check_sql(
        "SELECT from_address AS src, to_address AS dst, CAST(CAST(date_trunc('week', "
        "block_timestamp) AS DATE) AS VARCHAR) AS week_start, count(*) AS tx_count, "
        "CAST(sum(CAST(value_wei AS HUGEINT)) AS VARCHAR) AS total_value_wei FROM uniq GROUP BY 1, 2, 3",
        "uniq",
    ),
)
def edge_stage(spark, sf_dir):
    stored, path = scratch_path(spark, "transactions"), scratch_path(spark, "edges")
    sinks.write_transactions(transactions(spark, sf_dir), stored)
    stages.edges_stage(spark, stored, path)
    return dated(sources.read_edges(spark, path))


@query(
    "C4_rejected_times",
    check_sql(
        "SELECT hash AS tx_hash, coalesce(\"from\", '') AS from_address FROM raw "
        "WHERE block_timestamp IS NULL OR block_timestamp = 'soon'",
        "raw",
    ),
)
def rejected_times(spark, sf_dir):
    path, rejects = scratch_path(spark, "edges"), scratch_path(spark, "rejects")
    stages.edges_stage(spark, stored_transactions(spark, sf_dir), path, rejects_path=rejects)
    return spark.read.parquet(rejects).select("tx_hash", "from_address")


def write_label_rows(spark, sf_dir, path):
    written = labeled_addresses(spark, sf_dir).select(
        "address",
        F.lit(1).alias("label"),
        F.lit("list").alias("label_source"),
        F.lit("u").alias("source_url"),
        F.lit("2024-05-01T00:00:00Z").cast("timestamp").alias("retrieved_at"),
    )
    sinks.write_labels(written, path)


@query(
    "C5_nodes_stage",
    check_sql(
        "SELECT d.address, coalesce(s.is_contract, false) AS is_contract, degree_in, degree_out, "
        "CASE WHEN degree_in + degree_out >= (SELECT threshold FROM threshold) THEN 'hub' "
        "WHEN coalesce(s.is_contract, false) THEN 'contract' ELSE 'eoa' END AS node_type "
        f"FROM degrees d LEFT JOIN {_LATEST_SQL} s ON d.address = s.address",
        "degrees",
        "threshold",
        "status",
    ),
)
def node_stage(spark, sf_dir):
    names = ("edges", "labels", "status", "nodes")
    edges, labels, status, path = (scratch_path(spark, n) for n in names)
    write_edges_of(spark, sf_dir, edges)
    write_label_rows(spark, sf_dir, labels)
    sinks.append_status(status_rows(spark, sf_dir), status)
    stages.nodes_stage(
        spark, edges, labels, path, status_path=status, percentile=PERCENTILE
    )
    return sources.read_nodes(spark, path)


# A whole run: one market segment is labeled, so its suppliers are counterparties to expand.

_RUN_SQL = named_sql("classified", "exchanges") + [
    "acc AS (SELECT * FROM classified WHERE reject_reason IS NULL)",
    "segment AS (SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS address "
    "FROM customer WHERE c_mktsegment = 'BUILDING')",
    "hits AS (SELECT a.*, f.address IS NOT NULL AS from_hit, t.address IS NOT NULL AS to_hit "
    "FROM acc a LEFT JOIN segment f ON from_address = f.address "
    "LEFT JOIN segment t ON to_address = t.address "
    "WHERE f.address IS NOT NULL OR t.address IS NOT NULL)",
    "sums AS (SELECT CASE WHEN from_hit THEN from_address ELSE to_address END AS labeled, "
    "CASE WHEN from_hit THEN to_address ELSE from_address END AS counterparty, "
    "sum(CAST(value_wei AS HUGEINT)) AS total FROM hits WHERE from_hit <> to_hit GROUP BY 1, 2)",
    "picked AS (SELECT DISTINCT counterparty AS address FROM (SELECT *, row_number() OVER "
    "(PARTITION BY labeled ORDER BY total DESC, counterparty) AS n FROM sums) WHERE n <= 2 "
    "AND counterparty NOT IN (SELECT address FROM exchanges))",
    "both_parts AS (SELECT tx_hash, block_timestamp, from_address, to_address, value_wei, 0 AS o "
    "FROM hits UNION ALL SELECT tx_hash, block_timestamp, from_address, to_address, value_wei, 1 "
    "FROM acc WHERE from_address IN (SELECT address FROM picked) "
    "OR to_address IN (SELECT address FROM picked))",
    "one_each AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tx_hash ORDER BY o, "
    "block_timestamp, from_address, to_address, value_wei) AS n FROM both_parts) WHERE n = 1)",
    "run_edges AS (SELECT from_address AS src, to_address AS dst, "
    "CAST(CAST(date_trunc('week', block_timestamp) AS DATE) AS VARCHAR) AS week_start, "
    "count(*) AS tx_count, CAST(sum(CAST(value_wei AS HUGEINT)) AS VARCHAR) AS total_value_wei "
    "FROM one_each GROUP BY 1, 2, 3)",
]


def run_sql(select):
    return f"WITH {','.join(_RUN_SQL)}\n{select}"


def run_graph(spark, sf_dir, folder, **options):
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    listed = scratch_path(spark, "list")
    customer.select(customer_address("c_custkey")).toDF("value").write.text(listed)
    transfers = classify_transfers(fill_recipient(raw_transfers(spark, sf_dir)))
    if not options.get("skip_transactions"):
        # A run scans them three times.
        transfers = write_scratch(transfers, "transfers")
    return stages.build_graph(
        spark,
        [(listed, "csv")],
        transfers,
        folder,
        end=datetime(2002, 1, 1, tzinfo=timezone.utc),
        weeks=400,
        k=2,
        exclude=exchange_addresses(spark, sf_dir),
        percentile=PERCENTILE,
        **options,
    )


@query("C6_build_graph", run_sql("SELECT * FROM run_edges"))
def whole_run(spark, sf_dir):
    folder = scratch_path(spark, "graph")
    run_graph(spark, sf_dir, folder)
    edges = dated(sources.read_edges(spark, stages.latest_tables(spark, folder)["edges"]))
    return edges.withColumns({"src": F.lower("src"), "dst": F.lower("dst")})


@query(
    "C6_run_nodes",
    run_sql(
        "SELECT address, CAST(sum(i) AS BIGINT) AS degree_in, CAST(sum(o) AS BIGINT) AS degree_out "
        "FROM (SELECT src AS address, 0 AS i, 1 AS o FROM run_edges UNION ALL "
        "SELECT dst, 1, 0 FROM run_edges UNION ALL SELECT address, 0, 0 FROM segment) GROUP BY 1"
    ),
)
def run_nodes(spark, sf_dir):
    folder = scratch_path(spark, "graph")
    run_graph(spark, sf_dir, folder)
    rows = sources.read_nodes(spark, stages.latest_tables(spark, folder)["nodes"])
    return rows.select(F.lower("address").alias("address"), "degree_in", "degree_out")


@query(
    "C6_skip_flags",
    run_sql(
        "SELECT name, 'table' AS kind, name <> 'nodes' AS found, CASE name "
        "WHEN 'labels' THEN (SELECT count(*) FROM segment) "
        "WHEN 'transactions' THEN (SELECT count(*) FROM one_each) "
        "WHEN 'edges' THEN (SELECT count(*) FROM run_edges) END AS n_records "
        "FROM (SELECT unnest(['labels', 'transactions', 'edges', 'nodes']) AS name) UNION ALL "
        "SELECT name, 'metadata', name IN ('labels', 'edges'), CASE WHEN name IN ('labels', 'edges') "
        "THEN 1 END FROM (SELECT unnest(['labels', 'transactions', 'edges', 'nodes']) AS name)"
    ),
)
def skipping_run(spark, sf_dir):
    # The second run takes the first one's transactions and builds no nodes.
    folder = scratch_path(spark, "graph")
    run_graph(spark, sf_dir, folder)
    report = run_graph(spark, sf_dir, folder, skip_transactions=True, skip_nodes=True)
    return report.drop("size_kb")


@query(
    "C6_run_counts",
    run_sql(
        "SELECT coalesce(reject_reason, 'accepted') AS what, count(*) AS n_rows FROM classified "
        "GROUP BY 1 UNION ALL SELECT 'rows_seen', count(*) FROM both_parts UNION ALL "
        "SELECT 'rows_kept', count(*) FROM one_each UNION ALL SELECT 'rows_removed', "
        "(SELECT count(*) FROM both_parts) - (SELECT count(*) FROM one_each)"
    ),
)
def run_counts(spark, sf_dir):
    folder = scratch_path(spark, "graph")
    run_graph(spark, sf_dir, folder)
    counts = stages.run_folders(spark, folder)[-1] + "/counts"
    outcomes = spark.read.json(f"{counts}/outcomes").select(F.col("reason").alias("what"), "n_rows")
    names = ("rows_seen", "rows_kept", "rows_removed")
    each = F.inline(F.array(*(F.struct(F.lit(n).alias("what"), F.col(n).alias("n_rows")) for n in names)))
    return outcomes.unionByName(spark.read.json(f"{counts}/repeats").select(each))


@query(
    "J8_unresolved_of_stage",
    check_sql(
        "SELECT d.address FROM degrees d WHERE d.address NOT IN (SELECT address FROM status) "
        "AND d.address NOT IN (SELECT address FROM contracts)",
        "degrees",
        "status",
        "contracts",
    ),
)
def unresolved_of_stage(spark, sf_dir):
    # A cache file of contracts joins the status table before it is asked.
    names = ("edges", "status", "cache", "nodes", "unresolved")
    edges, status, cache, path, left = (scratch_path(spark, n) for n in names)
    write_edges_of(spark, sf_dir, edges)
    sinks.append_status(status_rows(spark, sf_dir), status)
    cached = contract_addresses(spark, sf_dir).select(F.concat_ws(",", "address", F.lit("1")))
    cached.toDF("value").write.text(cache)
    labels = scratch_path(spark, "labels")
    write_label_rows(spark, sf_dir, labels)
    stages.nodes_stage(
        spark, edges, labels, path, status_path=status, cache_path=cache, unresolved_path=left
    )
    return spark.read.parquet(left)
