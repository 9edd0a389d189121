"""Transaction-graph inputs derived from the driver's tables, in Spark and in SQL.

An order line is a transfer between its customer and its supplier; returned lines flow
back. (l_orderkey, l_linenumber) is the hash and repeats, so deduplication has work to do.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.wide_int import zero_padded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
)


def address_of(number):
    return F.concat(F.lit("0x"), zero_padded(F.lower(F.hex(number)), 40))


def customer_address(key="o_custkey"):
    return address_of(F.col(key) + 1)


def supplier_address(key="l_suppkey"):
    return address_of(F.col(key) + 1_000_000)


def lines(spark, sf_dir) -> DataFrame:
    """Order lines with their order's date and customer, and the two addresses."""
    line = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    back = F.col("l_returnflag") == "R"
    # Both addresses are columns before sender and receiver choose: each is written once in the
    # generated method, which what follows the join shares and the JIT leaves out beyond 8,000 bytes.
    ends = {"_customer": customer_address(), "_supplier": supplier_address()}
    customer, supplier = map(F.col, ends)
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(ends)
    return joined.withColumns(
        {
            "tx_hash": F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")),
            "ts": F.expr("o_orderdate + make_dt_interval(0, l_linenumber)").cast("timestamp"),
            "sender": F.when(back, supplier).otherwise(customer),
            "receiver": F.when(back, customer).otherwise(supplier),
            "cents": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            "block": F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) * F.lit(7200)
            + F.col("l_orderkey") % 7200,
        }
    ).drop(*ends)


_LINES_SQL = """
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_hash,
    o_orderdate + to_hours(l_linenumber) AS ts,
    CASE WHEN l_returnflag = 'R' THEN '0x' || lpad(lower(to_hex(l_suppkey + 1000000)), 40, '0')
         ELSE '0x' || lpad(lower(to_hex(o_custkey + 1)), 40, '0') END AS sender,
    CASE WHEN l_returnflag = 'R' THEN '0x' || lpad(lower(to_hex(o_custkey + 1)), 40, '0')
         ELSE '0x' || lpad(lower(to_hex(l_suppkey + 1000000)), 40, '0') END AS receiver,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 7200 + l_orderkey % 7200
      AS block
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def transactions(spark, sf_dir) -> DataFrame:
    """Typed transactions; the value has 27 to 34 digits and carries in both halves."""
    digits = F.concat(F.col("cents").cast("string"), zero_padded(F.col("l_partkey"), 26))
    return lines(spark, sf_dir).select(
        "tx_hash",
        F.col("ts").alias("block_timestamp"),
        F.col("sender").alias("from_address"),
        F.col("receiver").alias("to_address"),
        digits.alias("value_wei"),
    )


_TX_SQL = """
tx AS (
  SELECT tx_hash, ts AS block_timestamp, sender AS from_address, receiver AS to_address,
    CAST(cents AS VARCHAR) || lpad(CAST(l_partkey AS VARCHAR), 26, '0') AS value_wei,
    block AS block_number
  FROM lines
)"""


def block_transactions(spark, sf_dir) -> DataFrame:
    digits = F.concat(F.col("cents").cast("string"), zero_padded(F.col("l_partkey"), 26))
    return lines(spark, sf_dir).select(
        "tx_hash",
        F.col("ts").alias("block_timestamp"),
        F.col("sender").alias("from_address"),
        F.col("receiver").alias("to_address"),
        digits.alias("value_wei"),
        F.col("block").cast("bigint").alias("block_number"),
    )


def raw_transfers(spark, sf_dir) -> DataFrame:
    """Transfers as landed pages give them, with every defect the cleaning knows."""
    source = lines(spark, sf_dir)
    part = F.col("l_partkey")
    when_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssxxx")
    return source.select(
        F.col("receiver").alias("address"),
        F.when(part % 2 == 0, "to").otherwise("from").alias("direction"),
        F.col("tx_hash").alias("hash"),
        F.when(part % 89 == 5, "").otherwise(F.col("sender")).alias("from"),
        F.when(part % 97 == 3, F.lit(None))
        .when(part % 97 == 4, "")
        .otherwise(F.col("receiver"))
        .alias("to"),
        F.when(F.col("l_tax") == 0.08, F.lit(None))
        .when(F.col("l_discount") == 0.0, 0.0)
        .otherwise(F.col("l_extendedprice") / 1000.0)
        .alias("value"),
        F.lit("ETH").alias("asset"),
        F.when(F.col("l_linenumber") == 7, "erc20")
        .when(F.col("l_linenumber") == 6, "internal")
        .otherwise("external")
        .alias("category"),
        F.col("block").cast("bigint").alias("block_number"),
        F.when(part % 83 == 7, "soon")
        .when(part % 83 == 8, F.lit(None))
        .otherwise(when_text)
        .alias("block_timestamp"),
        F.when(part % 11 == 2, F.concat(F.col("cents").cast("string"), F.lit("0000000000001")))
        .alias("value_wei_text"),
    )


_RAW_SQL = """
raw AS (
  SELECT receiver AS address, CASE WHEN l_partkey % 2 = 0 THEN 'to' ELSE 'from' END AS direction,
    tx_hash AS hash,
    CASE WHEN l_partkey % 89 = 5 THEN '' ELSE sender END AS "from",
    CASE WHEN l_partkey % 97 = 3 THEN NULL WHEN l_partkey % 97 = 4 THEN '' ELSE receiver END AS "to",
    CASE WHEN l_tax = 0.08 THEN NULL WHEN l_discount = 0 THEN 0.0
         ELSE l_extendedprice / CAST(1000 AS DOUBLE) END AS value,
    'ETH' AS asset,
    CASE l_linenumber WHEN 7 THEN 'erc20' WHEN 6 THEN 'internal' ELSE 'external' END AS category,
    block AS block_number,
    CASE WHEN l_partkey % 83 = 7 THEN 'soon' WHEN l_partkey % 83 = 8 THEN NULL
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS block_timestamp,
    CASE WHEN l_partkey % 11 = 2 THEN CAST(cents AS VARCHAR) || '0000000000001' END AS value_wei_text
  FROM lines
)"""

_FILLED_SQL = """
filled AS (
  SELECT * REPLACE (CASE WHEN coalesce("to", '') <> '' THEN "to"
                         WHEN direction = 'to' THEN address END AS "to") FROM raw
)"""

_CLASSIFIED_SQL = """
classified AS (
  SELECT hash AS tx_hash,
    CASE WHEN block_timestamp <> 'soon' THEN
      strptime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') END AS block_timestamp,
    "from" AS from_address, "to" AS to_address,
    coalesce(value_wei_text, CAST(CAST(value * 1e18 AS HUGEINT) AS VARCHAR), '0') AS value_wei,
    block_number, category,
    CASE WHEN category NOT IN ('external', 'internal') THEN 'category'
         WHEN value = 0 AND value_wei_text IS NULL THEN 'zero_value'
         WHEN coalesce("to", '') = '' THEN 'empty_to'
         WHEN coalesce("from", '') = '' THEN 'empty_from'
         WHEN block_timestamp IS NULL OR block_timestamp = 'soon' THEN 'bad_timestamp'
    END AS reject_reason
  FROM filled
)"""


def labeled_addresses(spark, sf_dir) -> DataFrame:
    """Customers of one market segment and every tenth supplier, checksum case left out."""
    customers = (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(customer_address("c_custkey").alias("address"), F.col("c_custkey").alias("number"))
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .filter("s_suppkey % 10 = 3")
        .select(supplier_address("s_suppkey").alias("address"), F.col("s_suppkey").alias("number"))
    )
    return customers.unionByName(suppliers)


_LABELED_SQL = """
labeled AS (
  SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS address, c_custkey AS number
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0'), s_suppkey
  FROM supplier WHERE s_suppkey % 10 = 3
)"""


def exchange_addresses(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_suppkey % 25 = 1")
        .select(supplier_address("s_suppkey").alias("address"))
    )


_EXCHANGES_SQL = """
exchanges AS (
  SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0') AS address
  FROM supplier WHERE s_suppkey % 25 = 1
)"""


def contract_addresses(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_nationkey < 12")
        .select(supplier_address("s_suppkey").alias("address"))
    )


_CONTRACTS_SQL = """
contracts AS (
  SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0') AS address
  FROM supplier WHERE s_nationkey < 12
)"""


def status_rows(spark, sf_dir) -> DataFrame:
    """A status per supplier and ship day, for two of three suppliers."""
    per_day = (
        table(spark, sf_dir, "lineitem")
        .filter("l_suppkey % 3 != 0")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(F.bool_or(F.col("l_linestatus") == "O").alias("is_contract"))
    )
    return per_day.select(
        supplier_address().alias("address"),
        "is_contract",
        F.col("l_shipdate").cast("timestamp").alias("resolved_at"),
    )


_STATUS_SQL = """
status AS (
  SELECT '0x' || lpad(lower(to_hex(l_suppkey + 1000000)), 40, '0') AS address,
    bool_or(l_linestatus = 'O') AS is_contract, l_shipdate AS resolved_at
  FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY l_suppkey, l_shipdate
)"""

_TOUCHED_SQL = """
touched AS (
  SELECT tx.*, f.address IS NOT NULL AS from_hit, t.address IS NOT NULL AS to_hit
  FROM tx LEFT JOIN labeled f ON tx.from_address = f.address
          LEFT JOIN labeled t ON tx.to_address = t.address
  WHERE f.address IS NOT NULL OR t.address IS NOT NULL
)"""

_STATS_SQL = """
stats AS (
  SELECT CASE WHEN from_hit THEN from_address ELSE to_address END AS labeled,
    CASE WHEN from_hit THEN to_address ELSE from_address END AS counterparty,
    sum(CAST(value_wei AS HUGEINT)) AS total, count(*) AS tx_count,
    max(block_timestamp) AS most_recent
  FROM touched WHERE from_hit <> to_hit GROUP BY 1, 2
)"""

_CHOSEN_SQL = """
chosen AS (
  SELECT DISTINCT counterparty AS address FROM (
    SELECT *, row_number() OVER (PARTITION BY labeled ORDER BY total DESC, counterparty) AS n
    FROM stats)
  WHERE n <= 5 AND counterparty NOT IN (SELECT address FROM exchanges)
)"""

_MERGED_SQL = """
merged AS (
  SELECT tx_hash, block_timestamp, from_address, to_address, value_wei FROM (
    SELECT *, row_number() OVER (PARTITION BY tx_hash ORDER BY origin_rank, block_timestamp,
      from_address, to_address, value_wei) AS n
    FROM (
      SELECT tx_hash, block_timestamp, from_address, to_address, value_wei, 0 AS origin_rank
      FROM touched
      UNION ALL
      SELECT tx_hash, block_timestamp, from_address, to_address, value_wei, 1 FROM tx
      WHERE from_address IN (SELECT address FROM chosen)
         OR to_address IN (SELECT address FROM chosen)))
  WHERE n = 1
)"""

_UNIQUE_SQL = """
uniq AS (
  SELECT tx_hash, block_timestamp, from_address, to_address, value_wei FROM (
    SELECT *, row_number() OVER (PARTITION BY tx_hash ORDER BY block_timestamp, from_address,
      to_address, value_wei) AS n FROM tx)
  WHERE n = 1
)"""

_EDGES_SQL = """
edges AS (
  SELECT from_address AS src, to_address AS dst,
    CAST(date_trunc('week', block_timestamp) AS DATE) AS week_start, count(*) AS tx_count,
    CAST(sum(CAST(value_wei AS HUGEINT)) AS VARCHAR) AS total_value_wei
  FROM tx GROUP BY 1, 2, 3
)"""

_DEGREES_SQL = """
degrees AS (
  SELECT address, CAST(sum(i) AS BIGINT) AS degree_in, CAST(sum(o) AS BIGINT) AS degree_out
  FROM (SELECT src AS address, 0 AS i, 1 AS o FROM edges
        UNION ALL SELECT dst, 1, 0 FROM edges
        UNION ALL SELECT address, 0, 0 FROM labeled)
  GROUP BY address
)"""

_THRESHOLD_SQL = """
threshold AS (
  SELECT coalesce(min(total), 9223372036854775807) AS threshold FROM (
    SELECT degree_in + degree_out AS total,
      row_number() OVER (ORDER BY degree_in + degree_out) - 1 AS position, count(*) OVER () AS n
    FROM degrees WHERE degree_in + degree_out > 0)
  WHERE position >= least(CAST(floor(CAST(0.99 AS DOUBLE) * n) AS BIGINT), n - 1)
)"""

_NODES_SQL = """
nodes AS (
  SELECT d.address, c.address IS NOT NULL AS is_contract, degree_in, degree_out,
    CASE WHEN degree_in + degree_out >= (SELECT threshold FROM threshold) THEN 'hub'
         WHEN c.address IS NOT NULL THEN 'contract' ELSE 'eoa' END AS node_type
  FROM degrees d LEFT JOIN contracts c ON d.address = c.address
)"""

_PARTS = {
    "lines": (_LINES_SQL, ()),
    "tx": (_TX_SQL, ("lines",)),
    "raw": (_RAW_SQL, ("lines",)),
    "filled": (_FILLED_SQL, ("raw",)),
    "classified": (_CLASSIFIED_SQL, ("filled",)),
    "labeled": (_LABELED_SQL, ()),
    "exchanges": (_EXCHANGES_SQL, ()),
    "contracts": (_CONTRACTS_SQL, ()),
    "status": (_STATUS_SQL, ()),
    "touched": (_TOUCHED_SQL, ("tx", "labeled")),
    "stats": (_STATS_SQL, ("touched",)),
    "chosen": (_CHOSEN_SQL, ("stats", "exchanges")),
    "merged": (_MERGED_SQL, ("touched", "chosen")),
    "uniq": (_UNIQUE_SQL, ("tx",)),
    "edges": (_EDGES_SQL, ("tx",)),
    "degrees": (_DEGREES_SQL, ("edges", "labeled")),
    "threshold": (_THRESHOLD_SQL, ("degrees",)),
    "nodes": (_NODES_SQL, ("degrees", "threshold", "contracts")),
}

# The hub percentile of the stand-in queries: with few addresses 99.9 would leave one hub.
PERCENTILE = 99.0


def named_sql(*parts: str) -> list[str]:
    """The named parts, and what they build on, in order."""
    wanted = []

    def want(name):
        text, needs = _PARTS[name]
        for need in needs:
            want(need)
        if text not in wanted:
            wanted.append(text)

    for part in parts:
        want(part)
    return wanted


def check_sql(select: str, *parts: str) -> str:
    """`select` with the named parts, and what they build on, as WITH clauses."""
    wanted = named_sql(*parts)
    return f"WITH {','.join(wanted)}\n{select}" if wanted else select
