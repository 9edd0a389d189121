"""Queries on single columns: addresses, amounts, times."""

from pyspark.sql import functions as F

from ledgerloom.functions.addresses import (
    address_key,
    is_zero_address,
    loose_addresses,
    prefixed_addresses,
)
from ledgerloom.functions.checksum import checksum_address
from ledgerloom.functions.times import (
    format_rfc3339,
    hex_quantity,
    parse_rfc3339,
    parse_rfc3339_strict,
    period_start,
)
from ledgerloom.functions.wide_int import canonical_u128, ether_to_rank_wei, ether_to_wei
from ledgerloom.operators import cleaning, labeling
from ledgerloom.operators.nodes import node_class, parse_node_type
from workload.keccak import checksum_sql
from workload.registry import query
from workload.standins import (
    check_sql,
    customer_address,
    labeled_addresses,
    lines,
    named_sql,
    raw_transfers,
    supplier_address,
    table,
)

_MESSY_SQL = """
SELECT tx_hash, CASE WHEN l_partkey % 7 = 0 THEN '  ' || upper(sender) || ' '
  WHEN l_partkey % 7 = 1 THEN substr(sender, 3) WHEN l_partkey % 7 = 2 THEN substr(sender, 1, 41)
  WHEN l_partkey % 7 = 3 THEN replace(sender, '0x00', '0xzz') WHEN l_partkey % 7 = 4 THEN NULL
  WHEN l_partkey % 7 = 5 THEN '0x' || repeat('0', 40) ELSE sender END AS messy FROM lines"""


def messy_addresses(spark, sf_dir):
    kind, sender = F.col("l_partkey") % 7, F.col("sender")
    messy = (
        F.when(kind == 0, F.concat(F.lit("  "), F.upper(sender), F.lit(" ")))
        .when(kind == 1, F.substring(sender, 3, 40))
        .when(kind == 2, F.substring(sender, 1, 41))
        .when(kind == 3, F.regexp_replace(sender, "0x00", "0xzz"))
        .when(kind == 4, F.lit(None))
        .when(kind == 5, F.concat(F.lit("0x"), F.repeat(F.lit("0"), 40)))
        .otherwise(sender)
    )
    return lines(spark, sf_dir).select("tx_hash", messy.alias("messy"))


_KEYED_SQL = f"""
SELECT tx_hash, messy, CASE WHEN regexp_full_match(trim(messy), '(0[xX])?[0-9a-fA-F]{{40}}')
  THEN '0x' || lower(right(trim(messy), 40)) END AS key FROM ({_MESSY_SQL})"""


@query("P1_normalize_address", check_sql(f"SELECT tx_hash, key FROM ({_KEYED_SQL})", "lines"))
def normalize(spark, sf_dir):
    return messy_addresses(spark, sf_dir).select("tx_hash", address_key(F.col("messy")).alias("key"))


_PARTIES_SQL = """
SELECT '0x' || lpad(lower(to_hex(c_custkey + 1)), 40, '0') AS key FROM customer
UNION ALL SELECT '0x' || lpad(lower(to_hex(s_suppkey + 1000000)), 40, '0') FROM supplier"""


@query("P2_checksum_address", checksum_sql(_PARTIES_SQL, "SELECT key, checksum FROM checksums"))
def checksum(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(customer_address("c_custkey").alias("key"))
    suppliers = table(spark, sf_dir, "supplier").select(supplier_address("s_suppkey").alias("key"))
    both = customers.unionByName(suppliers)
    return both.select("key", checksum_address(F.col("key")).alias("checksum"))


@query(
    "P3_zero_address",
    check_sql(
        f"SELECT tx_hash, key = '0x' || repeat('0', 40) AS is_zero FROM ({_KEYED_SQL}) "
        "WHERE key IS NOT NULL",
        "lines",
    ),
)
def zero(spark, sf_dir):
    keyed = messy_addresses(spark, sf_dir).select("tx_hash", address_key(F.col("messy")).alias("key"))
    return keyed.filter("key is not null").select(
        "tx_hash", is_zero_address(F.col("key")).alias("is_zero")
    )


@query(
    "P2_address_dimension",
    checksum_sql(
        "SELECT sender AS key FROM lines UNION ALL SELECT receiver FROM lines",
        "SELECT key, checksum FROM checksums",
        *named_sql("lines"),
    ),
)
def dimension(spark, sf_dir):
    return labeling.address_dimension(lines(spark, sf_dir), "sender", "receiver")


def notes(spark, sf_dir):
    """Free text around addresses: one note per line, every document, every page."""
    note = F.concat(
        F.lit("sent "), F.upper("sender"), F.lit(" to:"), F.col("receiver"), F.lit("; hash "),
        F.repeat(F.col("l_linenumber").cast("string"), 64), F.lit(" end"),
    )
    from_lines = lines(spark, sf_dir).select(
        F.lit("line").alias("origin"), F.col("tx_hash").alias("id"), note.alias("text")
    )
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").cast("string").alias("id"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("origin"),
        F.col("page_id").cast("string").alias("id"),
        F.col("html").alias("text"),
    )
    return from_lines.unionByName(docs).unionByName(pages)


_NOTES_SQL = """
SELECT 'line' AS origin, tx_hash AS id, 'sent ' || upper(sender) || ' to:' || receiver ||
  '; hash ' || repeat(CAST(l_linenumber AS VARCHAR), 64) || ' end' AS text FROM lines
UNION ALL SELECT 'document', CAST(doc_id AS VARCHAR), text FROM documents
UNION ALL SELECT 'page', CAST(page_id AS VARCHAR), html FROM pages"""


@query(
    "P4_extract_prefixed",
    check_sql(
        "SELECT origin, id, unnest(regexp_extract_all(text, '(?i)0x[a-fA-F0-9]{40}')) "
        f"AS raw_address FROM ({_NOTES_SQL})",
        "lines",
    ),
)
def extract_prefixed(spark, sf_dir):
    return labeling.extract_addresses(notes(spark, sf_dir), "text", ["origin", "id"], True)


@query(
    "P5_extract_loose",
    check_sql(
        "SELECT origin, id, '0x' || unnest(regexp_extract_all(text, "
        f"'(?i)(?:0x)?([a-fA-F0-9]{{40}})', 1)) AS raw_address FROM ({_NOTES_SQL})",
        "lines",
    ),
)
def extract_loose(spark, sf_dir):
    return labeling.extract_addresses(notes(spark, sf_dir), "text", ["origin", "id"])


@query(
    "P5_hits_per_text",
    check_sql(
        "SELECT origin, id, CAST(len(regexp_extract_all(text, '(?i)0x[a-fA-F0-9]{40}')) AS "
        "BIGINT) AS n_prefixed, CAST(len(regexp_extract_all(text, "
        f"'(?i)(?:0x)?([a-fA-F0-9]{{40}})', 1)) AS BIGINT) AS n_loose FROM ({_NOTES_SQL})",
        "lines",
    ),
)
def hits_per_text(spark, sf_dir):
    return notes(spark, sf_dir).select(
        "origin",
        "id",
        F.size(prefixed_addresses(F.col("text"))).cast("bigint").alias("n_prefixed"),
        F.size(loose_addresses(F.col("text"))).cast("bigint").alias("n_loose"),
    )


# Amounts of all sizes: up to 1.05e38 wei, close to the largest 128-bit integer.
_SCALED_SQL = """
SELECT hash, block_number, value * CAST(CASE block_number % 7 WHEN 1 THEN 1e6 WHEN 2 THEN 1e11
  WHEN 3 THEN 1e15 WHEN 4 THEN 1e18 ELSE 1 END AS DOUBLE) AS value FROM raw"""


def scaled_transfers(spark, sf_dir):
    size = F.col("block_number") % 7
    scale = F.when(size == 1, 1e6).when(size == 2, 1e11).when(size == 3, 1e15).when(size == 4, 1e18)
    value = F.col("value") * scale.otherwise(1.0)
    return raw_transfers(spark, sf_dir).select("hash", "block_number", value.alias("value"))


@query(
    "P6_ether_to_wei",
    check_sql(
        "SELECT hash, value, coalesce(CAST(CAST(value * 1e18 AS HUGEINT) AS VARCHAR), '0') "
        f"AS value_wei FROM ({_SCALED_SQL})",
        "raw",
    ),
)
def to_wei(spark, sf_dir):
    return scaled_transfers(spark, sf_dir).select(
        "hash", "value", ether_to_wei(F.col("value")).alias("value_wei")
    )


@query(
    "P7_ether_to_rank_wei",
    check_sql(
        "SELECT hash, coalesce(CAST(greatest(CAST(trunc(signed * 1e18) AS HUGEINT), 0) AS "
        "VARCHAR), '0') AS rank_wei FROM (SELECT hash, CASE WHEN block_number % 5 = 0 THEN "
        "-value WHEN block_number % 5 = 1 THEN value * CAST(1.7e-20 AS DOUBLE) ELSE value END "
        f"AS signed FROM ({_SCALED_SQL}))",
        "raw",
    ),
)
def rank_wei(spark, sf_dir):
    kind, value = F.col("block_number") % 5, F.col("value")
    signed = F.when(kind == 0, -value).when(kind == 1, value * F.lit(1.7e-20)).otherwise(value)
    rows = scaled_transfers(spark, sf_dir)
    return rows.select("hash", ether_to_rank_wei(signed).alias("rank_wei"))


_WIDE_TEXT_SQL = """
SELECT tx_hash, CASE l_linenumber WHEN 1 THEN '+' || CAST(cents AS VARCHAR)
  WHEN 2 THEN '-' || CAST(cents AS VARCHAR)
  WHEN 3 THEN CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE ' 12' END
  WHEN 4 THEN '000' || CAST(cents AS VARCHAR) || repeat('9', 29)
  WHEN 5 THEN '34028236692093846346337460743' || lpad(CAST(cents * 100 AS VARCHAR), 10, '0')
  WHEN 6 THEN CAST(cents AS VARCHAR) || repeat('7', 40) ELSE 'x' || CAST(cents AS VARCHAR) END
  AS wide FROM lines"""


def wide_texts(spark, sf_dir):
    number, cents = F.col("l_linenumber"), F.col("cents").cast("string")
    wide = (
        F.when(number == 1, F.concat(F.lit("+"), cents))
        .when(number == 2, F.concat(F.lit("-"), cents))
        .when(number == 3, F.when(F.col("l_partkey") % 2 != 0, " 12"))
        .when(number == 4, F.concat(F.lit("000"), cents, F.repeat(F.lit("9"), 29)))
        .when(
            number == 5,
            F.concat(
                F.lit("34028236692093846346337460743"),
                F.lpad((F.col("cents") * 100).cast("string"), 10, "0"),
            ),
        )
        .when(number == 6, F.concat(cents, F.repeat(F.lit("7"), 40)))
        .otherwise(F.concat(F.lit("x"), cents))
    )
    return lines(spark, sf_dir).select("tx_hash", wide.alias("wide"))


@query(
    "P8_parse_wide_int",
    check_sql(
        "SELECT tx_hash, wide, CASE WHEN regexp_full_match(wide, '\\+?[0-9]+') THEN "
        "coalesce(CAST(TRY_CAST(ltrim(wide, '+') AS UHUGEINT) AS VARCHAR), '0') ELSE '0' END "
        f"AS amount FROM ({_WIDE_TEXT_SQL})",
        "lines",
    ),
)
def parse_wide(spark, sf_dir):
    return wide_texts(spark, sf_dir).select(
        "tx_hash", "wide", canonical_u128(F.col("wide")).alias("amount")
    )


_TIME_TEXT_SQL = """
SELECT hash, CASE WHEN block_number % 4 = 0 THEN replace(block_timestamp, '+00:00', 'Z')
  WHEN block_number % 4 = 1 THEN replace(block_timestamp, '+00:00', '.250+05:30')
  ELSE block_timestamp END AS stamp FROM raw"""


def time_texts(spark, sf_dir):
    kind, stamp = F.col("block_number") % 4, F.col("block_timestamp")
    shown = (
        F.when(kind == 0, F.regexp_replace(stamp, r"\+00:00", "Z"))
        .when(kind == 1, F.regexp_replace(stamp, r"\+00:00", ".250+05:30"))
        .otherwise(stamp)
    )
    return raw_transfers(spark, sf_dir).select("hash", shown.alias("stamp"))


@query(
    "P9_parse_timestamp",
    check_sql(
        "SELECT hash, stamp, CASE WHEN stamp <> 'soon' THEN CAST(epoch_ms(CAST(stamp AS "
        f"TIMESTAMPTZ)) AS VARCHAR) END AS utc_millis FROM ({_TIME_TEXT_SQL})",
        "raw",
    ),
)
def parse_times(spark, sf_dir):
    return time_texts(spark, sf_dir).select(
        "hash",
        "stamp",
        F.unix_millis(parse_rfc3339(F.col("stamp"))).cast("string").alias("utc_millis"),
    )


@query(
    "P10_parse_timestamp_strict",
    check_sql(
        "SELECT tx_hash, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp, "
        "CAST(epoch_ms(ts) AS BIGINT) AS utc_millis FROM lines",
        "lines",
    ),
)
def parse_strict(spark, sf_dir):
    stamped = lines(spark, sf_dir).select("tx_hash", format_rfc3339(F.col("ts")).alias("stamp"))
    return stamped.select(
        "tx_hash", "stamp", F.unix_millis(parse_rfc3339_strict(F.col("stamp"))).alias("utc_millis")
    )


@query(
    "P11_week_start",
    check_sql(
        "SELECT tx_hash, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week_start "
        "FROM lines",
        "lines",
    ),
)
def week_start(spark, sf_dir):
    return lines(spark, sf_dir).select(
        "tx_hash", period_start(F.col("ts")).cast("string").alias("week_start")
    )


@query(
    "P12_period_start",
    check_sql(
        "SELECT tx_hash, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(CAST(date_trunc('week', "
        "ts) AS DATE) AS VARCHAR) AS week, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) "
        "AS month FROM lines",
        "lines",
    ),
)
def periods(spark, sf_dir):
    shown = [period_start(F.col("ts"), g).cast("string").alias(g) for g in ("day", "week", "month")]
    return lines(spark, sf_dir).select("tx_hash", *shown)


@query(
    "P13_format_timestamp",
    "SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, "
    "'%Y-%m-%dT%H:%M:%S+00:00') WHEN epoch_us(ts) % 1000 = 0 THEN strftime(ts, "
    "'%Y-%m-%dT%H:%M:%S.%g+00:00') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS stamp "
    "FROM events",
)
def format_times(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", format_rfc3339(F.col("ts").cast("timestamp")).alias("stamp"))


@query(
    "P14_lowercase_key",
    check_sql("SELECT DISTINCT lower(upper(sender)) AS key FROM lines", "lines"),
)
def lowercase(spark, sf_dir):
    shouted = lines(spark, sf_dir).select(F.upper("sender").alias("sender"))
    return shouted.select(F.lower("sender").alias("key")).distinct()


@query(
    "P15_fill_recipient", check_sql('SELECT hash, direction, address, "to" FROM filled', "filled")
)
def fill(spark, sf_dir):
    filled = cleaning.fill_recipient(raw_transfers(spark, sf_dir))
    return filled.select("hash", "direction", "address", "to")


@query(
    "P16_convert_transfers",
    check_sql(
        "SELECT tx_hash, strftime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp, "
        "from_address, to_address, value_wei FROM classified WHERE reject_reason IS NULL",
        "classified",
    ),
)
def convert(spark, sf_dir):
    filled = cleaning.fill_recipient(raw_transfers(spark, sf_dir))
    rows = cleaning.accepted(cleaning.classify_transfers(filled))
    return cleaning.to_transactions(rows, checksum=False).select(
        "tx_hash",
        format_rfc3339(F.col("block_timestamp")).alias("stamp"),
        "from_address",
        "to_address",
        "value_wei",
    )


@query(
    "P16_convert_with_checksums",
    checksum_sql(
        "SELECT from_address AS key FROM classified WHERE reject_reason IS NULL "
        "UNION ALL SELECT to_address FROM classified WHERE reject_reason IS NULL",
        "SELECT tx_hash, strftime(block_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp, "
        "f.checksum AS from_address, t.checksum AS to_address, value_wei FROM classified "
        "JOIN checksums f ON from_address = f.key JOIN checksums t ON to_address = t.key "
        "WHERE reject_reason IS NULL",
        *named_sql("classified"),
    ),
)
def convert_checksummed(spark, sf_dir):
    filled = cleaning.fill_recipient(raw_transfers(spark, sf_dir))
    rows = cleaning.to_transactions(cleaning.accepted(cleaning.classify_transfers(filled)))
    return rows.withColumn("stamp", format_rfc3339(F.col("block_timestamp"))).drop("block_timestamp")


@query(
    "P17_node_class",
    "SELECT s_suppkey, CASE WHEN s_acctbal >= 5000 THEN 'hub' WHEN s_nationkey < 12 THEN "
    "'contract' ELSE 'eoa' END AS node_type FROM supplier",
)
def classes(spark, sf_dir):
    kind = node_class(F.col("s_acctbal"), F.col("s_nationkey") < 12, F.lit(5000))
    return table(spark, sf_dir, "supplier").select("s_suppkey", kind.alias("node_type"))


@query(
    "P18_node_type_text",
    "SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN 'hub' WHEN c_nationkey % 4 = 1 THEN "
    "'contract' ELSE 'eoa' END AS node_type FROM customer",
)
def type_texts(spark, sf_dir):
    kind = F.col("c_nationkey") % 4
    text = F.when(kind == 0, "hub").when(kind == 1, "contract").when(kind == 2, "whale")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", parse_node_type(text).alias("node_type")
    )


@query(
    "P19_hex_quantity",
    check_sql(
        "SELECT tx_hash, '0x' || lower(to_hex(block)) AS quantity, block AS block_number "
        "FROM lines",
        "lines",
    ),
)
def quantities(spark, sf_dir):
    quantity = F.concat(F.lit("0x"), F.lower(F.hex(F.col("block").cast("bigint"))))
    hexed = lines(spark, sf_dir).select("tx_hash", quantity.alias("quantity"))
    return hexed.withColumn("block_number", hex_quantity(F.col("quantity")))


@query(
    "P20_label_columns",
    check_sql(
        "SELECT address, 1 AS label, 'OFAC_SDN' AS label_source, 'list-' || number % 3 AS "
        "source_url, '2024-05-01T00:00:00+00:00' AS retrieved_at FROM labeled",
        "labeled",
    ),
)
def label_columns(spark, sf_dir):
    found = labeled_addresses(spark, sf_dir).select(
        F.col("address").alias("raw_address"),
        F.concat(F.lit("list-"), F.col("number") % 3).alias("source_url"),
    )
    at = F.lit("2024-05-01T00:00:00Z").cast("timestamp")
    labels = labeling.build_label_table(found, retrieved_at=at)
    return labels.withColumns(
        {
            "address": F.lower("address"),
            "retrieved_at": format_rfc3339(F.col("retrieved_at")),
        }
    )
