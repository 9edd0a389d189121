"""Column functions against literal cases and plain Python."""

import random

import pytest
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
from ledgerloom.functions.wide_int import (
    U128_MAX,
    canonical_u128,
    ether_to_rank_wei,
    ether_to_wei,
    numeric_desc,
)
from ledgerloom.operators.edges import wide_sum

MAX = int(U128_MAX)

# Published examples of the checksum form.
CHECKSUMMED = [
    "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed",
    "0xfB6916095ca1df60bB79Ce92cE3Ea74c37c5d359",
    "0xdbF03B407c01E7cD3CBea99509d93f8DDDC8C6FB",
    "0xD1220A0cf47c7B9Be7A2E6BA89F429762e7b9aDb",
    "0xd8dA6BF26964aF9D7eEd9e03E53415D37aA96045",
]


def mapped(spark, values, function, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    found = rows.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()
    return [row.r for row in found]


def test_address_key(spark):
    good = CHECKSUMMED[0]
    texts = [good, good.lower(), good[2:], f"  {good}\n", "0X" + good[2:], "0xinvalid", "0x123", "", None]
    assert mapped(spark, texts, address_key) == [good.lower()] * 5 + [None] * 4


def test_zero_address(spark):
    texts = ["0x" + "0" * 40, CHECKSUMMED[0]]
    assert mapped(spark, texts, is_zero_address) == [True, False]


def test_checksum(spark):
    texts = [c.lower() for c in CHECKSUMMED] + [None] + [CHECKSUMMED[0].lower()]
    expected = CHECKSUMMED + [None, CHECKSUMMED[0]]
    assert mapped(spark, texts, checksum_address) == expected


def test_extraction(spark):
    address, digest = CHECKSUMMED[4], "ab" * 32
    text = f"Digital Currency Address - ETH: {address} or 0x{'0' * 40}; hash {digest}, no 0x12"
    assert mapped(spark, [text], prefixed_addresses) == [[address, "0x" + "0" * 40]]
    loose = [address, "0x" + "0" * 40, "0x" + digest[:40]]
    assert mapped(spark, [text], loose_addresses) == [loose]
    assert mapped(spark, [text], lambda c: loose_addresses(c, bounded=True)) == [loose[:2]]
    twice = address + address[2:]
    assert len(mapped(spark, [twice], loose_addresses)[0]) == 2
    assert mapped(spark, [f"x{address}.", address[2:]], lambda c: loose_addresses(c, True)) == [
        [address],
        [address],
    ]


def test_canonical_u128(spark):
    cases = {
        None: "0",
        "": "0",
        "+": "0",
        "+5": "5",
        "-3": "0",
        "abc": "0",
        " 7": "0",
        "5\n": "0",
        "++5": "0",
        "+0+5": "0",
        "007": "7",
        "000": "0",
        U128_MAX: U128_MAX,
        str(MAX + 1): "0",
        "9" * 39: "0",
        "1" * 40: "0",
        "0" * 50 + "9": "9",
    }
    assert mapped(spark, list(cases), canonical_u128) == list(cases.values())


def test_wide_sum_matches_integers(spark):
    rng = random.Random(7)
    makers = (
        lambda: rng.randrange(10**20),
        lambda: rng.randrange(10**38),
        lambda: rng.randrange(MAX // 30),
        lambda: 10**18 - 1,
        lambda: 9_999_999,
    )
    rows = [(i % 97, str(rng.choice(makers)())) for i in range(6000)]
    rows += [(1000, U128_MAX), (1000, "0"), (1001, str(MAX - 1)), (1001, "1")]
    rows += [(1002, str(MAX - 1)), (1002, "2"), (1003, None), (1004, U128_MAX), (1004, U128_MAX)]
    expected = {}
    for key, text in rows:
        expected[key] = min(MAX, expected.get(key, 0) + int(text or 0))
    frame = spark.createDataFrame(rows, "k int, v string")
    found = {r.k: int(r.total_value) for r in wide_sum(frame, ["k"], "v").collect()}
    assert found == expected


def test_ether_to_wei(spark):
    values = [
        1.5, 1.1, 12.345678901234567, 2.5e-18, 3.5e-18, 0.0, -1.5, 123456789.123, 9.3,
        9.223372036854775, 9.223372036854776, 3e10, 0.1 + 0.2, 1e-18, 4.9e9,
    ]
    assert mapped(spark, values, ether_to_wei, "double") == ["%.0f" % (v * 1e18) for v in values]
    ranked = [str(max(0, int(v * 1e18))) for v in values]
    assert mapped(spark, values, ether_to_rank_wei, "double") == ranked
    assert mapped(spark, [None], ether_to_wei, "double") == ["0"]
    odd = [None, float("nan"), 1e30]
    assert mapped(spark, odd, ether_to_rank_wei, "double") == ["0", "0", U128_MAX]


def test_numeric_order(spark):
    values = [str(v) for v in (0, 9, 10, 99, 10**18, 10**18 - 1, MAX)]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    ordered = [r.v for r in frame.orderBy(*numeric_desc(F.col("v"))).collect()]
    assert ordered == sorted(values, key=int, reverse=True)


def test_times(spark):
    texts = [
        "2024-01-03T12:00:00+00:00",
        "2024-01-03T12:00:00.123456789Z",
        "2024-01-01T01:00:00+02:00",
        "2024-01-03t12:00:00.5z",
        "bad",
        "2024-01-03",
        None,
    ]
    shown = [
        "2024-01-03T12:00:00+00:00",
        "2024-01-03T12:00:00.123456+00:00",
        "2023-12-31T23:00:00+00:00",
        "2024-01-03T12:00:00.500+00:00",
        None,
        None,
        None,
    ]
    assert mapped(spark, texts, lambda c: format_rfc3339(parse_rfc3339(c))) == shown
    weeks = mapped(spark, texts[:3], lambda c: period_start(parse_rfc3339(c)).cast("string"))
    assert weeks == ["2024-01-01", "2024-01-01", "2023-12-25"]
    months = mapped(spark, texts[:1], lambda c: period_start(parse_rfc3339(c), "month").cast("string"))
    assert months == ["2024-01-01"]
    with pytest.raises(ValueError):
        period_start(F.col("v"), "hour")


def test_strict_times_fail(spark):
    assert len(mapped(spark, [None, "2024-01-03T12:00:00Z"], parse_rfc3339_strict)) == 2
    with pytest.raises(Exception, match="bad timestamp: soon"):
        mapped(spark, ["soon"], parse_rfc3339_strict)


def test_hex_quantity(spark):
    texts = ["0x1b4", "1B4", "0x0", "0x" + "0" * 30 + "7", "zz", "", None, "0x" + "f" * 16, "0x" + "f" * 17]
    assert mapped(spark, texts, hex_quantity) == [436, 436, 0, 7, None, None, None, None, None]


def test_ether_digits_are_exact_up_to_the_largest_amount(spark):
    values = [float(f"{m}e{e}") for m in (1, 1.1, 3.3, 9.87654321) for e in range(9, 21)]
    values += [2.0**k / 1e18 for k in range(60, 128, 3)]
    frame = spark.createDataFrame([(v,) for v in values if v * 1e18 < 2.0**128], "ether double")
    rows = frame.select("ether", ether_to_wei(F.col("ether")).alias("wei"), ether_to_rank_wei(F.col("ether")).alias("rank"))
    for row in rows.collect():
        assert row["wei"] == row["rank"] == str(int(row["ether"] * 1e18)), row["ether"]


def test_random_amounts_keep_every_digit(spark):
    rng = random.Random(3)
    ethers = [rng.random() * 2.0 ** rng.randrange(1, 69) for _ in range(3000)]
    ethers += [rng.uniform(2.0**125, 2.0**128) / 1e18 for _ in range(500)]
    ethers = [v for v in ethers if v * 1e18 < 2.0**128]
    assert sum(v * 1e18 >= 1e38 for v in ethers) > 100
    rows = spark.createDataFrame([(v,) for v in ethers], "v double")
    rows = rows.select("v", ether_to_wei(F.col("v")).alias("wei"), ether_to_rank_wei(F.col("v")).alias("rank"))
    for r in rows.collect():
        assert (r.wei, r.rank) == (str(round(r.v * 1e18)), str(int(r.v * 1e18)))


def test_amounts_stay_small_expressions(spark):
    rows = spark.range(1).select(F.col("id").cast("double").alias("v"))
    for amount in (ether_to_wei, ether_to_rank_wei):
        plan = rows.select(amount(F.col("v")))._jdf.queryExecution().optimizedPlan()
        assert plan.expressions().head().treeString().count("\n") < 400
