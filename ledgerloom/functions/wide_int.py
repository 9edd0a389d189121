"""Exact unsigned 128-bit amounts on built-in columns.

Amounts travel as decimal text (up to 39 digits, which is one more than a Spark decimal
holds). To add them up, the text is cut into six limbs of seven digits, each summed as a
bigint, and the carries are folded once per group. A bigint limb sum holds more than
9 * 10^11 rows in one group and an overflow raises (ANSI) instead of wrapping. The sums
stay in hash aggregation with map-side combine.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the largest unsigned 128-bit integer.
U128_MAX = "340282366920938463463374607431768211455"

_LIMB_DIGITS = 7
_LIMB_COUNT = 6
_BASE = 10**_LIMB_DIGITS
_PADDED = _LIMB_DIGITS * _LIMB_COUNT
_PAIR_DIGITS = 2 * _LIMB_DIGITS
_MAX_PADDED = U128_MAX.zfill(_PADDED)
_MAX_HIGH_LIMB = int(_MAX_PADDED[:_LIMB_DIGITS])
_MAX_PAIRS = [
    int(_MAX_PADDED[i : i + _PAIR_DIGITS]) for i in range(0, _PADDED, _PAIR_DIGITS)
]


def zero_padded(text: Column, width: int) -> Column:
    """`lpad` with "0". Spark copies the padding one pad at a time, so the pad is all of it."""
    return F.lpad(text, width, "0" * width)


def canonical_u128(text: Column) -> Column:
    """Decimal text without sign or leading zeros; null, malformed or too large is "0"."""
    digits = F.ltrim(text, F.lit("+0"))
    short, longest = (text.rlike(rf"^\+?0*[1-9][0-9]{size}\z") for size in ("{0,37}", "{38}"))
    fits = short | (longest & (digits <= F.lit(U128_MAX)))
    return F.when(fits, digits).otherwise(F.lit("0"))


def padded_u128(text: Column) -> Column:
    """Canonical text padded to the width of all limbs.

    Select it under a name of its own before `limb_sums`: aggregation would otherwise
    evaluate the cleaning once per limb. Up to 38 digits without leading zero, as most are, are
    canonical at one look.
    """
    short = text.rlike(r"^[1-9][0-9]{0,37}\z")
    return zero_padded(F.when(short, text).otherwise(canonical_u128(text)), _PADDED)


def limb_sums(padded: Column, prefix: str) -> list[Column]:
    """Aggregates `<prefix>0` (highest limb) to `<prefix>5` of a `padded_u128` column."""
    return [
        F.sum(F.substring(padded, 1 + i * _LIMB_DIGITS, _LIMB_DIGITS).cast("bigint")).alias(
            f"{prefix}{i}"
        )
        for i in range(_LIMB_COUNT)
    ]


def fold_limbs(sums: DataFrame, prefix: str, name: str) -> DataFrame:
    """Replace the limb sums by their decimal text `name`, capped at the u128 maximum.

    All addends are non-negative, so one cap at the end equals a cap after every addition.
    Each carry is a projection of its own: nested in one expression the chain is repeated
    in every branch, and the generated method grows beyond what the JIT compiles.
    """
    limbs = [f"{prefix}{i}" for i in range(_LIMB_COUNT)]
    base = F.lit(_BASE)
    for higher, lower in zip(limbs[-2::-1], limbs[:0:-1]):
        carried = F.col(higher) + F.call_function("div", F.col(lower), base)
        sums = sums.withColumns({higher: carried, lower: F.col(lower) % base})
    # One more than the highest limb of the maximum shows that the total is too large.
    tops = [F.least(F.col(limbs[0]), F.lit(_MAX_HIGH_LIMB + 1)), *map(F.col, limbs[2::2])]
    names = [f"{prefix}_pair{i}" for i in range(len(tops))]
    pairs = {n: t * base + F.col(low) for n, t, low in zip(names, tops, limbs[1::2])}
    high, middle, low = map(F.col, names)
    top, mid, end = (F.lit(value) for value in _MAX_PAIRS)
    too_large = (high > top) | (
        (high == top) & ((middle > mid) | ((middle == mid) & (low > end)))
    )
    shown, lowest = [x.cast("string") for x in (high, middle)], low.cast("string")
    padded = [zero_padded(x, _PAIR_DIGITS) for x in (shown[1], lowest)]
    total = (
        F.when(too_large, F.lit(U128_MAX))
        .when(high > 0, F.concat(shown[0], *padded))
        .when(middle > 0, F.concat(shown[1], padded[1]))
        .otherwise(lowest)
    )
    return sums.withColumns(pairs).withColumn(name, total).drop(*limbs, *names)


def numeric_desc(text: Column) -> list[Column]:
    """Order canonical decimal text by value, largest first, without parsing it."""
    return [F.length(text).desc(), text.desc()]


def _exact_decimal(whole: Column) -> Column:
    """A non-negative double without fraction, below 2^125, as decimal(38, 0); exact.

    Its upper and lower part are exact bigints. `whole` is named twice in each and no step
    builds on another, so the expression stays small and compiled.
    """
    low = whole % F.lit(2.0**62)
    high = (whole - low) / F.lit(2.0**62)
    return high.cast("bigint").cast("decimal(20,0)") * F.lit(Decimal(2**62)) + low.cast(
        "bigint"
    ).cast("decimal(20,0)")


def _eighth(whole: Column) -> Column:
    return _exact_decimal(whole / F.lit(8.0))


def _largest_text(eighth: Column) -> Column:
    """Digits of a double from 2^110 to 2^128, which may be one more than a decimal holds.

    Such a double is a multiple of 8: its `eighth` is cut at twenty digits, and both parts are
    multiplied with the carry.
    """
    cut = F.lit(Decimal(10**20))
    low = (eighth % cut) * F.lit(Decimal(8))
    high = F.call_function("div", eighth, cut) * F.lit(8) + F.call_function("div", low, cut)
    return F.concat(high.cast("string"), F.lpad((low % cut).cast("string"), 20, "0"))


def _two_longs_text(whole: Column) -> Column:
    """Digits of a double from 2^63 to 2^110, as two bigints.

    The remainder is exact. The quotient is below 2^51, so its two roundings stay below a half.
    """
    cut = F.lit(1e18)
    low = whole % cut
    high = F.rint((whole - low) / cut).cast("bigint").cast("string")
    return F.concat(high, F.lpad(low.cast("bigint").cast("string"), 18, "0"))


def _wide_text(whole: Column, eighth: Column | None = None) -> Column:
    """Exact digits of a double from 2^63 to 2^128; from there on, beyond every u128 amount, a
    double shows its shortest digits padded with zeros."""
    return (
        F.when(whole < F.lit(2.0**110), _two_longs_text(whole))
        .when(whole < F.lit(2.0**128), _largest_text(_eighth(whole) if eighth is None else eighth))
        .otherwise(F.format_string("%.0f", whole))
    )


def with_wide_wei(df: DataFrame, ether: str, name: str) -> DataFrame:
    """Add the digits of the wei of an ether double, sign left out, from 2^63 wei on; else null.

    The column serves `ether_to_wei` and `ether_to_rank_wei` at once. Like its own first steps it
    is a projection: all in one method, the method grows beyond what the JIT compiles.
    """
    size, step = F.col(f"{name}_size"), f"{name}_eighth"
    wide = (size >= F.lit(2.0**63)) & (size < F.lit(float("inf")))
    largest = (size >= F.lit(2.0**110)) & (size < F.lit(2.0**128))
    sized = df.withColumn(f"{name}_size", F.abs(F.col(ether) * F.lit(1e18)))
    stepped = sized.withColumn(step, F.when(largest, _eighth(size)))
    shown = stepped.withColumn(name, F.when(wide, _wide_text(size, F.col(step))))
    return shown.drop(f"{name}_size", step)


def ether_to_wei(ether: Column, wide: Column | None = None) -> Column:
    """Wei text of an ether double, every digit of the double kept; null is "0".

    `wide` is its column of `with_wide_wei`, where that is at hand.
    """
    wei = F.rint(ether * F.lit(1e18))
    size = F.abs(wei)
    sign = F.when(wei < 0, F.lit("-")).otherwise(F.lit(""))
    wide = _wide_text(size) if wide is None else wide
    # Below 2^63 the bigint cast is exact. NaN and infinities cannot occur in JSON input.
    return (
        F.when(size < F.lit(2.0**63), wei.cast("bigint").cast("string"))
        .when(size < F.lit(float("inf")), F.concat(sign, wide))
        .otherwise(F.lit("0"))
    )


def ether_to_rank_wei(ether: Column, wide: Column | None = None) -> Column:
    """Whole wei for ranking: fraction cut, negative or missing is "0", capped at u128.

    `wide` is its column of `with_wide_wei`, where that is at hand.
    """
    wei = ether * F.lit(1e18)
    wide = _wide_text(wei) if wide is None else wide
    # Below 2^63 the bigint cast cuts the fraction; a larger double has none.
    return (
        F.when(~(wei > 0) | F.isnan(wei), F.lit("0"))
        .when(wei < F.lit(2.0**63), wei.cast("bigint").cast("string"))
        .when(wei < F.lit(2.0**128), wide)
        .when(wei.isNotNull(), F.lit(U128_MAX))
        .otherwise(F.lit("0"))
    )
