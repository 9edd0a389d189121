"""Address text: normalizing, testing and extracting. All built-in expressions.

The lowercase form with `0x` is the join key everywhere; the mixed-case checksum form is
only for display (see `checksum.py`).
"""

from pyspark.sql import Column, functions as F

ZERO_ADDRESS = "0x" + "0" * 40

# What counts as an address inside free text.
PREFIXED_PATTERN = r"(?i)0x[a-fA-F0-9]{40}"
LOOSE_PATTERN = r"(?i)(?:0x)?([a-fA-F0-9]{40})"
# The loose form with boundaries: a longer run of hex digits is not an address.
BOUNDED_PATTERN = r"(?i)(?<![a-fA-F0-9])(?:0x)?(?<![a-fA-F0-9]{2})([a-fA-F0-9]{40})(?![a-fA-F0-9])"


def address_key(text: Column) -> Column:
    """Lowercase `0x` address of well-formed text, else null.

    Surrounding whitespace and a missing prefix are accepted.
    """
    body = F.regexp_extract(text, r"(?U)^\s*(?:0[xX])?([0-9a-fA-F]{40})\s*\z", 1)
    return F.when(body != "", F.concat(F.lit("0x"), F.lower(body)))


def is_zero_address(key: Column) -> Column:
    return F.lower(key) == F.lit(ZERO_ADDRESS)


def prefixed_addresses(text: Column) -> Column:
    """Array of every `0x` address in the text, as written."""
    return F.regexp_extract_all(text, F.lit(PREFIXED_PATTERN), F.lit(0))


def loose_addresses(text: Column, bounded: bool = False) -> Column:
    """Array of every 40-hex run, prefix optional, returned with `0x`.

    Without boundaries a 64-hex hash yields its first 40 digits; `bounded` rejects it.
    """
    pattern = BOUNDED_PATTERN if bounded else LOOSE_PATTERN
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda hit: F.concat(F.lit("0x"), hit))
