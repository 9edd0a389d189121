"""UTC timestamps, period starts and their text forms."""

from pyspark.sql import Column, functions as F

_RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})\z"
)


def parse_rfc3339(text: Column) -> Column:
    """UTC timestamp of RFC-3339 text; missing or malformed text is null."""
    return F.when(text.rlike(_RFC3339), F.try_to_timestamp(F.upper(text)))


def parse_rfc3339_strict(text: Column) -> Column:
    """Like `parse_rfc3339`, but malformed text fails the job; null stays null."""
    parsed = parse_rfc3339(text)
    failure = F.raise_error(F.concat(F.lit("bad timestamp: "), text)).cast("timestamp")
    return F.when(text.isNull(), F.lit(None)).otherwise(F.coalesce(parsed, failure))


def format_rfc3339(ts: Column) -> Column:
    """RFC-3339 text with the shortest of no, three or six fraction digits."""
    micros = F.unix_micros(ts)
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    millis = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return (
        F.when(micros % 1_000_000 == 0, seconds)
        .when(micros % 1_000 == 0, millis)
        .otherwise(full)
    )


def period_start(ts: Column, granularity: str = "week") -> Column:
    """First date of the day, week (Monday) or month that holds `ts`."""
    if granularity not in ("day", "week", "month"):
        raise ValueError(f"unknown granularity: {granularity}")
    if granularity == "day":
        return F.to_date(ts)
    return F.trunc(F.to_date(ts), granularity)


def hex_quantity(text: Column) -> Column:
    """Bigint of `0x`-prefixed hex text; malformed or too large is null."""
    digits = F.regexp_extract(text, r"^(?:0x)*([0-9a-fA-F]+)\z", 1)
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    usable = (short != "") & (F.length(short) <= 16)
    return F.when(usable, F.conv(short, 16, 10).try_cast("bigint"))
