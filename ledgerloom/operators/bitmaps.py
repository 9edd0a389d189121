"""Bitmaps over hashed keys: which rows can be in a large set, told without a shuffle.

Spark's own runtime filters serve an inner or semi join on one key, and are built from small
sides only. Here the set may be large, the rows that cannot be in it must stay (outer and anti
joins), or either of two columns may hit.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import write_scratch

# Fixed value: the bits of one bitmap of Spark's bitmap functions.
_PIECE_BITS = 32_768


@dataclass(frozen=True)
class Bitmap:
    """Pieces of a bitmap of `bits` bits; 128 KB to 128 MB as a whole, so always broadcast."""

    pieces: DataFrame
    bits: int


def _place(hashed: Column, bits: int) -> tuple[Column, Column]:
    place = F.pmod(hashed, F.lit(bits))
    return F.call_function("div", place, F.lit(_PIECE_BITS)), place % F.lit(_PIECE_BITS)


def bitmap_of(keys: DataFrame, hashed: Column, rows: int) -> Bitmap:
    """A bitmap over the hashes of about `rows` keys: 16 bits a key, up to 2^30 bits."""
    bits = 1 << min(max((16 * rows).bit_length(), 20), 30)
    piece, bit = _place(hashed, bits)
    pieces = keys.select(piece.alias("piece"), bit.alias("bit")).groupBy("piece")
    return Bitmap(write_scratch(pieces.agg(F.bitmap_construct_agg("bit").alias("bitmap")), "bitmap"), bits)


def with_hit(rows: DataFrame, hashed: Column, bitmap: Bitmap, flag: str) -> DataFrame:
    """Add boolean `flag`: false if no key has this hash, true if one has or by chance."""
    piece, bit = _place(hashed, bitmap.bits)
    side = bitmap.pieces.select(F.col("piece").alias(f"_piece_{flag}"), F.col("bitmap").alias(f"_bitmap_{flag}"))
    joined = rows.join(F.broadcast(side), piece == F.col(f"_piece_{flag}"), "left")
    byte = F.substring(F.col(f"_bitmap_{flag}"), (bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.call_function("shiftright", value, (bit % 8).cast("int")) % 2 == 1
    marked = joined.withColumn(flag, F.coalesce(hit, F.lit(False)))
    return marked.drop(f"_piece_{flag}", f"_bitmap_{flag}")
