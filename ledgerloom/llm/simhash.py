"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

A fingerprint has a bit set where over half of the text's shingle hashes have it. Equal
fingerprints collapse to one before anything is compared. The distinct ones are dealt into
tiles by the population counts of their two halves (large cells are cut further by a hash);
two tiles meet only if these counts differ by no more than the radius, since each differing
bit moves them by one. A pair of tiles is compared exactly with exclusive-or and bit counts;
of its links only a spanning forest leaves the task, so a large group of near copies never
becomes its square. Components of the links follow as Spark joins.

Tiles keep the comparison in bounded pieces, but their number grows with the square of the
distinct fingerprints; that is the price of an exact comparison by this method.

Defined cases: null and empty texts have fingerprint zero and are linked like any other;
texts with fewer words than a shingle hash their whole word sequence; equal fingerprints are
linked; repeated rows are kept and linked; a null id never becomes a component's id unless
all ids of the component are null; an empty table gives no rows.
"""

import re
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import keep, parted, utf8
from ledgerloom.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
TILE_ROWS = 8192
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text, as an unsigned integer."""
    words = _WORD.findall((text or b"").translate(_LOWER))
    if not words:
        return 0
    size = min(shingle, len(words))
    hashed = partial(xxhash.xxh64_intdigest, seed=seed)
    runs = map(b" ".join, zip(*(words[k:] for k in range(size))))
    hashes = np.fromiter(map(hashed, runs), dtype="<u8", count=len(words) - size + 1)
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def with_fingerprint(documents: DataFrame, column: str = "fp") -> DataFrame:
    """Add the fingerprint of `text` as a signed long; a column of the name is replaced."""

    @F.pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return documents.withColumn(column, of_texts(utf8("text")))


def _forest(left, right, radius):
    """Links of a spanning forest between two tiles (or within one if `right` is None)."""
    both = left if right is None else np.concatenate([left, right])
    against, offset = (left, 0) if right is None else (right, len(left))
    group = np.arange(len(both))
    out = []
    step = max(1, (1 << 20) // max(1, len(against)))
    for first in range(0, len(left), step):
        part = left[first : first + step]
        near = np.bitwise_count(part[:, None] ^ against[None, :]) <= radius
        if right is None:
            near[np.arange(len(part)), first + np.arange(len(part))] = False
        for i in np.flatnonzero(near.any(axis=1)):
            met = np.flatnonzero(near[i]) + offset
            groups, at = np.unique(group[met], return_index=True)
            new = groups != group[first + i]
            if new.any():
                out += [(left[first + i], both[j]) for j in met[at[new]]]
                group[np.isin(group, groups[new])] = group[first + i]
    return np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)


def _tile_id(p, q, sub):
    cell = (F.col(p) * 64 + F.col(q)).cast("long")
    return F.shiftleft(cell, 40) + F.col(sub)


def tile_links(fingerprints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS):
    """Links (a, b) between distinct fingerprints (column fp) at `radius` bits or fewer.

    The links are a spanning forest of each pair of tiles: together they connect exactly
    what all links connect. A tile travels as one row; pairs of tiles are listed by number
    first, so that they are dealt out evenly.
    """
    high = F.bit_count(F.shiftrightunsigned("fp", 32))
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    cells = fingerprints.select("fp", high.alias("p"), low.alias("q"))
    # At most 33 x 33 pairs of population counts: always small enough to broadcast.
    cuts = cells.groupBy("p", "q").agg(F.ceil(F.count(F.lit(1)) / tile_rows).alias("cuts"))
    cuts = keep(cuts, "cells")
    sub = F.pmod(F.xxhash64("fp"), F.col("cuts"))
    tiled = cells.join(F.broadcast(cuts), ["p", "q"]).withColumn("sub", sub)
    tiles = tiled.groupBy(_tile_id("p", "q", "sub").alias("tile")).agg(F.collect_list("fp").alias("fps"))
    tiles = keep(tiles, "tiles")
    steps = [
        F.struct(F.lit(dp).alias("p"), F.lit(dq).alias("q"))
        for dp in range(-radius, radius + 1)
        for dq in range(-radius, radius + 1)
        if abs(dp) + abs(dq) <= radius
    ]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = cuts.select("p", "q", "cuts", F.explode(F.array(*steps)).alias("by")).select(
        "p", "q", "cuts", (F.col("p") + F.col("by.p")).alias("p2"), (F.col("q") + F.col("by.q")).alias("q2")
    )
    others = cuts.select(F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("cuts").alias("cuts2"))
    pairs = own.join(F.broadcast(others), ["p2", "q2"]).withColumn("sub", every("cuts"))
    pairs = pairs.withColumn("sub2", every("cuts2")).select(
        _tile_id("p", "q", "sub").alias("one"), _tile_id("p2", "q2", "sub2").alias("two")
    )
    left = tiles.select(F.col("tile").alias("one"), F.col("fps").alias("left"))
    right = tiles.select(F.col("tile").alias("two"), F.col("fps").alias("right"))
    # A pair comes from both of its tiles; the join drops tiles that the hash has left empty.
    met = pairs.filter("one <= two").join(left, "one").join(right, "two")

    def compare(batches):
        for rows in batches:
            for one, two, left, right in zip(rows["one"], rows["two"], rows["left"], rows["right"]):
                left = np.asarray(left, dtype=np.int64).view(np.uint64)
                right = None if one == two else np.asarray(right, dtype=np.int64).view(np.uint64)
                found = _forest(left, right, radius)
                if len(found):
                    yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return met.select("one", "two", "left", "right").mapInPandas(compare, "a long, b long")


def groups(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_key, fp, component_id, root) of every document row.

    text_key hashes the text; root is a fingerprint of the component that no other one has.
    """
    texts = documents.select("doc_id", "text", F.xxhash64(utf8("text")).alias("text_key"))
    marked = keep(with_fingerprint(texts).drop("text"), "fingerprints")
    firsts = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "firsts")
    links = keep(tile_links(firsts, radius), "tile-links")
    linked = firsts.join(components(links), F.col("fp") == F.col("node")).select("fp", "root", "first_id")
    low = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = linked.join(low, "root").select("fp", "component_id", "root")
    ids = firsts.join(joined, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    # Written, so that both sides of the last join are plain scans and a hot fingerprint is split.
    ids = keep(ids, "component-ids")
    return marked.join(ids, "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def first_of_each(documents: DataFrame) -> DataFrame:
    """Documents without near copies: the smallest id of each component stays.

    A null id stays only if its component has no other id. Of different texts with the same
    id (or none) the one with the smallest hash stays. Rows that repeat an id and a text are
    all kept here (exact dedup removes repeated rows). Only texts of documents that have a near
    copy are shuffled.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    found = keep(groups(documents).select("doc_id", "text_key", "root"), "groups")
    stays = keep(found.groupBy("root").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n")), "stays")
    first = stays.select("root", "n", F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
    # All rows of components of more than one: what is no loser for certain is alone in its own.
    losers = found.join(first.filter("n > 1").select("root"), "root", "left_semi")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sure, rest = parted(
        documents, F.xxhash64("doc_id", F.xxhash64(text)), losers, F.xxhash64("doc_id", "text_key")
    )
    same = rest["doc_id"].eqNullSafe(first["_id"]) & (F.xxhash64(text) == first["_key"])
    return sure.unionByName(rest.join(first, same, "left_semi"))
