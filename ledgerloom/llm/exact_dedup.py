"""Exact dedup with a minimal perfect hash over the distinct digests of a history.

The history's distinct digests are cut into buckets by their first bytes, and each bucket
gets a minimal perfect hash: rounds of bit arrays; a digest settles in the first round in
which no other digest shares its bit, and its slot is the number of bits set before its
own. A slot holds the full digest, the locator of the winner and the group's size. The
function maps every digest somewhere, so a lookup compares all digest bytes: equal ones are
repeats of the slot's group, the others are not in the history and group on their own.

Copies collapse to one row per digest on the map side before anything is shuffled, so a text
that makes up a third of all rows costs one row per task. Only digests and ids are moved.

Defined cases: ids are longs; null texts count as empty; an empty text is a text like any other; a null
id loses against any id; of rows that repeat the same id and text one row stays (`kept`
is true once per group); extra columns play no part; an empty table gives no rows.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, keep, parted, utf8

#: Digests of a bucket, as a mean, and the least number of buckets.
BUCKET_ROWS = 50_000
MIN_BUCKETS = 256
#: Bits of a round for each digest that has not settled yet.
LOAD = 2
ROUNDS = 64
#: Stands for a null id in a slot. It loses to every other id.
NO_ID = -(1 << 63)

_INDEX_FIELDS = "bucket int, rounds binary, sizes binary, digests binary, locators binary, rows binary, counts binary"


def _positions(digests, level, size):
    """Bit of every digest in one round. `digests` is n x 4 uint64."""
    with np.errstate(over="ignore"):
        x = digests[:, 1] + digests[:, 2] * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(32)) ^ digests[:, 3]
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(digests):
    """(bit arrays of the rounds, slot of every digest) for distinct digests."""
    rounds, slots = [], np.full(len(digests), -1, dtype=np.int64)
    left, before = np.arange(len(digests)), 0
    for level in range(ROUNDS):
        if not len(left):
            break
        size = LOAD * len(left) + 1
        at = _positions(digests[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        ranks = np.cumsum(alone) - 1
        slots[left[settled]] = before + ranks[at[settled]]
        before += int(alone.sum())
        rounds.append(alone)
        left = left[~settled]
    if len(left):
        raise ValueError("digests are not distinct")
    return rounds, slots


def find_slots(rounds, digests):
    """Slot of every digest, or -1 where no round has its bit."""
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, before = np.arange(len(digests)), 0
    for level, bits in enumerate(rounds):
        if not len(left):
            break
        at = _positions(digests[left], level, len(bits))
        hit = bits[at]
        slots[left[hit]] = before + np.cumsum(bits)[at[hit]] - 1
        before += int(bits.sum())
        left = left[~hit]
    return slots


def _as_words(column):
    joined = b"".join(column)
    return np.frombuffer(joined, dtype="<u8").reshape(-1, 4)


def _build(rows):
    digests = _as_words(rows["digest"])
    rounds, slots = build_hash(digests)
    order = np.argsort(slots)
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "rounds": [b"".join(np.packbits(r).tobytes() for r in rounds)],
            "sizes": [np.array([len(r) for r in rounds], dtype=np.int64).tobytes()],
            "digests": [digests[order].tobytes()],
            "locators": [rows["locator"].to_numpy(dtype=np.int64)[order].tobytes()],
            "rows": [rows["row"].to_numpy(dtype=np.int64)[order].tobytes()],
            "counts": [rows["n"].to_numpy(dtype=np.int64)[order].tobytes()],
        }
    )


def _unpack(index):
    rounds, at = [], 0
    for size in np.frombuffer(index["sizes"], dtype=np.int64):
        packed = np.frombuffer(index["rounds"], dtype=np.uint8, count=(size + 7) // 8, offset=at)
        rounds.append(np.unpackbits(packed, count=size).astype(bool))
        at += len(packed)
    return rounds


def bucket_of(digest: str, buckets: int):
    """Bucket of a digest column, from its first four bytes."""
    first = F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")
    return F.pmod(first, F.lit(buckets)).cast("int")


def collapse(digests: DataFrame) -> DataFrame:
    """(digest, locator, row, n): one row per digest; the largest (locator, row) wins.

    A null locator comes out as NO_ID and loses to every id.
    """
    top = F.max(F.struct(F.coalesce("locator", F.lit(NO_ID)).alias("locator"), "row")).alias("top")
    found = digests.groupBy("digest").agg(top, F.count(F.lit(1)).alias("n"))
    return found.select("digest", "top.locator", "top.row", "n")


def build_index(history: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(index, number of buckets) over `history`: digest (32 bytes), locator and row (longs).

    The index has one row per bucket that is not empty and is kept in the shared folder.
    """
    distinct = keep(collapse(history), "history")
    buckets = max(MIN_BUCKETS, -(-distinct.count() // bucket_rows))
    filed = distinct.withColumn("bucket", bucket_of("digest", buckets))
    index = filed.groupBy("bucket").applyInPandas(_build, _INDEX_FIELDS)
    return keep(index, "digest-index"), buckets


def look_up(arrivals: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Groups after `arrivals` (digest, locator, row) meet the index.

    (digest, locator, row, n, known): every digest of the index or of the arrivals once,
    with the winner and the size over both; `known` tells whether the index had it.
    """
    filed = collapse(arrivals).withColumn("bucket", bucket_of("digest", buckets))

    def match(came, slots):
        digests = _as_words(came["digest"])
        ids, rows, n = (came[c].to_numpy(dtype=np.int64) for c in ("locator", "row", "n"))
        known = np.empty((0, 4), dtype="<u8")
        best = best_row = sizes = np.empty(0, dtype=np.int64)
        member = np.zeros(len(digests), dtype=bool)
        if len(slots):
            entry = slots.iloc[0]
            known = np.frombuffer(entry["digests"], dtype="<u8").reshape(-1, 4)
            best, best_row, sizes = (
                np.frombuffer(entry[c], dtype=np.int64).copy() for c in ("locators", "rows", "counts")
            )
            at = find_slots(_unpack(entry), digests)
            member = (at >= 0) & (known[at] == digests).all(axis=1)
            own, new, new_row = at[member], ids[member], rows[member]
            wins = (new > best[own]) | ((new == best[own]) & (new_row > best_row[own]))
            best[own[wins]], best_row[own[wins]] = new[wins], new_row[wins]
            sizes[own] += n[member]
        every = np.concatenate([known, digests[~member]])
        return pd.DataFrame(
            {
                "digest": [x.tobytes() for x in every],
                "locator": np.concatenate([best, ids[~member]]),
                "row": np.concatenate([best_row, rows[~member]]),
                "n": np.concatenate([sizes, n[~member]]),
                "known": np.arange(len(every)) < len(known),
            }
        )

    met = filed.groupBy("bucket").cogroup(index.groupBy("bucket"))
    return met.applyInPandas(match, "digest binary, locator long, row long, n long, known boolean")


def groups(documents: DataFrame, history_share: float = 0.5) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept) of every document row.

    The older part of the ids is taken as the history, the rest as arrivals; the share
    moves work between index and lookups and changes no result.
    """
    rows = documents.select(
        F.col("doc_id").alias("locator"), F.unhex(F.sha2(utf8("text"), 256)).alias("digest")
    )
    # Row numbers tell rows of the same id and text apart; they are written, so they stay.
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    low, high = rows.agg(F.min("locator"), F.max("locator")).first()
    cut = 0 if low is None else low + int((high - low) * history_share)
    old = F.coalesce(F.col("locator") <= cut, F.lit(True))
    index, buckets = build_index(rows.filter(old))
    found = look_up(rows.filter(~old), index, buckets)
    winners = found.select(
        "digest",
        F.expr(f"nullif(locator, {NO_ID + 1} - 1)").alias("keep_id"),
        F.col("row").alias("best_row"),
        F.col("n").alias("group_size"),
    )
    joined = rows.join(winners, "digest")
    return joined.select(
        F.col("locator").alias("doc_id"), "digest", "keep_id", "group_size", (F.col("row") == F.col("best_row")).alias("kept")
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """Documents with one row per text: the row with the largest id stays.

    Rows that lose to no other are told by a bitmap and pass as they are; the texts of the
    others alone are shuffled.
    """
    found = keep(groups(documents), "groups")
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    losers = found.filter(~F.col("kept")).select("doc_id", "digest")
    sure, rest = parted(
        documents, F.xxhash64("doc_id", digest), losers, F.xxhash64("doc_id", "digest")
    )
    stays = found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    # Whole rows that repeat an id and a text are losers of their own row: all of them are here.
    name = free_name(rest, "_digest")
    marked = rest.withColumn(name, digest)
    same = marked["doc_id"].eqNullSafe(stays["_id"]) & (marked[name] == stays["_digest"])
    kept = marked.join(stays, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    return sure.unionByName(kept)
