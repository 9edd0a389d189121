"""Benchmark decontamination: which test items stand inside which documents.

Containment of an item is the share of its distinct shingles (runs of five words) that the
document has. Items are partitioned by size, in powers of two, and sketched by the smallest
hashes of their shingles (a bottom-k MinHash); k follows from the size class: an item that
is contained by the threshold misses at most a known number of shingles, so a document that
contains it shows at least the rest of its sketch. Documents are not sketched: all their
shingles are looked up, so a short item is found inside a document of any length and no
item above the threshold is missed. Candidates are verified by exact containment on words.

Equal item texts are searched once. Items are cut into blocks of bounded bytes, and one block
at a time goes through the driver to the tasks, where a process sketches it once into sorted
arrays; before the next block is sent, the matches of the last are written and its broadcast
is removed. So memory follows the size of a block, whatever the number of items or of their
copies. Documents are neither shuffled nor joined with each other; with more than one block
they are written once with a row number, by which the few rows with matches come together.

Defined cases: words are runs of letters and digits after lower-casing; an item of fewer
than five words has one shingle, its whole word sequence; items without words match nothing;
null and empty texts match nothing; repeated items and documents are reported each; null ids
are carried along; extra columns stay; empty tables give no matches.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, keep, kept_in_process
from ledgerloom.llm.words import Words, blocks, find_words, same_words

SHINGLE = 5
THRESHOLD = 0.8
#: Bytes of item texts that are sent to the tasks at once; arrays take some ten times as much.
BLOCK_BYTES = 8 << 20


def lowered(column: str = "text"):
    return F.lower(F.coalesce(F.col(column), F.lit(""))).cast("binary")


@dataclass(frozen=True)
class Items:
    """Items of one block. Their distinct shingles are sorted by item and hash; `bounds` cut
    them by item. The sketches are sorted by hash."""

    words: Words
    lengths: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    bounds: np.ndarray
    needed: np.ndarray
    sketch_hashes: np.ndarray
    sketch_items: np.ndarray

    def count(self, item):
        return int(self.bounds[item + 1] - self.bounds[item])


def _same_shingles(one, i, other, j, lengths):
    """Whether the `lengths` words of `one` from i on are those of `other` from j on."""
    out = np.ones(len(i), dtype=bool)
    for k in range(int(lengths.max(initial=0))):
        at = np.flatnonzero(out & (lengths > k))
        out[at] = same_words(one, i[at] + k, other, j[at] + k)
    return out


def _distinct(words, item, hashes, first, lengths):
    """Which of the shingles, sorted by item and hash, differ from those before them."""
    fresh = np.ones(len(hashes), dtype=bool)
    if not len(hashes):
        return fresh
    group = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (hashes[1:] != hashes[:-1])))
    head = np.repeat(group, np.diff(np.append(group, len(hashes))))
    fresh[head != np.arange(len(hashes))] = False
    other = np.flatnonzero(~fresh & ~_same_shingles(words, first, words, first[head], lengths[item]))
    # A hash that stands for two shingles of one item: tell them apart by their words.
    seen = {}
    for i in other.tolist():
        text = tuple(words.text(first[i] + k) for k in range(lengths[item[i]]))
        fresh[i] = seen.setdefault((head[i], text), i) == i
    return fresh


def sketch_items(texts, threshold=THRESHOLD, size=SHINGLE) -> Items:
    """Size classes and bottom-k sketches of lower-cased item texts (bytes)."""
    words = find_words(texts, lower=False)
    lengths = np.minimum(np.diff(words.bounds), size)
    parts = []
    for n in np.unique(lengths[lengths > 0]).tolist():
        hashes, first = words.grams(n)
        item = words.doc()[first]
        own = lengths[item] == n
        parts.append((item[own], hashes[own], first[own]))
    none = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
    item, hashes, first = (np.concatenate(x) for x in zip(none, *parts))
    order = np.lexsort((first, hashes, item))
    item, hashes, first = item[order], hashes[order], first[order]
    fresh = _distinct(words, item, hashes, first, lengths)
    item, hashes, first = item[fresh], hashes[fresh], first[fresh]
    bounds = np.searchsorted(item, np.arange(len(texts) + 1))
    count = np.diff(bounds)
    # The largest number of shingles in the item's size class, a power of two less one.
    largest = (1 << np.ceil(np.log2(count + 1)).astype(np.int64)) - 1
    k = np.minimum(count, 2 * ((1 - threshold) * largest).astype(np.int64) + 1)
    missing = count - np.ceil(threshold * count - 1e-9).astype(np.int64)
    in_sketch = np.arange(len(item)) - bounds[item] < k[item]
    order = np.argsort(hashes[in_sketch], kind="stable")
    return Items(
        words,
        lengths,
        hashes,
        first,
        bounds,
        k - missing,
        hashes[in_sketch][order],
        item[in_sketch][order],
    )


def _hits(found, hashes, members):
    """(position in `found`, member) of every entry of the sorted `hashes` that is met."""
    first = np.searchsorted(hashes, found, "left")
    count = np.searchsorted(hashes, found, "right") - first
    at = np.repeat(np.arange(len(found)), count)
    steps = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return at, members[np.repeat(first, count) + steps]


def find_items(texts, items: Items, threshold=THRESHOLD):
    """For every lower-cased text (bytes): [(item, shared shingles)] at the threshold."""
    out = [[] for _ in texts]
    if not len(items.sketch_hashes):
        return out
    distinct, n_items = np.unique(items.sketch_hashes), len(items.lengths)
    sizes = np.unique(items.lengths[items.lengths > 0]).tolist()
    for begin, end in blocks(texts):
        words = find_words(texts[begin:end], lower=False)
        doc = words.doc()
        grams = {n: words.grams(n) for n in sizes}
        hashes, starts = (np.concatenate(x) for x in zip(*grams.values()))
        near = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
        met = distinct[near] == hashes
        pairs = np.unique(
            np.stack([doc[starts[met]].astype(np.uint64), hashes[met]], axis=1), axis=0
        ).reshape(-1, 2)
        at, item = _hits(pairs[:, 1], items.sketch_hashes, items.sketch_items)
        keys, seen = np.unique(pairs[at, 0].astype(np.int64) * n_items + item, return_counts=True)
        for key in keys[seen >= items.needed[keys % n_items]].tolist():
            d, i = divmod(key, n_items)
            same = _shared(words, d, *grams[int(items.lengths[i])], items, i)
            if same >= threshold * items.count(i) - 1e-9:
                out[begin + d].append((i, same))
    return out


def _shared(words, d, hashes, starts, items, item):
    """How many distinct shingles of an item stand in text `d`, compared word by word."""
    low, high = np.searchsorted(starts, words.bounds[d : d + 2])
    own = slice(items.bounds[item], items.bounds[item + 1])
    order = np.argsort(hashes[low:high], kind="stable")
    at, k = _hits(items.hashes[own], hashes[low:high][order], starts[low:high][order])
    lengths = np.full(len(at), items.lengths[item])
    same = _same_shingles(items.words, items.first[own][at], words, k, lengths)
    return len(np.unique(at[same]))


def _distinct_items(benchmark):
    """(item, text, n_bytes) of every distinct item text, written; `item` numbers them."""
    texts = benchmark.select(lowered().alias("text")).distinct()
    return keep(texts.select(F.monotonically_increasing_id().alias("item"), "text"), "items")


_MATCHES = "array<struct<item:long,n_shingles:int,n_shared:int>>"


def with_matches(
    documents: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    column: str = "matches",
) -> DataFrame:
    """Add `column`: an array of (item, n_shingles, n_shared), empty for clean texts.

    `items` are the distinct lower-cased texts (`item` long, `text` binary) of a written table.
    A column of the name is replaced.
    """
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    block_of = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    if n_blocks == 1:
        return documents.withColumn(column, _finder(items, threshold, size)[0](lowered()))
    row, name = free_name(documents, "row"), free_name(documents, "found")
    numbered = keep(documents.withColumn(row, F.monotonically_increasing_id()), "documents")
    hits = None
    for block in range(n_blocks):
        find, sent = _finder(items.filter(block_of == block), threshold, size)
        found = numbered.select(row, find(lowered()).alias(name)).filter(F.size(name) > 0)
        found = keep(found, "matches")
        sent.destroy()
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy(F.col(row).alias("_" + row)).agg(F.flatten(F.collect_list(name)).alias(name))
    joined = numbered.join(hits, F.col(row) == F.col("_" + row), "left")
    none = F.array().cast(_MATCHES)
    return joined.withColumn(column, F.coalesce(name, none)).drop(row, "_" + row, name)


def _finder(items, threshold, size):
    """A function that finds the items of one block, and the broadcast it reads."""
    part = sorted((bytes(r["text"]), r["item"]) for r in items.select("item", "text").collect())
    sent = items.sparkSession.sparkContext.broadcast(part)
    key = ("items", uuid.uuid4().hex)

    def found_in(texts: pd.Series) -> pd.Series:
        part = sent.value
        known = kept_in_process("items", dict)
        if key not in known:
            # One block at a time: that of an earlier search goes.
            known.clear()
            known[key] = sketch_items([text for text, _ in part], threshold, size)
        own = known[key]
        every = find_items(list(texts), own, threshold)
        shown = lambda i, n: {"item": part[i][1], "n_shingles": own.count(i), "n_shared": n}
        return pd.Series([[shown(i, n) for i, n in found] for found in every], dtype=object)

    # Spark would search twice, once to drop empty results before they are exploded.
    return F.pandas_udf(found_in, _MATCHES).asNondeterministic(), sent


def search(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), one row per match.

    Every id of an item text has a row of its own.
    """
    items = _distinct_items(benchmark)
    names = benchmark.select("item_id", lowered().alias("_text"))
    names = names.join(items, F.col("_text") == F.col("text")).select("item_id", F.col("item").alias("_item"))
    marked = with_matches(documents.select("doc_id", "text"), items, threshold)
    rows = marked.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
    rows = rows.join(names, F.col("item") == F.col("_item"))
    share = (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    return rows.select("doc_id", "item_id", "n_shingles", "n_shared", share)


def without_leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that contain no item, with their columns unchanged."""
    name = free_name(documents, "matches")
    marked = with_matches(documents, _distinct_items(benchmark), threshold, column=name)
    return marked.filter(F.size(name) == 0).drop(name)
