"""Cost-balanced packing of documents into training sequences.

Every document is encoded, closed by an end token, and cut: whole sequences are taken off its
front, the rest is an item. Items are placed in windows of some million tokens. A window has
as many sequences as its tokens fill; what is left over makes shorter sequences whose lengths
are powers of two, which need no padding either. The cost of a piece is its tokens plus their
square over a scale (linear layers and attention within the piece). Items go, longest first,
to the sequence of lowest cost that has room for the whole item; where none has, the item fills
up the sequence of lowest cost that has any room, and its rest is queued again. The room of a
window is exactly its tokens, so every sequence ends up full.

A task packs the documents it reads, window after window, so no text and no token is shuffled
and memory is bounded by a window and one text. Sequence numbers hold the partition's number;
a task that is run again packs the same rows in the same way. They belong to one run over one
layout of the input: write the result once and go on from there.

Defined cases: null and empty texts are the end token alone; a document longer than a window is
a window of its own; rows with null or repeated ids are documents of their own; an empty table
gives no rows; columns beside the id and the text play no part.
"""

import hashlib
import heapq
import json
import struct
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ledgerloom.llm.bpe import DIGIT, LETTER, SPACE, Encoder, byte_letters, character_kinds, send_vocabulary
from ledgerloom.llm.common import kept_in_process

CAPACITY = 4096
#: Tokens of a window; its ids take four bytes each.
WINDOW_TOKENS = 1 << 22
#: Tokens of a piece at which attention costs as much as the linear layers.
COST_SCALE = 24_576
#: Pieces that are merged together.
MERGED_WORDS = 20_000


def cut_pieces(points, begins):
    """Starts and ends of the pieces of texts: runs of letters, single digits, runs of other
    characters; white space is dropped. An apostrophe takes s, t, m, d, re, ve or ll along."""
    n = len(points)
    if n == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    kind = character_kinds()[points]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[begins] = True
    fresh[n] = True
    start = fresh.copy()
    start[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    run = np.flatnonzero(start[:n])
    end = np.append(run[1:], n)
    lone = np.flatnonzero((points[run] == 39) & (end - run == 1) & ~fresh[end])
    lone = lone[kind[end[lone]] == LETTER] if len(lone) else lone
    if len(lone):
        at, stop = end[lone], end[lone + 1]
        first, second = points[at], points[np.minimum(at + 1, n - 1)]
        pair = np.isin(first, [114, 118]) & (second == 101) | (first == 108) & (second == 108)
        taken = np.where(np.isin(first, [115, 116, 109, 100]), 1, np.where(pair & (at + 1 < stop), 2, 0))
        at, stop, taken = at[taken > 0], stop[taken > 0], taken[taken > 0]
        start[at] = False
        start[(at + taken)[at + taken < stop]] = True
        run = np.flatnonzero(start[:n])
        end = np.append(run[1:], n)
    held = kind[run] != SPACE
    return run[held], end[held]


def _unassigned():
    """Whether a code point is unknown to Python's version of Unicode, but maybe not to the library's."""
    return np.array([category(chr(c)) == "Cn" for c in range(0x110000)])


class WordEncoder(Encoder):
    """A vocabulary of byte letters whose pieces end in a mark of their own.

    Texts are composed, set in lower case and cut into pieces; equal pieces of a block are
    encoded once and remembered. New pieces are merged together, one merge a round each.
    """

    block_chars = 1_000_000

    def __init__(self, content):
        from tokenizers import Tokenizer

        described = json.loads(content)
        model, letters = described["model"], sorted(byte_letters().items(), key=lambda x: x[1])
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([ids[c] for c, _ in letters], dtype=np.int32)
        self.last = np.array([ids[c + end] for c, _ in letters], dtype=np.int32)
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.whole = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        self.order = np.argsort(keys).astype(np.int32)
        self.keys, self.none = keys[self.order], len(pairs)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.memory, self.older = {}, {}
        self.normalizer = Tokenizer.from_str(content.decode()).normalizer
        self.unknown = kept_in_process("unassigned", _unassigned)

    def _segments(self, texts):
        parts, owner, after = super()._segments(texts)
        points = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
        unknown = self.unknown[points]
        # A sigma at the end of a word has a lower case of its own for `lower` alone.
        normal = [normalize("NFC", p).replace("Σ", "σ").lower() for p in parts]
        if unknown.any():
            ends = np.cumsum([len(p) for p in parts])
            for k in np.unique(np.searchsorted(ends, np.flatnonzero(unknown), side="right")).tolist():
                normal[k] = self.normalizer.normalize_str(parts[k])
        return normal, owner, after

    def _cut(self, points, begins):
        return cut_pieces(points, begins)

    def _learn(self, words):
        ordered = sorted(words, key=len)
        for k in range(0, len(ordered), MERGED_WORDS):
            part = ordered[k : k + MERGED_WORDS]
            self.memory.update(zip(part, self.merge([w.encode() for w in part])))

    def ranks(self, left, right):
        """The place of every pair in the list of merges; `none` for no merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.order[at], self.none)

    def merge(self, words):
        """Packed ids of pieces (bytes, none empty).

        In every round each piece merges its first pair of the lowest rank, until none has any.
        """
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = int(sizes.max())
        held = np.full((len(words), width + 1), -1, dtype=np.int32)
        inside = np.arange(width + 1) < sizes[:, None]
        held[inside] = self.inner[np.frombuffer(b"".join(words), dtype=np.uint8)]
        held[np.arange(len(words)), sizes - 1] = self.last[[w[-1] for w in words]]
        rank, rows, steps = self.ranks(held[:, :-1], held[:, 1:]), np.arange(len(words)), np.arange(width + 1)
        while len(rows):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), at]
            on = least < self.none
            rows, at, least = rows[on], at[on], least[on]
            here, own = np.arange(len(rows)), held[rows]
            own[here, at] = self.whole[least]
            moved = np.minimum(steps + (steps > at[:, None]), width)
            own = np.take_along_axis(own, moved, axis=1)
            held[rows] = own
            rank = np.take_along_axis(rank[on], np.minimum(moved[:, :-1], width - 1), axis=1)
            rank[here, at] = self.ranks(own[here, at], own[here, at + 1])
            left = np.flatnonzero(at > 0)
            near = at[left] - 1
            rank[left, near] = self.ranks(own[left, near], own[left, near + 1])
        kept = held >= 0
        packed = held[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


def _encoder(content):
    """The encoder of a worker process, with the pieces it has met."""
    return kept_in_process(("packing", hashlib.sha256(content).digest()), lambda: WordEncoder(content))


def capacities(tokens, capacity):
    """Lengths of the sequences that `tokens` fill exactly."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << k for k in reversed(range(capacity.bit_length())) if rest >> k & 1]


def pack_window(sizes, capacity=CAPACITY, scale=COST_SCALE):
    """Rows (document, start, length, sequence, offset) for documents of `sizes` tokens.

    Ties of length go by the order of the documents, ties of cost by the sequence's number.
    """
    rows, queue, n = [], [], 0
    for doc, size in enumerate(sizes):
        for start in range(0, size - capacity + 1, capacity):
            rows.append((doc, start, capacity, n, 0))
            n += 1
        if size % capacity:
            queue.append((-(size % capacity), doc, size - size % capacity))
    heapq.heapify(queue)
    total = np.array(capacities(-sum(q[0] for q in queue), capacity), dtype=np.int64)
    room, cost = total.copy(), np.zeros(len(total))
    while queue:
        length, doc, start = heapq.heappop(queue)
        length = -length
        fits = room >= length
        whole = fits.any()
        best = int(np.where(fits if whole else room > 0, cost, np.inf).argmin())
        taken = length if whole else int(room[best])
        rows.append((doc, start, taken, n + best, int(total[best] - room[best])))
        room[best] -= taken
        cost[best] += taken + taken * taken / scale
        if taken < length:
            heapq.heappush(queue, (taken - length, doc, start + taken))
    return rows, n + len(total)


def pack(
    documents: DataFrame,
    path: str,
    end: int,
    capacity: int = CAPACITY,
    scale: float = COST_SCALE,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, capacity, ids): a row per piece.

    `path` is a tokenizer file that drops white space between words, `end` closes a document,
    `capacity` is a power of two. `start` counts the ids of the document before the piece,
    `offset` those of its sequence; `capacity` is the length of the sequence, `ids` are packed
    little-endian unsigned 32-bit integers.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    vocabulary = send_vocabulary(documents.sparkSession, path)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    longs = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = StructType(
        [rows.schema["doc_id"]]
        + [StructField(name, LongType()) for name in longs]
        + [StructField("capacity", IntegerType()), StructField("ids", BinaryType())]
    )

    def packed(keys, ids, first):
        """The pieces of one window as an Arrow batch, and the number of its sequences."""
        sizes = [len(x) for x in ids]
        found, n = pack_window(sizes, capacity, scale)
        found.sort(key=lambda r: (r[3], r[4]))
        doc, start, length, sequence, offset = np.array(found, dtype=np.int64).T
        filled = np.bincount(sequence, weights=length, minlength=n).astype(np.int32)[sequence]
        own = [ids[d][s : s + k].tobytes() for d, s, k, _, _ in found]
        numbers = [start, length, np.array(sizes, dtype=np.int64)[doc], first + sequence, offset]
        columns = [pa.concat_arrays(keys).take(pa.array(doc))]
        columns += [pa.array(x) for x in numbers] + [pa.array(filled), pa.array(own, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema.names), n

    def packs(batches):
        encoder, closing = _encoder(vocabulary.value), struct.pack("<I", end)
        first = TaskContext.get().partitionId() << 40
        keys, ids, size = [], [], 0
        for batch in batches:
            texts = encoder.encode(batch.column(1).to_pylist())
            found = [np.frombuffer(x + closing, dtype="<u4") for x in texts]
            begin = 0
            for i, own in enumerate(found):
                ids.append(own)
                size += len(own)
                if size >= window_tokens:
                    keys.append(batch.column(0).slice(begin, i + 1 - begin))
                    pieces, n = packed(keys, ids, first)
                    yield pieces
                    first, begin = first + n, i + 1
                    keys, ids, size = [], [], 0
            keys.append(batch.column(0).slice(begin))
        if ids:
            yield packed(keys, ids, first)[0]

    return rows.mapInArrow(packs, schema)
