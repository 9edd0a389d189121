"""Words of whole texts as numpy arrays: one pass over the UTF-8 bytes of many texts.

A word is a maximal run of word bytes after lower-casing A-Z. Every separator is an ASCII
byte, so runs of bytes are exactly runs of characters. A word's hash is the sum of its bytes,
each mixed with its place in the word, mixed again; callers that need certainty compare the
bytes (`same_words`).
"""

from dataclasses import dataclass

import numpy as np

_PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def _separators(*ranges):
    table = np.ones(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = False
    return table


#: ASCII letters and digits and everything beyond ASCII make a word.
ALNUM = _separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def lower_table():
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix64(x):
    """Spread the bits of a uint64 array (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hashes(symbols, sizes, bits):
    """Hash of every sequence; `symbols` of `bits` bits lie in a row, `sizes` cut them.

    A symbol and its place are mixed into 64 bits before they are added up, so no pattern of
    symbols cancels out as in sums of powers.
    """
    ends = np.cumsum(sizes)
    place = np.arange(len(symbols)) - np.repeat(ends - sizes, sizes)
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = mix64((place.astype(np.uint64) << np.uint64(bits)) | symbols.astype(np.uint64))
        np.cumsum(mixed, out=sums[1:])
        return mix64(sums[ends] - sums[ends - sizes] + np.uint64(_BASE))


def same_sequences(a, a_start, b, b_start, sizes):
    """Whether a[a_start:][:size] equals b[b_start:][:size], for every place and size."""
    ends = np.cumsum(sizes)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    wrong = a[np.repeat(a_start, sizes) + place] != b[np.repeat(b_start, sizes) + place]
    upto = np.concatenate([[0], np.cumsum(wrong)])
    return upto[ends] == upto[ends - sizes]


@dataclass
class Words:
    """Words of several texts. `bounds[i]:bounds[i+1]` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    def doc(self):
        """The text index of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def text(self, i):
        return self.data[self.start[i] : self.end[i]].tobytes()

    def grams(self, n):
        """(hash of every run of n words within one text, index of its first word)."""
        count = len(self.start) - n + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        doc = self.doc()
        first = np.flatnonzero(doc[:count] == doc[n - 1 :])
        return self.gram_hashes(first, range(n)), first

    def gram_hashes(self, first, steps):
        """Hash of the words at first+step, for each step in turn."""
        out = np.zeros(len(first), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in steps:
                out = mix64(out * np.uint64(_BASE) + self.hash[first + k] + np.uint64(1 + k))
        return out


def _scan(data, table, offset):
    """(start, end, hash) of the words of one piece; positions are moved by `offset`."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashes = sequence_hashes(data[inside[1:-1].view(bool)], end - start, 8)
    return start + offset, end + offset, hashes


def same_words(one, i, other, j):
    """Whether word i[k] of `one` is word j[k] of `other`, byte by byte, for every k."""
    out = (one.end - one.start)[i] == (other.end - other.start)[j]
    at = np.flatnonzero(out)
    i, j = i[at], j[at]
    out[at] = same_sequences(one.data, one.start[i], other.data, other.start[j], (one.end - one.start)[i])
    return out


def find_words(texts, table=ALNUM, lower=True) -> Words:
    """Words of a list of UTF-8 byte strings (None counts as empty)."""
    texts = [t or b"" for t in texts]
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    if lower:
        joined = lower_table()[joined]
    parts, at = [], 0
    while at < len(joined):
        to = min(at + _PIECE, len(joined))
        if to < len(joined) and table[joined[to - 1]]:
            # Cut at a separator: the last one of the piece, else the next one.
            gaps = np.flatnonzero(~table[joined[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            else:
                rest = ~table[joined[to:]]
                to = to + int(rest.argmax()) + 1 if rest.any() else len(joined)
        parts.append(_scan(joined[at:to], table, at))
        at = to
    if not parts:
        parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    start, end, hashes = (np.concatenate(x) for x in zip(*parts))
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    return Words(joined, start, end, hashes, np.searchsorted(start, begins))


def blocks(texts, limit=1 << 20):
    """Index ranges of consecutive texts of about `limit` bytes together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"") + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
