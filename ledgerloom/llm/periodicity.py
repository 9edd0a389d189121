"""Periodic runs of words, caught online at the ends of dyadic blocks.

A run is a stretch of words with smallest period q, at least twice as long as q, that no
neighbouring word extends. Words are appended; whenever a block of 2**k words is complete, a
catcher stands at its end c and watches the words c + 2**k to c + 2**(k+1) - 1 that follow.
Each appended word t advances one suffix comparison a level: how far what ends before t agrees
with what ends before c, and then how far what follows t agrees with what follows c. Where the
two reach t - c together, a square of that period is caught. A square of period p holds the
end of a block of the largest power of two within p, so one catcher sees it. The reach of the
comparisons is the whole run, so squares of one run merge by their ends, and the smallest
period caught for a stretch is its own.

Comparisons use hashes of 2**k words (from the hashes of halves), so a word costs a few array
steps a level and a comparison as many as there are levels. Words are numbered by a
dictionary, and every run is compared word by word in the end: if a hash has lied, the texts
are searched again under another seed.

A task works on blocks of texts of like length, with a separator of its own after each. A text
of n words takes about 8 * n * log2(n) bytes; nothing is shuffled, and texts are never cut.

Defined cases: null and empty texts have no words and no runs; words are runs of bytes other
than space, tab, line feed, vertical tab, form feed and carriage return; repeated rows are
searched each; an empty table gives no rows; other columns stay, one of the result column's
name is replaced.
"""

from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, utf8
from ledgerloom.llm.words import mix64

MIN_LENGTH = 12
#: Words of one block of texts; a longer text is a block of its own.
BLOCK_WORDS = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """The runs of a growing sequence of word numbers."""

    def __init__(self, min_length=MIN_LENGTH, seed=0):
        self.min_length, self.seed = min_length, seed
        self.ids = np.empty(0, dtype=np.int64)
        #: levels[k][i] is the hash of the 2**k words from i on.
        self.levels = []
        self._open = np.empty((2, 0), dtype=np.int64)
        self._caught = [np.empty((3, 0), dtype=np.int64)]

    def append(self, ids, longest=None):
        """Go on with `ids`; catch the squares that these words complete.

        No run is longer than `longest`, where given; longer periods are not looked for.
        """
        before = len(self.ids)
        self.ids = np.concatenate([self.ids, np.asarray(ids, dtype=np.int64)])
        limit = len(self.ids) if longest is None else min(longest, len(self.ids))
        self._hash(before, limit)
        pairs = [self._open]
        for k in range((limit if longest is None else limit // 2).bit_length()):
            pairs += self._alike(k, before)
        at, word = np.concatenate(pairs, axis=1)
        back, on = self._back(at, word), self._on(at, word)
        settled = word + on < len(self.ids)
        self._open = np.stack([at, word])[:, ~settled]
        self._caught.append(self._squares(*(x[settled] for x in (at, word, back, on))))

    def runs(self):
        """(start, end, period) of the runs so far, as three arrays sorted by start and period."""
        at, word = self._open
        still = self._squares(at, word, self._back(at, word), self._on(at, word))
        start, end, period = np.concatenate([*self._caught, still], axis=1)
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), dtype=bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[first], end[first], period[first]
        order = np.lexsort((period, start))
        return start[order], end[order], period[order]

    def _hash(self, before, limit):
        """Hashes of the windows that the new words complete."""
        n = len(self.ids)
        with np.errstate(over="ignore"):
            for k in range(limit.bit_length()):
                if k == len(self.levels):
                    self.levels.append(np.empty(0, dtype=np.uint64))
                have = self.levels[k]
                if k == 0:
                    fresh = mix64(self.ids[before:].astype(np.uint64) * _ODD + np.uint64(self.seed + 1))
                else:
                    half, below = 1 << (k - 1), self.levels[k - 1]
                    left = below[len(have) : n + 1 - (1 << k)]
                    fresh = mix64(left * _ODD + below[len(have) + half : len(have) + half + len(left)])
                self.levels[k] = np.concatenate([have, fresh])

    def _alike(self, k, before):
        """Pairs (catcher, word) of level k where one side agrees over half of what a run needs."""
        n, periods = len(self.ids), (1 << k, (2 << k) - 1)
        middle = min(max(self.min_length // 2, periods[0]), periods[1])
        need = min(max(p, self.min_length - p) for p in (periods[0], middle, periods[1]))
        level = max((need + 1) // 2, 1).bit_length() - 1
        if level >= len(self.levels):
            return []
        half, hashes = 1 << level, self.levels[level]
        # What ends before the word is known when the word comes, what follows it later.
        word = np.arange(max(before, periods[0]), n)
        at = ((word >> k) - 1) << k
        low = int(np.searchsorted(at, half))
        word, at = word[low:], at[low:]
        hit = hashes[at - half] == hashes[word - half]
        ending = np.stack([at[hit], word[hit]])
        word = np.arange(max(before - half, periods[0]), n - half + 1)
        at = ((word >> k) - 1) << k
        hit = hashes[at] == hashes[word]
        return [ending, np.stack([at[hit], word[hit]])]

    def _on(self, at, word):
        """How many words from `at` and from `word` on agree."""
        out = np.zeros(len(at), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            hashes = self.levels[k]
            inside = np.flatnonzero(word + out < len(hashes))
            same = hashes[(at + out)[inside]] == hashes[(word + out)[inside]]
            out[inside[same]] += 1 << k
        return out

    def _back(self, at, word):
        """How many words that end before `at` and before `word` agree."""
        out = np.zeros(len(at), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            hashes = self.levels[k]
            inside = np.flatnonzero(at - out >= 1 << k)
            same = hashes[(at - out)[inside] - (1 << k)] == hashes[(word - out)[inside] - (1 << k)]
            out[inside[same]] += 1 << k
        return out

    def _squares(self, at, word, back, on):
        period = word - at
        caught = (back + on >= period) & (back + period + on >= self.min_length)
        return np.stack([at - back, word + on, period])[:, caught]


def _true(ids, start, end, period):
    """Whether every run has its period and ends where it should, word by word."""
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
        if (s > 0 and ids[s - 1] == ids[s - 1 + p]) or (e < len(ids) and ids[e] == ids[e - p]):
            return False
        if not np.array_equal(ids[s : e - p], ids[s + p : e]):
            return False
    return True


def find_runs(texts, min_length=MIN_LENGTH):
    """(start, length, period) of the runs of each text, sorted; texts are lists of words."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    numbers = {}
    flat = (numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(texts))
    flat = np.fromiter(flat, dtype=np.int64, count=int(sizes.sum()))
    begins = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(len(flat) + len(texts), dtype=np.int64)
    ids[begins + sizes] = -1 - np.arange(len(texts))
    ids[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), sizes)] = flat
    for seed in range(1 << 30):
        catchers = Catchers(min_length, seed)
        catchers.append(ids, longest=int(sizes.max(initial=0)))
        start, end, period = catchers.runs()
        if _true(ids, start, end, period):
            break
    text = np.searchsorted(begins, start, side="right") - 1
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    found = np.stack([start - begins[text], end - start, period], axis=1)
    return [found[a:b] for a, b in zip(cut[:-1], cut[1:])]


def collapse(words, runs):
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(marks)[:-1] == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def blocks_by_length(texts, limit=BLOCK_WORDS):
    """Indexes of the texts, shortest first, in blocks of about `limit` words."""
    block, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if block and size + len(texts[i]) > limit:
            yield block
            block, size = [], 0
        block.append(i)
        size += len(texts[i]) + 1
    if block:
        yield block


_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def with_runs(
    documents: DataFrame, text: str = "text", column: str = "periodicity", min_length: int = MIN_LENGTH
) -> DataFrame:
    """Add a struct (n_words, runs, collapsed): the runs of each text by start and period, and
    its words joined by single spaces without those that a run repeats."""

    @F.pandas_udf(_FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        cut = [t.split() for t in texts]
        runs, collapsed = [None] * len(cut), [None] * len(cut)
        for block in blocks_by_length(cut):
            for i, own in zip(block, find_runs([cut[i] for i in block], min_length)):
                runs[i] = [dict(zip(("start", "length", "period"), r)) for r in own.tolist()]
                collapsed[i] = b" ".join(collapse(cut[i], own)).decode()
        return pd.DataFrame({"n_words": list(map(len, cut)), "runs": runs, "collapsed": collapsed})

    # Bytes split at exactly the ASCII white space; text would split at more.
    name = free_name(documents, "found")
    marked = documents.withColumn(name, found(utf8(text)))
    return marked.withColumn(column, F.col(name)).drop(name)
