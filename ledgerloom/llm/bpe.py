"""Byte-level BPE, exact, by last-token states along a trie of the distinct words.

The encoding of a word is fixed by the last token of each of its prefixes: the last token of
a prefix is the one suffix token that joins cleanly with the last token of what remains
before it. Sorting the distinct words of a block lays their trie out depth first, so the path
from the root fits in one list: a word goes on from the states of the prefix it shares with
the word before it, and each trie node is computed once. Two tokens join cleanly if merging
their bytes would give the two back; that is decided by undoing the later merge at the
boundary step by step, and remembered.

Texts are cut into words by the vocabulary's pattern on arrays of character kinds, a block of
texts at a time; equal words of a block are found by a hash and compared, so that each distinct
word is handled once. A worker process keeps its encoder and the encodings of words it has met,
up to a bound, from task to task; nothing is shuffled, and the vocabulary file is read once by
the driver and sent to the executors (a few megabytes).

Defined cases: null texts count as empty and give no tokens; the special tokens of the file
are recognized inside texts; very long words only need a list of their own length; repeated
rows are encoded each; extra columns stay, those of the result columns' names are replaced; an
empty table gives no rows.
"""

import hashlib
import json
import struct

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, kept_in_process
from ledgerloom.llm.words import same_sequences, sequence_hashes

# Fixed value: the pattern that cuts texts into words before merging; `cut_words` does the same.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTER, DIGIT, SPACE, OTHER = range(4)
#: Encoded words that a worker remembers.
MEMORY_WORDS = 500_000
BLOCK_CHARS = 500_000


def byte_letters():
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in printable else next(spare)): b for b in range(256)}


def character_kinds():
    """The kind of every code point: letter, digit, space or other."""
    return kept_in_process("kinds", _make_kinds)


def _make_kinds():
    # By the library's own patterns: other libraries know other versions of Unicode.
    from tokenizers import Regex, pre_tokenizers

    table = np.full(0x110000, OTHER, dtype=np.uint8)
    # Surrogates stand in no text; a placeholder keeps positions and code points equal.
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "-" for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for _, (start, end) in cut.pre_tokenize_str(every):
            table[start:end] = kind
    return table


def cut_words(points, begins):
    """Starts of the words of texts: `points` are their code points, `begins` where each begins.

    Every run of one kind is a word. The last space of a run of white space belongs to the
    word after it if it is a plain space, and is a word of its own otherwise; white space at
    the end of a text stays together. An apostrophe takes s, t, m, d, re, ve or ll along.
    """
    n = len(points)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    kind = character_kinds()[points]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[begins] = True
    fresh[n] = True
    change = fresh[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)
    end = np.append(run[1:], n)
    space = kind[run] == SPACE
    word = np.zeros(n + 1, dtype=bool)
    word[run] = True
    # White space with a word after it in the same text gives up its last character.
    gives = space & ~fresh[end]
    word[end[gives] - 1] = True
    plain = gives & (points[end - 1] == 32)
    word[end[plain]] = False
    # Apostrophes at the start of a word, alone, with the right letters after them.
    lone = np.flatnonzero((points[run] == 39) & (end - run == 1) & word[run] & ~fresh[end])
    lone = lone[kind[end[lone]] == LETTER] if len(lone) else lone
    if len(lone):
        at, stop = end[lone], end[lone + 1]
        first, second = points[at], points[np.minimum(at + 1, n - 1)]
        one = np.isin(first, [115, 116, 109, 100])
        pair = ((first == 114) | (first == 118)) & (second == 101) | (first == 108) & (second == 108)
        taken = np.where(one, 1, np.where(pair & (at + 1 < stop), 2, 0))
        at, stop, taken = at[taken > 0], stop[taken > 0], taken[taken > 0]
        word[at] = False
        after = at + taken
        word[after[after < stop]] = True
    return np.flatnonzero(word[:n])


def distinct_words(points, starts, ends):
    """(a place of every distinct word, the number of each word among them).

    Words are grouped by a hash and then compared with the first of their group, character by
    character; should a hash stand for two words, they are grouped by their characters. Words
    may have gaps between them.
    """
    sizes = ends - starts
    inside = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    hashes = sequence_hashes(points[inside], sizes, 21)
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[word]
    if (sizes == sizes[like]).all() and same_sequences(points, starts, points, starts[like], sizes).all():
        return first, word
    numbers, first, word = {}, [], np.empty(len(starts), dtype=np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        word[i] = n = numbers.setdefault(points[a:b].tobytes(), len(first))
        if n == len(first):
            first.append(i)
    return np.array(first, dtype=np.int64), word


class Encoder:
    """A byte-level vocabulary whose ids follow the order of the merges."""

    block_chars = None

    def __init__(self, content: bytes, extra=()):
        """`extra` are further special tokens, numbered on from the vocabulary."""
        described = json.loads(content)
        letters = byte_letters()
        plain = lambda token: bytes(letters[c] for c in token)
        self.ids = {plain(t): i for t, i in described["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        after = 1 + max([*self.ids.values(), *self.special.values()])
        self.special.update((t, after + k) for k, t in enumerate(extra))
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        self.merged, self.parts = {}, {}
        for pair in described["model"]["merges"]:
            left, right = (self.ids[plain(x)] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = self.ids[self.bytes_of[left] + self.bytes_of[right]]
            self.merged[left, right] = whole
            self.parts[whole] = (left, right)
        self.longest = max(map(len, self.ids))
        self.sizes = {i: len(t) for i, t in self.bytes_of.items()}
        # The bytes of all tokens in a row, for decoding by index.
        tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.token_sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.clean, self.memory, self.older = {}, {}, {}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def joins_cleanly(self, left, right):
        """Whether `left` and `right` stay two tokens next to each other."""
        limit = len(self.bytes_of) + 1
        while True:
            whole = self.merged.get((left, right))
            if whole is not None and whole < limit:
                return False
            later = max(left, right)
            if later not in self.parts:
                return True
            if left > right:
                limit, left = left, self.parts[left][1]
            else:
                limit, right = right + 1, self.parts[right][0]

    def encode_words(self, words):
        """Encode distinct words (bytes, sorted) along their trie; yields lists of ids."""
        ids, clean, longest, sizes = self.ids, self.clean, self.longest, self.sizes
        last, before = [0], b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for begin in range(end - 1, max(-1, end - longest - 1), -1):
                    token = ids.get(word[begin:end])
                    if token is None:
                        continue
                    if begin == 0:
                        break
                    pair = last[begin] << 32 | token
                    fits = clean.get(pair)
                    if fits is None:
                        if len(clean) > 2_000_000:
                            clean.clear()
                        fits = clean[pair] = self.joins_cleanly(last[begin], token)
                    if fits:
                        break
                last.append(token)
            before, at, out = word, len(word), []
            while at:
                token = last[at]
                out.append(token)
                at -= sizes[token]
            out.reverse()
            yield out

    def _remember(self, words):
        """Have the encodings of `words` in memory: words met again lately outlive the others."""
        if len(self.memory) + len(words) > MEMORY_WORDS // 2:
            self.older, self.memory = self.memory, {}
        missing = [w for w in words if w not in self.memory]
        known = {w: self.older[w] for w in missing if w in self.older}
        self.memory.update(known)
        self._learn([w for w in missing if w not in known])

    def _learn(self, words):
        ordered = sorted((w.encode(), w) for w in words)
        for (_, word), found in zip(ordered, self.encode_words([b for b, _ in ordered])):
            self.memory[word] = struct.pack(f"<{len(found)}I", *found)

    def encode(self, texts):
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out, block, size, limit = [], [], 0, self.block_chars or BLOCK_CHARS
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= limit:
                out += self._encode_block(block)
                block, size = [], 0
        return out + self._encode_block(block)

    def _segments(self, texts):
        """Parts of the texts between special tokens: (parts, text of each, special token after)."""
        parts, owner, after = [], [], []
        for i, text in enumerate(texts):
            if self.cut is None or not any(t in text for t in self.special):
                own = [text]
            else:
                own = self.cut.split(text)
            for k in range(0, len(own), 2):
                parts.append(own[k])
                owner.append(i)
                after.append(self.special[own[k + 1]] if k + 1 < len(own) else -1)
        return parts, np.array(owner, dtype=np.int64), np.array(after, dtype=np.int64)

    def _cut(self, points, begins):
        """Starts and ends of the words of texts that begin at `begins`."""
        starts = cut_words(points, begins)
        return starts, np.append(starts, len(points))[1:].astype(np.int64)

    def _encode_block(self, texts):
        parts, owner, after = self._segments(texts)
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        starts, ends = self._cut(points, begins[:-1][sizes > 0])
        first, word = distinct_words(points, starts, ends)
        distinct = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        self._remember(distinct)
        packed = [self.memory[w] for w in distinct]
        flat = np.frombuffer(b"".join(packed), dtype="<u4")
        lengths = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        offsets = np.cumsum(lengths) - lengths
        # Ids of all words in order, then cut by part, with the special token after each.
        own = lengths[word]
        places = np.cumsum(own) - own
        every = flat[np.repeat(offsets[word] - places, own) + np.arange(own.sum())]
        upto = np.append(places, own.sum())[np.searchsorted(starts, begins)]
        out = [[] for _ in texts]
        for k, i in enumerate(owner.tolist()):
            out[i].append(every[upto[k] : upto[k + 1]].tobytes())
            if after[k] >= 0:
                out[i].append(struct.pack("<I", after[k]))
        return [b"".join(ids) for ids in out]

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, dtype="<u4")
        length = self.token_sizes[found]
        upto = np.cumsum(length)
        first = np.repeat(self.token_starts[found] - (upto - length), length)
        return self.token_bytes[first + np.arange(len(first))].tobytes().decode("utf-8", errors="replace")


def _encoder(content):
    """The encoder of a worker process, built once."""
    key = ("bpe", hashlib.sha256(content).digest())
    return kept_in_process(key, lambda: Encoder(content))


def send_vocabulary(spark, path: str):
    """Read a tokenizer file on the driver and send it to the executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def with_ids(documents: DataFrame, vocabulary, text: str = "text", column: str = "ids") -> DataFrame:
    """Add the ids of `text` as packed little-endian unsigned 32-bit integers (binary)."""

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoder(vocabulary.value).encode(list(texts)), dtype=object)

    return documents.withColumn(column, encoded(F.coalesce(F.col(text), F.lit(""))))


def with_decoded(documents: DataFrame, vocabulary, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Add the text that packed ids stand for."""

    @F.pandas_udf("string")
    def decoded(packed: pd.Series) -> pd.Series:
        encoder = _encoder(vocabulary.value)
        return pd.Series([encoder.decode(x or b"") for x in packed], dtype=object)

    return documents.withColumn(column, decoded(F.col(ids)))


def encoded_documents(documents: DataFrame, path: str) -> DataFrame:
    """`documents` with ids, n_tokens and decoded, by one function: one Python worker a task.

    Columns of these names are replaced.
    """
    vocabulary = send_vocabulary(documents.sparkSession, path)

    @F.pandas_udf("ids binary, decoded string")
    def coded(texts: pd.Series) -> pd.DataFrame:
        encoder = _encoder(vocabulary.value)
        ids = encoder.encode(list(texts))
        return pd.DataFrame({"ids": ids, "decoded": [encoder.decode(x) for x in ids]}, dtype=object)

    name = free_name(documents, "coded")
    marked = documents.withColumn(name, coded(F.coalesce(F.col("text"), F.lit(""))))
    return marked.withColumns(
        {
            "ids": F.col(name)["ids"],
            "decoded": F.col(name)["decoded"],
            "n_tokens": (F.octet_length(F.col(name)["ids"]) / 4).cast("long"),
        }
    ).drop(name)
