import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import __spark_entry__
from ledgerloom.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_packing(sizes, capacity, scale):
    """The same rule with lists: longest item first, to the cheapest sequence with room."""
    rows, items, n = [], [], 0
    for doc, size in enumerate(sizes):
        while size - sum(r[2] for r in rows if r[0] == doc) >= capacity:
            rows.append((doc, sum(r[2] for r in rows if r[0] == doc), capacity, n, 0))
            n += 1
        done = sum(r[2] for r in rows if r[0] == doc)
        if done < size:
            items.append((size - done, doc, done))
    left, room = sum(i[0] for i in items), []
    while left:
        room.append(max(c for c in (2**k for k in range(30)) if c <= min(left, capacity)))
        left -= room[-1]
    held = [[] for _ in room]
    cost = lambda s: sum(k + k * k / scale for k in held[s])
    while items:
        length, doc, start = item = min(items, key=lambda i: (-i[0], i[1]))
        items.remove(item)
        fits = [s for s in range(len(room)) if room[s] - sum(held[s]) >= length]
        some = [s for s in range(len(room)) if room[s] > sum(held[s])]
        s = min(fits or some, key=lambda s: (cost(s), s))
        taken = min(length, room[s] - sum(held[s]))
        rows.append((doc, start, taken, n + s, sum(held[s])))
        held[s].append(taken)
        if taken < length:
            items.append((length - taken, doc, start + taken))
    return rows, n + len(room)


@pytest.mark.parametrize("seed", range(12))
def test_window_by_brute_force(seed):
    dice = random.Random(seed)
    sizes = [dice.choice((1, 7, dice.randrange(1, 300))) for _ in range(dice.randrange(1, 60))]
    for scale in (8, 1 << 20):
        assert packing.pack_window(sizes, 64, scale) == plain_packing(sizes, 64, scale)


def test_costs_are_balanced():
    dice = random.Random(5)
    sizes = [int(dice.paretovariate(1.2) * 40) % 4000 + 1 for _ in range(4000)]
    rows, n = packing.pack_window(sizes)
    cost, held = np.zeros(n), np.zeros(n)
    for _, _, length, sequence, _ in rows:
        cost[sequence] += length + length * length / packing.COST_SCALE
        held[sequence] += length
    # Against filling sequences one after another with the longest that fit.
    items, plain = sorted(sizes), []
    while items:
        room, spent = packing.CAPACITY, 0.0
        while room and items:
            k = max(bisect.bisect_right(items, room) - 1, 0)
            taken = min(items[k], room)
            if taken == items[k]:
                items.pop(k)
            else:
                bisect.insort(items, items.pop(k) - taken)
            room, spent = room - taken, spent + taken + taken * taken / packing.COST_SCALE
        plain.append(spent)
    full = cost[held == packing.CAPACITY]
    assert len(full) == sum(sizes) // packing.CAPACITY == len(plain) - 1
    assert full.std() < np.std(plain[:-1])


def test_capacities():
    assert packing.capacities(0, 64) == []
    assert packing.capacities(64 * 3 + 37, 64) == [64, 64, 64, 32, 4, 1]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return packing.WordEncoder(file.read())


def same_ids(encoder, library, texts):
    found = encoder.encode(texts)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_is_encoded_as_by_the_library(encoder, library, texts):
    same_ids(encoder, library, texts)


def test_words_and_their_ends(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 40)
    monkeypatch.setattr(packing, "MERGED_WORDS", 7)
    dice = random.Random(1)
    words = ["Straße", "E\u0301t", "It's", "'S", "x'", "<|endoftext|>", "a<|endoftext|>", "\u0301", "12", "--", "ΟΔΟΣ"]
    words += ["\u3000", "\n\n", "日本", ",", "I", "İ", "I\u0307", "K", "(a)", "don't!", "a\x1cb", "\x85", "=\u0338", "é."]
    tails = ["", " ", ".", "x", "!?", "'", "'s", "...", "\u0338", "\t", "\u00a0"]
    texts = [
        "".join(dice.choice(words) + dice.choice(tails) + dice.choice([" ", "", "\r\n"]) for _ in range(k))
        for k in range(0, 300, 3)
    ]
    same_ids(encoder, library, texts)
    same_ids(encoder, library, ["x" * 5000, "a. " * 3000, "", " \t\n"])


def test_every_character(encoder, library):
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = [" ".join("a" + c + c + "b" for c in letters[k : k + 400]) for k in range(0, len(letters), 400)]
    same_ids(encoder, library, rows)


def check(rows, expected, capacity):
    """Whether the pieces hold every document of `expected` (lists of ids by key) exactly once."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(docs) == set(expected)
    for key, pieces in docs.items():
        ids, at = [], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = np.frombuffer(r["ids"], dtype="<u4")
            assert r["start"] == at and r["length"] == len(own) > 0
            at += len(own)
            ids += own.tolist()
        assert ids == expected[key] and {r["doc_tokens"] for r in pieces} == {len(ids)}
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and at.bit_count() == 1 and {r["capacity"] for r in pieces} == {at}


def test_nulls_empty_long_and_clashing_columns(make, library):
    texts = {1: None, 2: "", 3: "one two three " * 3000, 4: "tie", 5: "tie", 6: "<|endoftext|> x", 7: "z" * 3000}
    docs = make(list(texts.items())).withColumnRenamed("label", "ids").withColumnRenamed("n", "length")
    expected = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts.items()}
    for window in (1, 500, 1 << 22):
        check(packing.pack(docs, PATH, 2, capacity=256, window_tokens=window).collect(), expected, 256)
    assert packing.pack(docs.limit(0), PATH, 2).count() == 0


def test_null_and_repeated_ids(make):
    rows = packing.pack(make([(None, "a b"), (None, "a b"), (4, "c"), (4, "c")]), PATH, 2).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows if r["start"] == 0) == [(0, 3), (0, 3), (4, 2), (4, 2)]


def test_capacity_is_a_power_of_two(make):
    with pytest.raises(ValueError):
        packing.pack(make([]), PATH, 2, capacity=1000)


def test_query(llm, sf_dir, library):
    documents = llm.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in documents}
    rows = __spark_entry__.queries()["op12_packing"](llm, sf_dir).collect()
    held = defaultdict(int)
    for r in rows:
        ids = np.array(expected[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert len(ids) == r["length"] and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        assert r["doc_tokens"] == len(expected[r["doc_id"]])
        held[r["sequence_id"]] += r["length"]
    assert sum(held.values()) == sum(map(len, expected.values()))
    assert all(n <= 4096 and n.bit_count() == 1 for n in held.values())
