import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import words as W

PATTERN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(max_size=40).map(str.encode), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    found = W.find_words(texts)
    for i, text in enumerate(texts):
        own = [found.text(k) for k in range(found.bounds[i], found.bounds[i + 1])]
        assert own == PATTERN.findall(lower(text or b""))


def test_equal_words_hash_equal_across_pieces(monkeypatch):
    monkeypatch.setattr(W, "_PIECE", 64)
    texts = [b"alpha beta gamma " * 40, b"x" * 500 + b" beta", b"", None, b"gamma alpha"]
    found = W.find_words(texts)
    by_text = {}
    for i in range(len(found.start)):
        assert by_text.setdefault(found.text(i), found.hash[i]) == found.hash[i]
    assert len(set(by_text.values())) == len(by_text) == 4
    hashes, first = found.grams(2)
    assert len(first) == 119 + 1 + 0 + 1
    assert len(np.unique(hashes)) == 4


def test_blocks_cover_everything_once():
    texts = [b"a" * n for n in (5, 100, 0, 7, 300)] + [None]
    spans = list(W.blocks(texts, limit=50))
    assert [i for a, b in spans for i in range(a, b)] == list(range(6))
    assert list(W.blocks([])) == []


@pytest.mark.parametrize("n", [1, 2, 3])
def test_grams_stay_inside_texts(n):
    found = W.find_words([b"a b", b"c", b"d e f"])
    assert len(found.grams(n)[0]) == sum(max(0, k - n + 1) for k in (2, 1, 3))


def thue_morse(n, a, b):
    return bytes((a, b)[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_a_word_and_its_complement_hash_apart(n):
    found = W.find_words([thue_morse(n, 97, 98), thue_morse(n, 98, 97)])
    assert found.hash[0] != found.hash[1]


def test_same_words_compares_bytes():
    one, other = W.find_words([b"alpha beta ab"]), W.find_words([b"beta alpha ac abc"])
    i, j = np.divmod(np.arange(12), 4)
    found = W.same_words(one, i, other, j)
    assert found.tolist() == [one.text(a) == other.text(b) for a, b in zip(i, j)]
    none = np.empty(0, dtype=np.int64)
    assert W.same_words(one, none, other, none).tolist() == []
