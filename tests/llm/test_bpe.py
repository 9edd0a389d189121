import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return bpe.Encoder(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(encoder, library, texts):
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(got).cast("I")) == expected, text[:80]
        assert encoder.decode(got) == library.decode(expected, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(encoder, library, texts):
    check(encoder, library, texts)


def test_odd_texts(encoder, library):
    rng = random.Random(1)
    texts = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "!" * 9000, "a" * 5000, " \n\n\t x  "]
    texts += ["I'll don't 'S we've", "日本語" * 40, "\u0085  x\x1c y", "<|endoftext", "the " * 30_000]
    texts += ["".join(rng.choice("ab theinr") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    check(encoder, library, texts)


def test_small_memory_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 5)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 30)
    encoder.memory.clear()
    check(encoder, library, ["one two three four five six seven", "two three", "eight nine ten one"] * 3)


def test_documents(llm, make, library):
    rows = [(1, None), (2, ""), (3, "Some plain text"), (3, "Some plain text"), (None, "é <|endoftext|>")]
    got = bpe.encoded_documents(make(rows), PATH)
    assert set(make([]).columns) < set(got.columns)
    for r in got.collect():
        expected = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(expected) and r["decoded"] == (r["text"] or "")
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in expected)
    assert bpe.encoded_documents(make([]), PATH).count() == 0


def thue_morse(n, a, b):
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_a_word_and_its_complement(encoder, library, n):
    check(encoder, library, [thue_morse(n, "a", "b"), thue_morse(n, "b", "a"), thue_morse(n, "a", "b")])


def test_a_hash_of_two_words_costs_time_only(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "sequence_hashes", lambda points, sizes, bits: sizes % 2)
    check(encoder, library, ["one two three four", "four three two one", "éé ab ba", ""])


def test_columns_of_the_results_are_replaced(make):
    docs = make([(1, "plain text")]).withColumnRenamed("label", "ids").withColumnRenamed("n", "n_tokens")
    row = bpe.encoded_documents(docs, PATH).first()
    assert row["n_tokens"] == 2 and len(row["ids"]) == 8 and row["decoded"] == "plain text"


def test_a_process_keeps_its_encoder():
    with open(PATH, "rb") as file:
        content = file.read()
    assert bpe._encoder(content) is bpe._encoder(bytes(bytearray(content)))


def test_every_character(encoder, library):
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = ["".join(":" + c + "a1" + c + " " for c in letters[k : k + 400]) for k in range(0, len(letters), 400)]
    check(encoder, library, rows)
