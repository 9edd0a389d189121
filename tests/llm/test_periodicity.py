import hashlib
import random
import zlib

import numpy as np
import pytest

import __spark_entry__
from ledgerloom.llm.periodicity import Catchers, blocks_by_length, collapse, find_runs, with_runs


def brute_force(words, min_length=12):
    """Runs from the definition: every period, every maximal stretch that keeps it."""
    n, least = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, 2 * q):
                least.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in least.items())


def thue_morse(n):
    return ["ab"[i.bit_count() & 1] for i in range(n)]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def samples():
    dice = random.Random(7)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 300, thue_morse(256), fibonacci(377), list("ab") * 40]
    for size in (3, 30, 100, 200):
        for letters in ("ab", "abc", "abcdefgh"):
            out.append([dice.choice(letters) for _ in range(size)])
    for _ in range(40):
        period = [str(dice.randrange(6)) for _ in range(dice.randrange(1, 40))]
        body = (period * 9)[: dice.randrange(len(period), 9 * len(period) + 1)]
        edge = lambda: [str(dice.randrange(6)) for _ in range(dice.randrange(30))]
        out.append(edge() + body + edge() + body[: dice.randrange(len(body) + 1)])
    return out


def plain(found):
    return [tuple(r) for r in found.tolist()]


def test_texts_together_by_brute_force():
    texts = samples()
    for words, found in zip(texts, find_runs(texts)):
        assert plain(found) == brute_force(words)


@pytest.mark.parametrize("min_length", [1, 2, 5, 30])
def test_least_length(min_length):
    for words in samples():
        assert plain(find_runs([words], min_length)[0]) == brute_force(words, min_length)


def test_words_may_come_in_any_portions():
    dice = random.Random(3)
    for words in samples():
        numbers = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in words]
        one_by_one, portions, at = Catchers(), Catchers(), 0
        for k in range(len(ids)):
            one_by_one.append(ids[k : k + 1])
        while at < len(ids):
            step = dice.randrange(1, 40)
            portions.append(ids[at : at + step])
            at += step
        for catchers in (one_by_one, portions):
            start, end, period = catchers.runs()
            assert list(zip(start, end - start, period)) == brute_force(words)


def test_a_lying_hash_costs_time_only(monkeypatch):
    true_hash, tries = Catchers._hash, []

    def lies_at_first(self, before, limit):
        true_hash(self, before, limit)
        tries.append(self.seed)
        if self.seed == 0:
            self.levels = [np.zeros_like(x) for x in self.levels]

    monkeypatch.setattr(Catchers, "_hash", lies_at_first)
    words = fibonacci(200)
    assert plain(find_runs([words])[0]) == brute_force(words)
    assert tries == [0, 1]


def test_long_text_of_one_word():
    assert plain(find_runs([["x"] * 50_000])[0]) == [(0, 50_000, 1)]


def test_blocks_hold_every_text_once():
    texts = [["w"] * n for n in (5, 0, 9, 3, 100, 2)]
    made = list(blocks_by_length(texts, 10))
    assert sorted(sum(made, [])) == list(range(6)) and made[-1] == [4]


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_collapse():
    for words in samples():
        runs = brute_force(words)
        assert collapse(words, np.array(runs, dtype=np.int64).reshape(-1, 3)) == collapsed(words, runs)


def test_nulls_empty_repeats_and_clashing_columns(make):
    long = " ".join(["tick tock"] * 20_000)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "na " * 12), (4, "na " * 12), (None, "na na " * 12), (7, long)]
    docs = make(rows)
    found = with_runs(docs, column="N").drop("matches")
    assert [c for c in found.columns if c.lower() == "n"] == ["N"] and "label" in found.columns
    kept = sorted((r["N"]["n_words"], r["N"]["collapsed"], len(r["N"]["runs"])) for r in found.collect())
    assert kept == [(0, "", 0)] * 3 + [(12, "na", 1)] * 2 + [(12, "na na", 1), (40_000, "tick tock", 1)]
    assert with_runs(docs.limit(0)).count() == 0


def test_query(llm, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = __spark_entry__.queries()["op13_periodicity"](llm, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    periodic = 0
    for r in found:
        words = (texts[r["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_force(words) if n <= 1500 else plain(find_runs([words])[0])
        text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == expected
        periodic += bool(runs)
    assert periodic
