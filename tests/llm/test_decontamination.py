import random
import re

import numpy as np
import pytest

from ledgerloom.llm import decontamination, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text, n):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute_force(docs, items, threshold=0.8):
    out = []
    for item_id, text in items:
        n = min(5, len(WORD.findall((text or "").lower())))
        own = shingles(text, n) if n else set()
        for doc_id, doc in docs:
            same = len(own & shingles(doc, n)) if n else 0
            if own and same >= threshold * len(own) - 1e-9:
                out.append((doc_id, item_id, len(own), same))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 5)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 14, 15, 16, 40, 63, 64, 200])]
    items += [(50, None), (51, ""), (52, " ...!"), (12, items[-1][1]), (None, items[5][1]), (60, "go go go go go go go go")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 300)))) for i in range(30)]
    for k, (_, text) in enumerate(items[:13]):
        w = text.split()
        for lost in (0, len(w) // 10, len(w) // 5, len(w) // 3):
            cut = w[: len(w) - lost] if k % 2 else w[lost:]
            docs.append((100 * (k + 1) + lost, " ".join(word() for _ in range(2000)) + "\n" + ", ".join(cut).upper() + ". End"))
    docs += [(7, None), (8, ""), (9, "go go"), (10, "Go! " * 9), (100, docs[-1][1]), (None, items[9][1])]
    return docs, items


def test_matches_are_those_of_brute_force(llm, make, case):
    docs, items = case
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    expected = brute_force(docs, items)
    got = decontamination.search(make(docs), benchmark).drop("containment").collect()
    assert sorted(map(tuple, got), key=str) == expected and len(expected) > 30


def test_blocks_of_items_change_nothing(llm, make, case, monkeypatch):
    docs, items = case
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    got = decontamination.search(make(docs), benchmark).drop("containment").collect()
    assert sorted(map(tuple, got), key=str) == brute_force(docs, items)


def test_a_hash_of_two_shingles_changes_nothing(llm, make, case, monkeypatch):
    docs, items = case
    true_hashes = words.Words.gram_hashes
    monkeypatch.setattr(words.Words, "gram_hashes", lambda *a: true_hashes(*a) % np.uint64(7))
    found = decontamination.sketch_items([(t or "").lower().encode() for _, t in items])
    expected = brute_force(docs, items)
    got = decontamination.find_items([(t or "").lower().encode() for _, t in docs], found)
    pairs = [(docs[d][0], items[i][0], found.count(i), n) for d, own in enumerate(got) for i, n in own]
    assert sorted(pairs, key=str) == expected


def test_a_shingle_and_its_complement_are_two(llm, make):
    morse = lambda a, b: "".join((a, b)[i.bit_count() & 1] for i in range(1024))
    text = " ".join(["one two three four", morse("a", "b"), "one two three four", morse("b", "a")])
    benchmark = llm.createDataFrame([(1, text)], "item_id long, text string")
    rows = decontamination.search(make([(1, text), (2, "one two three four " + morse("a", "b"))]), benchmark)
    assert sorted(map(tuple, rows.drop("containment").collect())) == brute_force([(1, text)], [(1, text)])


def test_many_copies_of_an_item_and_a_column_of_the_name(llm, make):
    text = "these seven words stand in a document"
    benchmark = llm.createDataFrame([(k, text.upper()) for k in range(2000)], "item_id long, text string")
    rows = decontamination.search(make([(1, "before " + text), (2, "clean")]), benchmark)
    assert sorted(r["item_id"] for r in rows.collect()) == list(range(2000))
    items = decontamination._distinct_items(benchmark)
    assert items.count() == 1
    marked = decontamination.with_matches(make([(1, text), (2, "clean")]), items)
    assert sorted((r["doc_id"], len(r["matches"])) for r in marked.collect()) == [(1, 1), (2, 0)]


def test_blocks_pass_through_the_driver_one_at_a_time(llm, make, monkeypatch):
    items = [(k, f"item {k} has these nine words of its own {k}") for k in range(400)]
    docs = [(k, f"text before. Item {k} has these nine words of its own {k}") for k in range(0, 400, 40)]
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 6000)
    sent, live, broadcast = [], set(), type(llm.sparkContext).broadcast

    def watched(context, value):
        made = broadcast(context, value)
        destroy = made.destroy
        live.add(id(made))
        sent.append((sum(len(t) for t, _ in value), len(live)))
        made.destroy = lambda *a: (live.discard(id(made)), destroy(*a))
        return made

    monkeypatch.setattr(type(llm.sparkContext), "broadcast", watched)
    rows = decontamination.search(make(docs), llm.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(k, k) for k in range(0, 400, 40)]
    assert len(sent) > 5 and max(size for size, _ in sent) < 6000 and max(n for _, n in sent) == 1


def test_leaking_documents_go(llm, make, case):
    docs, items = case
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    leaking = {(d, t) for d, t in docs if brute_force([(d, t)], items)}
    kept = decontamination.without_leaks(make(docs), benchmark)
    assert kept.columns == make([]).columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == set(docs) - leaking
    assert kept.count() == len([d for d in docs if d not in leaking])


@pytest.mark.parametrize("texts", [[], [b""], [b"", b" .. ", b"!"]])
def test_items_without_words_match_nothing(texts):
    items = decontamination.sketch_items(texts)
    assert decontamination.find_items([b"a b c d e", b""], items) == [[], []]
    assert [items.count(i) for i in range(len(texts))] == [0] * len(texts)


def test_empty_tables(llm, make):
    nothing = llm.createDataFrame([], "item_id long, text string")
    assert decontamination.search(make([(1, "a b c d e f")]), nothing).count() == 0
    some = llm.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.search(make([]), some).count() == 0
