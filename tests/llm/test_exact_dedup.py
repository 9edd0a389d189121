import hashlib

import numpy as np
import pytest

from ledgerloom.llm import exact_dedup


def test_hash_is_minimal_and_perfect():
    raw = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    digests = exact_dedup._as_words(raw)
    rounds, slots = exact_dedup.build_hash(digests)
    assert sorted(slots) == list(range(5000))
    assert (exact_dedup.find_slots(rounds, digests) == slots).all()
    other = exact_dedup._as_words([hashlib.sha256(b"x%d" % i).digest() for i in range(500)])
    found = exact_dedup.find_slots(rounds, other)
    assert found.max() < 5000
    with pytest.raises(ValueError):
        exact_dedup.build_hash(np.concatenate([digests[:3], digests[:1]]))


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_groups_against_brute_force(make, share):
    rows = [(i, f"text {i % 7}") for i in range(60)] + [(100, None), (101, ""), (102, "Text 1"), (103, "text 1 ")]
    rows += [(5, "text 5"), (5, "text 5"), (None, "text 3"), (None, "lonely"), (None, "lonely"), (104, "é" * 60_000)]
    got = exact_dedup.groups(make(rows), share).toPandas()
    assert len(got) == len(rows)
    by_text = {}
    for i, text in rows:
        by_text.setdefault(text or "", []).append(i)
    for digest, part in got.groupby("digest"):
        ids = next(v for k, v in by_text.items() if hashlib.sha256(k.encode()).digest() == bytes(digest))
        known = [i for i in ids if i is not None]
        assert (part["group_size"] == len(ids)).all() and part["kept"].sum() == 1
        if known:
            assert (part["keep_id"] == max(known)).all()
            assert part[part["kept"]]["doc_id"].iloc[0] == max(known)
        else:
            assert part["keep_id"].isna().all()
    assert got["digest"].nunique() == len(by_text)


def test_one_row_of_each_text_stays(make):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "c"), (None, "b"), (None, "z"), (None, "z")]
    kept = exact_dedup.without_copies(make(rows))
    assert kept.columns == make([]).columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(2, "a"), (4, ""), (5, "b"), (5, "c"), (None, "z")], key=str)


def test_null_and_empty_text_of_one_id_are_copies(make):
    rows = [(4, None), (4, ""), (3, ""), (5, "b"), (5, "c")]
    found = [(r["doc_id"], r["text"] or "") for r in exact_dedup.without_copies(make(rows)).collect()]
    assert sorted(found) == [(4, ""), (5, "b"), (5, "c")]
    assert exact_dedup.without_copies(make([(None, None), (None, "")])).count() == 1


def test_empty_table(make):
    assert exact_dedup.groups(make([])).count() == 0
    assert exact_dedup.without_copies(make([])).count() == 0
