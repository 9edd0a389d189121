import random
import re

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), seed=42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_groups_against_brute_force(make):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(1, 400))) for _ in range(12)]
    texts = [b + f" tail{k}" * (k % 3) for b in base for k in range(6)]
    texts += [None, "", " \t\n", "One", "one", "two Words", "É é", "long " * 30_000]
    rows = [(7 * i % 1009, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[0]), (None, "only here")]
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    low = {}
    for (i, _), r in zip(rows, roots):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    expected = sorted(((i, f, low[r]) for (i, _), f, r in zip(rows, fps, roots)), key=str)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.groups(make(rows)).collect()]
    assert sorted(got, key=str) == expected


@pytest.mark.parametrize("tile_rows", [8, 10_000])
def test_tiles_connect_what_all_links_connect(llm, tile_rows):
    rng = np.random.default_rng(2)
    values = set(rng.integers(0, 2**64, 150, dtype=np.uint64).tolist())
    for v in list(values)[:60]:
        for _ in range(3):
            v ^= 1 << int(rng.integers(64)) | 1 << int(rng.integers(64))
            values.add(v)
    values = sorted(values | {0, 1, 7, 2**64 - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = llm.createDataFrame([(v,) for v in signed], "fp long")
    links = {(signed.index(r["a"]), signed.index(r["b"])) for r in simhash.tile_links(table, 3, tile_rows).collect()}
    assert all((values[a] ^ values[b]).bit_count() <= 3 for a, b in links)
    every = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3]
    assert union(len(values), links) == union(len(values), every)


def test_hot_group_leaves_a_forest_only(llm):
    values = [(1 << a | 1 << b) for a in range(40) for b in range(a)]
    table = llm.createDataFrame([(v,) for v in values], "fp long")
    assert simhash.tile_links(table, 4).count() < 20 * len(values)


def test_components_of_chains_cycles_and_stars(llm):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(1, 2), (2, 3), (3, 1), (9, 9), (None, 4), (50, -5), (51, -5), (50, -5)]
    links = llm.createDataFrame(pairs, "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 1: 1, 2: 1, 3: 1, 50: -5, 51: -5, -5: -5}
    assert components(links.limit(0)).count() == 0


def test_first_of_each_keeps_columns(make):
    rows = [(3, "a b c d"), (2, "A b c D"), (9, "other words stand here"), (None, "a b c d"), (None, "x y z w")]
    kept = simhash.first_of_each(make(rows))
    assert kept.columns == make([]).columns
    ids = sorted((r["doc_id"], r["text"]) for r in kept.filter("doc_id is not null").collect())
    assert ids == [(2, "A b c D"), (9, "other words stand here")]
    assert simhash.first_of_each(make([])).count() == 0


def test_first_of_each_leaves_one_of_repeated_and_null_ids(make):
    base = [" ".join(f"{c}{k}" for k in range(400)) for c in "abcde"]
    near = [b + " tail" for b in base]
    fps = [[plain_fingerprint(t) for t in pair] for pair in zip(base, near)]
    assert all((a ^ b).bit_count() <= 3 for a, b in fps)
    assert all((a ^ b).bit_count() > 3 for i, p in enumerate(fps) for q in fps[:i] for a in p for b in q)
    ids = [(5, 5), (None, None), (None, 7), (5, 5), (None, None)]
    rows = [(i, t) for pair, *texts in zip(ids, base, near) for i, t in zip(pair, texts)]
    kept = [(r["doc_id"], r["text"]) for r in simhash.first_of_each(make(rows)).collect()]
    assert sorted(t[0] for _, t in kept) == list("abcde") and set(kept) <= set(rows)
    assert (7, near[2]) in kept


def test_a_column_of_the_fingerprints_name_is_replaced(make):
    row = simhash.with_fingerprint(make([(1, "a b c d")])).first()
    assert row["fp"] & (1 << 64) - 1 == simhash.fingerprint(b"a b c d") and row["label"] == "x"
