import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.common import held_out, training_labels

WORDS = "river stone garden window letter silver market winter candle forest".split()


def corpus(n):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(WORDS, 30))
        bad = i % 4 == 0
        rows.append((i, text + " you utter nitwit" if bad else text + " you dear friend"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_from_labels_and_scores_all(llm, make):
    rows, labels = corpus(400)
    odd = [(900, None), (901, ""), (902, "word " * 50_000), (None, "you utter nitwit"), (0, rows[0][1])]
    known = llm.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(make(rows), known)
    assert len(model[0]) < 2000
    frame = make(rows + odd).withColumn("kept_aside", held_out())
    scored = toxicity.with_score(frame.drop("score"), model).toPandas()
    assert len(scored) == 405 and list(scored["label"].unique()) == ["x"]
    assert scored["score"].between(0, 1).all()
    aside = scored[scored["kept_aside"] & (scored["doc_id"] < 400)]
    assert ((aside["score"] >= 0.3) == (aside["doc_id"] % 4 == 0)).all()
    by_id = scored.set_index("doc_id")["score"]
    assert by_id[900] == by_id[901]
    assert scored[scored["doc_id"].isna()]["score"].iloc[0] >= 0.3


def test_empty_tables(llm, make):
    empty = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(make([]), empty)
    assert toxicity.with_score(make([]), model, "p").count() == 0
    assert toxicity.with_score(make([(1, "a b")]), model, "p").first()["p"] == 0.0


def test_held_out_rows_are_never_learned(llm):
    import zlib

    rows = [(i, 1, 1) for i in range(200)] + [(3, 1, 1), (None, 1, 1)]
    labels = llm.createDataFrame(rows, "doc_id long, quality int, toxic int")
    ids = {r["doc_id"] for r in training_labels(labels, "toxic", 10_000).collect()}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_weights_are_sparse_and_skip_grams_count():
    docs = [b"good fine day", b"you red fool", b"you blue fool", b"fine good day"] * 20
    shard = toxicity._distinct_by_text(docs)
    hashes, z, n = toxicity.train_shard(shard, np.array([0, 1, 1, 0] * 20, float), toxicity.Ftrl())
    l1 = np.full(len(z), 4.0)
    l1[0] = 0
    w = toxicity.solve(z, n, l1, toxicity.Ftrl())
    p = toxicity.score_texts([b"you green fool", b"good fine day", b""], _sorted(hashes, w))
    assert p[0] > 0.5 > p[1]


def _sorted(hashes, w):
    order = np.argsort(hashes)
    return hashes[order], w[order]


def plain_features(text):
    """Distinct words, pairs and skip-grams, as tuples."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())
    pairs = {(a, b, 0) for a, b in zip(words, words[1:])}
    return {(w,) for w in words} | pairs | {(a, b, 1) for a, b in zip(words, words[2:])}


def plain_ftrl(examples, settings):
    """FTRL-proximal per example, with accumulators in dictionaries; the weights by feature."""
    seen = Counter(f for own, _ in examples for f in own)
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        l1 = 0.0 if f == "bias" else settings.l1
        if abs(z[f]) <= l1:
            return 0.0
        rate = (settings.beta + math.sqrt(n[f])) / settings.alpha + settings.l2
        return -(z[f] - math.copysign(l1, z[f])) / rate

    for _ in range(settings.epochs):
        for own, y in examples:
            active = ["bias", *(f for f in own if seen[f] >= settings.min_docs)]
            weights = {f: weight(f) for f in active}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(weights.values()))))) - y
            for f in active:
                sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / settings.alpha
                z[f] += g - sigma * weights[f]
                n[f] += g * g
    return {f: weight(f) for f in z if weight(f)}


@pytest.mark.parametrize("max_rows, shards", [(24_000, 1), (24_000, 3), (150, 2)])
def test_shards_and_sample_by_brute_force(llm, make, monkeypatch, max_rows, shards):
    rows, labels = corpus(400)
    rng = np.random.default_rng(8)
    rows = [(i, " ".join([t, *rng.choice(WORDS, rng.integers(1, 9))])) for i, t in rows]
    known = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = {r["doc_id"]: r["label"] for r in training_labels(known, "toxic", max_rows).collect()}
    assert len(sample) < 400 and (max_rows > 400) == (len(sample) > 250)
    monkeypatch.setattr(toxicity, "ROWS_PER_SHARD", max(1, len(sample) / shards))
    settings = toxicity.Ftrl(l1=0.5, epochs=3)
    model = toxicity.train(make(rows), known, settings=settings, max_rows=max_rows)
    ids = llm.createDataFrame([(i,) for i in sample], "doc_id long")
    dealt = ids.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("s")).collect()
    texts, weights = dict(rows), Counter()
    assert len({r["s"] for r in dealt}) == shards
    for shard in range(shards):
        own = sorted(r["doc_id"] for r in dealt if r["s"] == shard)
        learned = plain_ftrl([(plain_features(texts[i]), sample[i]) for i in own], settings)
        for f, w in learned.items():
            weights[f] += w / shards
    assert len(model[0]) == len(weights) > 20
    expected = []
    for _, text in rows:
        total = weights["bias"] + sum(weights[f] for f in plain_features(text) if f in weights)
        expected.append(1 / (1 + math.exp(-total)))
    assert np.allclose(toxicity.score_texts([t.encode() for _, t in rows], model), expected, atol=1e-9)
