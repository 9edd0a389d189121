"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features are the presence of words, word pairs and skip-grams (two words with one between
them) as 64-bit hashes, so different features practically never share a coordinate. The
training sample is dealt into shards; each shard runs FTRL-proximal in id order with
per-coordinate rates, and the weights of all shards are averaged by coordinate. L1 leaves
few weights other than zero; these are the whole model, and every task scores its texts
with them.

Defined cases: null and empty texts have no features and score by the bias; very long texts
count in full; repeated rows are scored each; rows with a null id are scored, never trained
on; without any usable label every score is 0. Extra columns pass through untouched.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import keep, training_labels, utf8
from ledgerloom.llm.words import blocks, find_words

#: At most about so many labeled documents are trained on.
MAX_TRAIN_ROWS = 24_000
#: A shard holds about so many of them: one task keeps their features in memory.
ROWS_PER_SHARD = 8_000
#: A broadcast model must stay below this many weights; L1 keeps it far smaller.
MAX_WEIGHTS = 2_000_000
BIAS = np.uint64(0)


@dataclass(frozen=True)
class Ftrl:
    """Settings of FTRL-proximal; `min_docs` drops features of fewer documents in a shard."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    epochs: int = 6
    min_docs: int = 3


def features(words):
    """(text index, feature hash) of every word, pair and skip-gram, repeats included."""
    doc, n = words.doc(), len(words.start)
    out = [(doc, words.gram_hashes(np.arange(n), (0,)))]
    for gap in (1, 2):
        first = np.flatnonzero(doc[: n - gap] == doc[gap:]) if n > gap else np.empty(0, int)
        out.append((doc[first], words.gram_hashes(first, (0, gap))))
    docs, hashes = (np.concatenate(x) for x in zip(*out))
    return docs, hashes


def train_shard(rows, labels, settings: Ftrl):
    """FTRL over a shard: rows of distinct feature hashes. Returns (hash, z, n) arrays."""
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    every = np.concatenate(rows) if len(rows) else np.empty(0, np.uint64)
    vocabulary, index, counts = np.unique(every, return_inverse=True, return_counts=True)
    common = counts >= settings.min_docs
    dense = np.where(common, np.cumsum(common), 0)[index]
    vocabulary = np.concatenate([[BIAS], vocabulary[common]])
    ends = np.cumsum(lengths)
    examples = []
    for end, length in zip(ends, lengths):
        own = dense[end - length : end]
        examples.append(np.concatenate([[0], own[own > 0]]))
    z, n = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
    l1 = np.full(len(vocabulary), settings.l1)
    l1[0] = 0.0
    for _ in range(settings.epochs):
        for x, y in zip(examples, labels):
            w = solve(z[x], n[x], l1[x], settings)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[x])
            z[x] += g - (np.sqrt(n[x] + g * g) - root) / settings.alpha * w
            n[x] += g * g
    return vocabulary, z, n


def solve(z, n, l1, settings: Ftrl):
    """The proximal step: weights in closed form from the accumulators."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
    return -shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)


def _distinct_by_text(texts):
    """Distinct feature hashes of every text."""
    out = []
    for first, last in blocks(texts):
        docs, hashes = features(find_words(texts[first:last]))
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
        cuts = np.searchsorted(docs, np.arange(last - first + 1))
        out += [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def _extract(batches):
    for rows in batches:
        found = _distinct_by_text(list(rows["text"]))
        yield pd.DataFrame(
            {
                "doc_id": rows["doc_id"],
                "label": rows["label"],
                "shard": rows["shard"],
                "features": [f.tobytes() for f in found],
            }
        )


def train(
    documents: DataFrame,
    labels: DataFrame,
    target: str = "toxic",
    settings: Ftrl = Ftrl(),
    max_rows: int = MAX_TRAIN_ROWS,
):
    """(feature hashes, weights) sorted by hash; the bias is under hash 0."""
    known = keep(training_labels(labels, target, max_rows), "toxic-train")
    n_rows = known.count()
    shards = max(1, round(n_rows / ROWS_PER_SHARD))
    texts = documents.select("doc_id", utf8("text").alias("text"))
    # The training rows are bounded by max_rows, so their ids may be broadcast.
    chosen = texts.join(F.broadcast(known), "doc_id").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    )
    chosen = chosen.select("doc_id", "label", "shard", "text").mapInPandas(
        _extract, "doc_id long, label int, shard int, features binary"
    )

    def learn(rows):
        rows = rows.sort_values(["doc_id", "label", "features"])
        found = [np.frombuffer(x, dtype=np.uint64) for x in rows["features"]]
        hashes, z, n = train_shard(found, rows["label"].to_numpy(dtype=float), settings)
        l1 = np.full(len(z), settings.l1)
        l1[0] = 0.0
        w = solve(z, n, l1, settings)
        keep_them = w != 0
        return pd.DataFrame(
            {"feature": hashes[keep_them].view(np.int64), "weight": w[keep_them] / shards}
        )

    learned = keep(chosen, "toxic-features").groupBy("shard").applyInPandas(
        learn, "feature long, weight double"
    )
    weights = learned.groupBy("feature").agg(F.sum("weight").alias("weight"))
    rows = weights.filter("weight != 0").limit(MAX_WEIGHTS + 1).toPandas()
    if len(rows) > MAX_WEIGHTS:
        raise ValueError(f"more than {MAX_WEIGHTS} weights; raise l1")
    rows["feature"] = rows["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    rows = rows.sort_values("feature")
    return rows["feature"].to_numpy(np.uint64), rows["weight"].to_numpy(np.float64)


def score_texts(texts, model):
    """Probability of the label for every text of a list of UTF-8 byte strings."""
    hashes, weights = model
    if not len(hashes):
        return np.zeros(len(texts))
    bias = weights[0] if hashes[0] == BIAS else 0.0
    sums = np.full(len(texts), bias)
    for first, last in blocks(texts):
        docs, found = features(find_words(texts[first:last]))
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        hit = hashes[at] == found
        pairs = np.unique(docs[hit] * len(hashes) + at[hit])
        np.add.at(sums, first + pairs // len(hashes), weights[pairs % len(hashes)])
    return 1.0 / (1.0 + np.exp(-np.clip(sums, -500, 500)))


def with_score(documents: DataFrame, model, column: str = "score") -> DataFrame:
    """Add the score of `text` as `column` (in place of one of that name); all others stay."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(list(texts), model))

    return documents.withColumn(column, scored(utf8("text")))
