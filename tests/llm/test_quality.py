import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality
from ledgerloom.llm.common import training_labels

WORDS = "river stone garden window letter silver market winter candle forest".split()


def corpus(n):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        picked = rng.choice(WORDS, 40)
        bad = i % 4 == 0
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in picked)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_learns_scores_and_accepts(llm, make):
    rows, labels = corpus(400)
    odd = [(900, None), (901, ""), (902, "stone " * 40_000), (None, rows[1][1]), (1, rows[1][1])]
    known = llm.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    scored = quality.with_score(make(rows + odd), quality.train(make(rows), known), "p").toPandas()
    assert len(scored) == 405 and scored["p"].between(0, 1).all()
    own = scored[scored["doc_id"] < 400]
    assert ((own["p"] >= 0.7) == (own["doc_id"] % 4 != 0)).all()
    kept = quality.accepted(make(rows + odd), known)
    assert kept.columns == make([]).columns
    assert {r["doc_id"] for r in kept.collect()} >= {i for i in range(400) if i % 4}


def test_empty_tables(llm, make):
    empty = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(make([]), empty)
    assert quality.with_score(make([]), model, "p").count() == 0
    assert quality.with_score(make([(1, "a b")]), model, "p").first()["p"] == 0.5


def test_statistics_by_hand():
    stats = dict(zip(quality.STATISTICS, quality.statistics([b"Ab ab ab!\nAb ab ab!", None])[0]))
    assert stats["log_words"] == np.log1p(6) and stats["word_bytes"] == 2 and stats["word_spread"] == 0
    assert np.isclose(stats["distinct_words"], 1 / 6) and stats["top_word"] == 1
    assert stats["repeated_lines"] == 0.5 and np.isclose(stats["capitals"], 2 / 6)
    assert not quality.statistics([b""]).any()


def test_isotonic_is_monotone_and_pools():
    x, y = np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.0])
    knots, values = quality.isotonic(x, y, np.ones(6))
    assert (np.diff(values) >= 0).all()
    assert np.allclose(np.interp(x, knots, values), [0, 0.5, 0.5, 2 / 3, 2 / 3, 2 / 3])


def plain_isotonic(targets, weights):
    """The non-decreasing fit as the largest lower of the smallest upper means."""
    n = len(targets)
    mean = lambda a, b: np.average(targets[a : b + 1], weights=weights[a : b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("max_rows", [10_000, 120])
def test_fit_and_calibration_by_brute_force(llm, make, max_rows):
    rng = np.random.default_rng(4)
    rows, labels = corpus(400)
    # Labels that no statistic gives away whole, so that calibration has to pool.
    labels = [(i, int(rng.random() < (0.85 if q else 0.3)), t) for i, q, t in labels]
    rows = [(i, t + " " + "word, " * int(rng.integers(0, 30))) for i, t in rows]
    known = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    settings = quality.Settings(features=24, ridge=1e-2)
    model = quality.train(make(rows).repartition(5), known, settings=settings, max_rows=max_rows)
    sample = training_labels(known, "quality", max_rows).select(
        "doc_id", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("aside")
    )
    sample = sorted(map(tuple, sample.collect()))
    assert (len(sample) < 200) == (max_rows == 120)
    texts = dict(rows)
    stats = quality.statistics([texts[i].encode() for i, _, _ in sample])
    label = np.array([y for _, y, _ in sample], dtype=float)
    aside = np.array([a for _, _, a in sample])
    mean, spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
    assert np.allclose(model.mean, mean) and np.allclose(model.spread, spread)
    waves = []
    for row in stats:
        x = [max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(row, mean, spread)]
        angles = [sum(a * b for a, b in zip(x, model.directions[:, k])) + model.phases[k] for k in range(24)]
        waves.append([math.cos(a) * math.sqrt(2 / 24) for a in angles] + [1.0])
    waves = np.array(waves)
    # Ridge regression as least squares over the rows and one row for each penalized weight.
    rows_of = np.vstack([waves[~aside], math.sqrt(settings.ridge * len(sample)) * np.eye(25)])
    weights = np.linalg.lstsq(rows_of, np.concatenate([label[~aside], np.zeros(25)]), rcond=None)[0]
    assert np.allclose(model.weights, weights, atol=1e-8)
    raw = waves[aside] @ weights
    cells = {}
    for value, y in zip(raw, label[aside]):
        cells.setdefault(math.floor(max(-1.0, min(2.0, value)) * quality.GRID + 0.5), []).append((value, y))
    means = [np.mean(cells[c], axis=0) for c in sorted(cells)]
    fitted = plain_isotonic(np.array([m[1] for m in means]), np.array([len(cells[c]) for c in sorted(cells)], dtype=float))
    assert len(set(np.round(fitted, 12))) < len(fitted)
    assert np.allclose(np.interp([m[0] for m in means], model.knots, model.values), fitted, atol=1e-8)
