import random
from fractions import Fraction
from math import floor

import numpy as np
import pytest

import __spark_entry__
from ledgerloom.llm import whitening


def brute_force(vectors, components=4):
    """(n, sums, eigenvalues, eigenvectors, trace) in fractions, from the definition."""
    fit = sorted({tuple(floor(Fraction(c) * 256) for c in v) for v in vectors})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(size)]
    centred = [[x[i] - Fraction(sums[i], n) for i in range(size)] for x in fit]
    matrix = [[sum(x[i] * x[j] for x in centred) / n for j in range(size)] for i in range(size)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in matrix]))
    order = np.argsort(-values)[:components]
    return n, sums, values[order], vectors[:, order], float(sum(matrix[i][i] for i in range(size)))


def table(spark, rows):
    """Embeddings with columns of clashing names."""
    rows = [(i, v, "x", 1, [2.0]) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, found string, deviation int, Whitened array<double>")


def check(spark, vectors, components=4):
    embeddings = table(spark, list(enumerate(vectors))).repartition(3)
    model = whitening.train(embeddings, components=components)
    n, sums, values, _, trace = brute_force(vectors, components)
    real = values > 1e-9 * values.max()
    assert (model.n, model.sums) == (n, sums)
    assert np.allclose(model.eigenvalues, values[real], rtol=1e-9)
    assert np.allclose(model.explained, values[real] / trace, rtol=1e-9)
    assert model.identity_error <= 1e-6
    rows = {r["vec_id"]: r for r in whitening.whiten(embeddings, model).collect()}
    assert sorted(rows) == list(range(len(vectors)))
    for i, v in enumerate(vectors):
        x = [floor(Fraction(c) * 256) for c in v]
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert rows[i]["deviation"] == (exact if exact < 2**63 else None) and rows[i]["found"] == "x"
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        assert np.allclose(rows[i]["whitened"], centred @ model.components / np.sqrt(model.eigenvalues))
    return model


def test_by_brute_force(llm):
    dice = random.Random(2)
    mix = np.array([[dice.gauss(0, 1) for _ in range(6)] for _ in range(6)])
    vectors = [(mix @ [dice.gauss(0.3, 1) for _ in range(6)]).tolist() for _ in range(300)]
    model = check(llm, vectors + vectors[:50] + [vectors[0]] * 100)
    # Against components of the brute force: equal up to the sign.
    own = brute_force(vectors)[3]
    assert np.allclose(np.abs((model.components * own).sum(axis=0)), 1, atol=1e-9)


def test_large_values_are_exact(llm):
    dice = random.Random(4)
    for size in (1e6, 1e9, 1e13):
        check(llm, [[dice.uniform(-size, size), dice.uniform(0, size), dice.uniform(0, 9)] for _ in range(40)], 2)


def test_far_from_zero(llm):
    dice = random.Random(5)
    check(llm, [[1e7 + dice.random(), -1e7 + dice.random(), dice.random()] for _ in range(50)])


def test_fewer_components_than_asked(llm):
    dice = random.Random(6)
    line = [[t := dice.random(), 2 * t, -t] for _ in range(30)]
    exact = [[float(x), x + 1.0, 5.0] for x in range(9)]
    assert len(whitening.train(table(llm, list(enumerate(line)))).eigenvalues) <= 3
    assert len(check(llm, exact).eigenvalues) == 1


def test_unusable_rows(llm):
    good = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (None, [3.0, 2.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, []), (10, [1.0]), (11, [1.0] * 3)]
    embeddings = table(llm, good + bad)
    model = whitening.train(embeddings)
    assert model.n == 3
    found = whitening.whiten(embeddings, model).collect()
    assert sorted(r["vec_id"] or 0 for r in found) == [0, 1, 2, 2]


def test_entries_out_of_range(llm):
    embeddings = table(llm, [(1, [1e300, 0.0]), (2, [-1e308, 1.0]), (3, [0.0, 2.0]), (4, [1.7e308, 2.0])])
    model = whitening.train(embeddings)
    assert model.n == 4 and model.sums[1] == 256 * 5
    found = whitening.whiten(embeddings, model).collect()
    assert len(found) == 4 and {r["deviation"] for r in found} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_varies(llm, rows):
    embeddings = table(llm, rows)
    model = whitening.train(embeddings)
    assert model is None and whitening.whiten(embeddings, model).count() == 0


def test_floor_of_every_size():
    values = np.array([[-0.001, 0.999 / 256, -1.0, 2.0**54, 2.0**55, -(2.0**55), 1e308, -1e308]])
    wanted = [-1, 0, -256, 2**62, 2**63 - 1, -(2**63) + 1, 2**63 - 1, -(2**63) + 1]
    assert whitening.whole(values, 256).tolist() == [wanted]


def test_query(llm, sf_dir):
    rows = llm.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in rows}
    n, sums, values, axes, trace = brute_force(list(vectors.values()))
    found = __spark_entry__.queries()["op11_whitening"](llm, sf_dir).toPandas()
    assert len(found) == 4 * len(vectors) and set(found["n"]) == {n}
    assert len(set(found["identity_error"])) == 1 and found["identity_error"][0] <= 1e-4
    for k, part in found.groupby("component"):
        assert np.allclose(part["explained"], values[k - 1] / trace, rtol=1e-6)
        x = np.array([[floor(c * 256) for c in vectors[i]] for i in part["vec_id"]])
        white = (x - np.array(sums) / n) @ axes[:, k - 1] / np.sqrt(values[k - 1])
        assert min(np.abs(part["whitened"] - white).max(), np.abs(part["whitened"] + white).max()) < 1e-6
        assert part["deviation"].tolist() == ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
