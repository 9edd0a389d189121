"""Whitening of embeddings from polarised variances.

Entries become whole numbers floor(scale * c). The fit list holds every distinct vector once;
over it, the squares of centred values are summed exactly for every dimension and for the sum
of every two dimensions. Since var(x + y) = var(x) + 2 cov(x, y) + var(y), differences of these
sums give every covariance exactly; only then the matrix becomes floating point, and `eigh`
gives the components. Whitened entries are projections on them over the roots of their
eigenvalues.

Centring is exact as well: a dimension with sum S over n vectors is centred on the whole
number m next to S / n, and with r = S - n * m the sum of (n * x - S)^2 is
n * (n * sum((x - m)^2) - r^2). Sums leave a task as digits of 40 bits, which Spark adds up.

Each job is a pass over rows that adds up what its size depends on the dimensions alone: n and
S, the squares, and the covariance of the whitened fit list as a check. Equal vectors are
combined before the shuffle, so copies of one vector cost a row a task. The driver gets
d * (d + 1) / 2 sums and broadcasts a model of a few vectors of d numbers.

Defined cases: rows with a null vector or a null or non-finite entry are left out, and so are
rows whose length is not the one most distinct vectors have (ties: the larger); products beyond
a 64-bit integer become the nearest one; components without variance do not exist, so a fit
list of one vector, or an empty table, gives no rows; repeated rows are one vector of the fit
list and a row of the result each; other columns stay, those of the result columns' names are
replaced.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, keep

SCALE = 256
#: Components whose share of the largest eigenvalue is below this are rounding errors.
LEAST_SHARE = 1e-12
_LIMB = 40
_MASK = (1 << _LIMB) - 1
#: Squares of sums of two values below _SMALL fit a 64-bit integer, _ROWS of them together.
_SMALL, _ROWS = 1 << 25, 1024
_LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Model:
    """What the fit list gives; `components` are columns, by falling eigenvalue."""

    n: int
    sums: list
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self):
        return [float(e / self.trace) for e in self.eigenvalues]


def whole(vectors, scale):
    """floor(scale * c) of a float64 array as int64; entries out of range become the nearest."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    out = np.clip(scaled, 1024 - 2.0**63, 2.0**63 - 1024).astype(np.int64)
    out[scaled >= 2.0**63] = _LARGEST
    out[scaled <= -(2.0**63)] = -_LARGEST
    return out


def _usable(column):
    """(indexes, float64 matrix) of the usable vectors of an Arrow list column, by their length."""
    flat = column.flatten()
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    ends = np.cumsum(np.maximum(sizes, 0))
    nulls = np.asarray(flat.is_null())
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values) | nulls)])
    good = (sizes > 0) & (bad[ends] == bad[ends - np.maximum(sizes, 0)])
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        yield rows, values[(ends[rows] - size)[:, None] + np.arange(size)]


def _packed(numbers):
    """Every row of an int64 matrix as bytes, two a number where they suffice."""
    small = (np.abs(numbers) < 1 << 15).all(axis=1)
    wide = [row.tobytes() for row in numbers.astype("<i8")]
    narrow = [row.tobytes() for row in numbers.astype("<i2")]
    return [b if s else a for a, b, s in zip(wide, narrow, small.tolist())]


def _unpacked(rows, size):
    """The int64 matrix of packed vectors of `size` entries."""
    out = np.empty((len(rows), size), dtype=np.int64)
    narrow = np.fromiter((len(r) == 2 * size for r in rows), dtype=bool, count=len(rows))
    for kind, chosen in (("<i2", narrow), ("<i8", ~narrow)):
        at = np.flatnonzero(chosen)
        joined = b"".join(rows[i] for i in at.tolist())
        out[at] = np.frombuffer(joined, dtype=kind).reshape(-1, size)
    return out


def _limbs(value):
    """Digits of 40 bits of an integer, lowest first; the highest has the sign."""
    out = []
    while not -_MASK <= value <= _MASK:
        out.append(value & _MASK)
        value >>= _LIMB
    return [*out, value]


def _added(digits: DataFrame) -> dict:
    """{(i, j): sum} of rows (i, j, limb, part)."""
    total = {}
    for r in digits.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect():
        total[r.i, r.j] = total.get((r.i, r.j), 0) + (r.part << (_LIMB * r.limb))
    return total


def _summed(fit: DataFrame, size, values):
    """Exact sums over the fit list: `values(matrix)` yields (i, j, integer) for a batch."""

    def parts(batches):
        total = {}
        for batch in batches:
            for i, j, value in values(_unpacked(batch.column("vector").to_pylist(), size)):
                total[i, j] = total.get((i, j), 0) + value
        rows = [(i, j, k, part) for (i, j), value in total.items() for k, part in enumerate(_limbs(value))]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "limb", "part"])

    return _added(fit.select("vector").mapInArrow(parts, "i int, j int, limb int, part long"))


def fit_list(embeddings: DataFrame, vector: str, scale: int) -> DataFrame:
    """(size, vector): every distinct whole-number vector once, packed; written to the shared folder."""

    def packs(batches):
        for batch in batches:
            for _, values in _usable(batch.column(0)):
                rows = _packed(whole(values, scale))
                size = pa.array([values.shape[1]] * len(rows), pa.int32())
                yield pa.RecordBatch.from_arrays([size, pa.array(rows, pa.binary())], ["size", "vector"])

    packed = embeddings.select(vector).mapInArrow(packs, "size int, vector binary")
    return keep(packed.distinct(), "fit-list")


def _totals(matrix):
    yield -1, -1, len(matrix)
    for a in range(0, len(matrix), _ROWS):
        part = matrix[a : a + _ROWS]
        exact = part if np.abs(part).max() < _LARGEST // _ROWS else part.astype(object)
        for i, value in enumerate(exact.sum(axis=0).tolist()):
            yield i, i, value


def _squares(middle):
    """Sums of squares of the centred values of each dimension, and of each sum of two."""
    small = all(abs(m) < _SMALL for m in middle)

    def squares(matrix):
        for a in range(0, len(matrix), _ROWS):
            part = matrix[a : a + _ROWS]
            if small and np.abs(part).max() < _SMALL - max(map(abs, middle)):
                part = part - np.array(middle, dtype=np.int64)
            else:
                part = part.astype(object) - np.array(middle, dtype=object)
            part = np.ascontiguousarray(part.T)
            for i in range(len(part)):
                yield i, i, int((part[i] * part[i]).sum())
                both = part[i] + part[i + 1 :]
                for j, value in enumerate((both * both).sum(axis=1).tolist(), i + 1):
                    yield i, j, int(value)

    return squares


def covariance(fit: DataFrame, size: int):
    """(n, sums S, n^2 times n times the covariance matrix as exact integers) of the fit list."""
    totals = _summed(fit, size, _totals)
    n = totals.get((-1, -1), 0)
    if n == 0:
        return 0, [], []
    sums = [totals[i, i] for i in range(size)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    about = _summed(fit, size, _squares(middle))
    # sum((n x - S)^2) of each dimension and of each sum of two, from squares about `middle`.
    spread = {
        (i, j): n * (n * about[i, j] - (rest[i] + (rest[j] if j != i else 0)) ** 2) for i, j in about
    }
    cross = [[0] * size for _ in range(size)]
    for (i, j), both in spread.items():
        cross[i][j] = cross[j][i] = both if i == j else (both - spread[i, i] - spread[j, j]) // 2
    return n, sums, cross


def _projected(matrix, n, sums, components, eigenvalues):
    """Whitened entries of whole-number vectors; the centred values are exact until divided."""
    small = len(matrix) == 0 or n * int(np.abs(matrix).max()) + max(map(abs, sums)) < _LARGEST
    exact = matrix if small else matrix.astype(object)
    numerators = exact * n - np.array(sums, dtype=np.int64 if small else object)
    return numerators, (numerators.astype(np.float64) / n) @ components / np.sqrt(eigenvalues)


def _identity_error(fit, size, n, sums, components, eigenvalues):
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    count = len(eigenvalues)

    def parts(batches):
        first, second = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            matrix = _unpacked(batch.column("vector").to_pylist(), size)
            white = _projected(matrix, n, sums, components, eigenvalues)[1]
            first += white.sum(axis=0)
            second += white.T @ white
        values = pa.array(np.concatenate([first, second.ravel()]))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), values], ["i", "value"])

    sums_of = fit.select("vector").mapInArrow(parts, "i int, value double").groupBy("i")
    found = {r.i: r.total for r in sums_of.agg(F.sum("value").alias("total")).collect()}
    mean = np.array([found[i] for i in range(count)]) / n
    second = np.array([found[count + i] for i in range(count * count)]).reshape(count, count) / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(count)).max())


def train(embeddings: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE):
    """The model of the first `components` components, or None where nothing varies."""
    fit = fit_list(embeddings, vector, scale)
    sizes = fit.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return None
    size = sizes[0]["size"]
    fit = fit.filter(F.col("size") == size)
    n, sums, cross = covariance(fit, size)
    # Exact integers over n^3, each rounded once.
    matrix = np.array([[x / n**3 for x in row] for row in cross])
    values, vectors = np.linalg.eigh(matrix)
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > LEAST_SHARE * values.max()]
    order = order[:components]
    if not order:
        return None
    kept = np.ascontiguousarray(vectors[:, order]), values[order]
    error = _identity_error(fit, size, n, sums, *kept)
    trace = sum(cross[i][i] for i in range(size)) / n**3
    return Model(n, sums, *kept, trace, error)


_WHITENED = "deviation long, whitened array<double>"


def whiten(embeddings: DataFrame, model, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The usable rows of `embeddings` with their deviation and whitened vector.

    `deviation` is the sum over dimensions of (n * x - S)^2, exact; null beyond a 64-bit integer.
    """
    if model is None:
        names = {"deviation": F.lit(0).cast("long"), "whitened": F.array(F.lit(0.0))}
        return embeddings.withColumns(names).filter(F.lit(False))
    spark, size = embeddings.sparkSession, len(model.sums)
    parameters = spark.sparkContext.broadcast((model.n, model.sums, model.components, model.eigenvalues))

    @F.arrow_udf(_WHITENED)
    def whitened(vectors: pa.Array) -> pa.Array:
        n, sums, components, eigenvalues = parameters.value
        deviation, white = [None] * len(vectors), [None] * len(vectors)
        for rows, values in _usable(vectors):
            if values.shape[1] != size:
                continue
            numerators, projected = _projected(whole(values, scale), n, sums, components, eigenvalues)
            largest = int(np.abs(numerators).max(initial=0))
            if size * largest * largest > _LARGEST:
                numerators = numerators.astype(object)
            squares = (numerators * numerators).sum(axis=1).tolist()
            for i, square, row in zip(rows.tolist(), squares, projected):
                deviation[i] = square if square <= _LARGEST else None
                white[i] = row
        columns = [pa.array(deviation, pa.int64()), pa.array(white, pa.list_(pa.float64()))]
        return pa.StructArray.from_arrays(columns, ["deviation", "whitened"])

    name = free_name(embeddings, "found")
    marked = embeddings.withColumn(name, whitened(F.col(vector)))
    marked = marked.withColumns({c: F.col(name)[c] for c in ("deviation", "whitened")}).drop(name)
    return marked.filter(F.col("whitened").isNotNull())
