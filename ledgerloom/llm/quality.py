"""Quality scores: kernel ridge over document statistics, by random Fourier features.

Statistics of the whole text (lengths, shares of kinds of bytes, repetition of words and
lines) are standardized and mapped to random cosines, whose inner products approximate a
Gaussian kernel. Each partition sums its part of the normal equations, the sums give the
ridge weights, and isotonic regression over rows left out of the fit turns the raw values
into probabilities.

Defined cases: null and empty texts have all-zero statistics and are scored like any other;
very long texts count in full; repeated rows are scored each; rows with a null id are scored
but never learned from; without usable labels every score is 0.5. Extra columns stay.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import free_name, keep, training_labels, utf8
from ledgerloom.llm.words import blocks, find_words

#: At most about so many labeled documents are learned from.
MAX_TRAIN_ROWS = 200_000
PARTITIONS = 64
GRID = 2_000

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_spread", "upper", "digit", "space", "stop",
    "bang", "symbol", "bar", "other_mark", "beyond_ascii", "capitals", "distinct_words",
    "top_word", "repeated_pairs", "repeated_fives", "log_lines", "repeated_lines", "log_line_bytes",
)


@dataclass(frozen=True)
class Settings:
    features: int = 192
    width: float = 4.0
    ridge: float = 1e-3
    seed: int = 5


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score: a few hundred numbers."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats):
        return fourier(stats, self) @ self.weights

    def score(self, stats):
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def _kinds():
    """Kind of each byte: one row per kind."""
    chars = {
        "upper": range(65, 91),
        "digit": range(48, 58),
        "space": (9, 10, 11, 12, 13, 32),
        "stop": b".,;:?",
        "bang": b"!",
        "symbol": b"#$%&*@^~=+<>\\_",
        "bar": b"|",
        "other_mark": b"\"'()-/[]{}`",
        "beyond_ascii": range(128, 256),
    }
    table = np.zeros((len(chars), 256))
    for row, members in enumerate(chars.values()):
        table[row, list(members)] = 1.0
    return table


def _repeated(doc, hashes, n_docs):
    """Share of items of each document that repeat an earlier item of it."""
    total = np.bincount(doc, minlength=n_docs)
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    fresh = np.ones(len(d), dtype=bool)
    fresh[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    distinct = np.bincount(d[fresh], minlength=n_docs)
    starts = np.flatnonzero(fresh)
    runs = np.diff(np.append(starts, len(d)))
    top = np.zeros(n_docs)
    np.maximum.at(top, d[starts], runs)
    total = np.maximum(total, 1)
    return np.where(distinct > 0, 1.0 - distinct / total, 0.0), top / total


_LINES = np.ones(256, dtype=bool)
_LINES[[10, 13]] = False


def statistics(texts):
    """One row of STATISTICS for every UTF-8 text of a list."""
    out = np.zeros((len(texts), len(STATISTICS)))
    kinds = _kinds()
    for first, last in blocks(texts):
        part = texts[first:last]
        n = last - first
        size = np.array([len(t or b"") for t in part], dtype=float)
        counts = np.stack(
            [np.bincount(np.frombuffer(t or b"", dtype=np.uint8), minlength=256) for t in part]
        )
        shares = (counts @ kinds.T) / np.maximum(size, 1)[:, None]
        words = find_words(part)
        doc, length = words.doc(), (words.end - words.start).astype(float)
        n_words = np.bincount(doc, minlength=n)
        mean = np.bincount(doc, length, minlength=n) / np.maximum(n_words, 1)
        square = np.bincount(doc, length**2, minlength=n) / np.maximum(n_words, 1)
        repeated, top = _repeated(doc, words.hash, n)
        whole = np.frombuffer(b"\n".join(t or b"" for t in part), dtype=np.uint8)
        capital = (whole[words.start] >= 65) & (whole[words.start] <= 90)
        capitals = np.bincount(doc, capital, minlength=n) / np.maximum(n_words, 1)
        pairs, at_pair = words.grams(2)
        fives, at_five = words.grams(5)
        lines = find_words(part, table=_LINES, lower=False)
        line_doc, line_size = lines.doc(), (lines.end - lines.start).astype(float)
        n_lines = np.bincount(line_doc, minlength=n)
        out[first:last] = np.column_stack(
            [
                np.log1p(size),
                np.log1p(n_words),
                mean,
                np.sqrt(np.maximum(square - mean**2, 0)),
                shares,
                capitals,
                np.where(n_words > 0, 1 - repeated, 0),
                top,
                _repeated(doc[at_pair], pairs, n)[0],
                _repeated(doc[at_five], fives, n)[0],
                np.log1p(n_lines),
                _repeated(line_doc, lines.hash, n)[0],
                np.log1p(np.bincount(line_doc, line_size, minlength=n) / np.maximum(n_lines, 1)),
            ]
        )
    return out


def fourier(stats, model):
    """Random cosines of standardized statistics, and a constant."""
    x = np.clip((stats - model.mean) / model.spread, -6, 6)
    waves = np.cos(x @ model.directions + model.phases) * np.sqrt(2.0 / len(model.phases))
    return np.column_stack([waves, np.ones(len(stats))])


def isotonic(values, targets, weights):
    """Pool adjacent violators: knots and non-decreasing fitted values."""
    order = np.argsort(values, kind="stable")
    pools = []
    for v, t, w in zip(values[order], targets[order], weights[order]):
        pools.append([t, w, v, v])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            t2, w2, _, last = pools.pop()
            t1, w1, first, _ = pools.pop()
            pools.append([(t1 * w1 + t2 * w2) / (w1 + w2), w1 + w2, first, last])
    knots = [x for p in pools for x in (p[2], p[3])]
    return np.array(knots), np.array([p[0] for p in pools for _ in (0, 1)])


def _stats_frame(texts):
    return pd.DataFrame(statistics(list(texts)), columns=list(STATISTICS))


def with_statistics(rows: DataFrame) -> DataFrame:
    """`rows` (with a binary column `text`) with a struct column `stats` in place of the text."""

    @F.pandas_udf(", ".join(f"{c} double" for c in STATISTICS))
    def of_texts(texts: pd.Series) -> pd.DataFrame:
        return _stats_frame(texts)

    return rows.withColumn("stats", of_texts("text")).drop("text")


def train(
    documents: DataFrame,
    labels: DataFrame,
    target: str = "quality",
    settings: Settings = Settings(),
    max_rows: int = MAX_TRAIN_ROWS,
) -> Model:
    known = keep(training_labels(labels, target, max_rows), "quality-train")
    texts = documents.select("doc_id", utf8("text").alias("text"))
    # The training rows are bounded by max_rows, so their ids may be broadcast.
    chosen = with_statistics(texts.join(F.broadcast(known), "doc_id")).select(
        "label", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibrates"), "stats.*"
    )
    chosen = keep(chosen, "quality-stats")
    moments = chosen.agg(
        *(F.avg(c).alias(f"m_{c}") for c in STATISTICS),
        *(F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS),
        F.count(F.lit(1)).alias("n"),
    ).first()
    dim, rng = len(STATISTICS), np.random.default_rng(settings.seed)
    n = moments["n"]
    model = Model(
        mean=np.array([moments[f"m_{c}"] or 0.0 for c in STATISTICS]),
        spread=np.array([max(moments[f"s_{c}"] or 0.0, 1e-6) for c in STATISTICS]),
        directions=rng.normal(0.0, 1.0 / settings.width, (dim, settings.features)),
        phases=rng.uniform(0.0, 2 * np.pi, settings.features),
        weights=np.zeros(settings.features + 1),
        knots=np.array([0.0]),
        values=np.array([0.5]),
    )
    if n == 0:
        return model
    size = settings.features + 1

    def sums(batches):
        gram, right = np.zeros((size, size)), np.zeros(size)
        for rows in batches:
            z = fourier(rows[list(STATISTICS)].to_numpy(dtype=float), model)
            gram += z.T @ z
            right += z.T @ rows["label"].to_numpy(dtype=float)
        yield pd.DataFrame({"gram": [gram.tobytes()], "right": [right.tobytes()]})

    # One row of sums per partition, and few partitions: the training rows are bounded.
    fitted = chosen.filter(~F.col("calibrates")).coalesce(PARTITIONS)
    gram, right = np.zeros((size, size)), np.zeros(size)
    for part in fitted.mapInPandas(sums, "gram binary, right binary").collect():
        gram += np.frombuffer(part["gram"]).reshape(size, size)
        right += np.frombuffer(part["right"])
    gram += settings.ridge * max(n, 1) * np.eye(size)
    model = Model(**{**model.__dict__, "weights": np.linalg.solve(gram, right)})

    def raw(batches):
        for rows in batches:
            values = model.raw(rows[list(STATISTICS)].to_numpy(dtype=float))
            yield pd.DataFrame({"raw": values, "label": rows["label"].to_numpy(dtype=float)})

    # A grid bounds what isotonic regression sees, whatever the number of rows.
    left_out = chosen.filter("calibrates").mapInPandas(raw, "raw double, label double")
    cell = F.round(F.greatest(F.least("raw", F.lit(2.0)), F.lit(-1.0)) * GRID).cast("long")
    grid = left_out.groupBy(cell.alias("cell")).agg(
        F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).alias("n")
    )
    grid = grid.orderBy("cell").toPandas()
    if grid.empty:
        return Model(**{**model.__dict__, "knots": np.array([0.0, 1.0]), "values": np.array([0.0, 1.0])})
    knots, values = isotonic(*(grid[c].to_numpy(dtype=float) for c in ("raw", "label", "n")))
    return Model(**{**model.__dict__, "knots": knots, "values": values})


def with_score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Add the score of `text` as `column` (in place of one of that name); all others stay."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(statistics(list(texts))))

    return documents.withColumn(column, scored(utf8("text")))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Documents scored at least `threshold`, with their columns unchanged."""
    name = free_name(documents, "quality_score")
    scored = with_score(documents, train(documents, labels), name)
    return scored.filter(F.col(name) >= threshold).drop(name)
