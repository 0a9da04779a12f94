"""Quality classifier: random Fourier features, ridge regression by summed normal equations, isotonic calibration.

Each text gives about thirty statistics (shares of kinds of characters, lengths, repetition).  Cosines of random projections
approximate a Gaussian kernel over them.  Tasks sum the normal equations of their rows, the sums are added up over two
levels, and the driver solves one system of fixed size.  A fold of the labelled rows is kept from the fit; on it scores are
counted in bins and made monotone (pool adjacent violators).

Defined results: a null text is an empty text and is scored like any other; without labels, or with labels of one kind only,
every score is the labels' mean (0.5 without labels); scores lie in 0 to 1; a null id is not held out.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import keep_rows, map_batches, octets, written
from .labelled import CALIBRATION, held_out, training_labels

COSINES = 384
SEED = 11
RIDGE = 1e-3
THRESHOLD = 0.7
BINS = 2000
_SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = np.zeros(256, np.int64)            # lower 0, upper 1, digit 2, space 3, line end 4, symbol 5, control 6, not ASCII 7
for _i in range(256):
    _KINDS[_i] = (0 if 97 <= _i <= 122 else 1 if 65 <= _i <= 90 else 2 if 48 <= _i <= 57 else 3 if _i in (9, 32) else
                  4 if _i in (10, 13) else 5 if _i in _SYMBOLS else 6 if _i < 128 else 7)
_SENTENCE = list(b".,;:?")
N_STATISTICS = 30


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one text; all of them are zero for an empty text."""
    out = np.zeros(N_STATISTICS)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    kinds = np.bincount(_KINDS, weights=counts, minlength=8) / n
    symbols = counts[list(_SYMBOLS)]
    shares = counts[counts > 0] / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen = Counter(words)
    lines = text.split(b"\n")
    pairs = max(1, len(words) - 1)
    letters = max(1e-9, kinds[0] + kinds[1] + kinds[7])
    out[:8] = kinds
    out[8:] = (
        np.log1p(n), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        symbols.max() / n, (counts[_SENTENCE].sum()) / n, counts[33] / n, counts[124] / n, kinds[1] / letters,
        -(shares * np.log(shares)).sum(), len(seen) / w, max(seen.values(), default=0) / w,
        sum(map(eq, words, words[1:])) / pairs, len(set(zip(words, words[1:]))) / pairs,
        sum(not x[-1:].isalnum() and x[-1] < 128 for x in words) / w, sum(len(x) == 1 for x in words) / w,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), sum(not x.strip() for x in lines) / len(lines),
        _packed(text), len(words) / n)
    return out


def _packed(text: bytes) -> float:
    """Compressed share of a text, a piece at a time."""
    pieces = [text[i:i + (1 << 20)] for i in range(0, len(text), 1 << 20)]
    return sum(len(zlib.compress(p, 1)) for p in pieces) / len(text)


@dataclass
class Model:
    """Of fixed size, whatever the input."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    constant: float | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        rng = np.random.default_rng(SEED)
        omega = rng.normal(size=(N_STATISTICS, COSINES)) / np.sqrt(N_STATISTICS) * 1.2
        phase = rng.uniform(0, 2 * np.pi, COSINES)
        return np.hstack([np.ones((len(z), 1)), z, np.cos(z @ omega + phase)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def document_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), octets(text).alias("body"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = [statistics(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "stats"])
    return map_batches(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, N_STATISTICS))


def _summed(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over the rows: summed by task, then over some tasks, then over one."""
    size = 1 + N_STATISTICS + COSINES

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zz = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch.column(0)))
            zz += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        yield pa.RecordBatch.from_arrays([pa.array([zz.tobytes()], pa.binary())], names=["sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * (size + 1))
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    parts = rows.select("stats", "y").mapInArrow(per_task, "sums binary")
    total = np.zeros((size, size + 1))
    for row in parts.repartition(8).mapInArrow(added, "sums binary").collect():     # eight sums of fixed size
        total += np.frombuffer(bytes(row.sums), np.float64).reshape(total.shape)
    return total[:, :-1], total[:, -1]


def isotonic(at: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the monotone fit: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for x, y, w in zip(at, share, weight):
        pools.append([x * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _raw_scores(rows: DataFrame, model: Model, score) -> DataFrame:
    """``rows`` with their statistics replaced by a score."""
    rest = [c for c in rows.columns if c != "stats"]
    rows = rows.select(*rest, "stats")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        value = pa.array(score(model, _matrix(batch.column(len(rest)))), pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], value], names=[*rest, "score"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, work, f"{schema}, score double")


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    rows = written(stats.join(training_labels(labels, label), F.col("doc_id") == F.col("label_id")).select("stats", "y", "fold"), "training")
    cells = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATISTICS)]
    cells += [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATISTICS)]
    first = rows.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *cells).first()
    nothing = np.zeros(0)
    if not first.n or first.y in (0.0, 1.0):
        return Model(nothing, nothing, nothing, nothing, nothing, constant=0.5 if first.y is None else first.y)
    mean = np.array([first[f"m{i}"] for i in range(N_STATISTICS)])
    scale = np.array([first[f"s{i}"] for i in range(N_STATISTICS)])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), nothing, nothing, nothing)
    zz, zy = _summed(rows.where(F.col("fold") != CALIBRATION), model)
    model.weights = np.linalg.solve(zz + RIDGE * max(1.0, zz[0, 0]) * np.eye(len(zz)), zy)
    model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    scored = _raw_scores(rows.where(F.col("fold") == CALIBRATION), model, lambda m, s: m.raw(s))
    binned = scored.groupBy(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "score")) * BINS).cast("int").alias("bin"))
    bins = sorted(binned.agg(F.avg("score").alias("at"), F.avg("y").alias("y"), F.count("*").alias("n")).collect())
    if len(bins) > 20:
        knots, values = isotonic(*(np.array([float(b[k]) for b in bins]) for k in ("at", "y", "n")))
        # Beyond the outer knots, and within a pool, a little of the raw score keeps the order.
        model.knots = np.concatenate([[min(knots[0], 0.0) - 1.0], knots, [max(knots[-1], 1.0) + 1.0]])
        model.values = np.concatenate([[0.0], 0.002 + 0.996 * values, [1.0]])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    stats = written(document_statistics(docs, text, doc_id), "statistics")
    model = fit(stats, labels, label)
    scored = _raw_scores(stats, model, lambda m, s: m.score(s))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_low_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
                        text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    stats = written(document_statistics(docs, text, doc_id), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, label))
    return keep_rows(docs, text, lambda texts: model.value.score(np.array([statistics(t) for t in texts])) >= threshold
                     if texts else np.zeros(0, bool))
