"""Toxicity scores over text restored by noisy-channel decoding.

A writer's word reaches us through a channel that swaps letters for look-alikes (leetspeak), spaces letters out and repeats
them.  Each suspicious token becomes a lattice of the letters that may stand behind its characters, and each run of short
tokens (up to three characters) one in which a word goes on or ends at every gap; Viterbi search takes the path that a
character trigram model finds likeliest.  The tokens of a run count as words beside those restored from it.  The model is counted over all documents.  Restored words, and their
beginnings, get log-odds of toxic against other labelled documents; a logistic regression over a document's log-odds, fitted
on a fold that took no part in them, gives the score.

Learnt from at most about ``MOST_LABELLED`` labelled rows (chosen by a hash of their id beyond that), so that their labels
can be sent to all tasks; the model sent back holds words that at least ``SUPPORT`` of the toxic documents have, hence at
most (words per document) / ``SUPPORT`` of them.

Defined results: a null text is an empty text, scored like any other; without labels, or with labels of one kind only, every
score is the labels' mean (0 without labels); scores lie in 0 to 1; a null id is not held out.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_batches, octets, written
from .labelled import CALIBRATION, bounded, held_out, training_labels

MOST_LABELLED = 200_000
SUPPORT = 0.005
THRESHOLD = 0.3
PREFIX = 5

# ---------------------------------------------------------------- character model
# Symbols: 0 a word's edge, 1-26 letters, 27 letters outside ASCII, 28 digits, 29 all else.
_SYMBOL = bytes((c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 28 if 48 <= c <= 57 else
                 0 if c in b" \t\n\r\x0b\x0c" else 27 if c >= 128 else 29) for c in range(256))
_N = 30
#: Letters that may stand behind a character (fixed values).
LOOK_ALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_EDGE = ".,;:?!*#%&\"'|-_()[]{}<>~^/\\=+"
#: Maximal runs of tokens of up to one, two and three characters (letters of any script, digits, look-alikes), with any
#: number of separators between them.  A run of spelled letters between short words is thus decoded without these as well.
_SHORT, _GAP = r"[^\W_@$!|+(€£]|[@$!|+(€£]", r"[\s._*-]+"
_SPACED = [re.compile(rf"(?<![^\s.,;:_*\-])(?:(?:{_SHORT}){{1,{k}}}{_GAP})+(?:{_SHORT}){{1,{k}}}(?![^\s.,;:!?_*\-])") for k in (1, 2, 3)]
_BETWEEN = re.compile(_GAP)
_STRANGE = re.compile(r"[0-9@$!|+(€£]|(.)\1\1")


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each three successive symbols occur in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_N ** 3, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                s = np.frombuffer((b" " + t + b" ").translate(_SYMBOL), np.uint8).astype(np.int32)
                if len(s) > 2:
                    total += np.bincount((s[:-2] * _N + s[1:-1]) * _N + s[2:], minlength=_N ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["gram", "n"])
    parts = docs.select(octets(text).alias("body")).mapInArrow(run, "gram int, n long")
    out = np.zeros(_N ** 3)
    for row in parts.groupBy("gram").agg(F.sum("n").alias("n")).collect():       # at most 27,000 rows
        out[row.gram] = row.n
    return out.reshape(_N, _N, _N)


@lru_cache(1 << 14)
def _symbols(option: str) -> tuple[int, ...]:
    return tuple(_SYMBOL[ord(c)] if ord(c) < 128 else 27 for c in option)


def _runs(s: str) -> set[str]:
    """The matches of all of ``_SPACED``.

    A run of shorter tokens is part of one of longer tokens, where these are cut in the same places; so only the widest pattern
    is sought in the whole text, and each of the others inside the matches of the one before.
    """
    out, regions = set(), [(0, len(s))]
    for spaced in reversed(_SPACED):
        found = [m for start, end in regions for m in spaced.finditer(s, start, end)]
        out.update(m.group() for m in found)
        regions = [m.span() for m in found]
    return out


class Decoder:
    """Restores suspicious tokens under the character model."""

    def __init__(self, counts: np.ndarray) -> None:
        lower = counts.sum(axis=0) + 0.1                 # pairs, as the fallback of unseen triples
        backed = lower / lower.sum(axis=1, keepdims=True)
        self.log = np.log((counts + 5.0 * backed[None]) / (counts.sum(axis=2, keepdims=True) + 5.0)).tolist()
        self.known: dict[tuple[str, str], str] = {}
        self.bare: dict[str, tuple[str]] = {}
        self.spelled: dict[str, list[str]] = {}

    def lattice(self, token: str) -> list[list[str]]:
        """For each place the strings that may stand behind it; a run of three or more stands for one or two."""
        out, at = [], 0
        while at < len(token):
            end = at
            while end < len(token) and token[end] == token[at]:
                end += 1
            letters = LOOK_ALIKES.get(token[at], token[at])
            if end - at >= 3:
                out.append([c * k for c in letters for k in (1, 2)])
            else:
                out.extend([list(letters)] * (end - at))
            at = end
        return out

    def spaced_lattice(self, run: str) -> list[list[str]]:
        """Of short tokens: between two of them the word goes on or ends."""
        out: list[list[str]] = []
        for token in _BETWEEN.split(run):
            out += [["", " "], *self.lattice(token)] if out else self.lattice(token)
        return out

    def viterbi(self, token: str) -> str:
        return self.likeliest(self.lattice(token))

    def likeliest(self, lattice: list[list[str]]) -> str:
        # Each path is its last string and the path before, so the work is linear in the places.
        log, best = self.log, {(0, 0): (0.0, None)}
        for options in [*lattice, [" "]]:
            steps = [(option, _symbols(option)) for option in options]
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for option, symbols in steps:
                    p, x, y = cost, a, b
                    for z in symbols:
                        p, x, y = p + log[x][y][z], y, z
                    old = new.get((x, y))
                    if old is None or p > old[0]:
                        new[x, y] = (p, (option, path))
            best = new
        path, out = max(best.values(), key=lambda v: v[0])[1], []
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out)).strip()

    def restored(self, token: str) -> str:
        """The word behind a token: bare of marks at its edges, and decoded if it has look-alikes or long runs."""
        if token.isalpha() and not _STRANGE.search(token):
            return token
        core = token.rstrip(_EDGE + "$@").lstrip(_EDGE)
        if not _STRANGE.search(core) or not re.search(r"[^\W\d_]", core):
            return core
        return self.remembered(core, self.lattice)

    def remembered(self, text: str, lattice) -> str:
        """The likeliest of the text's lattice; long texts are decoded each time."""
        key = (text, lattice.__name__)
        if key in self.known:
            return self.known[key]
        out = self.likeliest(lattice(text))
        if len(text) <= 40:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = out
        return out

    def words(self, text: bytes) -> set[str]:
        """The different restored words of a text."""
        s = text.decode("utf-8", "replace").lower()
        out = set()
        for known, texts, find in ((self.bare, set(s.split()), lambda t: (self.restored(t),)), (self.spelled, _runs(s), self.spelled_words)):
            if len(known) > 200_000:
                known.clear()
            for t in texts:
                found = known.get(t)
                if found is None:
                    found = find(t)
                    if len(t) <= 40:                     # long ones are decoded each time
                        known[t] = found
                out.update(found)
        out.discard("")
        return out

    def spelled_words(self, run: str) -> list[str]:
        """The words that a run of short tokens may spell; none if it has no letter."""
        run = run.rstrip("!")
        return self.remembered(_BETWEEN.sub(" ", run), self.spaced_lattice).split() if re.search(r"[^\W\d_]", run) else []


def features(words: set[str]) -> set[str]:
    return words | {f"{w[:PREFIX]}*" for w in words if len(w) > PREFIX}


# ---------------------------------------------------------------- learning
@dataclass
class Model:
    decoder: Decoder
    odds: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray | None = None
    constant: float = 0.0

    def evidence(self, text: bytes) -> list[float]:
        words = self.decoder.words(text)
        found = sorted((self.odds[f] for f in self.odds.keys() & features(words)), reverse=True)
        strong = [x for x in found if x >= 3]
        return [1.0, found[0] if found else 0.0, np.log1p(len(strong)), np.log1p(len(found)), sum(found) / (1 + np.log1p(len(words))),
                len(strong) / (1 + len(words)) ** 0.5]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(evidence), self.constant)
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights, -30, 30)))


def word_odds(rows: DataFrame, model, n_toxic: int, n_other: int) -> dict[str, float]:
    """Log-odds of the features that enough toxic documents have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = features(model.value.decoder.words(t))
                every.update(own)
                if y:
                    toxic.update(own)
            if len(every) > 1_000_000:
                yield _counts(toxic, every)
                toxic, every = Counter(), Counter()
        yield _counts(toxic, every)
    least = max(3, SUPPORT * n_toxic)
    counts = rows.select("body", "y").mapInArrow(run, "feature string, toxic long, n long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(F.col("toxic") >= least)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (n_other + 1))
    return {r.feature: r.odds for r in counts.select("feature", odds.alias("odds")).where("odds >= 1").collect()}


def _counts(toxic: Counter, every: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(every), pa.string()), pa.array([toxic[w] for w in every], pa.int64()), pa.array(list(every.values()), pa.int64())],
        names=["feature", "toxic", "n"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def _evidence(rows: DataFrame, model, *more: str) -> DataFrame:
    """``rows`` with their body replaced by the evidence in it."""
    rows = rows.select("body", *more)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([model.value.evidence(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([found, *batch.columns[1:]], names=["evidence", *more])
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in more)
    return map_batches(rows, work, f"evidence array<double>, {kinds}")


def _shared(spark: SparkSession, model: Model):
    return spark.sparkContext.broadcast(model)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", doc_id: str = "doc_id") -> Model:
    spark = docs.sparkSession
    model = Model(Decoder(trigram_counts(docs, text)))
    labelled = written(training_labels(labels, label), "labels")
    sample = F.broadcast(written(bounded(labelled, MOST_LABELLED), "sample"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), octets(text).alias("body")).join(sample, F.col("doc_id") == F.col("label_id"))
    learning = rows.where(F.col("fold") != CALIBRATION)
    n, toxic = (int(x or 0) for x in learning.agg(F.count("*"), F.sum("y")).first())
    if toxic in (0, n):
        model.constant = float(toxic) / max(1, n)
        return model
    model.odds = word_odds(learning, _shared(spark, model), toxic, n - toxic)
    found = _evidence(rows.where(F.col("fold") == CALIBRATION), _shared(spark, model), "y")
    # Rows of the fold that agree in evidence (to three places) are one; their number is bounded by the labelled sample.
    seen = found.select(F.transform("evidence", lambda v: F.round(v, 3)).alias("x"), "y").groupBy("x", "y").count().collect()
    x, y, w = (np.array([r[i] for r in seen], float) for i in range(3))
    if len(set(y)) < 2:
        model.constant = float(toxic) / n
        return model
    model.weights = logistic(np.repeat(x, w.astype(int), axis=0), np.repeat(y, w.astype(int)))
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    model = _shared(docs.sparkSession, fit(docs, labels, label, text, doc_id))
    rows = docs.select(F.col(doc_id).alias("doc_id"), octets(text).alias("body"))
    rows = _evidence(rows, model, "doc_id")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 6))
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.value.score(x), pa.float64())], names=["doc_id", "score"])
    scored = map_batches(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
