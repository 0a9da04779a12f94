"""Quality and toxicity scores: held-out accuracy, decoding, and the defined results of awkward input."""
from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from helpers import SCHEMA, awkward, empty
from martkit.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int"
VOCABULARY = ["river", "mountain", "letter", "garden", "window", "market", "stone", "winter", "paper", "music", "idea", "story", "colour", "table"]
BAD = ["vermin", "lowlife", "wretch", "filth"]
SPOIL = {"vermin": "v3rm1n", "lowlife": "l o w l i f e", "wretch": "wreeeetch", "filth": "f!lth"}


def corpus(n: int = 900):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(VOCABULARY) + rng.choice(["", "", "s", "."]) for _ in range(rng.randrange(20, 200))]
        toxic, good = rng.random() < 0.25, rng.random() < 0.7
        if toxic:
            for w in rng.sample(BAD, 3):
                words.insert(rng.randrange(len(words)), SPOIL[w] if rng.random() < 0.5 else w)
        if not good:
            words = rng.choice([lambda w: [x.upper() + "!!" for x in w], lambda w: [x for x in w for _ in range(6)], lambda w: " | ".join(w).split(" ")])(words)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def made(spark):
    rows, labels = corpus()
    return spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels}


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_on_held_out_rows(made):
    docs, labels, truth = made
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(truth) and all(r.held_out == _held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id][0] for r in held]) > 0.95
    kept = {r.doc_id for r in quality.without_low_quality(docs, labels).collect()}
    assert kept == {r.doc_id for r in rows if r.predicted}


def test_labels_of_held_out_rows_are_not_used(spark, made):
    docs, labels, truth = made
    flipped = spark.createDataFrame([(i, 1 - q if _held(i) else q, 1 - t if _held(i) else t) for i, (q, t) in truth.items()], LABELS)
    for run in (quality.quality_scores, toxicity.toxicity_scores):
        one, two = ({r.doc_id: r.score for r in run(docs, x).collect()} for x in (labels, flipped))
        assert all(abs(one[i] - two[i]) < 1e-9 for i in one)


def test_toxicity_on_held_out_rows(made):
    docs, labels, truth = made
    rows = [r for r in toxicity.toxicity_scores(docs, labels).collect() if r.held_out]
    hit = {t: np.mean([r.predicted for r in rows if truth[r.doc_id][1] == t]) for t in (0, 1)}
    assert hit[1] > 0.95 and hit[0] < 0.03


def test_decoding(made):
    docs, *_ = made
    decoder = toxicity.Decoder(toxicity.trigram_counts(docs))
    for spoilt, word in {"r1v3r": "river", "m0untain": "mountain", "w!nd0w": "window", "gaaaaarden": "garden", "st0ry!!!": "story", "$tone": "stone",
                         "market": "market", "2024": "2024", "lettter": "letter", "p4per,": "paper"}.items():
        assert decoder.restored(spoilt) == word, spoilt
    assert {"market", "music"} <= decoder.words(b"go to the m a r k e t for m.u.s.i.c now")
    plain, best = "w!nd0w", max(_paths(decoder, "w!nd0w"), key=lambda x: x[0])[1]
    assert decoder.viterbi(plain) == best


def test_decoding_of_spaced_words(made):
    docs, *_ = made
    decoder = toxicity.Decoder(toxicity.trigram_counts(docs))
    for text, words in {"m a r k e t m u s i c": {"market", "music"}, "a m\ta\nr  k e t": {"market"}, "ma rk et": {"market"}, "the st one, x": {"stone"},
                        "m 4 r k 3 t!": {"market"}, "g.a.r.d.e.n - w_i_n_d_o_w": {"garden", "window"}}.items():
        assert words <= decoder.words(text.encode()), (text, decoder.words(text.encode()))
    accented = spark_free_decoder("chère élève ".encode() * 50)
    assert "élève" in accented.words("é l è v e".encode())


def spark_free_decoder(text):
    s = np.frombuffer((b" " + text + b" ").translate(toxicity._SYMBOL), np.uint8).astype(int)
    n = toxicity._N
    return toxicity.Decoder(np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n ** 3).astype(float).reshape(n, n, n))


def test_decoding_of_long_tokens(made):
    docs, *_ = made
    decoder = toxicity.Decoder(toxicity.trigram_counts(docs))
    assert decoder.restored("m" + "a" * 60 + "rket") == "market"
    assert decoder.restored("w!n" + "d" * 100_000 + "0w") == "window"


def _paths(decoder, token):
    import itertools
    for path in itertools.product(*decoder.lattice(token)):
        a = b = 0
        cost = 0.0
        for c in "".join(path) + " ":
            z = toxicity._SYMBOL[ord(c)] if ord(c) < 128 else 27
            cost, a, b = cost + decoder.log[a][b][z], b, z
        yield cost, "".join(path)


@pytest.mark.parametrize("run, none", [(quality.quality_scores, 0.5), (toxicity.toxicity_scores, 0.0)])
def test_awkward_and_empty(spark, made, run, none):
    docs, labels, _ = made
    label = "quality" if run is quality.quality_scores else "toxic"
    assert run(empty(spark), labels).count() == 0
    plain = run(awkward(spark), empty(spark, LABELS)).collect()
    assert len(plain) == awkward(spark).count() and {r.score for r in plain} == {none}
    one = spark.createDataFrame([(i, 1, 1) for i in range(20)] + [(None, 0, 0), (3, None, None)], LABELS)
    assert {r.score for r in run(awkward(spark), one).collect()} == {1.0}
    mixed = awkward(spark).unionByName(docs, allowMissingColumns=True)
    doubled = labels.unionByName(labels).selectExpr("*", "1 as score", "2 as stats", "3 as y", "4 as fold", "5 as body")
    rows = run(mixed, doubled).collect()
    assert len(rows) == mixed.count() and all(0 <= r.score <= 1 for r in rows), label
    assert not any(r.held_out for r in rows if r.doc_id is None)


def test_isotonic_is_monotone_and_best():
    rng = np.random.default_rng(1)
    x, w = np.arange(30.0), rng.integers(1, 9, 30).astype(float)
    y = np.clip(x / 30 + rng.normal(0, .3, 30), 0, 1)
    knots, values = quality.isotonic(x, y, w)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    # The best monotone fit at i: the largest over j <= i of the least mean of y[j..k] over k >= i.
    mean = lambda j, k: (y[j:k + 1] * w[j:k + 1]).sum() / w[j:k + 1].sum()
    best = [max(min(mean(j, k) for k in range(i, 30)) for j in range(i + 1)) for i in range(30)]
    assert set(np.round(best, 9)) == set(np.round(values, 9))


def test_runs_of_shorter_tokens_lie_in_those_of_longer_ones():
    """Sought inside the widest runs, the narrower patterns find what they find in the whole text, and decoding does not
    depend on what was decoded before."""
    rng = random.Random(3)
    letters = "ab i1!$@3 .-_*  ,;:\n\t(|+é€xyz0!!! oo"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    used = toxicity.Decoder(np.random.default_rng(3).integers(0, 9, (30, 30, 30)).astype(float))
    for i, s in enumerate(texts):
        assert toxicity._runs(s) == {m.group() for spaced in toxicity._SPACED for m in spaced.finditer(s)}
        words = used.words(s.encode())
        if i % 50 == 0:
            fresh = toxicity.Decoder(np.zeros((30, 30, 30)))
            fresh.log = used.log
            assert fresh.words(s.encode()) == words
