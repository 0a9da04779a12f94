"""Mixing against the plain way."""
from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from helpers import SCHEMA, awkward, awkward_rows, empty
from martkit.llm import mixing


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_targets(spark):
    rng = random.Random(3)
    for case in range(4):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 10, 1000, 50_000]) for i in range(rng.choice([1, 2, 7, 20]))} | ({None: 40} if case % 2 else {})
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes), abs=1e-6)


def test_fit_reaches_what_can_be_reached():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = rng.integers(1, 7)
        lengths, counts = rng.choice(np.arange(2, 60), n, replace=False), rng.integers(1, 5, n)
        budget = int(rng.integers(0, (lengths * counts).sum() + 10))
        took = mixing.fit(lengths, counts, budget)
        assert ((0 <= took) & (took <= counts)).all()
        reach = {0}
        for n_, c in zip(lengths.tolist(), counts.tolist()):
            reach = {s + k * n_ for s in reach for k in range(c + 1)}
        assert (took * lengths).sum() == max(s for s in reach if s <= budget)


def test_fit_of_large_budgets():
    rng = np.random.default_rng(6)
    lengths, counts = np.arange(1, 3000), rng.integers(1, 90, 2999)
    for share in (0.01, 0.3, 0.97):
        budget = int((lengths * counts).sum() * share)
        took = mixing.fit(lengths, counts, budget)
        assert ((0 <= took) & (took <= counts)).all() and (took * lengths).sum() == budget


def test_fit_of_long_texts():
    for lengths, counts, budget, best in (([100_000], [2], 100_000, 100_000), ([90_000, 500], [10, 100], 600_000, 590_000),
                                          ([70_001, 70_000], [40, 40], 560_000, 560_000), ([400_000, 399_999, 7], [3, 3, 2], 1_199_999, 1_199_999)):
        took = mixing.fit(np.array(lengths), np.array(counts), budget)
        assert ((0 <= took) & (took <= counts)).all() and (took * lengths).sum() == best


def test_fit_of_long_texts_beyond_the_whole_table(monkeypatch):
    monkeypatch.setattr(mixing, "WHOLE", 0)
    took = mixing.fit(np.array([90_001, 500, 1]), np.array([1000, 100, 600]), 30_000_000)
    assert (took * np.array([90_001, 500, 1])).sum() > 30_000_000 - 90_001


def _check(docs, rows):
    got = mixing.mixed_documents(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert collections.Counter((r.doc_id, r.size, r.source) for r in got) == collections.Counter((r[0], size(r[1]), r[3]) for r in rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    target, taken = plain_targets(sizes), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    again = mixing.mixed_documents(docs.repartition(7)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))
    return target, taken


def test_mix_with_a_hot_source_and_hot_lengths(spark):
    rng = random.Random(7)
    rows = [(i, "w " * (50 if i % 3 == 0 else rng.randrange(1, 90)), "en", "hot" if i % 3 == 0 else f"s{rng.randrange(6)}", 1) for i in range(4000)]
    target, taken = _check(spark.createDataFrame(rows, SCHEMA), rows)
    assert all(abs(taken[s] - target[s]) <= (50 if s == "hot" else 1) for s in target)


def test_awkward_and_empty(spark):
    _check(awkward(spark), awkward_rows())
    assert mixing.mixed_documents(empty(spark)).count() == 0
    blank = [(1, None, "en", None, 1), (2, "", "en", "a", 1)]
    target, taken = _check(spark.createDataFrame(blank, SCHEMA), blank)
    assert sum(taken.values()) == 0
