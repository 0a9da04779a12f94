"""Containment search against the plain way."""
from __future__ import annotations

import random
import re

import pytest

from helpers import SCHEMA, awkward, empty
from martkit.llm import contamination


def _words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def plain(docs, items, least=0.8):
    out = set()
    for item, text in set(items):
        w = _words(text)
        if not w:
            continue
        m = min(5, len(w))
        own = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)}
        for doc, body in docs:
            v = _words(body)
            shared = len(own & {tuple(v[i:i + m]) for i in range(len(v) - m + 1)})
            if shared >= least * len(own) - 1e-9:
                out.add((doc, item, len(own), shared))
    return out


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_finds_all(spark, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 5, 6, 9, 17, 40])))) for i in range(30)]
    items += [(90, ""), (91, None), (92, "..."), (0, items[0][1]), (93, items[1][1])]
    docs = []
    for d in range(60):
        words = rng.choices([f"d{i}" for i in range(500)], k=rng.choice([0, 3, 30, 300]))
        for _ in range(rng.randrange(3)):
            piece = [w.upper() + "!!" if rng.random() < .3 else w for w in rng.choice(items[:30])[1].split()]
            if len(piece) > 20:
                piece[rng.randrange(len(piece))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = piece
        docs.append((d, " ".join(words)))
    docs += [(None, docs[5][1]), (61, None)]
    a = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in contamination.contained_items(a, b).collect()}
    assert got == plain(docs, items)
    assert len(got) > 20
    clean = sorted(str(r.doc_id) for r in contamination.without_contaminated(a, b).collect())
    dirty = {d for d, *_ in got}
    assert clean == sorted(str(d) for d, _ in docs if d not in dirty)


def test_awkward_and_empty(spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    docs = awkward(spark)
    assert {r.doc_id for r in contamination.contained_items(docs, items).collect()} == {105}
    kept = contamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert contamination.contained_items(empty(spark), items).count() == 0
    assert contamination.contained_items(docs, empty(spark, "item_id long, text string")).count() == 0
