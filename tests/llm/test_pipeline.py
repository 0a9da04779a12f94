"""The pipeline stage after stage, on the test tables and on awkward rows."""
from __future__ import annotations

import re

import pytest

import corpus_pipeline
from helpers import awkward, empty
from martkit.llm import contamination, quality
from martkit.llm.common import table
from martkit.llm.queries import ORACLES, QUERIES
from test_contamination import plain

FOLDER = "/root/testdata/sf0.001"


def _near_kept(texts):
    """The smallest id of each group that similarity 0.8 links, by comparing all texts; words as ``plain_words`` has them."""
    def shingles(text):
        words = re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (text or "").lower()).split(" ")
        words = [w for w in words if w]
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids, sets = sorted(texts), {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in ids if find(i) == i}


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen.append((name, {r.doc_id: r.text for r in docs.collect()}, {r.doc_id for r in out.collect()}, out.columns))
        docs = out
    assert [s[0] for s in seen] == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    assert all(s[3] == columns for s in seen[:-1]) and all(s[2] <= set(s[1]) for s in seen)
    _, before, after, _ = seen[0]
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).collect()}
    assert after == {i for i in before if scores[i] == 1}
    _, before, after, _ = seen[1]
    assert after == set({t: i for i, t in sorted(before.items())}.values())
    _, before, after, _ = seen[2]
    assert after == _near_kept(before)
    _, before, after, _ = seen[3]
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    assert set(before) - after == {d for d, *_ in plain(list(before.items()), items)}
    assert seen[4][2] == seen[3][2]
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_on_awkward_rows(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "mixing":
            assert out.columns == docs.columns
        assert out.count() <= docs.count()
        if name == "mixing":
            assert out.count() == docs.count()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and contamination.BLOCK_WORDS > 0
