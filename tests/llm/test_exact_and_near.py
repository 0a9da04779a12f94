"""Exact dedup and SimHash against the plain way."""
from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

from helpers import SCHEMA, awkward, awkward_rows, empty
from martkit.llm import exact_dedup, simhash


def _copies(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, digest, kept = max(known, default=None), hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            stays = i == keep and not kept
            kept |= stays
            out[i, keep, len(ids), stays, digest] += 1
    return out


def test_exact_duplicates_awkward(spark):
    got = exact_dedup.exact_duplicates(awkward(spark))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == _copies(awkward_rows())


def test_exact_duplicates_hot_text(spark):
    rng = random.Random(1)
    rows = [(i, "hot " * 50 if i % 3 == 0 else f"text {rng.randrange(400)}", "en", "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert collections.Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()) == _copies(rows)


def test_stage_keeps_one_row_of_each_text(spark):
    docs = awkward(spark)
    kept = exact_dedup.without_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = {(r[1] or "", r[0]) for r in awkward_rows()}
    want = sorted({t: max((i for u, i in want if u == t and i is not None), default=None) for t, _ in want}.items())
    assert sorted(((r.text or "", r.doc_id) for r in kept.collect())) == want


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, exact_dedup.without_exact_duplicates, simhash.linked_components, simhash.without_near_duplicates])
def test_empty_table(spark, run):
    assert run(empty(spark)).count() == 0


def plain_fingerprint(text: str) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, ids, distance):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= distance:
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i in range(len(values)):
        least[root(i)].append(ids[i])
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(values))]


def test_linked_components_awkward(spark):
    rows = awkward_rows()
    values = [plain_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], values, plain_components(values, [r[0] for r in rows], 2)), key=str)
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.linked_components(awkward(spark)).collect()]
    assert sorted(got, key=str) == want


@pytest.mark.parametrize("busy", [2, 64])
def test_close_pairs_lose_none(spark, monkeypatch, busy):
    monkeypatch.setattr(simhash, "BUSY", busy)
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = set(centres)
    for c in centres:
        for _ in range(12):
            v = c
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                v ^= 1 << b
            values.add(v)
    values |= {1 << b for b in range(64)} | {0}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.close_pairs(fps, 2).collect()}
    arr = np.array(sorted(signed), np.int64)
    d = np.bitwise_count(arr.view(np.uint64)[:, None] ^ arr.view(np.uint64)[None, :])
    want = {(int(arr[i]), int(arr[j])) for i, j in zip(*np.nonzero(d <= 2)) if i < j}
    assert got == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def _vary(rng, words, share):
    return [f"new{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in words]


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(60, 400))
        rows.append((10 * i, " ".join(words)))
        for k in range(1, 4 if i < 50 else 1):
            copy = _vary(rng, words, 0.012)
            rows.append((10 * i + k, " ".join(copy)))
    sets = {i: set(zip(*[t.split()[k:] for k in range(5)])) for i, t in rows}
    should = {i for i, _ in rows if any(j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(i - i % 10, i))}
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(8)
    kept = {r.doc_id for r in simhash.without_near_duplicates(docs).collect()}
    assert {10 * i for i in range(150)} <= kept
    assert kept == _plain_kept(rows) and should and not should & kept


def test_near_dedup_awkward(spark):
    docs = awkward(spark)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 0 in ids and 100 not in ids and 101 not in ids and 1 in ids
    assert {102, 103, 104, 105, 106, 107} <= set(ids)        # texts without words are no copies of each other here


def _plain_kept(rows):
    """The smallest id of each group that similarity 0.8 links, by comparing all rows."""
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return set(least.values())


def _kept(spark, rows, parts=1):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    docs = docs.coalesce(1) if parts == 1 else docs.repartition(parts)
    return {r.doc_id for r in simhash.without_near_duplicates(docs).collect()}


def _edited(words, places):
    """With the words at these places new; each costs five shingles."""
    return " ".join(f"{w}x{min(places)}" if i in places else w for i, w in enumerate(words))


def test_copies_of_one_original_that_follow_an_edit(spark):
    # 300 shingles, four edits each: 0.875 to the original, 0.765 to each other.  The original is not the first row.
    words = [f"v{i}" for i in range(304)]
    rows = [(k, _edited(words, {4 + k + 70 * m for m in range(4)})) for k in range(40)]
    rows.insert(1, (99, " ".join(words)))
    assert _plain_kept(rows) == {0} == _kept(spark, rows)


def test_copies_that_come_before_their_original(spark):
    # Ids of four digits stand before 999 in the order of keys; every copy is in another task.
    rng = random.Random(21)
    words = [f"v{i}" for i in range(304)]
    rows = [(1000 + k, _edited(words, set(rng.sample(range(5, 299, 6), 4)))) for k in range(120)] + [(999, " ".join(words))]
    assert _plain_kept(rows) == {999} == _kept(spark, rows, 32)


def test_pairs_at_the_threshold_are_all_found(spark):
    rng = random.Random(22)
    rows = []
    for i in range(0, 400, 2):
        words = [f"v{i}x{j}" for j in range(rng.randrange(150, 400))]
        places, at = set(), 4
        while len(places) < len(words) * 0.0199:            # a tenth of the shingles or a little less: 0.80 to 0.85
            places.add(at)
            at += 6
        rows += [(i, " ".join(words)), (i + 1, _edited(words, places))]
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert sum(0.8 <= s < 0.85 for s in alike) >= 100
    assert _plain_kept(rows) == _kept(spark, rows, 8)


def test_close_sets_are_those_of_close_fingerprints(spark):
    rng = random.Random(31)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = [c ^ sum(1 << b for b in rng.sample(range(64), k)) for c in centres for k in (0, 0, 1, 2, 3)]
    nodes = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(fps)] + [(900, None)]
    got = {(r.a, r.b) for r in simhash._close_sets(spark.createDataFrame(nodes, "node long, fp long")).collect()}
    first = {v: min(i for i, x in enumerate(fps) if x == v) for v in fps}
    want = {(first[v], i) for i, v in enumerate(fps) if first[v] != i}
    want |= {tuple(sorted((first[a], first[b]))) for a in first for b in first if a != b and (a ^ b).bit_count() <= 2}
    assert got == want and len(want) > 12


def test_close_fingerprints_link_before_any_shared_shingle(spark, monkeypatch):
    # Nothing else than fingerprints can pair these sets here.
    real = simhash._shared_shingles
    monkeypatch.setattr(simhash, "_shared_shingles", lambda prefixes: real(prefixes).where("false"))
    words = [f"v{i}" for i in range(2000)]
    rows = [(1, " ".join(words)), (2, _edited(words, {700})), (3, " ".join(f"u{i}" for i in range(2000)))]
    assert _kept(spark, rows, 3) == {1, 3}
