"""The trie against all prefixes counted the plain way."""
from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from helpers import EXTRA
from martkit.llm import prefix_trie
from martkit.llm.prefix_trie import conversation_turns, fattest, prefix_trie as trie, rebuilt_trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_turns(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}


def plain(convs):
    members, children, ends = {}, {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
            if d:
                children.setdefault(tuple(v[:d - 1]), set()).add(tuple(v[:d]))
        ends.setdefault(tuple(v), []).append(c)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, ())), leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, m in members.items()), key=str)


def rebuilt(convs):
    out = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + v[h:]
    return out


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plain_trie(spark, convs: dict[int, str]):
    """Conversations given as strings, a letter a turn."""
    rows = [(c, i, "user", x) for c, v in convs.items() for i, x in enumerate(v)]
    turns = conversation_turns(spark.createDataFrame(rows, TURNS)).select("conv", F.col("place").alias("d"), "letter", "n")
    return trie(turns, spark.createDataFrame([(c,) for c in convs], "conv long"))


def test_awkward_conversations(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é😀", None, ""])) for c in range(90, 130) for t in range(rng.randrange(1, 9))]
    rows += [(100, None, "system", "first"), (100, None, None, None), (100, 3, "user", "a"), (100, 3, "user", "a"), (None, 1, "user", "lost"), (205, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, TURNS).select("*", *[F.lit("x").alias(c) for c in (*EXTRA, "conv", "d", "p", "e", "h", "n")]).repartition(5)
    assert _got(rebuilt_trie(df)) == plain(rebuilt(plain_turns(rows)))


def test_shapes(spark):
    """Prefixes of each other, copies, one long path with a branch at each length, and nothing at all."""
    comb = {i: "a" * i + "b" for i in range(1, 30)}
    convs = {**comb, 50: "", 51: "", 60: "a" * 70, 61: "a" * 70, 62: "a" * 33, 70: "xyz", 71: "xyzw", 72: "xy", 73: "q"}
    assert _got(_plain_trie(spark, convs)) == plain({c: [("user", x) for x in v] for c, v in convs.items()})


@pytest.mark.parametrize("seed", [1, 2])
def test_random_strings(spark, seed):
    rng = random.Random(seed)
    convs = {c: "".join(rng.choice("ab") for _ in range(rng.randrange(12))) for c in rng.sample(range(1000), 150)}
    assert _got(_plain_trie(spark, convs)) == plain({c: [("user", x) for x in v] for c, v in convs.items()})


def test_long_conversations_and_many_members_are_cut_up(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "CELL", 2)
    convs = {**{i: "abcdefghijklmnop" for i in range(10)}, 20: "abcdefghijkl", 21: "abcdefghijkLM", 22: "abz", 23: "abcdefghijklmnopqrst"}
    assert _got(_plain_trie(spark, convs)) == plain({c: [("user", x) for x in v] for c, v in convs.items()})
    rows = [(c, i, "u", x) for c, v in convs.items() for i, x in enumerate(v)]
    assert _got(rebuilt_trie(spark.createDataFrame(rows, TURNS))) == plain(rebuilt(plain_turns(rows)))


def test_fattest_numbers(spark):
    def two_fattest(a, b):
        return max(range(a + 1, b + 1), key=lambda i: i & -i)
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", fattest(F.col("a"), F.col("b"))).collect()
    assert all(f == two_fattest(a, b) for a, b, f in got)


def test_no_conversations(spark):
    df = rebuilt_trie(spark.createDataFrame([], TURNS))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"] and df.isEmpty()
