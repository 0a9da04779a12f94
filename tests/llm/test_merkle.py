"""Proofs against a tree built the plain way."""
from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, awkward_rows, empty
from martkit.llm.merkle import folded, leaf_digest, merkle_proofs, tampered_proofs


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _tree(leaves):
    """The root, and per leaf its runs as (left, right)."""
    paths, nodes = [[] for _ in leaves], [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 16):
            run = nodes[a:a + 16]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(([y for y, _ in run[:j]], [y for y, _ in run[j + 1:]]))
            above.append((H(*[y for y, _ in run]), [i for _, b in run for i in b]))
        nodes = above
    return nodes[0][0], paths


def _marked(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _rank(v):
    return (v is not None, v.encode() if isinstance(v, str) else v or 0)


def plain(rows):
    items = []
    for doc, text, lang, source, n in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if text is not None else None
        touched = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        leaf = _marked(doc, source, lang, n, text)
        items.append((source, doc, leaf, _marked(doc, source, lang, n, lowered) if touched else leaf))
    items.sort(key=lambda x: (_rank(x[0]), _rank(x[1]), x[2]))
    sources = sorted({x[0] for x in items}, key=_rank)
    groups = [[x for x in items if x[0] == s] for s in sources]
    inner = [_tree([x[2] for x in g]) for g in groups]
    root, tops = _tree([subroot for subroot, _ in inner])
    out = []
    for group, (subroot, paths), top in zip(groups, inner, tops):
        for (_, doc, leaf, node), path in zip(group, paths):
            siblings = [y for left, right in path + top for y in left + right]
            for left, right in path + top:
                node = H(*left, node, *right)
            out.append((doc, leaf, subroot, root, H(*siblings), node, node == root))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in tampered_proofs(df).collect()), key=str)


def test_awkward_rows(spark):
    assert _got(awkward(spark)) == plain(awkward_rows())


def test_several_levels_and_many_sources(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10 ** 9), f"Text {i} é", "en", "hot" if i % 2 else None if i % 7 == 0 else f"s{rng.randrange(40)}", i) for i in range(900)]
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(7)) == plain(rows)


def test_one_source_of_one_run_and_of_one_row(spark):
    for n in (1, 2, 16, 17, 257):
        rows = [(i, f"t{i}", None, "a", None) for i in range(n)]
        assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows), n


def test_many_sources_of_one_row(spark):
    rows = [(i, f"t{i}", None, f"s{i:03d}", None) for i in range(40)]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_ids_repeated_by_a_third_of_all_rows(spark):
    rows = [(5 if i % 3 == 0 else i, f"t{i // 6}", "en", "a", 1) for i in range(120)]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_no_rows(spark):
    df = tampered_proofs(empty(spark))
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and df.isEmpty()


def test_any_change_of_a_row_is_seen(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(60)], SCHEMA)
    proofs = merkle_proofs(df, altered=leaf_digest([df.doc_id, df.source, df.lang, df.n_chars, F.concat(df.text, F.lit("!"))]))
    seen = proofs.select((folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("good"), (folded(F.col("altered"), F.col("path")) == F.col("root")).alias("bad"))
    assert {tuple(r) for r in seen.collect()} == {(True, False)}
