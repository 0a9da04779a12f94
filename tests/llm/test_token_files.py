"""Ids against the library's of whole texts, files against what went in."""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import SCHEMA, awkward, awkward_rows, empty
from martkit.llm.token_files import Encoder, FileBuilder, IdFile, from_planes, read_token_files, to_planes, tokenised, write_token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "a \n b", "a\n b", "it's a 'test' 's", "x <|endoftext|> y", "<|endoftext|>", "　 a b", "é à  ü \n\n c",
       "\U0010ffff a b", "1 2 3  4 56", "a\t b \t c", "日本 語 x", "a\x85 b", "w" * 300 + " " + "z " * 50, "\x00 a \x00 b", "a\x1c b \x1c c", "a​ ​b c", "don't  'll"]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda texts: [e.ids + [0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(FILE)


def _stream(encoder, texts):
    ids, lengths = encoder.stream(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_ids_are_those_of_whole_texts(encoder, whole):
    assert encoder.in_pieces and _stream(encoder, ODD) == whole(ODD)
    assert _stream(encoder, [ODD[3]]) == whole([ODD[3]])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sé .,\n\t\r  　​\x1c\x85１2日-<|>"), max_size=25), min_size=1, max_size=5))
def test_pieces_never_change_ids(encoder, whole, texts):
    assert _stream(encoder, texts) == whole(texts)


def test_forgetting_changes_nothing(whole, monkeypatch):
    from martkit.llm import token_files
    monkeypatch.setattr(token_files, "_REMEMBERED", 5)
    small = Encoder(FILE)
    for _ in range(3):
        assert _stream(small, ODD) == whole(ODD)


def test_tokenizers_of_other_kinds_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    other = Encoder(path)
    assert not other.in_pieces
    assert _stream(other, ODD) == [e.ids + [0] for e in tokenizer.encode_batch(ODD, add_special_tokens=False)]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_planes(n, bits):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    planes = to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4) and np.array_equal(from_planes(planes, n), ids)


@pytest.mark.parametrize("bits", [False, True])
def test_file_decodes_only_what_is_asked_for(bits):
    rng = np.random.default_rng(1)
    ids, lengths = rng.integers(0, 50_000, 1003).astype(np.uint32), np.array([1, 0, 500, 2, 500])
    built = FileBuilder(3, 4, bits, block=64)
    built.add(ids[:501], [9, None, -5], lengths[:3])
    built.add(ids[501:], [7, 7], lengths[3:])
    f = IdFile(built.bytes() + b"\n")
    assert (f.task, f.file, f.n, f.doc_ids.to_pylist(), f.doc_lengths.tolist()) == (3, 4, 1003, [9, None, -5, 7, 7], lengths.tolist())
    for start, stop in ((0, 1003), (0, 1), (63, 65), (64, 128), (1000, 1003), (5, 5)):
        assert np.array_equal(f.ids(start, stop), ids[start:stop])
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert f.checksums().tolist() == [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
    decoded = []
    f.block_ids, plain = lambda k: decoded.append(k) or plain(k), f.block_ids
    f.ids(130, 190)
    assert decoded == [2]


def _plain(rows, whole):
    rows = sorted(((d is not None, d or 0, np.int64(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42))), t or "") for d, t, *_ in rows), key=lambda r: r[:3])
    out, at = [], 0
    for (there, d, _, _), ids in zip(rows, whole([r[3] for r in rows])):
        out.append((d if there else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("bits", [False, True])
def test_awkward_documents(spark, whole, bits):
    got = tokenised(awkward(spark).repartition(6), FILE, bits, file_ids=300).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == _plain(awkward_rows(), whole)


def test_files_follow_the_order_of_ids(spark, whole, tmp_path):
    df = spark.createDataFrame([((i * 7919) % 1000, f"text {i} " * (i % 40), "en", "s", 1) for i in range(1000)], SCHEMA).repartition(9)
    write_token_files(df, str(tmp_path / "ids"), FILE, file_ids=2000, block=128)
    found = read_token_files(spark, str(tmp_path / "ids")).orderBy("task", "file", "offset").collect()
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found) and len(found) == 1000
    assert len({(r.task, r.file) for r in found}) > 4
    # A file ends with the document that passes the limit.
    sizes = {}
    for r in found:
        sizes.setdefault((r.task, r.file), []).append(r.n_tokens)
    assert all(sum(v) - v[-1] < 2000 for v in sizes.values())


def test_no_documents(spark):
    df = tokenised(empty(spark), FILE)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and df.isEmpty()


def test_rows_that_repeat_and_ids_that_are_text(spark, whole):
    df = spark.createDataFrame([("3", "a b"), ("3", "a b"), ("10", "c")], "doc_id string, text string").withColumn("task", F.lit(1))
    got = sorted((tuple(r) for r in tokenised(df, FILE).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [3, 3, 10] and got == _plain([(3, "a b"), (3, "a b"), (10, "c")], whole)
