"""The split scan against Spark's reader of whole files."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martkit.sources.split_csv import read_split_csv, split_records


@pytest.fixture()
def small_blocks(spark):
    """Byte ranges of a few lines."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size: int) -> None:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def _field(rng: random.Random) -> str:
    kind = rng.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return f"{rng.randrange(10 ** 6)}"
    if kind == 2:
        return 'stray " quote' if rng.random() < 0.5 else "it's"
    inner = "".join(rng.choice(["a", "é", ",", "\n", '""', " ", "\n\n", "日", "x,y\n"]) for _ in range(rng.choice([0, 3, 40])))
    return f'"{inner}"'


def _csv(seed: int, rows: int) -> str:
    rng = random.Random(seed)
    return "a,b,c\n" + "".join(f"{i},{_field(rng)},{_field(rng)}\n" + ("\n" if rng.random() < 0.1 else "") for i in range(rows))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _plain(spark, path):
    return _rows(spark.read.csv(str(path), header=True, multiLine=True, escape='"', encoding="UTF-8"))


@pytest.mark.parametrize("size,rows", [(37, 8), (200, 40), (3000, 400), (1 << 20, 150)])
def test_rows_are_those_of_the_plain_reader(spark, tmp_path, small_blocks, size, rows):
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_text(_csv(k + size, rows), newline="")
    want = _plain(spark, tmp_path)
    small_blocks(size)
    assert _rows(read_split_csv(spark, str(tmp_path), ["a", "b", "c"])) == want and len(want) == 3 * rows


def test_one_record_over_many_blocks_and_no_line_feed_at_the_end(spark, tmp_path, small_blocks):
    path = tmp_path / "long.csv"
    path.write_text('"he\nader",b\n1,"' + "line\n" * 80 + '"\n2,"x\n""y"""\n3,z', newline="")
    want = _plain(spark, path)
    small_blocks(50)
    assert _rows(read_split_csv(spark, str(path), ["a", "b"])) == want and len(want) == 3


def test_carriage_returns_between_records(spark, tmp_path, small_blocks):
    path = tmp_path / "crlf.csv"
    path.write_text('a,b\r\n1,"x\ny"\r\n2,plain\r\n\r\n3,"q"\r\n', newline="")
    small_blocks(9)
    assert _rows(read_split_csv(spark, str(path), ["a", "b"])) == [("1", "x\ny"), ("2", "plain"), ("3", "q")]


def test_header_alone_and_empty_file(spark, tmp_path):
    (tmp_path / "head.csv").write_text("a,b\n")
    (tmp_path / "none.csv").write_text("")
    assert read_split_csv(spark, str(tmp_path), ["a", "b"]).isEmpty()


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f'{i},"two\nlines"\n' for i in range(20_000)), newline="")
    small_blocks(path.stat().st_size // 16)
    held = [r["count"] for r in split_records(spark, str(path)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 20_000 and sum(n > 1000 for n in held) >= 15 and max(held) < 2000


def test_first_pass_holds_no_text(spark, tmp_path, small_blocks):
    # Without any quote, a block that began inside of one would be a piece from end to end.
    from martkit.sources import split_csv
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "".join(f"{i},{'x' * 90}\n" for i in range(2000)), newline="")
    small_blocks(path.stat().st_size // 4)
    seen = [b for b in split_csv._block_effects(iter(_blocks(spark, path)))]
    assert sum(b.nbytes for b in seen) < 5_000 and sum(b.num_rows for b in seen) >= 8
    assert split_records(spark, str(path)).count() == 2000


def _blocks(spark, path):
    from martkit.sources import split_csv
    return split_csv._lines(spark, str(path)).toArrow().to_batches()
