"""Text folding and number parsing against Python's Unicode tables."""
from __future__ import annotations

import re
import unicodedata

from pyspark.sql import functions as F, types as T

from martkit.functions import fold_city, strip_space
from martkit.sources.csv_tables import _typed


def _folded(s: str) -> str:
    plain = unicodedata.normalize("NFKD", s.lower().strip()).encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", plain)


def test_fold_city_over_all_characters(spark):
    chars = [c for c in map(chr, range(1, 0x20000)) if unicodedata.category(c) not in ("Cs", "Cn", "Co")]
    rows = [(i, f"x{c}y") for i, c in enumerate(chars)]
    got = {r.id: r.s for r in spark.createDataFrame(rows, "id int, s string").select("id", fold_city(F.col("s")).alias("s")).collect()}
    wrong = [(f"U+{ord(c):04X}", got[i], _folded(f"x{c}y")) for i, c in enumerate(chars) if got[i] != _folded(f"x{c}y")]
    assert wrong == []


def test_fold_city_of_names(spark):
    cases = ["  São   Paulo ", "BRASÍLIA", "ǎ", "Ẽ ơ", "ﬁm", "10²", " Nova Iguaçu ", "", "½ km", "Straße", "éclair", "ﬁ²ﬂ"]
    got = spark.createDataFrame([(c,) for c in cases], "s string").select("s", fold_city(F.col("s")).alias("f")).collect()
    assert {r.s: r.f for r in got} == {c: _folded(c) for c in cases}


def test_white_space_of_any_kind_is_stripped(spark):
    blanks = [c for c in map(chr, range(1, 0x10000)) if c.isspace() and not 0x1c <= ord(c) <= 0x1f]
    rows = [(f"{c}a{c}b{c}",) for c in blanks]
    got = [r.s for r in spark.createDataFrame(rows, "s string").select(strip_space(F.col("s")).alias("s")).collect()]
    assert got == [s.strip() for s, in rows]


def test_numbers_are_plain_decimals(spark):
    cases = {"12d": None, "1f": None, "1.5": 1.5, "-3": -3.0, ".5": .5, "5.": 5.0, "1e3": 1000.0, "1E-2": .01, "0x10": None, "1_0": None, "": None,
             "1,5": None, "12L": None, "+7": 7.0, "e5": None, ".": None, "1 2": None}
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", _typed(F.col("s"), T.DoubleType()).alias("d"), _typed(F.col("s"), T.LongType()).alias("n")).collect()
    assert {r.s: r.d for r in rows} == cases
    assert {r.s: r.n for r in rows} == {k: None if v is None else round(v) for k, v in cases.items()}
