"""Awkward documents, and answers found the plain way."""
from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Names the operators use for columns of their own.
EXTRA = ("body", "row", "key", "fp", "h", "id", "sha", "digest", "size", "cell", "place", "w", "doc", "y", "fold", "stats", "score",
         "keep_id", "group_size", "label_id", "item_id", "leader", "__key", "evidence", "kept")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    prose = [" ".join(rng.choice("red green blue one two three four five six seven".split()) + str(rng.randrange(50)) for _ in range(80)) for _ in range(12)]
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]
    rows += [(100, prose[0], "en", "s0", 1), (101, prose[0], None, None, None), (100, prose[0], "en", "s0", 1)]      # copies; one row twice
    rows += [(None, prose[1], "en", None, 3), (None, None, None, None, None), (102, None, "en", "s1", 0), (103, "", "en", "s1", 0)]
    rows += [(104, " \n\t ", "de", "s2", 3), (105, "one", "de", "s2", 3), (106, long, "fr", "s2", len(long)), (107, "é ß \U0001F600 x", "fr", "s2", 7)]
    return rows


def awkward(spark: SparkSession, extra: bool = True) -> DataFrame:
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    return df.select("*", *[F.lit(f"x{c}").alias(c) for c in EXTRA]) if extra else df


def empty(spark: SparkSession, schema: str = SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)
