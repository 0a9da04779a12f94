"""The whole batch: load, check, clean, build, verify, publish."""
from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators.calendar import monthly_orders
from ..operators.checks import AT_ONCE, run_checks, summarize, with_position
from ..operators.cleaning import cleaning_log
from ..sources.generations import Generations
from .integrity import assert_star
from .star import STAR_COLUMNS, Star, StoredStar


class _FactsStored(Star):
    """Raw tables for the dimensions, and an order fact that is already on disk."""

    def __init__(self, raw: Mapping[str, DataFrame], facts: DataFrame):
        super().__init__(raw)
        self._facts = facts

    def fact_orders(self, *columns: str) -> DataFrame:
        return self._facts.select(*columns) if columns else self._facts


def write_star(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> StoredStar:
    """Write the star as Parquet, in a folder of its own under ``folder``; it is published only once its checks pass.

    ``fact_orders`` is computed once and read back for the items' order context and the customers' lifetime figures.
    A pointer to the run is written last and publishes the star in one step.  A star that fails, or a run that dies, leaves
    the star published before readable and unchanged.
    """
    own = f"run-{uuid.uuid4().hex}"
    run = f"{folder.rstrip('/')}/{own}"

    def put(name: str, df: DataFrame, sort: str | None = None) -> None:
        # Sorting inside files gives row groups narrow date ranges, so date filters skip them.
        (df.sortWithinPartitions(sort) if sort else df).write.parquet(f"{run}/{name}")

    put("fact_orders", Star(raw).fact_orders(), "order_purchase_timestamp")
    stored = _FactsStored(raw, spark.read.parquet(f"{run}/fact_orders"))
    # The other tables need nothing of each other, and the dimensions have stages of few tasks.
    with ThreadPoolExecutor(AT_ONCE) as pool:
        carried = inheritable_thread_target(spark)
        others = [name for name in STAR_COLUMNS if name != "fact_orders"]
        waiting = [pool.submit(carried(lambda name: put(name, stored.table(name), "purchase_date" if name == "fact_order_items" else None)), name)
                   for name in others]
        for part in waiting:
            part.result()
    star = StoredStar(spark, run)
    put("integrity", assert_star(star, raw))
    _pointer(spark, folder).publish([(own,)])
    return star


def _pointer(spark: SparkSession, folder: str) -> Generations:
    return Generations(spark, f"{folder.rstrip('/')}/published", "run string")


def open_star(spark: SparkSession, folder: str) -> StoredStar:
    """The star published last.  Runs whose checks did not pass, or that died, are not pointed to."""
    found = _pointer(spark, folder).latest()
    if not found:
        raise FileNotFoundError(f"no published star in {folder}")
    return StoredStar(spark, f"{folder.rstrip('/')}/{found[0].run}")


def write_report(df: DataFrame, path: str) -> None:
    """A small table (check results, cleaning log) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)


def run_batch(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str,
              failures: DataFrame | None = None) -> dict[str, DataFrame]:
    """Check results, cleaning log and star, all written under ``folder``."""
    folder = folder.rstrip("/")
    results = {"data_quality_checks": with_position(run_checks(raw, failures)), "cleaning_log": cleaning_log(raw)}
    for name, df in results.items():
        write_report(df, f"{folder}/{name}")
    results["data_quality_summary"] = summarize(results["data_quality_checks"], monthly_orders(raw["orders"]))
    star = write_star(spark, raw, f"{folder}/star")
    return {**results, **{name: star.table(name) for name in STAR_COLUMNS}}
