"""Publishing a star: refused and interrupted runs leave the star before them as it was."""
from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from martkit.operators import cleaning
from martkit.plans.batch import open_star, write_star
from martkit.plans.integrity import IntegrityError, data_dictionary
from martkit.plans.operator_queries import io_csv_typed
from martkit.plans.star import Star
from martkit.sources.generations import Generations

SMALL = "/root/testdata/sf0.001"


def _content(star):
    return {t: sorted(map(str, star.table(t).collect())) for t in ("fact_orders", "dim_customer", "dim_date")}


def test_refused_star_leaves_the_published_one(spark, tables, sound_tables, tmp_path):
    folder = str(tmp_path / "star")
    with pytest.raises(FileNotFoundError):
        open_star(spark, folder)
    write_star(spark, sound_tables, folder)
    before = _content(open_star(spark, folder))
    with pytest.raises(IntegrityError, match="orphans"):
        write_star(spark, tables, folder)
    assert _content(open_star(spark, folder)) == before
    products = sound_tables["products"]
    dead = sound_tables | {"products": products.withColumn("product_weight_g", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        write_star(spark, dead, folder)
    assert _content(open_star(spark, folder)) == before
    fewer = sound_tables | {t: sound_tables[t].where("order_id <> 'o1'") for t in ("orders", "order_items", "order_payments", "order_reviews")}
    write_star(spark, fewer, folder)
    after = _content(open_star(spark, folder))
    assert 0 < len(after["fact_orders"]) < len(before["fact_orders"])


@pytest.mark.parametrize("build", [lambda spark, raw, folder: write_star(spark, raw, folder), lambda spark, raw, folder: data_dictionary(Star(raw)).collect()])
def test_places_are_found_once_for_customers_and_sellers(spark, sound_tables, tmp_path, monkeypatch, build):
    calls, plain = [], cleaning.clean_geolocation
    monkeypatch.setattr(cleaning, "clean_geolocation", lambda geo: calls.append(1) or plain(geo))
    build(spark, sound_tables, str(tmp_path / "star"))
    assert len(calls) == 1


def test_other_tables_are_written_side_by_side(spark, sound_tables, tmp_path, monkeypatch):
    """Two tables wait for each other while they are built: one by one, neither would come."""
    both, plain = threading.Barrier(2, timeout=60), Star.table

    def table(self, name, *columns):
        if name in ("fact_order_items", "dim_product"):
            both.wait()
        return plain(self, name, *columns)
    monkeypatch.setattr(Star, "table", table)
    star = write_star(spark, sound_tables, str(tmp_path / "star"))
    assert star.table("fact_order_items").count() == sound_tables["order_items"].count()


def test_times_keep_their_fractions(spark):
    whole = {r.event_id: r.ts for r in spark.read.parquet(f"{SMALL}/events.parquet").collect()}
    assert {r.event_id: r.moment for r in io_csv_typed(spark, SMALL).collect()} == whole


def test_the_pointer_written_last_counts_whatever_the_clocks_say(spark, tmp_path):
    states = Generations(spark, str(tmp_path / "published"), "run string")
    assert states.latest() == []
    for run in ("b", "a"):
        states.publish([(run,)])
    broken = tmp_path / "published" / "000000000009-x"
    broken.mkdir()
    (broken / "part-0.json").write_text('{"run": "lost"}')
    assert [r.run for r in states.latest()] == ["a"]
    states.publish([("c",)])
    assert [r.run for r in states.latest()] == ["c"]
