"""Typed loading and CSV sinks."""
from __future__ import annotations

import datetime as dt

import pytest
from conftest import PLANTED, write_tables
from pyspark.sql import functions as F

from martkit.operators.checks import check_parsing
from martkit.plans.star import Star
from martkit.sources import csv_tables as io
from martkit.specs import MONEY, SPECS


def test_every_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        io.load_all(spark, str(tmp_path))
    assert all(s.file in str(error.value) for s in SPECS.values())


def test_other_file_names_and_folders_of_parts(spark, tmp_path, sound_tables):
    write_tables(tmp_path, PLANTED)
    (tmp_path / "sellers.csv").rename(tmp_path / "vendors.csv")
    io.write_csv(sound_tables["orders"], str(tmp_path / "orders_parts"), shrink_dates=False)
    tables, _ = io.load_all(spark, str(tmp_path), files={"sellers": "vendors.csv", "orders": "orders_parts"})
    assert tables["sellers"].count() == 1
    assert sorted(map(str, tables["orders"].collect())) == sorted(map(str, sound_tables["orders"].collect()))


def test_types_padding_trimming_and_bom(tables):
    for name, spec in SPECS.items():
        assert tables[name].schema == spec.schema or \
            [f.dataType for f in tables[name].schema.fields] == [f.dataType for f in spec.schema.fields]
    first = tables["customers"].where("customer_id = 'c1'").first()
    assert (first.customer_zip_code_prefix, first.customer_city) == ("01001", "sao paulo")
    assert tables["category_translation"].columns[0] == "product_category_name"
    assert tables["orders"].where("order_id = 'o1'").first().order_purchase_timestamp == dt.datetime(2017, 3, 1, 10)


def test_missing_column_is_an_error_and_extra_one_is_kept(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_city,seller_state\na,b,SP\n")
    with pytest.raises(io.SchemaError, match="seller_zip_code_prefix"):
        io.load_table(spark, SPECS["sellers"], str(tmp_path))
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state,note\na,1234567,b,SP,x\n")
    with pytest.warns(UserWarning, match="note"):
        row = io.load_table(spark, SPECS["sellers"], str(tmp_path)).first()
    assert row.note == "x" and row.seller_zip_code_prefix == "1234567"


def test_unparseable_values_become_null_and_are_counted(spark, tmp_path):
    path = tmp_path / "order_reviews.csv"
    path.write_text(
        ",".join(SPECS["order_reviews"].columns) + "\n"
        'r1,o1,4.6,,"two\nlines, ""quoted""",2017-03-01 10:00:00,01/03/2017\n'
        "r2,o2,many,NA,\tplain\t,2017-03-01 10:00:00,\n")
    text = io.read_text_table(spark, SPECS["order_reviews"], str(path))
    rows = {r.review_id: r for r in io.type_table(text, SPECS["order_reviews"]).collect()}
    assert rows["r1"].review_score == 5 and rows["r2"].review_score is None
    assert rows["r1"].review_comment_message == 'two\nlines, "quoted"'
    assert rows["r2"].review_comment_title is None and rows["r2"].review_comment_message == "plain"
    assert rows["r1"].review_answer_timestamp is None
    failures = io.parse_failures(text, SPECS["order_reviews"])
    bad = {r["column"]: r.failed for r in failures.collect() if r.failed}
    assert bad == {"review_score": 1, "review_answer_timestamp": 1}
    found = check_parsing({"order_reviews": text}, failures).collect()
    assert {r["check"] for r in found} == {f"Unparseable values: {c}" for c in bad}
    assert {r.status for r in found} == {"CRITICAL"}


def _stamps(folder):
    return {p: p.stat().st_mtime_ns for p in sorted(folder.rglob("*.parquet"))}


def test_typed_copy_is_reused_with_its_failure_counts(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_tables(raw, PLANTED)
    io.load_all(spark, str(raw), str(tmp_path / "copy"))
    before, parsed = _stamps(tmp_path / "copy"), []
    monkeypatch.setattr(io, "read_text_table", lambda *args: parsed.append(args[1].name))
    tables, failures = io.load_all(spark, str(raw), str(tmp_path / "copy"), reuse=True)
    assert tables["orders"].count() == 4 and failures.where("failed > 0").count() == 0
    assert not parsed and _stamps(tmp_path / "copy") == before


def test_changed_raw_files_are_never_served_from_the_copy(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_tables(raw, PLANTED)
    io.load_all(spark, str(raw), str(tmp_path / "copy"))
    path, parsed, plain = raw / SPECS["sellers"].file, [], io.read_text_table
    monkeypatch.setattr(io, "read_text_table", lambda *args: parsed.append(args[1].name) or plain(*args))

    def load():
        parsed.clear()
        return io.load_all(spark, str(raw), str(tmp_path / "copy"), reuse=True)[0]["sellers"].first().seller_city
    old = load()
    # Same length, other content.
    path.write_text(path.read_text().replace("sao paulo", "sao pablo"))
    assert (old, load(), parsed) == ("sao paulo", "sao pablo", ["sellers"])
    # Touched only: the content decides.
    path.touch()
    assert (load(), parsed) == ("sao pablo", [])
    with path.open("a") as f:
        f.write("s9,01001,rio,RJ\n")
    assert load() and parsed == ["sellers"]


def test_whole_numbers_are_exact(spark):
    from martkit.specs import TableSpec
    from pyspark.sql import types as T
    spec = TableSpec("t", "t.csv", T.StructType([T.StructField("n", T.LongType())]))
    texts = {"9007199254740993": 9007199254740993, "-9223372036854775808": -(1 << 63), "9223372036854775808": None, "2.5": 2, "3.5": 4, "-2.5": -2, "1e3": 1000,
             "0.49": 0, "inf": None, "4.0": 4, " 7": None, "7d": None}
    rows = io.type_table(spark.createDataFrame([(k,) for k in texts], "n string"), spec)
    assert [r.n for r in rows.collect()] == list(texts.values())


def test_large_files_take_the_split_scan(spark, tmp_path, monkeypatch):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "".join(f's{i},1001,"sao\npaulo",SP\n' for i in range(500)))
    want = sorted(map(tuple, io.load_table(spark, SPECS["sellers"], str(tmp_path)).collect()))
    calls, plain = [], io.read_split_csv
    monkeypatch.setattr(io, "read_split_csv", lambda *args: calls.append(1) or plain(*args))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert sorted(map(tuple, io.load_table(spark, SPECS["sellers"], str(tmp_path)).collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert calls == [1] and len(want) == 500


def test_csv_sink_shrinks_midnights_and_reads_back(spark, sound_tables, tmp_path):
    star = Star(sound_tables)
    for name in ("fact_orders", "dim_customer", "dim_product"):
        df = star.table(name)
        io.write_csv(df, str(tmp_path / name))
        again = io.read_star_csv(spark, str(tmp_path / name), io.star_schema(name))
        assert again.count() == df.count()
        for c in ("items_price", "lifetime_revenue"):
            if c in again.columns:
                assert again.schema[c].dataType == MONEY
                assert again.agg(F.sum(c)).first()[0] == df.agg(F.sum(c)).first()[0]
    written = "".join(p.read_text() for p in (tmp_path / "fact_orders").glob("*.csv"))
    assert "2017-03-10," in written and "2017-03-10 00:00:00" not in written
    facts = io.read_star_csv(spark, str(tmp_path / "fact_orders"), io.star_schema("fact_orders"))
    o4 = facts.where("order_id = 'o4'").first()
    assert o4.is_delivered is True and o4.delivery_days == 4.0 and o4.order_purchase_timestamp.hour == 10
    assert o4.order_estimated_delivery_date == dt.datetime(2017, 4, 10)
    assert facts.where("order_id = 'o3'").first().is_late is None


def test_compressed_export_reads_back_the_same(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS product_id", "IF(id % 3 = 0, NULL, concat('a \"', id, '\", b')) AS category")
    io.write_csv(df.repartition(3), str(tmp_path / "p"), compression="gzip")
    assert {p.name[-7:] for p in (tmp_path / "p").glob("part-*")} == {".csv.gz"}
    back = io.read_star_csv(spark, str(tmp_path / "p"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_items_travel_without_what_follows_from_them(spark):
    """Only the raw columns of items are shuffled to their orders."""
    from martkit.plans.star import Star
    from martkit.sources.carriers import raw_tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = Star(raw_tables(spark, "/root/testdata/sf0.001")).fact_order_items()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    first = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("freight_share" in line for line in lines[:first]) and not any("freight_share" in line for line in lines[first:])
