"""Shared session and a tiny data set in which every defect is planted once."""
from __future__ import annotations

import csv
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martkit.session import local_session  # noqa: E402
from martkit.sources.csv_tables import load_all  # noqa: E402
from martkit.specs import SPECS  # noqa: E402

DAY1 = "2017-03-01 10:00:00"
DAY2 = "2017-03-02 10:00:00"

# Rows by table, in the order of the declared columns.  None is an empty field.
PLANTED = {
    "orders": [
        # delivered before it was bought
        ("o1", "c1", "delivered", DAY1, DAY1, DAY2, "2017-02-20 10:00:00", "2017-03-10 00:00:00"),
        # delivered, yet without a date
        ("o2", "c2", "delivered", DAY1, DAY1, None, None, "2017-03-10 00:00:00"),
        ("o3", "c3", "canceled", DAY1, None, None, None, "2017-03-10 00:00:00"),
        # a customer nobody knows
        ("o4", "cX", "delivered", "2017-04-01 10:00:00", "2017-04-01 11:00:00", "2017-04-02 10:00:00",
         "2017-04-05 10:00:00", "2017-04-10 00:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", DAY1, 100.0, 10.0),
        ("o1", 2, "p1", "s1", DAY1, 100.0, 10.0),
        ("o2", 1, "p2", "s1", DAY1, 0.0, 5.0),          # price of zero
        ("o4", 1, "p1", "s1", DAY1, 50.0, 60.0),        # freight above price, deadline before purchase
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 3, 200.0),
        ("o1", 2, "voucher", 1, 20.0),
        ("o2", 1, "boleto", 1, 5.0),
        ("o4", 1, "pix", 0, 110.0),                     # unknown method, no installment
    ],
    "order_reviews": [
        ("r1", "o1", 5, None, "great", DAY1, DAY2),
        ("r2", "o2", 1, None, None, DAY1, DAY2),
        ("r2", "o4", 4, "ok", None, DAY1, DAY2),        # review id used twice
    ],
    "customers": [
        ("c1", "u1", "1001", " sao paulo ", "SP"),      # lost its leading zero
        ("c2", "u1", "20000", "rio", "RJ"),
        ("c3", "u2", "30000", "bh", "MG"),              # zip without coordinates
    ],
    "products": [
        ("p1", "beleza_saude", 40, 300, 1, 500, 20, 10, 15),
        ("p2", "pc_gamer", 30, 200, 2, 0, 10, 5, 5),    # no translation, weightless
    ],
    "sellers": [("s1", "01001", "sao paulo", "SP")],
    "geolocation": [
        ("01001", -23.55, -46.63, "sao paulo", "SP"),
        ("01001", -23.55, -46.63, "sao paulo", "SP"),   # exact copy
        ("20000", -22.9, -43.2, "rio", "RJ"),
        ("20000", 40.0, -3.7, "madrid", "RJ"),          # another continent
    ],
    "category_translation": [("beleza_saude", "health_beauty")],
}


def write_tables(folder: Path, tables: dict[str, list[tuple]]) -> Path:
    for name, rows in tables.items():
        spec = SPECS[name]
        coding = "utf-8-sig" if name == "category_translation" else "utf-8"
        with open(folder / spec.file, "w", newline="", encoding=coding) as f:
            out = csv.writer(f)
            out.writerow(spec.columns)
            out.writerows([["" if v is None else v for v in r] for r in rows])
    return folder


@pytest.fixture(scope="session")
def spark():
    session = local_session("martkit-tests", cores=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory) -> Path:
    return write_tables(tmp_path_factory.mktemp("raw"), PLANTED)


@pytest.fixture(scope="session")
def loaded(spark, raw_folder, tmp_path_factory):
    return load_all(spark, str(raw_folder), typed_copy=str(tmp_path_factory.mktemp("typed")))


@pytest.fixture(scope="session")
def tables(loaded):
    return loaded[0]


@pytest.fixture(scope="session")
def sound_tables(spark, tmp_path_factory):
    """The same data with the unknown customer added, so the star can be published."""
    fixed = {**PLANTED, "customers": [*PLANTED["customers"], ("cX", "u3", "01001", "sao paulo", "SP")]}
    folder = write_tables(tmp_path_factory.mktemp("sound"), fixed)
    return load_all(spark, str(folder), typed_copy=str(tmp_path_factory.mktemp("sound_typed")))[0]
