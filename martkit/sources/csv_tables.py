"""Typed CSV sources and sinks."""
from __future__ import annotations

import uuid
import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import specs
from ..functions import strip_space, zero_pad
from ..plans.star import STAR_COLUMNS
from ..session import stored
from .generations import Generations
from .split_csv import read_split_csv

# Spellings read as missing, beside the empty string.
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Fixed value: the one accepted time format.
_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
# The same with a fraction, for tables that ask for it.
_TIME_FRACTION = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


# A decimal number: Spark would also take a trailing d or f as a sign of the type.
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity)$"


class SchemaError(ValueError):
    """A raw file lacks declared columns."""


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of a file, or of the files in a folder, as Spark reads it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    shown = [f for f in found if not f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]
    return sorted((str(f.getPath().toString()), int(f.getLen()), int(f.getModificationTime())) for f in shown)


def _typed(c: Column, kind: T.DataType, fractions: bool = False) -> Column:
    """The declared type, or NULL where the text does not parse."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.TimestampNTZType):
        return F.when(c.rlike(_TIME_FRACTION if fractions else _TIME), c.try_cast(kind))
    if isinstance(kind, T.NumericType):
        c = F.when(c.rlike(_NUMBER), c)
    if isinstance(kind, T.IntegralType):
        # Through a decimal: a double has no room for whole numbers above 2 ** 53.
        return F.bround(c.try_cast("decimal(38,18)"), 0).try_cast(kind)
    return c.try_cast(kind)


def read_text_table(spark: SparkSession, spec: specs.TableSpec, path: str) -> DataFrame:
    """All columns as trimmed text, declared ones present, missing tokens NULL, zips padded.

    A quoted value may hold line breaks.  Files of more than one byte range are cut into records by many tasks
    (``split_csv``); of smaller ones each is a task of its own anyway, and Spark's reader takes them whole.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    if max((size for _, size, _ in _files(spark, path)), default=0) > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        raw = read_split_csv(spark, path, raw.columns)
    raw = raw.toDF(*[c.strip().lstrip("﻿") for c in raw.columns])
    absent = [c for c in spec.columns if c not in raw.columns]
    if absent:
        raise SchemaError(f"{spec.file}: missing columns {sorted(absent)}")
    extra = [c for c in raw.columns if c not in spec.columns]
    if extra:
        warnings.warn(f"{spec.file}: unexpected extra columns {sorted(extra)} (kept)", stacklevel=2)

    def text(name: str) -> Column:
        read = F.col(f"`{name}`")
        c = strip_space(F.when(~read.isin(*MISSING_TOKENS), read))
        return (zero_pad(c) if name in spec.zip_columns else c).alias(name)

    return raw.select(*[text(c) for c in [*spec.columns, *extra]])


def type_table(text: DataFrame, spec: specs.TableSpec, fractions: bool = False) -> DataFrame:
    """Declared types; with ``fractions`` a time may have a fraction of a second."""
    kinds = {f.name: f.dataType for f in spec.schema.fields}
    return text.select(*[_typed(F.col(c), kinds.get(c, T.StringType()), fractions).alias(c) for c in text.columns])


def _failed(spec: specs.TableSpec) -> list[Column]:
    """Rows, and per typed column the values that are present but did not parse."""
    return [F.count("*").alias("rows"), *[
        F.count_if(F.col(f.name).isNotNull() & _typed(F.col(f.name), f.dataType).isNull()).alias(f.name)
        for f in spec.schema.fields if not isinstance(f.dataType, T.StringType)]]


def write_typed(text: DataFrame, spec: specs.TableSpec, path: str) -> DataFrame:
    """Write the typed rows; the parse failures are observed on the way, so the text is read and parsed once."""
    seen = Observation(f"parsing {spec.name}")
    type_table(text.observe(seen, *_failed(spec)), spec).write.parquet(path)
    found = seen.get
    rows = [(spec.name, c, n, found["rows"]) for c, n in found.items() if c != "rows"] or [(spec.name, "", 0, found["rows"])]
    return text.sparkSession.createDataFrame(rows, "`table` string, `column` string, failed long, rows long")


def parse_failures(text: DataFrame, spec: specs.TableSpec) -> DataFrame:
    """table, column, failed, rows: values that are present but did not parse, from one aggregate."""
    typed = [f for f in spec.schema.fields if not isinstance(f.dataType, T.StringType)]
    if not typed:
        return text.agg(F.count("*").alias("rows")).select(
            F.lit(spec.name).alias("table"), F.lit("").alias("column"), F.lit(0).cast("long").alias("failed"), "rows")
    one = text.agg(*_failed(spec))
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("failed")) for f in typed])
    return one.select("rows", F.explode(pairs).alias("p")).select(
        F.lit(spec.name).alias("table"), "p.column", "p.failed", "rows")


def load_table(spark: SparkSession, spec: specs.TableSpec, folder: str, file: str | None = None) -> DataFrame:
    return type_table(read_text_table(spark, spec, f"{folder}/{file or spec.file}"), spec)


# ---------------------------------------------------------------- typed copy

def _digest(spark: SparkSession, paths: list[str]) -> str:
    """What the files hold, whatever the order of their lines: a scan of the text, nothing is parsed."""
    h = F.xxhash64("value")
    row = spark.read.option("lineSep", "\n").text(paths).agg(
        F.count("*"), F.coalesce(F.bit_xor(h), F.lit(0)), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0))).first()
    return "-".join(str(v) for v in row)


class _Manifest:
    """Which raw files each table of a typed copy was made of, and where it lies."""

    def __init__(self, spark: SparkSession, copy: str):
        self.spark, self.states = spark, Generations(spark, f"{copy}/manifest", _MANIFEST)
        self.tables = {r["table"]: r for r in self.states.latest()}

    def unchanged(self, table: str, files: list[tuple[str, int, int]]) -> bool:
        """Same files of same length, with the same time or, if they were touched, the same content."""
        known = self.tables.get(table)
        if known is None or [(f.path, f.length) for f in known.files] != [f[:2] for f in files]:
            return False
        return [f.time for f in known.files] == [f[2] for f in files] or known.digest == _digest(self.spark, [f[0] for f in files])


_MANIFEST = "`table` string, folder string, digest string, files array<struct<path: string, length: long, time: long>>"


def load_all(spark: SparkSession, folder: str, typed_copy: str | None = None, reuse: bool = False,
             files: Mapping[str, str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, parse failures) of a folder of CSV files; fails at once naming every missing file.

    ``files`` gives a table another file name than its spec; a name may also be a folder of part files.

    With ``typed_copy`` the tables and the failure counts are also written as Parquet and read back, so later steps
    do not parse again.  ``reuse`` takes from an existing copy the tables whose raw files have not changed since, and
    parses the others only.
    """
    copy = typed_copy.rstrip("/") if typed_copy else None
    names = {n: (files or {}).get(n, s.file) for n, s in specs.SPECS.items()}
    absent = [f for f in names.values() if not _exists(spark, f"{folder}/{f}")]
    if absent:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(absent)}. Download the dataset first.")

    def text(n: str) -> DataFrame:
        return read_text_table(spark, specs.SPECS[n], f"{folder}/{names[n]}")
    if not copy:
        texts = {n: text(n) for n in specs.SPECS}
        return {n: type_table(t, specs.SPECS[n]) for n, t in texts.items()}, \
            reduce(DataFrame.unionByName, [parse_failures(t, specs.SPECS[n]) for n, t in texts.items()])
    manifest, rows = _Manifest(spark, copy), []
    for n in specs.SPECS:
        raw = _files(spark, f"{folder}/{names[n]}")
        if reuse and manifest.unchanged(n, raw):
            known = manifest.tables[n]
            rows.append((n, known.folder, known.digest, raw))
            continue
        place = f"{copy}/{n}-{uuid.uuid4().hex}"
        write_typed(text(n), specs.SPECS[n], f"{place}/rows").coalesce(1).write.parquet(f"{place}/failures")
        rows.append((n, place, _digest(spark, [f[0] for f in raw]), raw))
    if any(n not in manifest.tables or (place, raw) != (manifest.tables[n].folder, [tuple(f) for f in manifest.tables[n].files]) for n, place, _, raw in rows):
        manifest.states.publish(rows)
    return {n: spark.read.parquet(f"{place}/rows") for n, place, *_ in rows}, \
        spark.read.parquet(*[f"{place}/failures" for _, place, *_ in rows])


# ---------------------------------------------------------------- sinks

def whole_days(df: DataFrame) -> DataFrame:
    """One row: per timestamp column, whether all of its values are midnights."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    return df.agg(*[F.coalesce(F.bool_and(F.date_trunc("day", F.col(c)) == F.col(c)), F.lit(True)).alias(c)
                    for c in stamps]) if stamps else df.limit(0).select()


def write_csv(df: DataFrame, path: str, shrink_dates: bool = True, fractions: bool = False, compression: str = "none") -> None:
    """CSV with a header, ISO dates and empty NULLs; a timestamp column of midnights is written as dates.

    Times are written to the second, or with ``fractions`` to the microsecond.  With a ``compression`` each part file is
    compressed as a whole, so a later task reads what one task wrote.

    Each task writes its own part file; nothing is gathered.  To learn which columns hold midnights, the rows are computed
    once and kept as Parquet in the shared folder; both looks at them read that.
    """
    if shrink_dates and whole_days(df).columns:
        df = stored(df, "rows")
        flags = whole_days(df).first().asDict()
        df = df.withColumns({c: F.to_date(c) for c, midnight in flags.items() if midnight})
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS" if fractions else "yyyy-MM-dd HH:mm:ss"
    df.write.mode("overwrite").option("timestampNTZFormat", stamp).csv(
        path, header=True, dateFormat="yyyy-MM-dd", escape='"', timestampFormat=stamp, emptyValue="",
        nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression)


# ---------------------------------------------------------------- typed re-read of exported star tables

_MONEY_COLUMNS = set("price freight_value item_total items_price freight_total order_value payment_total "
                     "lifetime_revenue".split())
_WHOLE = set("year iso_week date_key order_item_id customer_order_seq items_count products_count sellers_count "
             "payment_methods max_installments installment_bucket_order delay_days delivery_bucket_order review_score "
             "review_count lifetime_orders product_weight_g product_length_cm product_height_cm product_width_cm "
             "product_photos_qty product_name_length product_description_length month_num year_month_num "
             "day_of_week_num".split())
_FRACTION = set("approval_hours carrier_lead_days last_mile_days delivery_days promised_days review_response_hours "
                "freight_share lat lng product_volume_cm3".split())
_DAY = {"purchase_date", "first_purchase_date", "last_purchase_date", "date", "month_start"}
_INSTANT = {"order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date", "shipping_limit_date"}


def star_type(column: str) -> T.DataType:
    """Declared type of a star column on re-read: money as fixed decimal, counts whole, flags logical."""
    if column in _MONEY_COLUMNS:
        return specs.MONEY
    if column in _WHOLE:
        return T.LongType()
    if column in _FRACTION:
        return T.DoubleType()
    if column in _DAY:
        return T.DateType()
    if column in _INSTANT:
        return T.TimestampNTZType()
    if column.startswith(("is_", "has_", "flag_")) or column in ("used_voucher", "freight_gt_price"):
        return T.BooleanType()
    return T.StringType()


def star_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, star_type(c)) for c in STAR_COLUMNS[table]])


def read_star_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Exported CSV with declared types; an empty field is NULL and the locale plays no part."""
    return spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss]").csv(
        path, header=True, escape='"', nullValue="", emptyValue="", dateFormat="yyyy-MM-dd", locale="en-US")


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
