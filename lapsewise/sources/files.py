"""Scans of the raw inputs with explicit schemas (never inferred)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import schemas
from lapsewise.functions.text import py_strip

# Spellings pandas' CSV reader treats as missing by default.
NA_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_file``, ``_split`` and ``_pos``: the physical order of rows.

    Must be applied directly on a file scan, before any shuffle.  Within a
    file, (``_split``, ``_pos``) increases with the row's position: the split
    start orders the splits of one file and ``monotonically_increasing_id``
    orders rows within a split.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail before any write when a required input is missing."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        if not jp.getFileSystem(conf).globStatus(jp):
            missing.append(p)
    if missing:
        raise FileNotFoundError(f"required input missing: {', '.join(missing)}")


def _na_to_null(c: str) -> F.Column:
    v = py_strip(F.col(c))
    return F.when(v.isin(*NA_SPELLINGS), F.lit(None)).otherwise(F.col(c))


def read_named_csv(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """CSV files with a header -> ``columns`` by *name*, whatever their order.

    Doubled quotes inside a quoted field are one quote; the NA spellings are
    NULL in every column.  All files under ``path`` must share one header: a file
    with another one raises instead of being read by position.  ``multi_line``
    admits line breaks inside quoted fields; such files cannot be split, so one file
    is one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
    )
    df = reader.csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    df = with_file_order(df)
    return df.select(*[_na_to_null(c).alias(c) for c in columns], "_file", "_split", "_pos")


def read_clients_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Client file with header -> typed rows plus physical order columns.

    Unparseable ids or incomes raise (ANSI casts), as a typed insert would.
    """
    raw = read_named_csv(spark, path, schemas.RAW_CLIENTS_CSV.fieldNames(), multi_line)
    return raw.select(
        F.col("client_id").cast("long").alias("client_id"),
        F.col("name"),
        F.col("income").cast(schemas.MONEY_12_2).alias("income"),
        F.col("province"),
        "_file",
        "_split",
        "_pos",
    )


def read_products_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Cleaned product CSV (header) with physical order columns."""
    return read_named_csv(spark, path, schemas.PRODUCTS_CSV.fieldNames(), multi_line)


def read_lapses_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Lapse events; ``lapse_date`` may be stored as text, date or timestamp."""
    df = spark.read.parquet(path)
    return with_file_order(df)
