"""Sheet sources by file name."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from glossweave.operators.sheet import as_sheet
from glossweave.sources.sqlite import read_sqlite
from glossweave.sources.xlsx import read_xlsx

#: Suffixes of the formats.
SHEETS, DATABASES, TABLES = (".xlsx", ".xls"), (".sqlite3", ".sqlite", ".db"), (".parquet",)


def load_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet of a spreadsheet, database or parquet table; ValueError if it is missing or of another kind."""
    if not os.path.exists(path):
        raise ValueError(f"no such file: {path}")
    suffix = os.path.splitext(path)[1].lower()
    if suffix in SHEETS:
        return read_xlsx(spark, path)
    if suffix in DATABASES:
        return read_sqlite(spark, path)
    if suffix in TABLES:
        rows = spark.read.parquet(path)
        return as_sheet(rows, "_ord" if "_ord" in rows.columns else rows.columns[0])
    raise ValueError(f"unknown format: {path}")
