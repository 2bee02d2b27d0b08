"""A table of a SQLite file as a Python data source; row-id ranges are its partitions.

Equality and IN on LANGUAGE and equality on IEVREF are pushed into the query where the
session allows it (``spark.sql.python.filterPushdown.enabled``).
"""

from __future__ import annotations

import sqlite3

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from glossweave.operators.sheet import COLUMNS

ROWS_PER_PARTITION = 50_000
_PUSHED = ("IEVREF", "LANGUAGE")


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str):
        if not table.replace("_", "").isalnum():
            raise ValueError(f"no table name: {table}")
        self.path, self.table, self.where, self.values = path, table, [], []

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [_Range(0, 0)]
        return [_Range(a, a + ROWS_PER_PARTITION) for a in range(low, high + 1, ROWS_PER_PARTITION)]

    def read(self, partition):
        low, high = partition.value
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            have = {r[1].upper(): r[1] for r in db.execute(f'PRAGMA table_info("{self.table}")')}
            cells = ", ".join(f'CAST("{have[c]}" AS TEXT)' if c in have else "NULL" for c in COLUMNS)
            more = "".join(f" AND {w}" for w in self.where)
            yield from db.execute(f'SELECT rowid, {cells} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?{more}', (low, high, *self.values))


class PushingSqliteReader(SqliteReader):
    """With filters; Spark refuses a reader that has ``pushFilters`` while its setting is off."""

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in _PUSHED and isinstance(f, EqualTo) and f.value is not None:
                self.where.append(f'"{column}" = ?')
                self.values.append(f.value)
            elif column in _PUSHED and isinstance(f, In):
                self.where.append(f'"{column}" IN ({", ".join("?" * len(f.value))})')
                self.values += f.value
            else:
                yield f


class SqliteSource(DataSource):
    @classmethod
    def name(cls):
        return "sheet_sqlite"

    def schema(self):
        return StructType([StructField("_ord", LongType()), *[StructField(c, StringType()) for c in COLUMNS]])

    def reader(self, schema):
        kind = PushingSqliteReader if self.options.get("pushdown") == "true" else SqliteReader
        return kind(self.options["path"], self.options.get("table", "concepts"))


def pushdown(spark: SparkSession) -> str:
    """Whether the session lets Python sources take filters."""
    return spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()


def read_sqlite(spark: SparkSession, path: str, table: str = "concepts"):
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sheet_sqlite").option("table", table).option("pushdown", pushdown(spark)).load(path)
