"""SQLite exports as a Python data source: tables are read in ranges of row numbers."""

from __future__ import annotations

import sqlite3
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..shipping import ship_package

ROWS_PER_PARTITION = 100_000


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _columns(path: str, table: str) -> list[str]:
    with sqlite3.connect(f"file:{_local(path)}?mode=ro", uri=True) as connection:
        return [r[1] for r in connection.execute(f"PRAGMA table_info({_quoted(table)})")]


class Range(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str]):
        self.path, self.table, self.columns = path, table, columns

    def partitions(self) -> Sequence[InputPartition]:
        with sqlite3.connect(f"file:{_local(self.path)}?mode=ro", uri=True) as connection:
            low, high = connection.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return [Range(0, -1)]
        return [Range(k, k + ROWS_PER_PARTITION - 1) for k in range(low, high + 1, ROWS_PER_PARTITION)]

    def read(self, partition: Range):
        names = ", ".join(map(_quoted, self.columns))
        with sqlite3.connect(f"file:{_local(self.path)}?mode=ro", uri=True) as connection:
            query = f"SELECT rowid, {names} FROM {_quoted(self.table)} WHERE rowid BETWEEN ? AND ? ORDER BY rowid"
            for row in connection.execute(query, (partition.first, partition.last)):
                yield (row[0], *("" if v is None else str(v) for v in row[1:]))


class SqliteTable(DataSource):
    """Options: ``path`` of a file that all executors can open, and ``table``."""

    @classmethod
    def name(cls) -> str:
        return "schedule_sqlite"

    def schema(self) -> StructType:
        names = _columns(self.options["path"], self.options["table"])
        return StructType([StructField("ord", LongType()), *[StructField(c, StringType()) for c in names]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(self.options["path"], self.options["table"], schema.fieldNames()[1:])


def list_sqlite_tables(path: str) -> list[str]:
    with sqlite3.connect(f"file:{_local(path)}?mode=ro", uri=True) as connection:
        return [r[0] for r in connection.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def load_sqlite_tables(spark: SparkSession, path: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """The tables as strings (NULL becomes blank) with ``ord``; absent ones are empty."""
    ship_package(spark)
    spark.dataSource.register(SqliteTable)
    have, out = set(list_sqlite_tables(path)), {}
    for name in tables:
        if name in have:
            out[name] = spark.read.format("schedule_sqlite").option("path", path).option("table", name).load().withColumn("source_file", F.lit(path))
        else:
            out[name] = spark.createDataFrame([], "ord long, source_file string")
    return out
