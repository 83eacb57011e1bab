"""Shared plumbing: tables, the shared scratch folder, small literal tables, row numbers, joins."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A-Z lower-cased, other ASCII except 0-9 and a-z turned into a blank, bytes from 0x80 kept.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.  Where the session names none, a local one is set for a local
    master (tests); on a cluster that is an error, since its machines share no local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='driftlens-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: the lineage ends there,
    and what follows sees the same rows whichever executor is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed_at = path
    if _scopes:
        _scopes[-1].append(out)
    return out


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``stash`` writes inside are deleted at the end, but those that ``kept`` was called for."""
    _scopes.append([])
    try:
        yield
    finally:
        unstash(*_scopes.pop())


def kept(df: DataFrame) -> DataFrame:
    """``df``, a table made by ``stash`` in the innermost ``scratch``, which outlives it."""
    if _scopes:
        _scopes[-1][:] = [x for x in _scopes[-1] if x is not df]
    return df


def unstash(*tables: DataFrame) -> None:
    """Delete tables made by ``stash`` that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stashed_at", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def literal_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A small driver-side table as one literal in the plan (no Python rows travel to executors)."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schema))))


def broadcast_value(spark: SparkSession, value):
    context: SparkContext = spark.sparkContext
    return context.broadcast(value)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _reads_parquet_alone(df: DataFrame) -> bool:
    """Whether ``df`` only reads Parquet files, picks columns and filters."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and node.toString().strip().endswith(" parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a column of unique row numbers that stay what they are, and its name.  Rows read from
    Parquet files are numbered by their place: the file's number and the row's in it.  Anything else is
    written first; numbers given to rows as they are read would follow the executors at hand."""
    name = fresh_name(df, "__row")
    if not _reads_parquet_alone(df):
        return stash(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
    file = fresh_name(df, "__file")
    number = fresh_name(df, "__number")
    placed = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(name))
    files = placed.select(file).distinct().withColumn(number, F.row_number().over(Window.orderBy(file)) - 1)  # one row a file
    placed = join_few(placed, stash(files, "files"), file)
    placed = placed.withColumn(name, F.shiftleft(F.col(number).cast("long"), 40).bitwiseOR(F.col(name)))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], name), name


#: Keys of 8 bytes up to this number are broadcast; beyond it they are joined.  For tables that don't grow with the corpus.
BROADCAST_KEYS = 1_000_000
#: The same for tables that grow with the corpus: the driver builds some 80 bytes a row, several tables at a time.
CORPUS_KEYS = 1 << 16
#: Numbers that a row of ``key_maps`` covers (a power of two, 2^15 at most), and rows of it that are broadcast (1 kB each).
MAP_BITS, MAP_ROWS = 1 << 13, 8192
#: Parts that a key's rows are dealt to where they are joined with a table that holds each key once.
SALTS = 32


def join_few(df: DataFrame, small: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``df`` joined with ``small``, a written table that holds few rows of each ``key``.  It is broadcast up to a
    counted size (``most``, else BROADCAST_KEYS); beyond that its rows are repeated, so that a key's many rows in
    ``df`` are spread."""
    if small.count() <= (BROADCAST_KEYS if most is None else most):
        return df.join(F.broadcast(small), key)
    salt = fresh_name(df, "__salt")
    spread = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = [F.col(f"`{c}`") for c in df.columns if c != key]
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(*(rest or [F.col(key)])), F.lit(SALTS)).cast("int"))
    return dealt.join(spread.hint("merge"), [key, salt]).drop(salt)  # Spark takes it for as small as it was, and would broadcast it


def _block_of(key: str) -> Column:
    return F.shiftright(key, MAP_BITS.bit_length() - 1)


def key_maps(keys: DataFrame, key: str, block: str, bits: str) -> DataFrame:
    """The long numbers ``key`` as bit maps, a row for each MAP_BITS numbers in a row that hold any, written as a
    table.  Row numbers lie close together, so it takes about a bit for each row of the table they number."""
    placed = keys.select(_block_of(key).alias(block), F.col(key).bitwiseAND(MAP_BITS - 1).alias(bits))
    maps = placed.repartition(block).groupBy(block).agg(F.bitmap_construct_agg(bits).alias(bits))
    return stash(maps.withColumn(bits, F.substring(bits, 1, MAP_BITS // 8)), "key-maps")


def rows_of(df: DataFrame, keys: DataFrame, key: str, there: bool) -> DataFrame | None:
    """The rows of ``df`` whose long ``key`` is in the written table ``keys`` (or is not, without ``there``), found
    where they are by broadcast bit maps; None if the numbers lie too far apart for that."""
    block, bits = fresh_name(df, "__block"), fresh_name(df, "__bits")
    maps = key_maps(keys, key, block, bits)
    if maps.count() > MAP_ROWS:
        return None
    at = F.col(key).bitwiseAND(MAP_BITS - 1)
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    marked = df.withColumn(block, _block_of(key)).join(F.broadcast(maps), block, "left")
    return marked.where(is_set if there else ~is_set).select(*[F.col(f"`{c}`") for c in df.columns])


def drop_rows(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``gone``, a written table of distinct long numbers."""
    small = gone.count() <= CORPUS_KEYS
    if not small and (left := rows_of(df, gone, key, there=False)) is not None:
        return left
    return df.join(F.broadcast(gone) if small else gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
