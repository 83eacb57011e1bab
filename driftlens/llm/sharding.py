"""Uniform shuffle of a table into shards of exact sizes, with a hypergeometric communication matrix.

Every input partition learns from the matrix how many of its rows each shard takes; rows are
permuted inside their partition, exchanged, and permuted again inside their shard.  The matrix is
drawn from the multivariate hypergeometric law, so all assignments with these shard sizes are
equally likely.  Everything that runs over rows is a DataFrame expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, literal_table, stash, table

#: Rows of the matrix: input partitions beyond this number share one by remainder.
MAX_SOURCES = 1024
#: Cells a shard's second permutation is cut into, so that no shard is sorted by a single task.
MAX_CELLS = 16384
ROWS_PER_CELL = 1_000_000


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """One draw; beyond the library's range by inversion over 12 standard deviations around the mode."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, taken))
    low, high = max(0, taken - bad), min(taken, good)
    mode = min(max((taken + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    reach = int(12 * math.sqrt(taken * share * (1 - share) + 1)) + 20
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=float)
    step = np.log(good - k) + np.log(taken - k) - np.log(k + 1) - np.log(bad - taken + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(step)])
    weight = np.exp(weight - weight.max())
    return int(max(low, mode - reach) + rng.choice(len(weight), p=weight / weight.sum()))


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Counts with the given row and column sums, drawn so that every table is as likely as it is
    under a uniform shuffle.  ``sum(sources)`` must equal ``sum(shards)``."""
    if sum(sources) != sum(shards):
        raise ValueError("sources and shards must hold the same number of rows")
    rng, left, matrix = np.random.default_rng(seed), list(shards), []
    for rows in sources:
        drawn, pool = [], sum(left)
        for size in left:
            take = _hypergeometric(rng, size, pool - size, rows) if rows else 0
            drawn.append(take)
            rows, pool = rows - take, pool - size
        left = [size - take for size, take in zip(left, drawn, strict=True)]
        matrix.append(drawn)
    return matrix


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 20_250_101) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 .. n_shards-1) and ``slot`` (0 .. size-1).

    Shard sizes differ by at most one; every row gets exactly one place, repeated rows each their
    own.  Null values and very long texts are carried as they are.  Columns of ``df`` that are
    called ``shard`` or ``slot`` are replaced.  An empty table gives an empty result.  One copy of
    ``df`` is written to the shared folder, so that row numbers stay what they were when executors
    are lost: pass only the columns that are wanted.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = df.sparkSession
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]
    row, source, rank, order, cell, start, ends, size = (fresh_name(df, f"__{c}") for c in ("id", "source", "rank", "order", "cell", "start", "ends", "n"))
    rows = stash(df.select(*kept, F.monotonically_increasing_id().alias(row)), "shard-rows")
    rows = rows.withColumn(source, F.pmod(F.shiftright(row, 33), F.lit(MAX_SOURCES)).cast("int"))
    counts = {r[0]: r[1] for r in rows.groupBy(source).agg(F.count("*").alias(size)).collect()}  # at most MAX_SOURCES
    total, sources = sum(counts.values()), sorted(counts)
    shards = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    matrix = communication_matrix([counts[s] for s in sources], shards, seed)
    upto = literal_table(
        spark,
        [{source: s, ends: np.cumsum(drawn).tolist()} for s, drawn in zip(sources, matrix, strict=True)],
        T.StructType([T.StructField(source, T.IntegerType()), T.StructField(ends, T.ArrayType(T.LongType()))]),
    )
    cells = max(1, min(MAX_CELLS // n_shards, math.ceil(total / n_shards / ROWS_PER_CELL) * 4))

    first = Window.partitionBy(source).orderBy(F.xxhash64(F.lit(seed), row), row)
    dealt = (
        rows.withColumn(rank, F.row_number().over(first).cast("long"))
        .join(F.broadcast(upto), source)
        .withColumn("shard", F.size(F.filter(ends, lambda end: end < F.col(rank))).cast("int"))
        .withColumn(order, F.xxhash64(F.lit(seed + 1), row))
        .withColumn(cell, F.floor((F.shiftrightunsigned(order, 32) * F.lit(cells)) / F.lit(2.0**32)).cast("int"))
        .drop(ends, rank, source)
    )
    dealt = stash(dealt, "shard-dealt")
    before = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", cell).agg(F.count("*").alias(size))  # at most MAX_CELLS rows
        .select("shard", cell, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    )
    inside = Window.partitionBy("shard", cell).orderBy(order, row)
    return (
        dealt.withColumn(rank, F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", cell])
        .withColumn("slot", (F.col(start) + F.col(rank) - 1).cast("long"))
        .select(*kept, "shard", "slot")
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23 whose row counts differ by at most one (law ``rows``)."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return shuffle_into_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
