"""Exact top-k search by distributed histogram selection.

Queries and candidates are packed in blocks, and every query block meets every candidate block.
Each round scores all pairs and counts, per query, how many scores fall in each part of the range
that still holds the k-th score; the range shrinks until it is one value.  Then the scores above it,
and of those equal to it the smallest ids, are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship_package
from .common import stash, table

#: Vectors of a block.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Parts a range is cut into in each round.
PARTS = 1024

#: Components and scores stay within this; what lies beyond counts as this, with its sign.
MOST = 2**62 - 1

CANDIDATES = "rows binary, ids binary, vectors binary, dims int, most double"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates (row, vec_id, v) in blocks: row numbers, ids and vectors as 64-bit numbers, shorter
    vectors filled up with zeros, and the largest sum of squares in the block."""
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATE_BLOCK):
            part = batch.slice(at, CANDIDATE_BLOCK)
            vectors = _filled(part.column(2).to_pylist())
            most = float(np.max(np.sum(vectors.astype(float) ** 2, axis=1), initial=0))
            rows, ids = (part.column(k).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for k in (0, 1))
            columns = [pa.array([x], pa.binary()) for x in (rows, ids, vectors.tobytes())] + [pa.array([vectors.shape[1]], pa.int32()), pa.array([most])]
            yield pa.RecordBatch.from_arrays(columns, names=["rows", "ids", "vectors", "dims", "most"])


def _filled(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype="<i8")
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point or 64-bit numbers where no sum can leave their
    exact range, else in unbounded ones, cut at ``MOST``."""
    dims = min(q.shape[1], c.shape[1])
    q, c = q[:, :dims], c[:, :dims]
    largest = dims * int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0))
    if largest < 2**53:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    if largest <= MOST:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, -MOST, MOST).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]):
    """For each pair of blocks: query rows, their bounds, candidate ids, scores, and which pairs count
    (all but a query's own row).  Pairs of which no score can reach its query's bound are left out."""
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            q_rows, low, width = (np.array([x[name] for x in r["queries"]], dtype=np.int64) for name in ("row", "low", "width"))
            q = _filled([x["v"] for x in r["queries"]])
            reach = np.sqrt(np.sum(q.astype(float) ** 2, axis=1) * r["most"]) * (1 + 1e-9) + 1
            if (reach < low).all():
                continue
            c_rows, c_ids = np.frombuffer(r["rows"], "<i8"), np.frombuffer(r["ids"], "<i8")
            vectors = np.frombuffer(r["vectors"], "<i8").reshape(len(c_ids), r["dims"])
            yield q_rows, low, width, c_ids, _scores(q, vectors), q_rows[:, None] != c_rows[None]


def _histogram(k: int):
    """(row, part, n) of each pair of blocks.  Parts below the one that holds a block's own k-th
    score cannot hold the k-th score of all, so they are left out: at most k rows for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_rows, low, width, _, scores, counts in _pairs(batches):
            part = np.minimum((scores - low[:, None]) // width[:, None], PARTS)  # PARTS: above the range
            part[~counts | (part < 0)] = -1
            at = max(0, part.shape[1] - k)
            kth = np.partition(part, at, axis=1)[:, at]
            rows, columns = np.nonzero((part >= 0) & (part >= kth[:, None]))
            both, n = np.unique(rows * (PARTS + 1) + part[rows, columns], return_counts=True)
            columns = [pa.array(q_rows[both // (PARTS + 1)]), pa.array((both % (PARTS + 1)).astype(np.int32)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "n"])

    return run


def _selected(k: int):
    """(row, vec_id, score) of scores from each query's k-th score up; of a block the first k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_rows, low, _, c_ids, scores, counts in _pairs(batches):
            rows, columns = np.nonzero(counts & (scores >= low[:, None]))
            order = np.lexsort((c_ids[columns], -scores[rows, columns], rows))
            rows, columns = rows[order], columns[order]
            first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
            rows, columns = rows[first], columns[first]
            yield pa.RecordBatch.from_arrays([pa.array(q_rows[rows]), pa.array(c_ids[columns]), pa.array(scores[rows, columns])], names=["row", "vec_id", "score"])

    return run


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, v): each component x as floor(scale * x), and a number for each row; written, so that
    numbers stay what they are.  Left out are null ids, null vectors and those with null or non-finite
    components.  Scaled components beyond 2**62 - 1 count as that."""
    x = F.col("embedding")
    whole = F.transform(x, lambda e: _whole(e.cast("double") * scale))
    fine = F.forall(x, lambda e: F.coalesce(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")), F.lit(False)))
    rows = embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    return stash(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")), "vectors")


def _whole(x):
    """The largest whole number up to a double, as a long; beyond 2**62 that number with its sign."""
    edge = 2.0**62
    return F.when(x >= edge, F.lit(MOST)).when(x <= -edge, F.lit(-MOST)).otherwise(F.floor(x))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` highest inner products over all
    rows of ``candidates`` but its own, all if there are fewer; ties go to the smaller vec_id.

    Both tables are (row, vec_id, v) as from ``integer_vectors``; a query's own row is the one of its
    ``row``.  Rows of one id are rows of their own on both sides.  Shorter vectors count as if filled up
    with zeros.  Scores beyond 2**62 - 1 count as that.  Empty tables give an empty result.  All pairs are
    scored, block by block, in each round; how many rounds there are depends on the range of scores alone.
    """
    ship_package(queries.sparkSession)
    c = stash(candidates.select("row", "vec_id", "v").mapInArrow(_packed, CANDIDATES), "candidates")
    number = F.monotonically_increasing_id()
    block = F.shiftright(number, 33) * F.lit(1 << 24) + F.floor(number.bitwiseAND(F.lit((1 << 33) - 1)) / QUERY_BLOCK)
    q = stash(queries.select("row", F.col("vec_id").alias("query_id"), "v", block.alias("block")), "queries")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = (q.agg(F.max(squares)).first()[0] or 0) ** 0.5 * (c.agg(F.max("most")).first()[0] or 0) ** 0.5
    reach = min(int(longest * (1 + 1e-9)) + 1, MOST)  # no score lies beyond it
    width = -(-(2 * reach + 1) // PARTS)
    bounds = q.select("row", F.lit(-reach).cast("long").alias("low"), F.lit(width).cast("long").alias("width"))

    def against_all(bounds: DataFrame) -> DataFrame:
        """The stated queries in blocks, each with every block of candidates."""
        blocks = q.join(bounds, "row").groupBy("block").agg(F.collect_list(F.struct("row", "v", "low", "width")).alias("queries"))
        return c.crossJoin(blocks.select("queries"))

    while True:
        parts = against_all(bounds).mapInArrow(_histogram(k), "row long, part int, n long").groupBy("row", "part").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("row").orderBy(F.desc("part")))
        kth = parts.withColumn("upto", upto).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k)).select("row", "part")
        low = F.coalesce(F.col("low") + F.col("part") * F.col("width"), F.lit(-reach))  # fewer than k rows: all of them
        bounds = stash(bounds.join(kth, "row", "left").select("row", low.alias("low"), F.lit(max(1, -(-width // PARTS))).cast("long").alias("width")), "bounds")
        if width == 1:
            break
        width = max(1, -(-width // PARTS))
    found = against_all(bounds).mapInArrow(_selected(k), "row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(q.select("row", "query_id"), "row").select("query_id", "rank", "vec_id", "score")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest ``embeddings`` of every fiftieth, by integer inner products."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("vec_id % 50 = 0"), vectors)
