"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some word positions of a window and ignore the rest, so that a passage is found
although words were substituted.  A bit map of fixed size, made from the benchmark's seeds, passes
the few document windows that may match; these are joined with the seed table, and each hit is
verified by the matches along its whole diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship_package
from .common import WORD_BYTES, broadcast_value, drop_rows, join_few, kept, numbered, scratch, stash, table

#: 1 marks a word that must be equal, 0 one that is ignored.  Whatever 13 or more words of
#: which 0.8 are equal, one of the masks fits them: any longer such run holds one of 13 to 25 words.
MASKS = ("11101111", "11010010111", "1110110011", "1110001010011", "1100011111", "10111111")
#: A verified overlap has this many words at least, of which this share is equal.
LEAST_WORDS = 13
LEAST_EQUAL = 0.8
#: Hits that are so many words apart begin a new run; runs of the same hits are looked up once.
RUN_GAP = 64
#: Bits of the map for each seed, and bounds of the logarithm (base 2) of its size (8 kB to 32 MB).
BITS_A_SEED = 256
MAP_BITS = (16, 28)
BATCH_BYTES = 1 << 20

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_OFFSETS = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(root: int, n: int) -> np.ndarray:
    out = np.full(n, root, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """64-bit hashes of all words of a byte string: differences of a running polynomial sum."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, raw: bytes) -> np.ndarray:
        text, out, at = raw.translate(WORD_BYTES), [], 0
        while at < len(text):
            stop = len(text) if len(text) - at <= 2 * BATCH_BYTES else text.find(b" ", at + BATCH_BYTES)
            stop = len(text) if stop < 0 else stop
            out.append(self._part(np.frombuffer(text, np.uint8, stop - at, at)))
            at = stop
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def _part(self, codes: np.ndarray) -> np.ndarray:
        if len(self.up) < len(codes):
            n = 1 << int(len(codes)).bit_length()
            self.up, self.down = _powers(int(_ROOT), n), _powers(pow(int(_ROOT), -1, 2**64), n)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes != 32, [False]])))
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self.up[: len(codes)])])
        return _mix((sums[ends] - sums[starts]) * self.down[starts])


def seeds(words: np.ndarray) -> list[np.ndarray]:
    """For each mask the hashes of all its windows over ``words``."""
    out = []
    for k, offsets in enumerate(_OFFSETS):
        n = len(words) - len(MASKS[k]) + 1
        if n <= 0:
            out.append(np.empty(0, np.uint64))
            continue
        total = np.full(n, k + 1, dtype=np.uint64)
        for j, offset in enumerate(offsets):
            total += words[offset : offset + n] * np.uint64(int(_ROOT) * (2 * j + 1) % 2**64)
        out.append(_mix(total))
    return out


def _bits(h: np.ndarray, log2: int) -> Iterator[np.ndarray]:
    """The places in a bit map of size 2**log2 that a seed sets."""
    yield h & np.uint64((1 << log2) - 1)
    yield h >> np.uint64(64 - log2)
    yield (h * _ROOT) >> np.uint64(64 - log2)


def _is_set(bit_map: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bit_map[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 != 0


def _benchmark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        words = [hasher(t.as_py() or b"").tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["item_id", "words"])


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, raw in zip(batch.column(0), batch.column(1), strict=True):
            found = seeds(np.frombuffer(raw.as_py(), np.uint64))
            at = np.concatenate([np.arange(len(f)) for f in found]).astype(np.int32)
            if len(at):
                columns = [pa.array(np.concatenate(found).view(np.int64)), pa.array([item.as_py()] * len(at), pa.int64()), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "item_id", "item_at"])


def _map_of(log2: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (log2 - 3), np.uint8)
        for batch in batches:
            for at in _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), log2):
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    return run


def _hits(words: np.ndarray, bit_map: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, their places) of the windows that the map passes, by place."""
    hit_seeds, hit_at = [], []
    for found in seeds(words):
        keep = np.arange(len(found))
        for at in _bits(found, log2):
            keep = keep[_is_set(bit_map, at[keep])]
        hit_seeds.append(found[keep])
        hit_at.append(keep)
    hit_seeds, hit_at = np.concatenate(hit_seeds), np.concatenate(hit_at)
    order = np.lexsort((hit_seeds, hit_at))
    return hit_seeds[order], hit_at[order]


SEARCHED = "row long, key long, words binary, runs array<struct<core: long, at: int, hits: array<struct<seed: long, at: int>>>>"


def _searched(bit_map, log2: int):
    """Documents with windows that may match: their words, and their hits in runs.  ``core`` hashes the hits
    of a run and the distances between them, so runs of the same passage share it."""
    from xxhash import xxh64_intdigest

    hit = pa.struct([("seed", pa.int64()), ("at", pa.int32())])
    types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("core", pa.int64()), ("at", pa.int32()), ("hits", pa.list_(hit))]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n, bits = Hasher(), TaskContext.get().partitionId() << 40, bit_map.value
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                words = hasher(text.as_py() or b"")
                found, at = _hits(words, bits, log2)
                if not len(at):
                    continue
                runs, cuts = [], [0, *(np.flatnonzero(np.diff(at) > RUN_GAP) + 1).tolist(), len(at)]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    near = (at[low:high] - at[low]).astype(np.int32)
                    core = xxh64_intdigest(found[low:high].tobytes() + near.tobytes()) - 2**63
                    hits = [{"seed": s, "at": p} for s, p in zip(found[low:high].view(np.int64).tolist(), near.tolist(), strict=True)]
                    runs.append({"core": core, "at": int(at[low]), "hits": hits})
                row = (n, key.as_py(), words.tobytes(), runs)
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types, strict=True)], names=["row", "key", "words", "runs"])
                n += 1

    return run


def overlap(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(first word in ``words``, number of words, number of equal ones) of the overlap along one diagonal
    (word i of ``item`` against word i + shift of ``words``): of all runs of ``LEAST_WORDS`` or more words of
    which ``LEAST_EQUAL`` or more are equal the one with most equal words, then fewest words, then the first."""
    low, high = max(0, shift), min(len(words), shift + len(item))
    if high - low < LEAST_WORDS:
        return None
    found = _most_equal(words[low:high] == item[low - shift : high - shift])
    return found and (low + found[0], *found[1:])


def _most_equal(equal: np.ndarray) -> tuple[int, int, int] | None:
    """(start, words, equal words) of the overlap on a diagonal; see ``overlap``."""
    n = len(equal)
    least, whole = Fraction(str(LEAST_EQUAL)).as_integer_ratio()
    counts = np.concatenate([[0], np.cumsum(equal)])
    spare = whole * counts - least * np.arange(n + 1)  # a run is equal enough if this doesn't fall over it
    highest = np.maximum.accumulate(spare[::-1])[::-1]
    starts = np.arange(n + 1)
    ends = np.searchsorted(-highest, -spare, side="right") - 1  # the last end at which it has not fallen
    starts, ends = starts[ends - starts >= LEAST_WORDS], ends[ends - starts >= LEAST_WORDS]
    if not len(starts):
        return None
    matched = counts[ends] - counts[starts]
    ends = np.maximum(starts + LEAST_WORDS, np.searchsorted(counts, counts[ends]))  # without different words at the end
    best = np.lexsort((starts, ends - starts, -matched))[0]
    return int(starts[best]), int(ends[best] - starts[best]), int(matched[best])


VERIFIED = "key long, item_id long, doc_start long, item_start long, n_words long, n_equal long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps from (key, item_id, shift, words, item_words), where ``words`` begin at the diagonal's first."""
    names = ["key", "item_id", "doc_start", "item_start", "n_words", "n_equal"]
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            words, item, shift = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["item_words"], np.uint64), r["shift"]
            if found := overlap(words, item, min(0, shift)):
                start, n, matched = found
                start += max(0, shift)
                out.append((r["key"], r["item_id"], start, start - shift, n, matched))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best overlap of each row of ``docs`` (key, text) with each item of ``benchmark`` (item_id,
    text): key, item_id, doc_start and item_start (in words from 0), n_words, n_equal.

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters.  An overlap has
    13 or more words of which 0.8 or more are equal, without insertions; the best has most equal words,
    then fewest words.  Whatever the item's length, its whole extent in the document is compared.  Null
    and empty texts, and those of fewer words than 13, have no overlap; items of equal words each have
    their own; a null item_id is carried; a null key is carried; rows of equal key are one document;
    empty tables on either side give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    given = benchmark.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").mapInArrow(_benchmark_rows, "item_id long, words binary")
    given = stash(given.where(F.octet_length("words") >= 8 * LEAST_WORDS).distinct(), "benchmark")
    texts = given.select("words").distinct()
    items = stash(texts.select(F.monotonically_increasing_id().alias("item"), F.col("words").alias("item_words")), "items")
    names = stash(given.join(items, F.col("words") == F.col("item_words")).select("item", "item_id"), "item-names")
    seed_table = stash(items.select(F.col("item").alias("item_id"), "item_words").mapInArrow(_seed_rows, "seed long, item_id long, item_at int"), "seeds").withColumnRenamed("item_id", "item")
    log2 = min(max(MAP_BITS[0], int(BITS_A_SEED * seed_table.count() + 1).bit_length()), MAP_BITS[1])
    maps = seed_table.select("seed").coalesce(8).mapInArrow(_map_of(log2), "bits binary").collect()  # at most 8 maps of at most 32 MB
    bit_map = np.zeros(1 << (log2 - 3), np.uint8)
    for row in maps:
        bit_map |= np.frombuffer(row["bits"], np.uint8)
    shared = broadcast_value(spark, bit_map)
    searched = docs.selectExpr("cast(key as long) key", "cast(text as string) text").mapInArrow(_searched(shared, log2), SEARCHED)
    searched = stash(searched, "searched")
    runs = searched.select("row", F.inline("runs"))
    cores = runs.groupBy("core").agg(F.first("hits").alias("hits")).select("core", F.inline("hits"))
    diagonals = join_few(cores, seed_table, "seed").select("core", "item", (F.col("at") - F.col("item_at")).alias("off")).distinct()
    diagonals = stash(diagonals, "diagonals")
    pairs = join_few(runs.drop("hits"), diagonals, "core").select("row", "item", (F.col("off") + F.col("at")).alias("shift")).distinct()
    # of a document only the item's extent along the diagonal is sent
    pairs = join_few(pairs.join(searched.select("row", "key", "words"), "row"), items, "item")
    extent = F.expr("substring(words, cast(8 * greatest(shift, 0) + 1 as int), length(item_words))")
    pairs = pairs.select("key", F.col("item").alias("item_id"), "shift", extent.alias("words"), "item_words")
    best = F.max_by(F.struct("doc_start", "item_start", "n_words", "n_equal"), F.struct("n_equal", -F.col("n_words"), -F.col("doc_start"), -F.col("item_start")))
    found = pairs.mapInArrow(_verify, VERIFIED).groupBy("key", F.col("item_id").alias("item")).agg(best.alias("b"))
    return join_few(found, names, "item").select("key", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that overlap an item of ``benchmark``; all columns stay as they are.

    Rows are judged each: repeated rows go or stay together, null and empty texts stay, and with an
    empty table on either side ``docs`` stays as it is."""
    rows, spare = numbered(docs)
    with scratch():
        found = benchmark_overlaps(rows.select(F.col(spare).alias("key"), "text"), benchmark)
        gone = kept(stash(found.select(F.col("key").alias(spare)).distinct(), "dropped"))
    return drop_rows(rows, gone, spare).drop(spare)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps of all ``documents`` with all ``benchmark`` items."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    found = benchmark_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.col("n_equal") / F.col("n_words")).withColumnRenamed("key", "doc_id")
