"""Best-fit packing of tokenised documents by minimum bin slack.

Tokenising writes one small row per piece (no ids) to the shared folder.  Only the number of
pieces of each length travels to the driver - at most as many numbers as a sequence has tokens -
and there the fullest combination of lengths is found, bin after bin, by subset sums over
bitsets.  A combination is used as often as the lengths in it last, so the plan stays small
whatever the corpus holds.  Pieces then find their place by their rank among those of their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from .common import literal_table, stash, table

CAPACITY = 1024
END_ID = 2
#: Distinct words whose ids a Python worker remembers; beyond this it starts anew.
REMEMBERED_WORDS = 800_000
#: Longer chunks between blanks are tokenised without being remembered.
REMEMBERED_LENGTH = 64
#: Bytes of text that are tokenised together.
BATCH_BYTES = 4_000_000
#: Pieces of one length are ranked in groups of about so many.
RANK_ROWS = 500_000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)

START = "\x00"
_LATIN = re.compile("[\x00\n]?[!-~\u00a1-\u00ac\u00ae-\u024f]+")
_workers: dict[str, WordEncoder] = {}


#: The pre-token pattern that byte-level BPE vocabularies of 50k ids were made with.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class WordEncoder:
    """Ids of whole texts by a byte-level BPE, remembered by the chunks between blanks.

    The vocabulary's pre-tokens never run across the place before a blank that a non-blank
    follows, nor across a single line break between two non-blanks, so a text's ids are those
    of its chunks one after the other.  New chunks in Latin script are encoded in one go with the
    same vocabulary as ranks, all others, and texts with unusual white space, by the tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        names = _byte_names()
        ranks = {bytes(names[c] for c in token): k for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items() if set(token) <= names.keys()}
        ranks = {token: k for token, k in ranks.items() if token != b"<|endoftext|>"}
        self.fast = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.line_break = ranks[b"\n"]
        #: Texts like "word" (for " word"), "\nword" (for these characters) and START + "word" (for "word").
        self.known: dict[str, bytes] = {}

    def _many(self, chunks: list[str], lead: str) -> Iterator[bytes]:
        """Ids of each of ``chunks`` (no white space in any, none empty) with ``lead`` before it."""
        for k in range(0, len(chunks), 4096):
            part = chunks[k : k + 4096]
            ids = np.array(self.fast(lead + ("\n" + lead).join(part)), dtype="<u4")
            ends = [*(np.flatnonzero(ids == self.line_break) * 4).tolist(), 4 * len(ids)]
            data, start = ids.tobytes(), 0
            for end in ends:
                yield data[start:end]
                start = end + 4

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        latin = [c for c in chunks if _LATIN.fullmatch(c)]
        inner = [c for c in latin if c[0] != START and c[0] != "\n"]
        first = [c for c in latin if c[0] == START]
        lines = [c for c in latin if c[0] == "\n"]
        out = dict(zip(inner, self._many(inner, " "), strict=True))
        out.update(zip(first, self._many([c[1:] for c in first], ""), strict=True))
        mark = self.line_break.to_bytes(4, "little")
        out.update((c, mark + ids) for c, ids in zip(lines, self._many([c[1:] for c in lines], ""), strict=True))
        for c in chunks.difference(out):
            out[c] = self._whole(c[1:]) if c[0] == START else mark + self._whole(c[1:]) if c[0] == "\n" else self._whole(" " + c)
        return out

    @staticmethod
    def _cut(text: str) -> list[str] | None:
        """The chunks of a text, or None if it must be tokenised whole: white space that isn't a
        single blank or line break between two words, or the mark START in it."""
        if not text or text[0].isspace() or text[-1].isspace() or START in text:
            return None
        chunks = (START + text).replace("\n", " \n").split(" ")
        return chunks if len(chunks) == len(text.split()) and "" not in chunks and "\n" not in chunks else None

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        cut = []
        for text in texts:
            cut.append(self._cut(text))
        new = self._learn(set().union(*(c for c in cut if c)).difference(self.known))
        passing = {c: ids for c, ids in new.items() if len(c) > REMEMBERED_LENGTH}
        self.known.update((c, ids) for c, ids in new.items() if len(c) <= REMEMBERED_LENGTH)
        get = (self.known | passing).__getitem__ if passing else self.known.__getitem__
        return [b"".join(map(get, chunks)) if chunks else self._whole(text) for text, chunks in zip(texts, cut, strict=True)]


def piece_rows(doc_id, ids: bytes, capacity: int, end_id: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc32) of one document, its closing id included."""
    ids += int(end_id).to_bytes(4, "little")
    n = len(ids) // 4
    view, start, piece = memoryview(ids), 0, 0
    length = n if n <= capacity else n % capacity or capacity
    while start < n:
        yield doc_id, piece, start, length, zlib.crc32(view[4 * start : 4 * (start + length)])
        start, piece, length = start + length, piece + 1, capacity


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _workers:
            _workers[tokenizer_path] = WordEncoder(tokenizer_path)
        encoder = _workers[tokenizer_path]
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(keys):
                end, size, part = at, 0, []
                while end < len(keys) and size < BATCH_BYTES:
                    part.append(texts[end].as_py() or "")
                    size += len(part[-1])
                    end += 1
                rows = [r for key, ids in zip(keys[at:end], encoder.encode(part), strict=True) for r in piece_rows(key, ids, capacity, end_id)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                at = end

    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def _fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination that holds one piece of the largest length: lengths with how often each is used.

    A bit of ``reach`` stands for a sum that can be made.  Ties go to the longest lengths.
    """
    largest = max(counts)
    room, want = capacity - largest, (1 << (capacity - largest + 1)) - 1
    reach, stages = 1, []
    for length in sorted(counts):
        if length > room:
            break
        left = min(counts[length] - (length == largest), room // length)
        size = 1
        while left > 0:
            size = min(size, left)
            stages.append((length, size, reach))
            reach |= (reach << (length * size)) & want
            left -= size
            size *= 2
    total = reach.bit_length() - 1
    used = {largest: 1}
    for length, size, before in reversed(stages):
        if total >= length * size and before >> (total - length * size) & 1:
            used[length] = used.get(length, 0) + size
            total -= length * size
    assert total == 0
    return used


def slack_plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths with the number of bins each fills, so that all pieces are used up."""
    left = {length: n for length, n in histogram.items() if n > 0}
    plan = []
    while left:
        used = _fullest(left, capacity)
        bins = min(left[length] // n for length, n in used.items())
        plan.append((used, bins))
        for length, n in used.items():
            left[length] -= n * bins
            if not left[length]:
                del left[length]
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> list[dict]:
    """For each length runs of ranks: rank r of a run lies in bin first_bin + r // per_bin, as the
    (r % per_bin)-th of its length there, behind ``before`` tokens of other lengths."""
    taken: dict[int, int] = {}
    rows, first_bin = [], 0
    for used, bins in plan:
        before = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append({"length": length, "first_rank": taken.get(length, 0), "ranks": n * bins, "per_bin": n, "first_bin": first_bin, "before": before})
            taken[length] = taken.get(length, 0) + n * bins
            before += length * n
        first_bin += bins
    return rows


PLACES = T.StructType([T.StructField(c, T.LongType()) for c in ("length", "first_rank", "ranks", "per_bin", "first_bin", "before")])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (see ``PIECES``) with ``sequence_id`` and ``offset``.

    Every piece gets a place of its own, repeated rows too; sequences have no gaps and hold at
    most ``capacity`` tokens.  An empty table gives an empty result.  Lengths must lie in
    1 .. capacity; other columns may be null and are carried.  Columns that ``PIECES`` does not name
    are dropped.  ``sequence_id`` numbers the bins from 0 in the order they were planned.
    """
    spark = pieces.sparkSession
    pieces = stash(pieces.select(*PIECES.fieldNames(), F.monotonically_increasing_id().alias("__id")), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    places = _places(slack_plan(histogram, capacity))
    runs: dict[int, list] = {}
    for p in places:
        runs.setdefault(p["length"], []).append(p)
    by_length = literal_table(
        spark,
        [{"length": k, "cells": -(-histogram[k] // RANK_ROWS), "runs": v} for k, v in runs.items()],
        T.StructType([T.StructField("length", T.LongType()), T.StructField("cells", T.LongType()), T.StructField("runs", T.ArrayType(PLACES))]),
    )
    pieces = pieces.join(F.broadcast(by_length.select("length", "cells")), "length").withColumn("__cell", F.pmod(F.xxhash64("__id"), "cells")).drop("cells")
    by_cell = pieces.groupBy("length", "__cell").agg(F.count("*").alias("__n"))  # one row for each cell: few beside the pieces
    upto = Window.partitionBy("length").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_cell.select("length", "__cell", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("length", "__cell").orderBy("__id")
    ranked = (
        pieces.withColumn("__rank", F.row_number().over(inside))
        .join(F.broadcast(starts), ["length", "__cell"])  # capacity + pieces / RANK_ROWS rows
        .withColumn("__rank", F.col("__start") + F.col("__rank") - 1)
        .join(F.broadcast(by_length), "length")
    )
    run = F.filter("runs", lambda r: (r["first_rank"] <= F.col("__rank")) & (F.col("__rank") < r["first_rank"] + r["ranks"]))[0]
    within = F.col("__rank") - F.col("__run.first_rank")
    return (
        ranked.withColumn("__run", run)
        .withColumn("sequence_id", (F.col("__run.first_bin") + F.floor(within / F.col("__run.per_bin"))).cast("long"))
        .withColumn("offset", (F.col("__run.before") + F.pmod(within, F.col("__run.per_bin")) * F.col("length")).cast("long"))
        .select(*PIECES.fieldNames(), "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are ignored) into few sequences of at most ``capacity`` tokens.

    A null or empty text is a document of the closing id alone; a null doc_id stays null; repeated
    rows are packed each.  Longer documents, however long, are cut into full pieces, of which the first
    may be shorter; an empty table gives an empty result.  Ids depend on the text alone, and strings of special tokens are ordinary text.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(tokenised_pieces(docs, str(tokenizer_path), capacity, end_id), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
