"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.  A window that
compresses better with the toxic one holds what toxic text repeats; a document is judged by its best
windows, with a threshold calibrated on labelled documents that trained no dictionary.

Toxic documents are mostly ordinary words.  A dictionary trained on all of their text holds the same
beginnings as the ordinary one, and the difference of the two lengths is noise.  So the toxic one is
trained on a selection of its class's text, the words whose beginnings are far more frequent in toxic
than in ordinary documents, and the ordinary dictionary is put behind it: both compressors then know the
same ordinary text, and the difference of two lengths is what the toxic part alone saves.  This selection
departs from the plain method (README, op8, gives the figures of both).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship_package
from .common import table

#: The bounded training sample: documents of each class, in the order of a hash of their ids, and the
#: bytes up to which a document is taken.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_BYTES = 3000, 6000, 20_000
#: Bytes of a window (it ends at the next blank), and of the dictionaries.
WINDOW, ORDINARY_BYTES, TOXIC_BYTES = 96, 16384, 4096
#: The shortest match the compressors look for.
MIN_MATCH = 4
#: Beginnings of words that are compared between the classes.
SHORTEST, LONGEST = 4, 8
#: A beginning is typical if so many toxic documents hold it, so many times the ordinary share, and
#: its likelihood ratio statistic (G) against equal shares is so large.
LEAST_DOCS, LEAST_RATIO, LEAST_G = 4, 8.0, 25.0
#: A window's gain counts up to this many bytes.
MOST_GAIN = 16
#: A document's best windows that its score rests on.
BEST = 3

_WORD = re.compile(rb"[a-z\x80-\xff]+")


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of 1, the best gains, and the logarithm of the number of windows


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole lower-cased text in windows of ``size`` bytes or up to the next blank, at most twice that."""
    text, out, at = text.lower(), [], 0
    while at < len(text):
        end = at + size
        if end < len(text):
            end = text.find(b" ", end, at + 2 * size)
            end = at + 2 * size if end < 0 else end
        out.append(text[at:end])
        at = end
    return out


class Judge:
    """Features and scores of texts under a model."""

    def __init__(self, model: Model):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            strategy=z.STRATEGY_GREEDY, min_match=MIN_MATCH, window_log=16, chain_log=16, hash_log=16, search_log=6,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        parts = (model.ordinary, model.toxic + model.ordinary)
        self.compressors = [z.ZstdCompressor(compression_params=params, dict_data=z.ZstdCompressionDict(p, dict_type=z.DICT_TYPE_RAWCONTENT)) for p in parts]
        self.weights = np.array(model.weights)

    def features(self, text: bytes) -> list[float]:
        plain, toxic = (c.compress for c in self.compressors)
        cut = windows(text)
        gains = sorted((len(plain(w)) - len(toxic(w)) for w in cut), reverse=True)[:BEST]
        gains = [min(max(g, 0), MOST_GAIN) for g in gains] + [0] * (BEST - len(gains))
        return [1.0, *gains, math.log1p(len(cut))]

    def score(self, text: bytes | None) -> float:
        x = float(self.weights @ self.features(text or b""))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def _beginnings(text: bytes) -> set[bytes]:
    return {w[:k] for w in set(_WORD.findall(text.lower())) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Shortest beginnings of words that are typical of toxic documents."""
    in_toxic, in_ordinary = Counter(), Counter()
    for counter, texts in ((in_toxic, toxic), (in_ordinary, ordinary)):
        for text in texts:
            counter.update(_beginnings(text))
    found, share = set(), len(toxic) / (len(toxic) + len(ordinary))
    for start, n in in_toxic.items():
        other = in_ordinary[start]
        if n < LEAST_DOCS or n / len(toxic) < LEAST_RATIO * (other + 0.5) / (len(ordinary) + 1):
            continue
        g = 2 * (n * math.log(n / ((n + other) * share)) + (other * math.log(other / ((n + other) * (1 - share))) if other else 0))
        if g >= LEAST_G:
            found.add(start)
    return {s for s in found if not any(s[:k] in found for k in range(SHORTEST, len(s)))}


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    import zstandard as z

    try:
        return z.train_dictionary(size, samples).as_bytes()
    except z.ZstdError:
        return b" ".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method, with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-3, *[1e-1] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    typical = _typical(toxic, ordinary)
    marked = [b" ".join(w for w in _WORD.findall(t.lower()) if any(w[:k] in typical for k in range(SHORTEST, LONGEST + 1))) for t in toxic]
    marked = [b" " + m + b" " for m in marked if m]
    plain = [w for t in ordinary for w in windows(t, 64)]
    plain = plain[:: max(1, len(plain) // 40_000)]
    return Model(_dictionary(ORDINARY_BYTES, plain), _dictionary(TOXIC_BYTES, marked) if marked else b"", (0.0,) * (BEST + 2))


def _without_copies(rows: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """One of each group of near copies: a text is left out if the smallest hash of its 5-word
    sequences, under any of three seeds, is that of an earlier text of its class."""
    seen, out = set(), []
    for text, label in rows:
        words = text.lower().split()
        runs = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
        marks = {(label, seed, min(zlib.crc32(r, seed) for r in runs)) for seed in (1, 2, 3)}
        if not marks & seen:
            out.append((text, label))
        seen |= marks
    return out


def fit(rows: list[tuple[bytes, int]], share: float) -> Model:
    """A model of labelled texts; ``share`` is the share of toxic documents among all labelled ones.

    Each half is calibrated under dictionaries trained on the other; the final ones are trained on
    both.  Repeated texts and near copies count once.  Without examples of both classes in each half every document
    gets the prior ``share``.
    """
    rows = _without_copies(sorted(dict(rows).items()))
    halves = [[r for r in rows if zlib.crc32(r[0]) & 1 == k] for k in (0, 1)]
    if any({label for _, label in half} != {0, 1} for half in halves):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (math.log(share / (1 - share)), *[0.0] * (BEST + 1)))

    def trained(part: list[tuple[bytes, int]]) -> Model:
        return _dictionaries([t for t, label in part if label], [t for t, label in part if not label])

    judges = [Judge(trained(half)) for half in halves]
    x = np.array([judge.features(t) for judge, half in zip(judges, reversed(halves), strict=True) for t, _ in half])
    labels = np.array([label for half in reversed(halves) for _, label in half], dtype=float)
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    return trained(rows)._replace(weights=tuple(_logistic(x, labels, weight).tolist()))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic): labels of held-out
    documents (crc32 of the id as text divisible by 5) are never read, nor are nulls; of several
    labels of one document the largest counts."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [labels.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))]
    chosen = F.broadcast(chosen[0].union(chosen[1]))  # at most the sample's ids
    text = F.col("text").cast("binary")
    sample = docs.select("doc_id", text.alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES).join(chosen, "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # of repeated ids the smallest text
    share = counts.get(1, 0) / max(1, sum(counts.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["toxic"]) for batch in batches for r in batch.to_pylist())
        model = fit([(text, label) for _, text, label in rows], share)
        yield pa.RecordBatch.from_arrays([pa.array([model.ordinary], pa.binary()), pa.array([model.toxic], pa.binary()), pa.array([list(model.weights)], pa.list_(pa.float64()))], names=["ordinary", "toxic", "weights"])

    ship_package(docs.sparkSession)
    # the sample is bounded, so one task holds it
    row = sample.select("doc_id", "text", "toxic").repartition(1).mapInArrow(run, "ordinary binary, toxic binary, weights array<double>").first()
    return Model(bytes(row["ordinary"]), bytes(row["toxic"]), tuple(row["weights"])) if row else fit([], share)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(key, score) for each row of ``docs`` (key, text): the score of the whole text, from 0 to 1.

    Null and empty texts get the score of a text without windows; null keys are carried; repeated
    rows are scored each; an empty table gives an empty result; other columns are ignored.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            scores = [judge.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "score"])

    return docs.selectExpr("cast(key as long) key", "cast(text as binary) text").mapInArrow(run, "key long, score double")


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``; all columns stay as they are.

    Null and empty texts have the score of a text without windows, long ones are judged whole, repeated
    rows alike; an empty table gives an empty result."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([judge.score(t.as_py()) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their toxicity."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_scores(docs.select(F.col("doc_id").alias("key"), "text"), model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.withColumnRenamed("key", "doc_id").select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)
