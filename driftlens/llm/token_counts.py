"""Token counts under a unigram language model, by dynamic programming over a trie.

The distinct new pre-tokens of a batch form a trie.  A node's forward score - the best score of any
segmentation of its prefix - depends on the prefix alone, so it is computed once however many
pre-tokens share it; the node that ends a pre-token stores the number of tokens on its best path.
The trie is walked depth first in sorted order, so that only the current branch is in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship_package
from .common import table

#: Distinct pre-tokens whose counts a Python worker remembers; beyond this it starts anew.
REMEMBERED_WORDS = 1_000_000
#: Longer pre-tokens are counted without being remembered.
REMEMBERED_LENGTH = 64
#: Characters of text that are counted together.
BATCH_CHARS = 8_000_000
#: Stands for the blank before a pre-token.
BLANK = "▁"
#: Zipf's law: the logarithm of a piece's probability falls with that of its rank plus this.
ZIPF_SHIFT = 2.7
#: How much worse than the worst piece a character is that no piece covers.
UNKNOWN_PENALTY = 10.0

_workers: dict[str, TrieCounter] = {}


def unigram_scores(model_path: str) -> dict[str, float]:
    """Log probabilities of a vocabulary's ordinary pieces, by Zipf's law from their ranks (the file's
    own scores are merge ranks, not probabilities)."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    skipped = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    pieces = [k for k in range(model.get_piece_size()) if not any(f(k) for f in skipped)]
    total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in range(len(pieces))))
    return {model.id_to_piece(k): -math.log(r + ZIPF_SHIFT) - total for r, k in enumerate(pieces)}


class TrieCounter:
    """Token counts of pre-tokens: of all segmentations into pieces the one with the highest score
    counts, of equal ones that with the shorter last piece.  A character that no piece covers is as
    many tokens as its UTF-8 form has bytes."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        #: Texts like "word" (for BLANK + "word") and "\\nword" (for these characters).
        self.known: dict[str, int] = {}

    def _count(self, words: list[str]) -> Iterator[int]:
        """Counts of sorted words."""
        best, tokens, before, score_of = [0.0], [0], "", self.scores.get
        for word in words:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del best[same + 1 :], tokens[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                last = word[end - 1]
                top, n = best[end - 1] + self.unknown, tokens[end - 1] + len(last.encode("utf-8", "replace"))
                for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
                    score = score_of(word[start:end])
                    if score is not None and best[start] + score > top:
                        top, n = best[start] + score, tokens[start] + 1
                best.append(top)
                tokens.append(n)
            before = word
            yield tokens[-1]

    @staticmethod
    def cut(text: str) -> list[str]:
        """Pre-tokens: cut before every blank and line break."""
        return text.replace("\n", " \n").split(" ") if text else []

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(number of pre-tokens, number of tokens) of each text."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        cut = [self.cut(text) for text in texts]
        new = sorted(set().union(*cut).difference(self.known))
        full = sorted((w if w[:1] == "\n" else BLANK + w, w) for w in new)
        found = {w: n for (_, w), n in zip(full, self._count([f for f, _ in full]), strict=True)}
        passing = {w: n for w, n in found.items() if len(w) > REMEMBERED_LENGTH}
        self.known.update((w, n) for w, n in found.items() if len(w) <= REMEMBERED_LENGTH)
        get = (self.known | passing).__getitem__ if passing else self.known.__getitem__
        return [(len(words), sum(map(get, words))) for words in cut]


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) for each row of ``docs`` (doc_id, text; other columns are ignored).

    A null or empty text has no tokens; a null doc_id stays null; repeated rows are counted each; an
    empty table gives an empty result.  Every text is counted whole, however long.
    """
    if model_path is None:
        import public_tokenizers

        model_path = str(public_tokenizers.path("piece_bpe_32k.model"))
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _workers:
            _workers[model_path] = TrieCounter(unigram_scores(model_path))
        counter = _workers[model_path]
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < batch.num_rows:
                end, size, part = at, 0, []
                while end < batch.num_rows and size < BATCH_CHARS:
                    part.append(texts[end].as_py() or "")
                    size += len(part[-1])
                    end += 1
                counts = counter.counts(part)
                columns = [pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *columns], names=["doc_id", "n_pretokens", "n_tokens"])
                at = end

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents``."""
    return token_counts(table(spark, sf_dir, "documents"))
