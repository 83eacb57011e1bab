"""Language-model clients and the scorers that call them, one client for each partition."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship_package
from ..sources.tables import Target
from .scoring import embedding_scores

BATCH, ATTEMPTS = 32, 3


class Client(Protocol):
    def ping(self) -> None: ...
    def embed(self, texts: list[str]) -> list[list[float]]: ...
    def chat(self, prompt: str) -> str: ...


class HttpClient:
    """A local model server: ``ollama`` or ``openai`` style."""

    def __init__(self, base_url: str, model: str, style: str = "ollama", timeout: float = 120.0):
        self.base_url, self.model, self.style, self.timeout = base_url.rstrip("/"), model, style, timeout

    def _post(self, path: str, body: dict) -> dict:
        request = urllib.request.Request(self.base_url + path, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def ping(self) -> None:
        with urllib.request.urlopen(self.base_url + ("/api/tags" if self.style == "ollama" else "/v1/models"), timeout=10):
            pass

    def embed(self, texts: list[str]) -> list[list[float]]:
        if self.style == "ollama":
            return self._post("/api/embed", {"model": self.model, "input": texts})["embeddings"]
        return [d["embedding"] for d in self._post("/v1/embeddings", {"model": self.model, "input": texts})["data"]]

    def chat(self, prompt: str) -> str:
        messages = [{"role": "user", "content": prompt}]
        if self.style == "ollama":
            return self._post("/api/chat", {"model": self.model, "messages": messages, "stream": False, "format": "json", "options": {"temperature": 0}})["message"]["content"]
        return self._post("/v1/chat/completions", {"model": self.model, "messages": messages, "temperature": 0})["choices"][0]["message"]["content"]


class FakeClient:
    """Deterministic answers without a server: letter counts as vectors, and scores by shared words."""

    def __init__(self, targets: Sequence[Target] = ()):
        self.targets = tuple(targets)

    def ping(self) -> None:
        pass

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]

    def chat(self, prompt: str) -> str:
        text = prompt.rsplit("Text:", 1)[-1].lower()
        subs = [{"category_id": t.category_id, "sub_category_id": t.sub_category_id, "score": min(1.0, 0.5 * sum(s.lower() in text for s in t.seeds)), "reasoning": "shared words"} for t in self.targets]
        return json.dumps({"category_scores": [], "sub_category_scores": subs})


def embed_text(t: Target) -> str:
    """A target's label, description and seeds, and behind a sub-target's own its category's seeds."""
    return ". ".join(x for x in [t.label, t.description, *t.seeds, *t.category_seeds] if x)


def prompt_for(targets: Sequence[Target], text: str) -> str:
    """The instruction for one text."""
    listed = "\n".join(f"- {t.category_id}/{t.sub_category_id}: {t.label}. {t.description}" for t in targets)
    return (
        "Score how well the text fits each target, from 0 to 1. Answer with JSON only: "
        '{"category_scores": [{"category_id", "score", "reasoning"}], "sub_category_scores": [{"category_id", "sub_category_id", "score", "reasoning"}]}.\n'
        f"Targets:\n{listed}\nText: {text}"
    )


def score_by_embedding(rows: DataFrame, targets: Sequence[Target], client: Client) -> DataFrame:
    """The matrix of ``rows`` (row_id, row_ord, text) by embeddings; rows without text have no scores."""
    spark = rows.sparkSession
    ship_package(spark)
    client.ping()
    vectors = client.embed([embed_text(t) for t in targets])
    frame = spark.createDataFrame(
        [(t.category_id, t.sub_category_id, t.ord, [float(x) for x in v]) for t, v in zip(targets, vectors, strict=True)],
        "category_id string, sub_category_id string, ord int, target_vector array<double>",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), BATCH):
                part = batch.iloc[k : k + BATCH]
                yield pd.DataFrame({"row_id": part.row_id, "row_ord": part.row_ord, "vector": client.embed(part.text.tolist())})

    texts = rows.select("row_id", "row_ord", "text").where(F.trim(F.coalesce("text", F.lit(""))) != "")
    return embedding_scores(texts.mapInPandas(run, "row_id string, row_ord long, vector array<double>"), frame)


def answers(rows: DataFrame, targets: Sequence[Target], client: Client, done: DataFrame | None = None) -> DataFrame:
    """(row_id, row_ord, response) of each row with text that ``done`` (row_id) lacks; up to three attempts
    until an answer has scores."""
    ship_package(rows.sparkSession)
    client.ping()
    targets = tuple(targets)

    def usable(answer: str) -> bool:
        try:
            parsed = json.loads(answer)
        except ValueError:
            return False
        return isinstance(parsed, dict) and bool(parsed.get("sub_category_scores") or parsed.get("category_scores"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            said = []
            for text in batch.text:
                for _ in range(ATTEMPTS):
                    answer = client.chat(prompt_for(targets, text))
                    if usable(answer):
                        break
                said.append(answer)
            yield pd.DataFrame({"row_id": batch.row_id, "row_ord": batch.row_ord, "response": said})

    rows = rows.select("row_id", "row_ord", "text").where(F.trim(F.coalesce("text", F.lit(""))) != "")
    if done is not None:
        rows = rows.join(done.select("row_id"), "row_id", "left_anti")
    return rows.mapInPandas(run, "row_id string, row_ord long, response string")


