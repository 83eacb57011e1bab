"""A quality classifier of memo texts: TF-IDF of one- and two-word terms and logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise, round4
from .scoring import ngrams

#: Terms at most; rows from which a term must occur in two; rows from which a fifth is held out.
FEATURES, TWO_ROWS, HOLD_OUT_FROM, SEED = 50_000, 30, 10, 42


def _terms(rows: DataFrame) -> DataFrame:
    words = F.regexp_extract_all(normalise("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return rows.withColumn("_w", words).withColumn("_terms", ngrams("_w", 2)).drop("_w")


def train(rows: DataFrame) -> tuple[PipelineModel, dict]:
    """A model of ``rows`` (row_id, text, label boolean) and its accuracy and F1 on a held-out fifth of each
    class (by a hash of the id).  Both classes must occur."""
    rows = rows.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two classes
    if len(counts) < 2:
        raise ValueError("both classes are needed")
    n = sum(counts.values())
    weight = F.when(F.col("label") == 1.0, F.lit(n / (2 * counts[1.0]))).otherwise(F.lit(n / (2 * counts[0.0])))
    terms = _terms(rows).withColumn("weight", weight)
    held = F.pmod(F.xxhash64(F.lit(SEED), F.col("row_id").cast("string")), F.lit(5)) == 0
    fit, test = (terms.where(~held), terms.where(held)) if n >= HOLD_OUT_FROM else (terms, None)
    stages = [
        CountVectorizer(inputCol="_terms", outputCol="_tf", vocabSize=FEATURES, minDF=2.0 if n >= TWO_ROWS else 1.0),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="features"),
        LogisticRegression(weightCol="weight", maxIter=200),
    ]
    model = Pipeline(stages=stages).fit(fit)
    report = {"n_rows": n, "n_yes": counts[1.0], "held_out": test is not None}
    if test is not None and test.limit(1).count():
        predicted = model.transform(test)
        for name in ("accuracy", "f1"):
            report[name] = round(MulticlassClassificationEvaluator(metricName=name).evaluate(predicted), 4)
    return model, report


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``ml_probability``, the probability of a quality cause."""
    scored = model.transform(_terms(rows))
    return scored.select(*rows.columns, round4(vector_to_array("probability")[1]).alias("ml_probability"))


