"""Flat-file sources: CSV, NDJSON, taxonomies; and single-file sinks for people."""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import defaults
from ..functions.text import number, strip, text_or_blank


def read_csv(spark: SparkSession, path: str | list[str], required: Sequence[str] = ()) -> DataFrame:
    """A CSV with a header, all strings, blanks as '', quoted line breaks kept; missing columns raise."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_text_rows(spark: SparkSession, path: str, id_column: str, text_column: str) -> DataFrame:
    """(row_id, text, row_ord): ids stripped, all rows kept, in file order."""
    df = read_csv(spark, path, (id_column, text_column))
    return df.select(strip(id_column).alias("row_id"), F.col(f"`{text_column}`").alias("text"), F.monotonically_increasing_id().alias("row_ord"))


def read_scores(spark: SparkSession, path: str, on_bad: str = "skip") -> DataFrame:
    """A score table with ``score`` as a double: bad numbers are skipped, become zero (``zero``) or raise (``fail``)."""
    df = read_csv(spark, path, ("row_id", "score"))
    if on_bad == "fail":
        return df.withColumn("score", F.col("score").cast("double"))
    df = df.withColumn("score", number("score"))
    return df.na.fill({"score": 0.0}) if on_bad == "zero" else df.where("score IS NOT NULL")


def read_memo_csvs(spark: SparkSession, root: str) -> DataFrame:
    """All memo chunk files below ``root`` with ``source_file``; files may lack columns.  Files with one
    and the same header are read together."""
    pattern = "taskmemo_chunks_*.csv"
    first = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    heads = first.select(F.col("_metadata.file_path").alias("f"), F.split(F.regexp_replace("value", "^﻿", ""), r"[\r\n]").getItem(0).alias("h"))
    groups = heads.groupBy("h").agg(F.sort_array(F.collect_list("f")).alias("files")).collect()  # one row for each distinct header
    out = None
    for g in sorted(groups, key=lambda r: r["files"][0]):
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(g["files"])
        df = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns], F.col("_metadata.file_path").alias("source_file"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*defaults.MEMO_COLUMNS, "source_file")))
    for c in defaults.MEMO_COLUMNS:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit("")) if c in out.columns else F.lit(""))
    return out


CHECKPOINT = "row_id string, parsed string"


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, parsed JSON text) of an NDJSON checkpoint: malformed and blank lines and blank ids are
    dropped, of one id the last line counts."""
    lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("ord"))
    rows = lines.select("ord", "f", F.get_json_object("value", "$.row_id").alias("row_id"), F.get_json_object("value", "$.parsed").alias("parsed"))
    rows = rows.where("row_id IS NOT NULL AND row_id <> '' AND parsed IS NOT NULL")
    return rows.groupBy("row_id").agg(F.max_by("parsed", F.struct("f", "ord")).alias("parsed"))


class Target(NamedTuple):
    """A category (sub_category_id blank) or one of its sub-categories."""

    ord: int
    category_id: str
    sub_category_id: str
    label: str
    description: str
    seeds: tuple[str, ...]
    category_seeds: tuple[str, ...]


class Taxonomy(NamedTuple):
    name: str
    version: int
    description: str
    default_threshold: float
    categories: tuple[Target, ...]
    subs: tuple[Target, ...]


def parse_taxonomy(data: dict) -> Taxonomy:
    """A checked taxonomy: a name, one category or more, one sub-category or more in each, unique ids."""
    if not isinstance(data, dict) or not data.get("name"):
        raise ValueError("a taxonomy needs a name")
    categories, subs = [], []
    for c in data.get("categories") or []:
        if not c.get("id"):
            raise ValueError("a category needs an id")
        seeds = tuple(map(str, c.get("seed_keywords") or ()))
        categories.append(Target(len(categories), str(c["id"]), "", str(c.get("label") or c["id"]), str(c.get("description") or ""), seeds, ()))
        own = c.get("sub_categories") or []
        if not own:
            raise ValueError(f"category {c['id']} needs a sub-category")
        for s in own:
            if not s.get("id"):
                raise ValueError(f"a sub-category of {c['id']} needs an id")
            subs.append(Target(len(subs), str(c["id"]), str(s["id"]), str(s.get("label") or s["id"]), str(s.get("description") or ""), tuple(map(str, s.get("seed_keywords") or ())), seeds))
    if not categories:
        raise ValueError("a taxonomy needs a category")
    for kind in ([c.category_id for c in categories], [(s.category_id, s.sub_category_id) for s in subs]):
        if len(kind) != len(set(kind)):
            raise ValueError("ids must be unique")
    threshold = data.get("default_threshold")
    return Taxonomy(str(data["name"]), int(data.get("version") or 1), str(data.get("description") or ""), float(defaults.TFIDF_THRESHOLD if threshold is None else threshold), tuple(categories), tuple(subs))


def load_taxonomy(path: str) -> Taxonomy:
    """From a YAML file (or JSON, which needs no YAML library)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return parse_taxonomy(json.loads(text))
    import yaml

    return parse_taxonomy(yaml.safe_load(text))


def targets_frame(spark: SparkSession, targets: Sequence[Target]) -> DataFrame:
    """Targets as a small table (as many rows as the taxonomy declares)."""
    schema = "ord int, category_id string, sub_category_id string, label string, description string, seeds array<string>, category_seeds array<string>"
    return spark.createDataFrame([(t.ord, t.category_id, t.sub_category_id, t.label, t.description, list(t.seeds), list(t.category_seeds)) for t in targets], schema)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> int:
    """One CSV file with a byte order mark and header, written row by row on the driver; returns the rows
    written.  For reports; large tables go to Parquet."""
    columns = list(columns or df.columns)
    rows = df.select(*[F.array_join(c, "; ").alias(c) if dict(df.dtypes)[c].startswith("array") else F.col(c) for c in columns])
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for row in rows.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_json(value: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False, default=str)


def dump_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """One CSV for each table; returns its rows."""
    return {name: write_csv(df.drop("ord", "source_file"), f"{folder}/{name}.csv") for name, df in tables.items()}


def label_columns(df: DataFrame) -> DataFrame:
    """Evaluation labels: ids stripped, sub_category_id blank where there is none."""
    sub = text_or_blank("sub_category_id") if "sub_category_id" in df.columns else F.lit("")
    return df.select(text_or_blank("row_id").alias("row_id"), text_or_blank("category_id").alias("category_id"), sub.alias("sub_category_id"))
