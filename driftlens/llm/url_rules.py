"""URL filters by a sort-merge range join.

A rule (host, path) fits its host and all subdomains of it.  Written with its labels in reverse and
a dot behind each, a host starts with the reversed rule's host exactly if the rule fits it, so every
rule's host is an interval of keys, and intervals are nested or apart.  URLs and rules are dealt to
ranges of keys, sorted, and swept once; a stack holds the rules whose interval is open.
"""

from __future__ import annotations


from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from .common import literal_table, stash, table

#: The rules of the query (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
RULE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("verdict", "host", "path")])
#: Behind every key of an interval: no host has a character above it.
LAST = "\U0010ffff"
#: Ranges of keys, and the bounded sample of keys that they are cut by (it only balances them).
RANGES, SAMPLE = 256, 20_000
#: Groups that all rows are dealt to, besides one for each range: a range with a share of the sample
#: gets that share of them, so that a host or page with very many URLs is no single task's.
GROUPS = 1024


def host_of(url):
    """The host of a URL column, A-Z lower-cased: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    """The path of a URL column: what follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host):
    """A host column's reversed labels, each with a dot behind it; empty for an empty host."""
    reverse = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(reverse)


COLUMNS = ("range", "salt", "key", "kind", "path", "page_id", "host", "verdict")
SWEPT = "page_id long, host string, path string, rule string, verdict string"


class Stack:
    """The open intervals, outermost first: of each its host and its rules' paths, with their lengths."""

    def __init__(self):
        self.open: list[tuple[str, str, dict[str, str], set[int]]] = []

    def close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def push(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, host, {}, set()))
        _, _, paths, lengths = self.open[-1]
        if paths.get(path) != "block":
            paths[path] = verdict
        lengths.add(len(path))

    def best(self, key: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; of equally long ones that of the longer host
        (of equal rules with both verdicts, ``block``)."""
        self.close(key)
        found = None
        for _, host, paths, lengths in self.open:
            for n in sorted(lengths, reverse=True):
                if n <= len(path) and path[:n] in paths:
                    if found is None or len(host) + n >= len(found[0]):
                        found = host + path[:n], paths[path[:n]]
                    break
        return found


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, of = Stack(), None
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, salt, key, kind, path, page_id, host, verdict = r
                if (at, salt) != of:
                    stack, of = Stack(), (at, salt)
                if kind == 0:
                    stack.push(key, host, path, verdict)
                    continue
                rule, said = stack.best(key, path) or (None, default)
                out.append((page_id, host, path, rule, said))
            if out:
                types = [pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["page_id", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url), by ``rules``
    (verdict ``allow`` or ``block``, host, path).

    The longest rule that fits gives rule (``hostpath``) and verdict; without one they are null and
    ``default``.  A rule with an empty host, or with a null, fits nothing.  Null URLs and those
    without ``://`` have an empty host and path.  Null page_ids are carried, repeated rows are judged
    each, repeated rules count once, empty tables are allowed on both sides, other columns are ignored.
    """
    spark = pages.sparkSession
    ship_package(spark)
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    urls = urls.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    urls = stash(urls.withColumn("key", key_of(F.col("host"))), "urls")
    total = urls.count()
    sample = urls.select("key", "path").sample(min(1.0, SAMPLE / max(1, total)), seed=7).collect()  # about SAMPLE of all partitions
    marks = sorted({r["key"] for r in sample})
    bounds = marks[:: max(1, len(marks) // RANGES)][1:][: RANGES - 1]  # bounded: at most RANGES keys
    lower = T.StringType()
    edges = F.lit(bounds) if bounds else F.array().cast(T.ArrayType(lower))
    shares = Counter(bisect_right(bounds, r["key"]) for r in sample)
    salts = F.lit([max(1, GROUPS * shares[k] // len(sample)) if sample else 1 for k in range(len(bounds) + 1)])
    order = "range", "salt", "key", "kind"

    def range_of(key):
        return F.size(F.filter(edges, lambda b: b <= key))

    rules = rules.select("verdict", F.lower("host").alias("host"), "path").where("verdict IN ('allow', 'block') AND host <> '' AND path IS NOT NULL").distinct()
    rules = rules.withColumn("key", key_of(F.col("host")))
    spread = F.explode(F.sequence(range_of(F.col("key")), range_of(F.concat("key", F.lit(LAST)))))
    rules = rules.withColumn("range", spread)
    rules = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.get(salts, F.col("range")) - 1)))
    rules = rules.select("range", "salt", "key", F.lit(0).alias("kind"), "path", F.lit(None).cast("long").alias("page_id"), "host", "verdict")
    urls = urls.withColumn("range", range_of(F.col("key")))
    urls = urls.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.get(salts, F.col("range"))).cast("int"))
    urls = urls.select("range", "salt", "key", F.lit(1).alias("kind"), "path", "page_id", "host", F.lit(None).cast("string").alias("verdict"))
    both = rules.union(urls).select(*COLUMNS)
    return both.repartition("range", "salt").sortWithinPartitions(*order).mapInArrow(_sweep(default), SWEPT)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` judged by the fixed rules."""
    rules = literal_table(spark, [{"verdict": v, "host": h, "path": p} for v, h, p in RULES], RULE_SCHEMA)
    return judge_urls(table(spark, sf_dir, "pages"), rules)
