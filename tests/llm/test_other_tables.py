"""Top-k search, URL rules, components, the pipeline and the catalogue."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftlens.llm import catalog, topk, url_rules
from driftlens.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_top(rows, k):
    """Sorted (query_id, rank, vec_id, score); each row is a row of its own, whatever its id."""
    out = []
    for at, (q, v) in enumerate(rows):
        if q % 50:
            continue
        cut = lambda x: max(-topk.MOST, min(topk.MOST, x))
        scored = sorted((-cut(sum(a * b for a, b in zip(v, w, strict=False))), i) for n, (i, w) in enumerate(rows) if n != at)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,dims,spread", [(300, 6, 3), (700, 3, 1), (60, 4, 10**7), (3, 2, 5), (120, 3, 10**9), (120, 4, 10**17)])
def test_top_k(spark, monkeypatch, n, dims, spread):
    """Many ties, wide ranges, and fewer rows than k; small blocks."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    rng = np.random.default_rng(n)
    rows = [(k, [int(x) for x in rng.integers(-spread, spread + 1, dims)]) for k in range(n)]
    rows += [rows[0], (0, rows[1][1]), (1, rows[0][1])]  # a repeated row, and repeated ids with other vectors
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "row long, vec_id long, v array<long>").repartition(3)
    got = topk.top_k(frame.where("vec_id % 50 = 0"), frame).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, 5)


def test_vectors(spark):
    rows = [(0, [0.5, -0.25]), (50, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [0.001, -0.001]), (7, [])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)))
    assert {r["vec_id"]: r["v"] for r in vectors.collect()} == {0: [128, -64], 50: [256, 512], 6: [0, -1], 7: []}
    found = topk.top_k(vectors.where("vec_id % 50 = 0"), vectors).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == {(0, 1, 6, 64), (0, 2, 7, 0), (0, 3, 50, 0), (50, 1, 0, 0), (50, 2, 7, 0), (50, 3, 6, -512)}
    assert topk.top_k(vectors.where("false"), vectors).count() == 0
    large = spark.createDataFrame([(0, [2.0**30]), (50, [1.5e10, 1e300]), (50, [-1e300]), (7, [4194304.5, 0.5]), (7, [1.0])], "vec_id long, embedding array<double>")
    whole = [(0, [2**38]), (50, [int(1.5e10 * 256), topk.MOST]), (50, [-topk.MOST]), (7, [4194304 * 256 + 128, 128]), (7, [256])]
    wide = topk.integer_vectors(large)
    assert sorted((r["vec_id"], r["v"]) for r in wide.collect()) == sorted(whole)
    assert sorted(tuple(r) for r in topk.top_k(wide.where("vec_id % 50 = 0"), wide).collect()) == brute_top(whole, 5)
    assert topk.top_k(vectors.where("vec_id = 0"), vectors.where("false")).count() == 0


def brute_rule(host, path, rules):
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_url_rules(spark):
    rng = np.random.default_rng(0)
    labels = ["a", "b", "ab", "com", "net", "x-1", "ü"]
    some = lambda k: ".".join(rng.choice(labels, rng.integers(1, k)))
    paths = ["/", "/a", "/a/b", "/ab", "", "/a/b/c?x"]
    rules = [(str(rng.choice(["allow", "block"])), some(4), str(rng.choice(paths[:5]))) for _ in range(60)]
    rules += [("block", "com", "/"), ("allow", "com", "/"), ("allow", "", "/"), (None, "net", "/")]
    urls = [f"http{'s' * int(rng.integers(2))}://{some(6).upper() if k % 3 else some(6)}{rng.choice(paths)}#f" for k in range(400)]
    urls += [None, "", "no-scheme.com/x", "http://", "://com/a", "http://com", "http://a.com:80/a", "http://..com//", "x" * 20000 + "://com/" + "y" * 20000, urls[0], urls[0]]
    pages = spark.createDataFrame([(None if k == 7 else k, u, "h", 1) for k, u in enumerate(urls)], "page_id long, url string, html string, rule int").repartition(4)
    frame = spark.createDataFrame(rules, "verdict string, host string, path string")
    rows = url_rules.judge_urls(pages, frame).collect()
    assert len(rows) == len(urls)
    fixed = [r for r in rules if r[0]]
    for r in rows:
        u = urls[7 if r["page_id"] is None else r["page_id"]]
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
        path = rest[cut:].split("?")[0].split("#")[0]
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == tuple(brute_rule(host, path, fixed))
    assert url_rules.judge_urls(pages.where("false"), frame).count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages, frame.where("false")).collect()} == {"allow"}


def test_components(spark):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(-500, 500, (420, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000 + k) for k in range(1, 300)] + [(1, 1), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    """Stages keep the columns of documents; each works on what the one before it kept, also on nothing."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scan", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs.limit(120)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.schema.names == docs.schema.names
        rows = out.collect()
        assert 0 < len(rows) <= left.count()
        left = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in left.collect()}
    blank = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, blank, SF).count() == 0


def test_catalog():
    import __spark_entry__ as entry

    assert sorted(n.split("_")[0] for n in catalog.QUERIES) == sorted(f"op{k}" for k in range(1, 11))
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES) and entry.queries()["pipeline"] is corpus_pipeline.run
