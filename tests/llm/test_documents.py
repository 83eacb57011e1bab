"""Operators on documents: brute force, and edge cases that all of them must take."""

import collections
import itertools
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftlens.llm import common, decontamination, licenses, near_dups, packing, secret_scan, sharding, token_counts, toxicity
from driftlens.llm.components import components

LONG = "word " * 30_000 + "end"
TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "One two three four five six",
    "one two three four five six",
    "one two three four five six",
    "Café ÉTÉ naïve 漢字   x　y",
    "x" * 5000,
    LONG,
    "This is under the MIT License, or the mit\nlicense; Apache  License!",
    'db token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" and order 1234567890123456789012',
    "a  b   c \n\n d <|endoftext|> \x00 'll we've",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, blanks, repeated rows and ids, very long texts, and columns whose names operators use too."""
    rows = [(None if k == 3 else k // 2, t, "en", "src0", 1, 7, 0.5, "c") for k, t in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, component_id string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_sharding(docs, none):
    rows = sharding.shuffle_into_shards(docs, 5).collect()
    assert collections.Counter(r["text"] for r in rows) == collections.Counter(TEXTS)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert sorted(map(len, by.values())) == [2, 2, 3, 3, 3]
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shuffle_into_shards(none, 5).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs, 0)


def test_sharding_query(spark):
    """The query's columns against the documents themselves."""
    rows = sharding.op10_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(texts.keys())
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[k]) for k in range(24)]
    assert set(slots) <= set(range(24)) and max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding_keeps_clashing_columns(spark):
    frame = spark.createDataFrame([(k, -k, 5, "c") for k in range(20)], "__id long, __n long, shard int, __cell string")
    rows = sharding.shuffle_into_shards(frame, 3).collect()
    assert sorted((r["__id"], r["__n"], r["__cell"]) for r in rows) == [(k, -k, "c") for k in range(20)] and {r["shard"] for r in rows} == {0, 1, 2}


def test_matrix_is_uniform():
    """Over many draws the first cell has the hypergeometric mean and variance; sums always hold."""
    first = []
    for seed in range(3000):
        m = sharding.communication_matrix([4, 6, 2], [5, 4, 3], seed)
        assert [sum(r) for r in m] == [4, 6, 2] and [sum(c) for c in zip(*m, strict=True)] == [5, 4, 3]
        first.append(m[0][0])
    assert abs(np.mean(first) - 4 * 5 / 12) < 0.06
    assert abs(np.var(first) - 4 * (5 / 12) * (7 / 12) * (8 / 11)) < 0.06


def test_large_hypergeometric():
    rng = np.random.default_rng(1)
    drawn = [sharding._hypergeometric(rng, 10**10, 10**10, 10**6) for _ in range(300)]
    assert abs(np.mean(drawn) - 5e5) < 150 and 350 < np.std(drawn) < 650


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return path, t


def test_encoder_equals_tokenizer(tokenizer):
    import random

    path, t = tokenizer
    encoder, rng = packing.WordEncoder(path), random.Random(5)
    texts = [x or "" for x in TEXTS]
    for signs in (" \n\t 　 ab'sé12.!\r中 's't", "abé1.' \n'", "ab \n\x00Ġ"):
        texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(1500)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing(docs, none, tokenizer):
    rows = packing.pack_documents(docs, tokenizer[0]).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = 0
    for t in TEXTS:
        ids = np.array([*tokenizer[1].encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        want = {(0, 0, first, zlib.crc32(ids[:first].tobytes()))}
        want |= {(k + 1, s, 1024, zlib.crc32(ids[s : s + 1024].tobytes())) for k, s in enumerate(range(first, len(ids), 1024))}
        assert want <= {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows}
    assert sum(r["length"] for r in rows) == total
    assert len(sequences) <= -(-total // 1024) + 1
    assert packing.pack_documents(none, tokenizer[0]).count() == 0


def test_slack_plan():
    rng = np.random.default_rng(0)
    for _ in range(30):
        histogram = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, 101, 25)}
        plan = packing.slack_plan(histogram, 100)
        used = collections.Counter()
        for combination, bins in plan:
            assert sum(k * n for k, n in combination.items()) <= 100 and bins > 0
            for k, n in combination.items():
                used[k] += n * bins
        assert used == histogram
    assert packing._fullest({60: 1, 30: 2, 25: 3, 10: 1}, 100) == {60: 1, 30: 1, 10: 1}
    assert packing.slack_plan({}, 100) == []


def brute_print(text, n):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0d]+", low)
    runs = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark, docs, none):
    got = near_dups.near_duplicate_groups(docs.select(F.col("doc_id").alias("key"), "text", "score"))
    rows = got.collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r["fingerprint"] for r in rows) == sorted(format(brute_print(t, 4), "016x") for t in TEXTS)
    assert near_dups.near_duplicate_groups(none.select(F.col("doc_id").alias("key"), "text")).count() == 0


def brute_components(near):
    """The smallest reachable index of each node of a graph, from its matrix of links."""
    root = np.arange(len(near))
    while True:
        smallest = np.array([root[near[k]].min() for k in range(len(near))])
        if (smallest == root).all():
            return root
        root = smallest


@pytest.mark.parametrize("cell_rows,block_rows,rows", [(16384, 32768, 0), (8, 16, 0), (8, 40, 1 << 27)])
def test_simhash_components(spark, monkeypatch, cell_rows, block_rows, rows):
    """Fingerprints around few centres, against all pairs; also with cells so small that hot ones are
    split, and with the scheme of halves for large tables."""
    monkeypatch.setattr(near_dups, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(near_dups, "BLOCK_PAIRS", 50)
    rng = np.random.default_rng(3)
    prints = []
    for c in rng.integers(0, 2**63, 6, dtype=np.uint64):
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            prints.append(int(c) ^ sum(1 << int(b) for b in flips))
    prints = np.array(sorted(set(prints)), dtype=np.uint64)
    prints = prints[np.argsort(prints.view(np.int64))]
    signed, root = prints.view(np.int64), brute_components(np.bitwise_count(prints[:, None] ^ prints[None]) <= 4)
    frame = spark.createDataFrame([(int(x), int(x)) for x in signed], "node long, f0 long").repartition(3)
    scheme = near_dups.close_scheme(rows)
    groups = {r["node"]: r["root"] for r in components(near_dups.loose_links(frame, scheme, len(prints))).collect()}
    assert {int(x): int(signed[r]) for x, r in zip(signed, root, strict=True)} == {int(x): groups.get(int(x), int(x)) for x in signed}


@pytest.mark.parametrize("seed,ball,radius,distance", [(1, 6, 2, 9), (2, 4, 1, 6), (3, 0, 0, 5)])
def test_links_of_cells(seed, ball, radius, distance):
    """In each unit the components of all pairs in each other's ball, by brute force."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    rows = np.array([int(centres[rng.integers(5)]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(150)], np.uint64)[:, None]
    unit, inside = rng.integers(0, 3, 150), (rows[:, 0] & np.uint64((1 << ball) - 1)).astype(np.int64)
    node = rng.permutation(150).astype(np.int64)
    scheme = near_dups.Scheme(4, 1, distance, ())
    a, b = near_dups._near_links(scheme, unit, inside, node, rows, ball, radius)
    near = (unit[:, None] == unit[None]) & (np.bitwise_count(rows ^ rows.T) <= distance) & (np.bitwise_count(inside[:, None] ^ inside[None]) <= radius)
    want, at = brute_components(near), np.argsort(node)
    got = near_dups._labels(150, at[a], at[b])
    assert len({*zip(want.tolist(), got.tolist(), strict=True)}) == len(set(want.tolist())) == len(set(got.tolist()))
    assert len(a) == 150 - len(set(want.tolist()))


def shingles(text):
    low = text.translate({k: k + 32 for k in range(65, 91)}).split()
    return {" ".join(low[k : k + 5]) for k in range(max(1, len(low) - 4))} if low else set()


@pytest.fixture(scope="module")
def families():
    """Copies of five texts with ever more words replaced, some of which are less similar than asked for."""
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(5):
        words = [f"v{x}" for x in rng.integers(0, 10**6, 200)]
        for changed in range(0, 14):
            copy = list(words)
            for at in rng.choice(200, changed, replace=False):
                copy[at] = f"c{rng.integers(10**6)}"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("anchors,class_rows", [(64, 2048), (2, 3)])
def test_verified_groups(spark, monkeypatch, families, anchors, class_rows):
    """All texts in one class: the components of cosine 0.8, exactly, however many rounds it takes."""
    monkeypatch.setattr(near_dups, "ANCHORS", anchors)
    monkeypatch.setattr(near_dups, "CLASS_ROWS", class_rows)
    sets = [shingles(t) for t in families]
    near = np.array([[25 * len(a & b) ** 2 >= 16 * len(a) * len(b) for b in sets] for a in sets])
    want = brute_components(near)
    texts = spark.createDataFrame(list(enumerate(families)), "node long, text string").repartition(3)
    classes = texts.select("node", F.lit(0).cast("long").alias("root"))
    found = {r["node"]: r["root"] for r in near_dups.verified_groups(classes, texts, near_dups.similar_scheme(100)).collect()}
    assert [found.get(k, k) for k in range(len(families))] == want.tolist() and 5 < len(set(want.tolist())) < 40


def test_similar_texts_are_found(spark, families):
    """The whole search against all pairs: nothing below the similarity is joined, hardly anything missed."""
    sets = [shingles(t) for t in families]
    want = brute_components(np.array([[25 * len(a & b) ** 2 >= 16 * len(a) * len(b) for b in sets] for a in sets]))
    frame = spark.createDataFrame(list(enumerate(families)), "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in near_dups.keep_one_of_each(frame).collect()}
    assert set(want.tolist()) <= kept and len(kept) <= len(set(want.tolist())) + 2


def test_schemes_grow_with_the_table():
    sizes = [near_dups.similar_scheme(10**k) for k in (2, 5, 8)]
    assert [len(s.segments[0].cell) for s in sizes] == sorted(len(s.segments[0].cell) for s in sizes) and len(sizes[0].segments) < len(sizes[2].segments)
    assert all(len(set(x.cell + x.ball)) == len(x.cell) + 12 for s in sizes for x in s.segments) and all(s.distance == 50 for s in sizes)


def test_keep_one(spark, docs):
    text = " ".join(f"w{k}" for k in range(300))
    near = text.replace("w150", "other")
    rows = [(5, text), (3, near), (9, text), (9, text), (1, "quite another text with words of its own"), (None, text), (None, None), (None, None)]
    frame = spark.createDataFrame([(k, t, "x", 7, 0) for k, t in rows], "doc_id long, text string, lang string, __row long, __id long")
    kept = near_dups.keep_one_of_each(frame)
    assert kept.columns == frame.columns and {r["__row"] for r in kept.collect()} == {7}
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) == [-1, 1, 3]
    assert near_dups.keep_one_of_each(docs).count() < len(TEXTS) and near_dups.keep_one_of_each(docs.where("false")).count() == 0


@pytest.fixture
def broadcast_rows(monkeypatch):
    """How many rows each table has that is given to a broadcast."""
    seen, broadcast = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: seen.append(df.count()) or broadcast(df))
    return seen


def test_keep_one_broadcasts_no_table_that_grows(spark, tmp_path, broadcast_rows):
    """The driver holds what is broadcast: 70,000 rows to drop, of as many groups, are too many for that."""
    text = F.concat_ws(" ", *[F.xxhash64(F.col("id") % 70_000, F.lit(c)).cast("string") for c in range(20)])
    spark.range(0, 140_000, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(f"{tmp_path}/docs")
    kept = near_dups.keep_one_of_each(spark.read.parquet(f"{tmp_path}/docs"))
    assert kept.agg(F.count("*"), F.countDistinct("doc_id"), F.max("doc_id")).first()[:] == (70_000, 70_000, 69_999)
    assert broadcast_rows and max(broadcast_rows) <= 65_536


def test_repeated_rows_are_not_broadcast(spark, monkeypatch):
    """A loose class of unlike texts: each meets many sets of anchors, and what is repeated for that has no bound."""
    rows, repeated = [], near_dups.stash
    monkeypatch.setattr(near_dups, "ANCHORS", 2)

    def stash(df, label):
        if label == "verified":
            plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
            at = {k: next((i for i, line in enumerate(plan) if k in line), 0) for k in ("Generate", "Join")}
            rows.append(at["Generate"] < at["Join"])  # repeated above the join
        return repeated(df, label)

    monkeypatch.setattr(near_dups, "stash", stash)
    texts = spark.range(300).select(F.col("id").alias("node"), F.concat_ws(" ", *[F.xxhash64("id", F.lit(c)).cast("string") for c in range(8)]).alias("text"))
    found = near_dups.verified_groups(texts.select("node", F.lit(0).cast("long").alias("root")), texts, near_dups.similar_scheme(100))
    assert found.count() == 0 and len(rows) > 2 and all(rows)


@pytest.mark.parametrize("maps", [8192, 0])
def test_similar_texts_without_broadcasts(spark, monkeypatch, families, broadcast_rows, tmp_path, maps):
    """With every table too large for a broadcast the same rows stay, by bit maps and by joins."""
    frame = spark.createDataFrame(list(enumerate(families)), "doc_id long, text string").repartition(3)
    frame.write.parquet(f"{tmp_path}/docs")
    frame = spark.read.parquet(f"{tmp_path}/docs")
    want = {r["doc_id"] for r in near_dups.keep_one_of_each(frame).collect()}
    for module in (common, near_dups):
        monkeypatch.setattr(module, "CORPUS_KEYS", 2)
    monkeypatch.setattr(common, "MAP_ROWS", maps)
    monkeypatch.setattr(near_dups, "ANCHORS", 2)
    broadcast_rows.clear()
    assert {r["doc_id"] for r in near_dups.keep_one_of_each(frame).collect()} == want and max(broadcast_rows) <= 3


@pytest.mark.parametrize("maps", [8192, 0])
def test_drop_rows_by_bit_maps(spark, monkeypatch, maps):
    monkeypatch.setattr(common, "CORPUS_KEYS", 2)
    monkeypatch.setattr(common, "MAP_ROWS", maps)
    keys = [None, -(2**63), -8193, -1, 0, 1, 7, 8, 8191, 8192, 2**40 - 1, 2**40, 2**40 + 8191, 2**63 - 1]
    rows = spark.createDataFrame([(k, k) for k in keys], "key long, __bits long")
    gone = spark.createDataFrame([(k,) for k in keys[1::2]], "key long")
    left = common.drop_rows(rows, gone, "key")
    assert left.columns == rows.columns and {r["key"] for r in left.collect()} == set(keys[::2])
    if maps:
        assert {r["key"] for r in common.rows_of(rows, gone, "key", there=True).collect()} == set(keys[1::2])


def test_licenses(docs, none):
    rows = [r.asDict() for r in licenses.license_scan(docs).collect()]
    assert len(rows) == len(TEXTS)
    for t in TEXTS:
        low = (t or "").translate({i: i + 32 for i in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [k for p in licenses.BASE_PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        assert any(r["n_words"] == len(words) and r["n_base"] == len(at) and r["first_word"] == min(at, default=None) and r["last_word"] == max(at, default=None) for r in rows)
    notice = next(r for r in rows if r["n_base"])
    assert notice["base_labels"] == "apache,mit" and 0 <= notice["score"] <= 1
    assert licenses.license_scan(none).count() == 0


def brute_license(text):
    """(labels, score) by regular expressions, with expressions of at most one kind of operator."""
    low = (text or "").translate({k: k + 32 for k in range(65, 91)})
    line = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)) + " "
    labels, doubt = set(), 1.0
    for phrase, label in {**licenses.NOTICE_PHRASES, **licenses.BASE_PHRASES}.items():
        n = len(re.findall(f"(?= {phrase} )", line))
        labels |= {label} if n else set()
        doubt *= 0.4**n
    for m in re.finditer(r"spdx-license-identifier:? *([^\n]*)", low):
        operands = re.findall(r"[a-z0-9][a-z0-9.+\-]*", m[1])
        names = [licenses.family(x) for x in operands[::2]] if " with " not in m[1] else [licenses.family(operands[0])]
        needed = len(set(operands[::2])) == 1 or " or " not in m[1]
        known = {x for x in names if x}
        labels |= known
        doubt *= 1 - ((0.95 if needed else 0.8) if known else 0.3)
    return ",".join(sorted(labels)), round(1 - doubt, 9)


def test_license_labels_and_scores(spark):
    tag = "// SPDX-License-Identifier: "
    lines = ["MIT", "MIT OR Apache-2.0", "MIT AND Apache-2.0", "MIT OR MIT", "GPL-2.0-only WITH Classpath-exception-2.0", "Unheard-1.0", "MIT OR Unheard", "0BSD AND ISC"]
    texts = [tag + x + "\nfurther text" for x in lines] + ["the MIT License and the BSD license, MIT license", "mozilla public license " * 3, None, "", "permit license", tag + "MIT\n" + tag + "MPL-2.0 OR EPL-2.0\nisc license"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_scan(frame).collect()}
    assert {k: (r["labels"], round(r["score"], 9)) for k, r in rows.items()} == {k: brute_license(t) for k, t in enumerate(texts)}
    assert [rows[k]["needed_labels"] for k in range(8)] == ["mit", "", "apache,mit", "mit", "gpl", "", "", "isc"]
    assert rows[4]["exceptions"] == "classpath-exception-2.0" and rows[1]["score"] < rows[2]["score"] and rows[1]["labels"] == rows[2]["labels"]


def test_license_expressions():
    e = licenses.parse_expression("mit or (apache-2.0 and gpl-2.0-only with classpath-exception-2.0). more")
    assert e.identifiers == {"mit", "apache-2.0", "gpl-2.0-only"} and e.exceptions == {"classpath-exception-2.0"} and e.needed == set()
    assert licenses.parse_expression("a and b or a").needed == {"a"}
    assert licenses.parse_expression("a and (b or a)").needed == {"a"}
    assert licenses.parse_expression("and") is None and licenses.parse_expression("") is None
    assert licenses.parse_expression("(mit").identifiers == {"mit"}
    assert licenses.family("gpl-2.0+") == "gpl" and licenses.family("mitigate") is None and licenses.family("cc-by-4.0") == "cc-by"
    row = licenses.scan(b"// SPDX-License-Identifier: (MIT OR LGPL-2.1-only)\ncode", licenses._automaton())
    assert row[5] == "lgpl,mit" and row[4] == "" and row[1] == 0


def test_token_counts(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer, models

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    scores = token_counts.unigram_scores(path)
    rows = token_counts.token_counts(docs, path).collect()
    assert len(rows) == len(TEXTS) and token_counts.token_counts(none, path).count() == 0
    plain = Tokenizer(models.Unigram([("<unk>", -1e3), *scores.items()], unk_id=0, byte_fallback=False))
    words = sorted({token_counts.BLANK + w for t in TEXTS if t for w in t.split() if all(c in scores for c in w)} | {token_counts.BLANK + w for w in ("internationalisation", "unbelievable", "prefixes", "prefixed")})
    counter = token_counts.TrieCounter(scores)
    assert list(counter._count(words)) == [len(plain.encode(w).ids) for w in words]
    assert token_counts.TrieCounter({"a": -1.0, "ab": -1.5}).counts(["", "漢"]) == [(0, 0), (1, 6)]


def test_decontamination(spark, docs, none):
    rng = np.random.default_rng(1)
    words = lambda n: [f"q{x}" for x in rng.integers(0, 10**6, n)]
    item, other = words(40), words(20)
    changed = list(item)
    for at in (5, 13, 22, 30):
        changed[at] = "swap"
    rows = [(1, words(30) + item + words(30)), (2, words(5) + changed), (3, words(80)), (4, item[:14] + words(20)), (5, item[:10] + words(20)), (None, item), (7, words(2000) + item[10:30] + words(100) + other)]
    texts = [(k, " ".join(w).upper() + "!") for k, w in rows] + [(8, None), (9, "")]
    frame = spark.createDataFrame(texts, "key long, text string")
    benchmark = spark.createDataFrame([(3, " ".join(item)), (1, ", ".join(item)), (2, " ".join(other)), (None, None), (6, "")], "item_id long, text string")
    found = {(r["key"], r["item_id"]): r for r in decontamination.benchmark_overlaps(frame, benchmark).collect()}
    both = {(k, i) for k in (1, 2, 4, None, 7) for i in (1, 3)}  # items 1 and 3 have the same words
    assert set(found) == both | {(7, 2)} and all(found[k, 1][2:] == found[k, 3][2:] for k in (1, 2, 4, None, 7))
    assert found[1, 1][2:] == (30, 0, 40, 40) and found[2, 1]["n_equal"] == 36 and found[4, 1]["n_words"] == 14
    assert found[7, 1]["doc_start"] == 2000 and found[7, 1]["item_start"] == 10
    kept = decontamination.decontaminate(frame.withColumnRenamed("key", "doc_id").withColumn("__row", F.lit(4)), benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 8, 9] and kept.columns == ["doc_id", "text", "__row"]
    assert decontamination.decontaminate(docs, benchmark).count() == len(TEXTS)
    keyed = none.select(F.col("doc_id").alias("key"), "text")
    assert decontamination.benchmark_overlaps(keyed, benchmark).count() == 0
    assert decontamination.benchmark_overlaps(frame, benchmark.where("false")).count() == 0


def test_overlap_tries_all_runs_of_a_diagonal():
    """Against all runs by brute force; passages of which less than 0.8 are equal as a whole are among them."""
    rng, lost = np.random.default_rng(6), 0
    patterns = [np.arange(59) % 22 < 15, np.arange(59) % 19 < 13, np.arange(180) < 20 + 160 * (np.arange(180) % 4 < 3), np.arange(13) < 12]
    patterns += [np.isin(np.arange(59), rng.choice(59, k, replace=False), invert=True) for k in rng.integers(8, 22, 300)]
    for k, equal in enumerate(patterns):
        item = np.arange(len(equal), dtype=np.uint64)
        words = np.concatenate([np.full(3, 10**6, np.uint64), np.where(equal, item, np.uint64(10**7))])
        runs = [(a, b - a, int(equal[a:b].sum())) for a in range(len(equal)) for b in range(a + 13, len(equal) + 1)]
        runs = [(a, n, m) for a, n, m in runs if 10 * m >= 8 * n]
        best = min(runs, key=lambda r: (-r[2], r[1], r[0]), default=None)
        found = decontamination.overlap(words, item, 3)
        assert (found and (found[0] - 3, *found[1:])) == best, k
        lost += found is not None and equal.mean() < 0.8
    assert lost > 30 and decontamination.overlap(words[:12], item, 3) is None


def test_overlaps_equal_a_full_search(spark):
    """Passages of 13 to 40 words with random substitutions, and one of 6,000 words: all diagonals and all
    their runs by brute force."""
    rng = np.random.default_rng(12)
    items = [[f"i{k}w{x}" for x in range(n)] for k, n in enumerate([*rng.integers(13, 41, 30).tolist(), 6000, 500])]
    items.append(items[31][:250] + ["gap"] * 90 + items[31][250:])  # hits of one diagonal far apart
    texts = []
    for k, item in enumerate(items[:30]):
        for share in (0.1, 0.2, 0.3):
            swapped = [w if rng.random() > share else "swap" for w in item]
            texts.append(["before"] * int(rng.integers(0, 90)) + swapped + ["behind"] * 3)
    changed = [w if rng.random() > 0.1 else "swap" for w in items[30]]
    texts += [changed, ["x"] * 10 + items[31][:250] + ["y"] * 90 + items[31][250:], items[3][5:] + items[4], []]
    want = {}
    for d, words in enumerate(texts):
        for i, item in enumerate(items):
            place = {w: k for k, w in enumerate(item)} if len(set(item)) == len(item) else None
            shifts = {k - place[w] for k, w in enumerate(words) if w in place} if place else {k - j for k, w in enumerate(words) for j, v in enumerate(item) if w == v}
            for shift in shifts:
                low, high = max(0, shift), min(len(words), shift + len(item))
                equal = np.array([words[k] == item[k - shift] for k in range(low, high)], bool)
                counts, best = np.concatenate([[0], np.cumsum(equal)]), None
                spare = 5 * counts - 4 * np.arange(len(counts))
                for start in range(len(equal) - 12):
                    ends = start + 13 + np.flatnonzero(spare[start + 13 :] >= spare[start])
                    if len(ends):
                        most = counts[ends].max()
                        run = (int(counts[start] - most), int(ends[counts[ends] == most].min()) - start, low + start)
                        best = run if best is None else min(best, run)
                if best:
                    found = (*best, best[2] - shift)
                    want[d, i] = min(want.get((d, i), found), found)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "key long, text string").repartition(4)
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r["key"], r["item_id"]): (-r["n_equal"], r["n_words"], r["doc_start"], r["item_start"]) for r in decontamination.benchmark_overlaps(frame, benchmark).collect()}
    assert got == want and len(want) > 60 and want[90, 30][1] > 5900


def test_masks_fit_all_patterns():
    """Every pattern of 13 to 25 words with 0.8 equal holds a mask; longer ones hold one of these, since
    of two halves of 13 words or more one is as equal as the whole."""
    for n in range(decontamination.LEAST_WORDS, 2 * decontamination.LEAST_WORDS):
        changed = int(n * (1 - decontamination.LEAST_EQUAL) + 1e-9)
        patterns = np.array([sum(1 << at for at in c) for c in itertools.combinations(range(n), changed)])
        missed = np.ones(len(patterns), bool)
        for mask in decontamination.MASKS:
            for at in range(n - len(mask) + 1):
                missed &= patterns & sum(1 << at + k for k, sign in enumerate(mask) if sign == "1") != 0
        assert not missed.any(), n


def test_short_items_are_found(spark):
    """Items of 13 to 16 words with as many substitutions as the rule allows, at all places."""
    rows, items = [], []
    for n, changed in ((13, 2), (15, 3), (16, 3)):
        word = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(word)))
        for c in itertools.combinations(range(n), changed):
            rows.append((len(rows), " ".join(["before it", *("swap" if k in c else w for k, w in enumerate(word)), "behind"])))
    frame = spark.createDataFrame(rows, "key long, text string").repartition(4)
    found = decontamination.benchmark_overlaps(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert found.select("key").distinct().count() == len(rows) == 78 + 455 + 560


def test_hasher_cuts_long_texts(monkeypatch):
    text = (" ".join(f"a{k}" for k in range(5000))).encode()
    whole = decontamination.Hasher()(text)
    monkeypatch.setattr(decontamination, "BATCH_BYTES", 1000)
    assert (decontamination.Hasher()(text) == whole).all() and len(set(whole.tolist())) == 5000


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("aeioulmnrst"), rng.integers(3, 9))) for _ in range(2000)]
    rows, labels = [], []
    for k in range(1200):
        words = [str(w) for w in rng.choice(vocabulary, 60)]
        toxic = int(k % 5 == 0)
        for _ in range(4 * toxic):
            words[rng.integers(60)] = str(rng.choice(["zorkface", "grubwit", "quibbledunce", "vexhead"]))
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(frame, marks)
    scored = toxicity.toxicity_scores(frame.withColumnRenamed("doc_id", "key"), model).withColumnRenamed("key", "doc_id")
    held = scored.join(marks, "doc_id").where(toxicity.held_out("doc_id")).where("toxic IS NOT NULL").collect()
    assert len(held) > 150 and np.mean([(r["score"] >= 0.5) == bool(r["toxic"]) for r in held]) > 0.95
    again = toxicity.train(frame.repartition(7), marks.repartition(3))
    assert again == model  # whatever the order of rows
    judge = toxicity.Judge(model)
    assert [r["score"] for r in held[:40]] == [judge.score(rows[r["doc_id"]][1].encode()) for r in held[:40]]
    plain, toxic = judge.compressors
    words = rows[0][1].encode()  # the features are what the two compressors give for each window
    gains = sorted((len(plain.compress(w)) - len(toxic.compress(w)) for w in toxicity.windows(words)), reverse=True)
    assert judge.features(words)[1] == min(max(gains[0], 0), toxicity.MOST_GAIN) and b"".join(toxicity.windows(words)) == words
    all_scores = toxicity.toxicity_scores(docs.select(F.col("doc_id").alias("key"), "text"), model).collect()
    assert len(all_scores) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in all_scores)
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() >= len(TEXTS) - 2
    assert toxicity.reject_toxic(none, model).count() == 0
    blank = toxicity.train(none, marks.where("false"))
    assert toxicity.toxicity_scores(docs.select(F.col("doc_id").alias("key"), "text"), blank).count() == len(TEXTS)


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.train_forest(spark)


def test_secrets(spark, docs, none, forest):
    rows = secret_scan.secret_findings(docs.withColumnRenamed("source", "path"), forest).collect()
    hit = [r for r in rows if r["is_secret"]]
    assert len(hit) == 1 and TEXTS[11][hit[0]["start"] : hit[0]["start"] + hit[0]["length"]].startswith("9233a8")
    masked = secret_scan.redact_secrets(docs, forest)
    assert masked.columns == docs.columns
    assert collections.Counter(r["text"] for r in masked.collect()) == collections.Counter('db token = "[SECRET]" and order 1234567890123456789012' if t == TEXTS[11] else t for t in TEXTS)
    assert secret_scan.secret_findings(none.withColumnRenamed("source", "path"), forest).count() == 0
    plan = masked._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_secret_accuracy(spark, forest):
    """Labelled findings that the forest has not seen."""
    findings = secret_scan.labelled_findings(1200, seed=77)
    frame = spark.createDataFrame([(k, f["text"], f["path"]) for k, f in enumerate(findings)], "doc_id long, text string, path string")
    rows = secret_scan.secret_findings(frame, forest).where("finding = 0").collect()
    assert len(rows) == len(findings)
    assert np.mean([r["is_secret"] == bool(findings[r["doc_id"]]["label"]) for r in rows]) > 0.93


def test_forest_in_sql_is_the_trained_model(spark):
    """The expression's probabilities are those of the library's model on the same features."""
    findings = spark.createDataFrame([(f["text"], f["path"], f["label"]) for f in secret_scan.labelled_findings(700, seed=5)], "text string, path string, label int")
    rows = secret_scan.featured(findings).cache()
    model = secret_scan.fit_forest(rows)
    score = secret_scan._forest(F.struct(*secret_scan.FEATURES), secret_scan.trees_of(model))
    both = secret_scan._assembled(rows.withColumn("score", score))
    got = [(r["score"], float(r["probability"][1])) for r in model.transform(both).select("score", "probability").collect()]
    assert len(got) > 600 and all(abs(a - b) < 1e-9 for a, b in got) and len({round(a, 3) for a, _ in got}) > 20


def test_candidates_are_those_of_the_pattern(spark):
    """Java's matches against another engine's, on findings and on the corpus."""
    import regex

    pattern = regex.compile(secret_scan.CANDIDATE)
    texts = [f["text"] for f in secret_scan.labelled_findings(400, seed=9)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = frame.select("doc_id", secret_scan._candidates(F.col("text")).alias("c")).collect()
    for r in cut:
        assert [c["text"] for c in r["c"]] == [m[0] for m in pattern.finditer(texts[r["doc_id"]] or "")], texts[r["doc_id"]][:200]


def test_masking_keeps_clashing_columns(spark, forest):
    frame = spark.createDataFrame([(1, 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"', "kept")], "doc_id long, text string, __found string")
    assert [tuple(r) for r in secret_scan.redact_secrets(frame, forest).collect()] == [(1, 'token = "[SECRET]"', "kept")]


def test_short_and_punctuated_secrets(spark, forest):
    """Values behind a secret word and an assignment, which need neither 16 signs nor a digit."""
    secret = ["hX7k2Qm9", "Tr0ub4dor&3x", "qZ!8v@Lw#2p$Rk", "kQzWvXbTnRjLmPdG", "a8F.k2Lq.Zx91", "vTqXzRbKwLpNcJhGdFsY"]
    lines = [x % v for v in secret for x in ("password = %s", 'api_key: "%s"', "db_password=%s next")]
    plain = ["author: Christopher", "password: required", "the password is remembered by all", "token = tokenizer.encode", "secret: presentation"]
    frame = spark.createDataFrame([(k, t, "src0") for k, t in enumerate(lines + plain)], "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(frame, forest).collect()}
    assert [kept[k] for k in range(len(lines))] == [x % "[SECRET]" for _ in secret for x in ("password = %s", 'api_key: "%s"', "db_password=%s next")]
    assert [kept[len(lines) + k] for k in range(len(plain))] == plain
