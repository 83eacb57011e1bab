"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments.  Fingerprints that differ in few bits differ in few bits of at
least one segment, so each looks up, for every segment, all values in a small Hamming ball around
its own; complete distances are then verified.  A segment's ball is looked up in two ways: some bits
name the cell that a row is sent to (values one bit away are sent rows too where the scheme says so),
the others are looked up among the rows of the cell, where a ball costs no exchange.  Only a spanning
forest of the links found in a cell leaves it, so a large group of copies costs no more links than it
has members.  Cells that many fingerprints share are split, and every part still meets every other.

Links of the pipeline's scheme are then verified on the texts themselves (``verified_groups``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship_package
from .common import CORPUS_KEYS, drop_rows, join_few, kept, numbered, rows_of, scratch, stash, table, unstash
from .components import components

#: Rows of one cell that are held together; the rest goes to further parts of the cell.
CELL_ROWS = 16384
#: Rows that are compared in one go, cells being whole, and pairs whose distances are taken together.
BLOCK_ROWS, BLOCK_PAIRS = 32768, 1_000_000
#: Fingerprints that the search for cells to split looks at (splitting only balances work).
COUNTED = 1_000_000
#: Hot cells are looked up by broadcast up to this number of them.
BROADCAST_CELLS = 100_000


class Segment(NamedTuple):
    """``cell``: the bits that name the cell; ``reach``: their flips by which two fingerprints still
    meet in a cell (0, 1 or 2); ``ball``: further bits, of which up to ``radius`` may differ."""

    cell: tuple[int, ...]
    reach: int = 0
    ball: tuple[int, ...] = ()
    radius: int = 0


class Scheme(NamedTuple):
    """How fingerprints are made and compared.  ``words`` counts 64-bit words; bit 0 is the lowest of
    the first.  ``similarity``: the least cosine of two texts' shingle sets, if links are verified."""

    shingle: int
    words: int
    distance: int
    segments: tuple[Segment, ...]
    similarity: float | None = None


def close_scheme(rows: int) -> Scheme:
    """4 differing bits of 64, none missed.  Segments of 22, 21 and 21 bits with radii 1, 1, 0: were 2,
    2 and 1 of them to differ, it would be 5.  For tables whose cells would then be crowded, halves of
    32 bits with radius 2: one of them differs in 2 bits at most."""
    if rows <= 1 << 26:
        return Scheme(4, 1, 4, (Segment(tuple(range(22)), 1), Segment(tuple(range(22, 43)), 1), Segment(tuple(range(43, 64)))))
    return Scheme(4, 1, 4, (Segment(tuple(range(32)), 2), Segment(tuple(range(32, 64)), 2)))


#: The share of pairs just as similar as asked for that no segment may find, by the segments' own law.
MISSED = 0.05
#: Bits of a segment that are looked up within its cell, and of how many the flips.
BALL, BALL_RADIUS = 12, 2
#: Matches by chance that a lookup may have, on average.
CHANCE = 16


def similar_scheme(rows: int, similarity: float = 0.8) -> Scheme:
    """Five words, and the similarity that SimHash estimates: the cosine of two texts' shingle sets,
    verified on the texts.  192 bits; pairs of cosine c differ in arccos(c) / pi of them.  A segment has
    so many cell bits that lookups among ``rows`` have few matches by chance, and there are so many
    segments that a pair of just this similarity is missed by all with probability ``MISSED`` were they
    independent.  The distance is three standard errors above the one expected."""
    bits, apart = 192, math.acos(similarity) / math.pi
    ball = sum(math.comb(BALL, r) for r in range(BALL_RADIUS + 1))
    near = sum(math.comb(BALL, r) * apart**r * (1 - apart) ** (BALL - r) for r in range(BALL_RADIUS + 1))
    cell = max(6, min(30, math.ceil(math.log2(max(1, rows) * ball / CHANCE / 2**BALL))))
    found = (1 - apart) ** cell * near
    n = math.ceil(math.log(MISSED) / math.log(1 - found))
    rng, pool, segments = np.random.default_rng(0), [], []
    while len(segments) < n:  # bits are drawn without repetition until all have been used
        if len(pool) < cell + BALL:
            pool = [*pool, *(b for b in rng.permutation(bits).tolist() if b not in pool)]
        segments.append(Segment(tuple(pool[:cell]), 0, tuple(pool[cell : cell + BALL]), BALL_RADIUS))
        pool = pool[cell + BALL :]
    distance = int(bits * apart + 2 * math.sqrt(bits * apart * (1 - apart)))
    return Scheme(5, bits // 64, distance, tuple(segments), similarity)


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """Another hash from each hash (the finaliser of splitmix64 on h + k steps)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * k) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, highest bit first."""
    total = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 255 * 1024):
        bits = np.unpackbits(hashes[k : k + 255 * 1024].astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
        full = len(bits) // 255 * 255
        lanes = [bits[:full].reshape(-1, 255, 8).sum(axis=1), bits[full:].sum(axis=0, keepdims=True)]
        total += np.concatenate(lanes).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def shingle_hashes(text: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of a text's shingles, in parts of bounded size: A-Z lower-cased, words parted by
    white space, and the whole text if it has fewer words; nothing for a text without words."""
    from xxhash import xxh64_digest

    tokens = text.lower().split() if text else []
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - shingle + 1)
    last = ends[min(shingle, len(tokens)) - 1 :]
    for k in range(0, n, 1 << 18):
        pieces = zip(starts[k : min(n, k + (1 << 18))].tolist(), last[k : k + (1 << 18)].tolist(), strict=False)
        yield np.frombuffer(b"".join([xxh64_digest(joined[a:b], 42) for a, b in pieces]), dtype=">u8").astype(np.uint64)


def fingerprint(text: bytes | None, shingle: int, words: int) -> list[int]:
    """``words`` unsigned 64-bit words; zeros for a text without words."""
    out, n = [np.zeros(64, dtype=np.int64) for _ in range(words)], 0
    for hashes in shingle_hashes(text, shingle):
        n += len(hashes)
        for w in range(words):
            out[w] += _bit_counts(_mix(hashes, w) if w else hashes)
    return [int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big") if n else 0 for counts in out]


def fingerprints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """(key, f0, f1, .., other columns) for ``docs`` (key, text, other columns): signed 64-bit words,
    one row per row of ``docs``."""
    names, others = [f"f{w}" for w in range(words)], [c for c in docs.columns if c not in ("key", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = np.array([fingerprint(t.as_py(), shingle, words) for t in texts], dtype=np.uint64).reshape(-1, words)
            columns = [batch.column(0), *(pa.array(rows[:, w].view(np.int64)) for w in range(words)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["key", *names, *others])

    ship_package(docs.sparkSession)
    given = docs.select(F.col("key").cast("long"), F.col("text").cast("string"), *others)
    schema = ", ".join(["key long", *(f"{c} long" for c in names), *(f"{f.name} {f.dataType.simpleString()}" for f in given.schema[2:])])
    return given.mapInArrow(run, schema)


def _picked(words: list[np.ndarray], bits: tuple[int, ...]) -> np.ndarray:
    """The bits of each fingerprint as one number."""
    out = np.zeros(len(words[0]), np.uint64)
    for k, bit in enumerate(bits):
        out |= ((words[bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)) << np.uint64(k)
    return out


def _lookups(scheme: Scheme):
    """The rows that each fingerprint sends to cells, from (node, f0, ..): one per segment, with reach 1
    also to values that have one more bit set (so that no pair of neighbours meets twice), with
    reach 2 to all values one bit away (where values two bits apart meet)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                node = batch.column(0).to_numpy(zero_copy_only=False)
                words = [batch.column(1 + w).to_numpy(zero_copy_only=False).view(np.uint64) for w in range(scheme.words)]
                for k, s in enumerate(scheme.segments):
                    value = _picked(words, s.cell)
                    key = value | np.uint64(k << 32)
                    keys, rows = [key], [np.arange(len(key))]
                    for bit in range(len(s.cell) if s.reach else 0):
                        flipped = np.arange(len(key)) if s.reach == 2 else np.flatnonzero((value >> np.uint64(bit)) & np.uint64(1) == 0)
                        keys.append(key[flipped] ^ np.uint64(1 << bit))
                        rows.append(flipped)
                    at_row = np.concatenate(rows)
                    inside = _picked(words, s.ball).astype(np.int32)
                    columns = [np.concatenate(keys).view(np.int64), inside[at_row], node[at_row], *(w[at_row].view(np.int64) for w in words)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "inside", "node", *(f"f{w}" for w in range(scheme.words))])

    return run


def _labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Component labels (the smallest index) of a graph of ``n`` nodes with links a-b, beyond those of ``labels``."""
    labels = np.arange(n) if labels is None else labels.copy()
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels


def _stars(labels: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (centre, node) that span each component: a star around its smallest node, so that cells that
    share a group mostly name the same links."""
    order = np.lexsort((node, labels))
    first = np.concatenate([[True], labels[order][1:] != labels[order][:-1]]) if len(order) else np.empty(0, bool)
    centre = np.repeat(order[first], np.diff(np.append(np.flatnonzero(first), len(order))))
    return node[centre[~first]], node[order[~first]]


def _near_links(scheme: Scheme, unit: np.ndarray, inside: np.ndarray, node: np.ndarray, rows: np.ndarray, ball: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the graph whose links join rows of one unit that lie in each other's ball
    (``inside`` differing in ``radius`` of ``ball`` bits or fewer) and within the scheme's distance.

    Rows of equal unit and ``inside`` are a run.  First rows meet the first of their run, and firsts
    those of runs in their ball; then all pairs of runs that this has not made one component anyway."""
    key = (unit.astype(np.int64) << ball) | inside
    order = np.argsort(key, kind="stable")
    key, node, rows = key[order], node[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run_key, sizes = key[starts], np.diff(np.append(starts, len(key)))
    masks = [sum(1 << bit for bit in c) for r in range(1, radius + 1) for c in combinations(range(ball), r)]

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(rows[a] ^ rows[b]).sum(axis=1, dtype=np.int16) <= scheme.distance

    def other_runs(mask: int) -> tuple[np.ndarray, np.ndarray]:
        low = np.flatnonzero(run_key & (1 << (mask.bit_length() - 1)) == 0)  # the one without the highest bit looks up the other
        at = np.searchsorted(run_key, run_key[low] ^ mask)
        found = (at < len(run_key)) & (run_key[np.minimum(at, len(run_key) - 1)] == run_key[low] ^ mask)
        return low[found], at[found]

    def expanded(r: np.ndarray, s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        upto = np.cumsum(sizes[r] * sizes[s])
        for done in range(0, int(upto[-1]) if len(upto) else 0, BLOCK_PAIRS):
            at = np.arange(done, min(done + BLOCK_PAIRS, int(upto[-1])))
            pair = np.searchsorted(upto, at, side="right")
            within = at - (upto[pair] - sizes[r[pair]] * sizes[s[pair]])
            a, b = starts[r[pair]] + within // sizes[s[pair]], starts[s[pair]] + within % sizes[s[pair]]
            keep = (a < b) | (r[pair] != s[pair])
            yield a[keep], b[keep]

    def joined(labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return _labels(len(key), *(np.concatenate(x) for x in zip(*pairs, strict=True)), labels) if pairs else labels

    members = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    first = np.repeat(starts, sizes)[members]
    hit = near(first, members)
    links = [(first[hit], members[hit])]
    neighbours = [other_runs(mask) for mask in masks]
    for r, s in neighbours:
        hit = near(starts[r], starts[s])
        links.append((starts[r[hit]], starts[s[hit]]))
    labels = joined(np.arange(len(key)), links)
    own = np.flatnonzero(sizes > 1)
    for r, s in [(own, own), *neighbours]:
        low, high = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        open_ = (low[r] != high[r]) | (low[s] != high[s]) | (low[r] != low[s])
        open_ &= (sizes[r] > 1) | (sizes[s] > 1)
        for a, b in expanded(r[open_], s[open_]):
            apart = labels[a] != labels[b]
            a, b = a[apart], b[apart]
            hit = near(a, b)
            labels = joined(labels, [(a[hit], b[hit])])
    return _stars(labels, node)


def _links(scheme: Scheme):
    """Links (a, b) of each cell, from rows sorted by cell, part and kind (held rows first)."""
    ball = max(len(s.ball) for s in scheme.segments)
    radius = max(s.radius for s in scheme.segments)

    def emit(unit: np.ndarray, columns: tuple) -> Iterator[pa.RecordBatch]:
        inside, node, rows = columns
        a, b = _near_links(scheme, unit, inside, node, rows, ball, radius)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def in_blocks(starts: np.ndarray, probe: np.ndarray, columns: tuple) -> Iterator[pa.RecordBatch]:
        """Whole cells, many at a time; of a large one its held rows with further ones, some at a time."""
        ends, k = np.append(starts[1:], len(probe)), 0
        while k < len(starts):
            last = max(k + 1, int(np.searchsorted(ends, starts[k] + BLOCK_ROWS, side="right")))
            low, high = starts[k], ends[last - 1]
            if high - low <= 2 * CELL_ROWS or last > k + 1:
                sizes = ends[k:last] - starts[k:last]
                yield from emit(np.repeat(np.arange(last - k), sizes), tuple(c[low:high] for c in columns))
            else:
                held = low + int(np.count_nonzero(~probe[low:high]))
                for at in range(held, max(high, held + 1), CELL_ROWS):
                    both = tuple(np.concatenate([c[low:held], c[at : min(at + CELL_ROWS, high)]]) for c in columns)
                    yield from emit(np.zeros(len(both[0]), np.int64), both)
            k = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []  # the cell that the last batch may not have ended, and what came before it
        n = 0

        def flush(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, n
            cell, probe, *columns = (np.concatenate(x) for x in zip(*kept, strict=True))
            starts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)]))
            end = len(cell) if all_of_it else starts[-1]
            if end:
                yield from in_blocks(starts if all_of_it else starts[:-1], probe[:end], tuple(c[:end] for c in columns))
            if end < len(cell) and len(cell) - end > 4 * CELL_ROWS and not all_of_it:  # keep what further rows have to meet
                yield from in_blocks(np.array([0]), probe[end:], tuple(c[end:] for c in columns))
                held = end + int(np.count_nonzero(~probe[end:]))
                kept = [(cell[end:held], probe[end:held], *(c[end:held] for c in columns))]
            else:
                kept = [(cell[end:], probe[end:], *(c[end:] for c in columns))]
            n = len(kept[0][0])

        for batch in batches:
            cell = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)], axis=1)
            rows = np.stack([batch.column(5 + w).to_numpy(zero_copy_only=False).view(np.uint64) for w in range(scheme.words)], axis=1)
            kept.append((cell, batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False), rows))
            n += len(cell)
            if n > BLOCK_ROWS:
                yield from flush(False)
        if n:
            yield from flush(True)

    return run


def loose_links(nodes: DataFrame, scheme: Scheme, n_nodes: int) -> DataFrame:
    """(a, b): links within the scheme's distance that span the components of ``nodes`` (node, f0, ..),
    whose fingerprints are distinct."""
    spark = nodes.sparkSession
    ship_package(spark)
    names = [f"f{w}" for w in range(scheme.words)]
    sent = "cell long, inside int, node long, " + ", ".join(f"{c} long" for c in names)
    rows = nodes.select("node", *names).mapInArrow(_lookups(scheme), sent)
    nth = max(1, math.ceil(n_nodes / COUNTED))
    some = nodes.select("node", *names).where(F.pmod(F.xxhash64("node"), F.lit(nth)) == 0).mapInArrow(_lookups(scheme), sent)
    counts = some.groupBy("cell").agg((F.count("*") * nth).alias("n")).where(F.col("n") > CELL_ROWS)
    hot = stash(counts.select("cell", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts")), "hot-cells")
    zero = F.lit(0).cast("int")
    if n_hot := hot.count():
        rows = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_CELLS else hot, "cell", "left")
        own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        # a row is held in its own part and also meets the parts before it
        rows = rows.withColumn("own", F.coalesce(own, zero)).withColumn("part", F.explode(F.sequence(zero, F.col("own"))))
        rows = rows.withColumn("probe", F.col("part") != F.col("own"))
    else:
        rows = rows.withColumn("part", zero).withColumn("probe", F.lit(False))
    dealt = rows.select("cell", "part", "probe", "inside", "node", *names).repartition("cell", "part").sortWithinPartitions("cell", "part", "probe")
    return dealt.mapInArrow(_links(scheme), "a long, b long")


#: Texts of a class that the others are compared with at once, and rows of a class that go to one task.
ANCHORS, CLASS_ROWS = 64, 2048
#: How many times more sets of anchors a class may have in each further round.
GROWTH = 32


def _shingle_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(2).cast(pa.binary()):
                parts = list(shingle_hashes(text.as_py(), shingle))
                found.append(np.unique(np.concatenate(parts)).tobytes() if parts else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["class", "node", "shingles"])

    return run


def similar(both: np.ndarray, one: np.ndarray | int, other: np.ndarray | int, least: float) -> np.ndarray:
    """Whether sets of ``one`` and ``other`` members that share ``both`` have this cosine at least."""
    share = Fraction(str(least))
    return both * both * share.denominator**2 >= share.numerator**2 * one * other


def _verify(least: float):
    """Links of texts that are similar enough, from rows sorted by unit and kind (anchors first): anchors
    with each other and with the unit's other rows.  Only links that span a component leave."""

    def links(anchors: list[tuple], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(s, np.uint64) for _, s in anchors]
        if len(sets) + len(rows) < 2 or not sets:
            return
        known, at = np.unique(np.concatenate(sets), return_inverse=True)
        of_set = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[np.argsort(at, kind="stable")]
        ends = np.cumsum(np.bincount(at, minlength=len(known)))  # the sets that hold each known hash
        sizes = np.array([len(s) for s in sets], np.int64)
        first, second = [], []
        for k, (_, raw) in enumerate([*anchors, *rows]):
            own = np.frombuffer(raw, np.uint64)
            place = np.searchsorted(known, own)
            place[place == len(known)] = 0
            shared = place[known[place] == own] if len(known) else place[:0]
            n = ends[shared] - np.where(shared, ends[shared - 1], 0)
            inside = np.repeat(ends[shared] - np.cumsum(n), n) + np.arange(int(n.sum()))
            both = np.bincount(of_set[inside], minlength=len(sets))
            for j in np.flatnonzero(similar(both, sizes, len(own), least) & (both > 0)).tolist():
                if j != k:
                    first.append(j)
                    second.append(k)
        node = np.array([n for n, _ in [*anchors, *rows]], np.int64)
        a, b = _stars(_labels(len(node), np.array(first, np.int64), np.array(second, np.int64)), node)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, anchors, rows = None, [], []
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if r[:3] != unit:
                    yield from links(anchors, rows)
                    unit, anchors, rows = r[:3], [], []
                (rows if r[3] else anchors).append((r[4], r[5]))
                if len(rows) >= 256:  # a bounded number of texts at a time, besides the anchors
                    yield from links(anchors, rows)
                    rows = []
        yield from links(anchors, rows)

    return run


def verified_groups(classes: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, root): components of the links between texts of one class whose shingle sets have the
    scheme's similarity, computed exactly.  ``classes`` (node, root) are the components of loose links,
    ``texts`` (node, text) holds each node once.

    Rounds: of each class some members, the anchors, are compared with all members; the next anchors
    are those that are still outside the class's largest component, until none is.  So no link between
    two components is left out, small classes are done in one round, and a large group of copies, most
    of which the first anchors join, takes work in proportion to its size."""
    spark = classes.sparkSession
    ship_package(spark)
    few = classes.count() <= CORPUS_KEYS
    named = classes.withColumnRenamed("root", "class")
    if not few:  # texts outside the classes stay where they are
        inside = rows_of(texts, named.select("node"), "node", there=True)
        texts = texts if inside is None else inside
    found = texts.join(F.broadcast(named) if few else named, "node").select("class", "node", "text")
    sets = stash(found.mapInArrow(_shingle_sets(scheme.shingle), "class long, node long, shingles binary"), "shingle-sets")
    state = sets.select("class", "node", F.lit(True).alias("open"), F.lit(False).alias("tried"))
    groups, round_ = None, 0
    while True:
        # ANCHORS times a growing number of sets of anchors, picked by a hash, all of a small class
        several = GROWTH**round_
        per_class = state.groupBy("class").agg(F.count("*").alias("n"), F.sum((F.col("open") & ~F.col("tried")).cast("long")).alias("left"))
        per_class = per_class.where("left > 0").select(
            "class",
            F.ceil(F.col("n") / CLASS_ROWS).cast("int").alias("blocks"),
            F.least(F.ceil(F.col("left") / ANCHORS), F.lit(several)).cast("int").alias("sets"),
            F.greatest(F.lit(1), F.floor(F.col("left") / (ANCHORS * several))).cast("long").alias("nth"),
        )
        due = join_few(state, stash(per_class, "classes"), "class", CORPUS_KEYS)
        hashed = F.xxhash64(F.lit(round_), "node")
        anchor = F.col("open") & ~F.col("tried") & (F.pmod(hashed, "nth") == 0)
        due = stash(due.withColumn("anchor", anchor), "due")
        zero = F.lit(0).cast("int")
        set_of, block_of = F.pmod(F.shiftright(hashed, 20), "sets").cast("int"), F.pmod(F.shiftright(hashed, 8), "blocks").cast("int")
        to = due.select("node", "anchor", "blocks", "sets", set_of.alias("set"), block_of.alias("block"))
        # an anchor goes to all blocks with its set, any other row to its block with all sets, an anchor also as such a row;
        # repeated only after the join: Spark takes a repeated table for as small as it was, and would broadcast it
        as_anchor = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda k: F.struct(F.col("set"), k.alias("block"), F.lit(0).alias("kind")))
        as_row = F.transform(F.sequence(zero, F.col("sets") - 1), lambda k: F.struct(k.alias("set"), F.col("block"), F.lit(1).alias("kind")))
        goes = F.concat(F.when(F.col("anchor"), as_anchor).otherwise(F.slice(as_anchor, 1, 0)), F.when(F.expr("NOT anchor OR sets > 1"), as_row).otherwise(F.slice(as_row, 1, 0)))
        units = sets.join(to, "node").select("class", "node", "shingles", F.inline(goes)).select("class", "set", "block", "kind", "node", "shingles")
        dealt = units.repartition("class", "set", "block").sortWithinPartitions("class", "set", "block", "kind")
        more = stash(dealt.mapInArrow(_verify(scheme.similarity), "a long, b long"), "verified")
        if groups is None:
            groups = stash(components(more), "groups")
        else:  # between components found before, of which few are left
            name = lambda side: groups.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
            between = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
            merged = stash(components(between), "merged").select(F.col("node").alias("root"), F.col("root").alias("into"))
            nodes = groups.union(merged.join(groups, merged["root"] == groups["node"], "left_anti").select(F.col("root").alias("node"), "root"))
            groups = stash(nodes.join(merged, "root", "left").select("node", F.coalesce("into", "root").alias("root")), "groups")
        # classes that were not due have nothing open, and nothing more is linked in them
        grouped = due.select("class", "node", (F.col("tried") | F.col("anchor")).alias("tried")).join(groups, "node", "left")
        grouped = stash(grouped.select("class", "node", "tried", F.coalesce("root", "node").alias("group")), "grouped")
        unstash(more, due)
        largest = grouped.groupBy("class", "group").agg(F.count("*").alias("n")).groupBy("class").agg(F.max_by("group", F.struct("n", -F.col("group"))).alias("largest"))
        state = join_few(grouped, stash(largest, "largest"), "class", CORPUS_KEYS).select("class", "node", (F.col("group") != F.col("largest")).alias("open"), "tried")
        if not state.where("open AND NOT tried").limit(1).count():
            return groups
        round_ += 1


def near_duplicate_groups(docs: DataFrame, scheme: Scheme | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(key, fingerprint, group, columns ``carried``) for each row of ``docs`` (key, text, ..): ``group`` is
    the smallest key that can be reached over links, the row's own included.

    Without a scheme, links are 4 or fewer differing bits of fingerprints of 4-word shingles.  Null
    and empty texts, and those of white space only, have fingerprint zero and are linked like any other.
    A null key is carried, and is a group's name only if the whole group has no other.  Repeated rows
    stay; an empty table gives an empty result; other columns are ignored.  A scheme with a
    similarity needs keys that are unique and not null; texts of equal fingerprints are one.
    """
    scheme = scheme or close_scheme(0)
    names = [f"f{w}" for w in range(scheme.words)]
    prints = stash(fingerprints(docs.select("key", "text", *carried), scheme.shingle, scheme.words), "prints")
    if scheme.words == 1:
        prints = prints.withColumn("node", F.col("f0"))
        smallest = prints.groupBy("node").agg(F.min("key").alias("first"))
        nodes = stash(smallest.select("node", "first", F.col("node").alias("f0")), "nodes")
    else:
        nodes = stash(prints.groupBy(*names).agg(F.min("key").alias("node")).select("node", F.col("node").alias("first"), *names), "nodes")
    n_nodes = nodes.count()
    if scheme.similarity is not None:
        scheme = similar_scheme(n_nodes, scheme.similarity)
    elif scheme == close_scheme(0):
        scheme = close_scheme(n_nodes)
    groups = components(loose_links(nodes, scheme, n_nodes))
    if scheme.similarity is not None:
        groups = verified_groups(groups, docs.select(F.col("key").alias("node"), "text"), scheme)
    if scheme.words == 1:
        rooted = stash(groups.join(nodes.select("node", "first"), "node"), "rooted")
        named = rooted.groupBy("root").agg(F.min("first").alias("group"))
        by_node = join_few(rooted, stash(named, "named"), "root", CORPUS_KEYS).select("node", "group")
    else:  # nodes are keys, and a root is the smallest of its group
        by_node = groups.select("node", F.col("root").alias("group"))
    text = F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in names])
    if scheme.words == 1:
        by_node = nodes.join(by_node, "node", "left").select("node", F.coalesce("group", "first").alias("group"))
        rows = prints.join(by_node, "node")
    else:
        by_node = nodes.join(by_node, "node", "left").select(*names, F.coalesce("group", "first").alias("group"))
        rows = prints.join(by_node, names)
    return rows.select("key", text.alias("fingerprint"), "group", *carried)


def keep_one_of_each(docs: DataFrame, scheme: Scheme | None = None) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest doc_id stays (nulls
    last; of repeated rows the first read).  All columns stay as they are.

    Without a scheme, a link is a cosine of 0.8 or more between two texts' sets of five-word shingles.
    All texts without words are one group, null texts too; an empty table gives an empty result.
    """
    rows, spare = numbered(docs)
    with scratch():
        keyed = rows.select(F.col(spare).alias("key"), "text", F.col("doc_id").alias("__id"))
        named = stash(near_duplicate_groups(keyed, scheme or similar_scheme(0), ("__id",)).select("key", "group", "__id"), "groups")
        order = F.struct(F.col("__id").isNull(), "__id", "key")
        first = named.groupBy("group").agg(F.min_by("key", order).alias("kept"), F.count("*").alias("n")).where("n > 1")
        gone = join_few(named, stash(first, "kept"), "group", CORPUS_KEYS).where("key <> kept").select(F.col("key").alias(spare))
        gone = kept(stash(gone, "dropped"))
    return drop_rows(rows, gone, spare).drop(spare)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    return near_duplicate_groups(docs).select(F.col("key").alias("doc_id"), "fingerprint", F.col("group").alias("component_id"))
