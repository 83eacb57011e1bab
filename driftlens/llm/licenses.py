"""License scans: an Aho-Corasick automaton finds notice phrases and identifier tags, and a
shunting-yard parser evaluates the and/or/with expressions that tags are followed by."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship_package
from .common import WORD_BYTES, table

#: Phrases whose places are counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases, for labels only.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "licensed under cc0": "cc0",
}
#: The tag before an expression.
TAG = "spdx license identifier"
#: How identifiers begin, and the label of that family.
IDENTIFIER_FAMILIES = {
    "mit": "mit",
    "apache": "apache",
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "mpl": "mpl",
    "epl": "epl",
    "bsd": "bsd",
    "isc": "isc",
    "unlicense": "unlicense",
    "cc0": "cc0",
    "cc-by": "cc-by",
}
#: Evidence of a base or further notice phrase, of an expression that needs a known licence
#: whatever is chosen, of one that only offers it, and of a tag without a sound expression.
PHRASE_WEIGHT, NEEDED_WEIGHT, OFFERED_WEIGHT, BARE_TAG_WEIGHT = 0.6, 0.95, 0.8, 0.3
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
EXPRESSION_TOKEN = re.compile(r"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+\-]*)", re.ASCII)


class Expression(NamedTuple):
    """A licence expression: all identifiers, those that every choice needs, and exceptions."""

    identifiers: frozenset
    needed: frozenset
    exceptions: frozenset


def parse_expression(text: str) -> Expression | None:
    """The licence expression at the start of ``text`` (lower-cased), by shunting-yard; None if there is none.

    ``with`` binds closest, then ``and``, then ``or``.  What follows a complete expression is
    ignored, as is the rest from a missing operand or an unclosed bracket on.
    """
    tokens, at, depth, operand = [], 0, 0, True
    while m := EXPRESSION_TOKEN.match(text, at):
        token = m[1]
        if operand and token == "(":
            depth += 1
        elif operand and token not in PRECEDENCE and token != ")":
            token, operand = token.rstrip("."), False
        elif not operand and token in PRECEDENCE:
            operand = True
        elif not operand and token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        at = m.end()
    while tokens and (tokens[-1] in PRECEDENCE or tokens[-1] == "("):
        depth -= tokens[-1] == "("
        tokens.pop()
    tokens += [")"] * depth
    output: list[str] = []
    held: list[str] = []
    for token in tokens:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held and held[-1] != "(":
                output.append(held.pop())
            if held:
                held.pop()
        elif token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                output.append(held.pop())
            held.append(token)
        else:
            output.append(token)
    output += [t for t in reversed(held) if t != "("]
    values: list[Expression] = []
    for token in output:
        if token not in PRECEDENCE:
            values.append(Expression(frozenset([token]), frozenset([token]), frozenset()))
            continue
        if len(values) < 2:
            return None
        right, left = values.pop(), values.pop()
        if token == "with":
            values.append(Expression(left.identifiers, left.needed, left.exceptions | right.identifiers))
        else:
            needed = left.needed | right.needed if token == "and" else left.needed & right.needed
            values.append(Expression(left.identifiers | right.identifiers, needed, left.exceptions | right.exceptions))
    return values[-1] if values else None


def family(identifier: str) -> str | None:
    """The label of an identifier, by its longest known beginning that ends at a sign or a digit."""
    for start in sorted(IDENTIFIER_FAMILIES, key=len, reverse=True):
        rest = identifier[len(start) :]
        if identifier.startswith(start) and not rest[:1].isalpha():
            return IDENTIFIER_FAMILIES[start]
    return None


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**NOTICE_PHRASES, **BASE_PHRASES, TAG: None}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(raw: bytes, automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, needed_labels, exceptions) of one UTF-8 text."""
    words = raw.translate(WORD_BYTES).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    places, base, labels, doubt, tags = [], set(), set(), 1.0, 0
    all_needed, exceptions = set(), set()
    counted, upto = 0, 0
    for end, phrase in automaton.iter(line):
        start = end - len(phrase) - 1  # the blank before the phrase
        if phrase in BASE_PHRASES:
            counted, upto = counted + line.count(" ", min(upto, start), max(upto, start)) * (1 if start >= upto else -1), start
            places.append(counted)
            base.add(BASE_PHRASES[phrase])
            doubt *= 1 - PHRASE_WEIGHT
        elif phrase == TAG:
            tags += 1
        else:
            labels.add(NOTICE_PHRASES[phrase])
            doubt *= 1 - PHRASE_WEIGHT
    if tags:
        lowered = raw.lower()
        for m in re.finditer(rb"spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier[ \t]*:?", lowered):
            stop = lowered.find(b"\n", m.end())
            value = parse_expression(lowered[m.end() : stop if stop >= 0 else len(lowered)].decode("utf-8", "replace"))
            offered, needed = ({family(x) for x in part} - {None} for part in (value.identifiers, value.needed)) if value else (set(), set())
            labels |= offered
            all_needed |= needed
            exceptions |= value.exceptions if value else set()
            doubt *= 1 - (NEEDED_WEIGHT if needed else OFFERED_WEIGHT if offered else BARE_TAG_WEIGHT)
    labels |= base
    joined = [",".join(sorted(x)) for x in (base, labels, all_needed, exceptions)]
    return (len(words), len(places), min(places, default=None), max(places, default=None), *joined[:2], 1 - doubt, *joined[2:])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    n_words counts the words of the whole text; n_base, first_word and last_word the places of the
    base phrases (the latter two null if there is none); base_labels and labels are sorted, distinct
    and comma-joined (empty if there are none); score, from 0 to 1, is one minus the product of the
    remaining doubts after each finding.  Expressions behind tags are evaluated: all licences they name
    are labels, needed_labels are those that some expression needs whichever of its choices is taken
    (both sides of ``and``, what the sides of ``or`` share), and exceptions what stands behind ``with``.
    A null text counts as empty, a null doc_id stays null,
    repeated rows are scanned each, and an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "needed_labels", "exceptions"]
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [scan(t.as_py() or b"", automaton) for t in texts]
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)] if found else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, needed_labels string, exceptions string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their licence notices."""
    return license_scan(table(spark, sf_dir, "documents"))
