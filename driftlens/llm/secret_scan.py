"""Secret scans: a random forest tells secrets from other long strings.

Candidates are runs of 16 or more letters, digits and ``_+/=-`` with a digit, and whatever has 8 or more
signs and is assigned to a secret word, such as a password.  Features are their length, transitions between kinds of characters, coverage by dictionary words, the document's path,
and neighbouring words.  The forest is trained on labelled findings and then written as one SQL
expression, so a scan is a projection without exchange, and a text can be redacted where it stands.
Everything here is DataFrame and SQL expressions.
"""

from __future__ import annotations

import base64
import random
import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, literal_table, table

#: What a candidate looks like.
KEY = r"(?i:token|secret|passw|passphrase|pwd|api[ _\-]?key|access[ _\-]?key|private[ _\-]?key|client[ _\-]?key|auth(?!or)|bearer|credential)[A-Za-z0-9_\-]{0,12}"
VALUE = r"(?<=[=:>]\s{0,2}[\"']?)(?<=" + KEY + r"[\"']?\s{0,2}(?::=|=>|=|:)\s{0,2}[\"']?)[^\s\"'<>=:][^\s\"'<>]{6,}[^\s\"'<>.,;:)\]}]"
RUN = r"(?<![A-Za-z0-9_+/=\-])(?![A-Za-z0-9_\-]{0,24}?" + KEY + r"=[^=])(?=[A-Za-z_+/=\-]*[0-9])[A-Za-z0-9_+/=\-]{16,}"
CANDIDATE = f"{VALUE}|{RUN}"
#: Words whose letters in a candidate are no sign of chance.
DICTIONARY = (
    "access account admin alpha android api app apple april archive article asset august author auth backup beta bin blog book bucket build cache "
    "change changeme chapter class client cloud code color com commit component config content core custom data database date debug december default "
    "demo dev device doc document download dummy edit email en engine error event example fake february file filter final fixture flag folder font form "
    "friday full gallery game guide handler header here home host html icon image images index info input install issue item january java july june key "
    "label lang layer layout library license line link linux list local log login logo mail main map march master media menu meta mobile model module "
    "monday month music name net network news node note november number object october old open option order org output package page part password patch "
    "path photo place plan platform plugin policy port post preview primary private product profile project public python query read record region release "
    "report request resource result review root route sample saturday schema screen script search secret section secure select september server service "
    "session setting share short sign site size slug source stable staging start state static status step store stream string style sub sunday super "
    "support system table tag task team temp template term test text theme thursday time title token tool topic track tree tuesday type update upload url "
    "user util value version video view web wednesday week widget window wiki word work year your zone"
).split()
#: Neighbouring words and signs, on the lower-cased text before and after a candidate.
SECRET_WORDS = r"(token|secret|passw|pwd|api[ _\-]?key|access[ _\-]?key|private[ _\-]?key|auth|bearer|credential|client[ _\-]?key)[^.\n]{0,16}$"
DIGEST_WORDS = r"(sha\d*|md5|commit|checksum|digest|etag|hash|revision|uuid|guid|fingerprint|build|version|isbn|order|invoice|id)[^.\n]{0,12}$"
ASSIGNED = r"[=:]\s*[\"']?$"
EXAMPLE_PATHS = r"(test|example|sample|fixture|demo|mock|doc)"
#: Characters before and after a candidate that count as its neighbourhood.
BEFORE, AFTER = 40, 24
#: The forest.
TREES, DEPTH, SEED = 15, 5, 11
MASK = "[SECRET]"

FEATURES = ("length", "transitions", "distinct", "digits", "capitals", "hex", "syllables", "covered", "repeats", "example", "secret_word", "digest_word", "assigned", "quoted", "signs")
FINDINGS = T.StructType([T.StructField("text", T.StringType()), T.StructField("path", T.StringType()), T.StructField("label", T.IntegerType())])


def labelled_findings(n: int = 4000, seed: int = SEED) -> list[dict]:
    """Labelled findings (text with one candidate, path, label), made by rule: the bounded sample that
    the forest is trained on where a caller has none of their own."""
    rng = random.Random(seed)
    alnum, hexa, syllables = string.ascii_letters + string.digits, "0123456789abcdef", "an be con der en fi go ha in ko la men no or pre que re sa ti un ver wa".split()

    def some(signs: str, k: int) -> str:
        out = "".join(rng.choice(signs) for _ in range(k))
        return out if any(c.isdigit() for c in out) else out[:-1] + rng.choice(string.digits)

    def prose(k: int) -> str:
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(k))

    def compound() -> str:
        words = [rng.choice(DICTIONARY) if rng.random() < 0.7 else "".join(rng.choice(syllables) for _ in range(3)) for _ in range(rng.randint(3, 6))]
        return rng.choice("_-/").join([*words, str(rng.randint(1, 2030))]) + ("_file_name_0" if sum(map(len, words)) < 12 else "")

    def random_key() -> str:
        kind = rng.randrange(8)
        if kind < 3:
            out = some(hexa, rng.choice([32, 40, 40, 40, 48, 64]))
            return out.upper() if rng.random() < 0.25 else out
        if kind == 3:
            return "AKIA" + some(string.ascii_uppercase + string.digits, 16)
        if kind == 4:
            return rng.choice(["ghp_", "gho_", "glpat-", "sk-", "xoxb-", "sk_live_"]) + some(alnum, rng.choice([24, 36, 48]))
        if kind == 5:
            return base64.b64encode(rng.randbytes(rng.choice([18, 24, 32, 48]))).decode() + "0"
        return some(alnum + "_-", rng.choice([20, 24, 32, 40, 64]))

    def joined(word: str, value: str) -> str:
        quote = rng.choice(['"', '"', "'", ""])
        line = f"{word}{rng.choice([' = ', '=', ': ', ' := ', ' '])}{quote}{value}{quote}"
        if rng.random() < 0.2:
            line = line.upper() if rng.random() < 0.5 else line + rng.choice([";", ",", " \\"])
        return line

    def assigned(value: str) -> str:
        quote = rng.choice(['"', "'", "", ""])
        return f"{rng.choice(secret)}{rng.choice([' = ', '=', ': ', ' := '])}{quote}{value}{quote}"

    def password() -> str:
        kind = rng.randrange(4)
        if kind == 0:
            return some(alnum, rng.randint(8, 15))
        if kind == 1:  # without a digit
            return "".join(rng.choice(string.ascii_letters) for _ in range(rng.randint(10, 32)))
        if kind == 2:
            return rng.choice(alnum) + "".join(rng.choice(alnum + "!@#$%^&*._-") for _ in range(rng.randint(6, 22))) + rng.choice(alnum + "!#$")
        word = rng.choice(DICTIONARY) + rng.choice(syllables)
        return word.capitalize() + rng.choice("!@#$._") + str(rng.randint(10, 9999)) + rng.choice(["!", "#", "$x", "aQ"]) + rng.choice(alnum) + rng.choice(alnum)

    def plain() -> str:
        kind = rng.randrange(4)
        if kind == 0:
            return "".join(rng.choice(syllables) for _ in range(rng.randint(4, 7)))
        if kind == 1:
            return rng.choice(["required", "changeme", "your-password", "your_token_here", "xxxxxxxx", "********", "undefined", "password", "placeholder", "expired-now", "disabled"]) + rng.choice(["", "", "-value"])
        words = [rng.choice(DICTIONARY) for _ in range(rng.randint(2, 4))]
        out = rng.choice("._-/").join(words)
        return (out if kind == 2 else rng.choice(["${%s}", "os.environ[%s]", "get_%s()", "self.%s", "https://%s.org/"]) % out) + ("_value" if len(out) < 8 else "")

    secret = ["token", "secret", "api_key", "apikey", "password", "auth", "Bearer", "credential", "access_key", "client_key", "private_key", "db_password"]
    digest = ["commit", "sha1", "sha256", "md5", "checksum", "digest", "etag", "revision", "uuid", "build id", "version", "order", "invoice", "fingerprint"]
    placeholder = ["your_api_key_here_1234", "example_token_12345678", "changeme123changeme123", "xxxxxxxxxxxxxxxxxxxxxxx0", "0000000000000000000000", "1234567890123456789012", "test_secret_value_0001", "dummy-access-token-2024", "abcabcabcabcabcabc123123", "sample_password_value_01"]
    out = []
    for _ in range(n):
        path = rng.choice(["app/config.py", "deploy/prod.env", "web/index.html", "notes.md", "", "lib/settings.json"])
        kind = rng.random()
        if rng.random() < 0.25:
            label = int(rng.random() < 0.5)
            line = assigned(password() if label else plain())
        elif kind < 0.40:
            line, label = joined(rng.choice(secret), random_key()), 1
        elif kind < 0.45:
            line, label = prose(2) + " " + rng.choice(["AKIA" + some(string.ascii_uppercase + string.digits, 16), "ghp_" + some(alnum, 36), "sk_live_" + some(alnum, 24)]), 1
        elif kind < 0.50:
            line, label, path = joined(rng.choice(secret), random_key()), int(rng.random() < 0.25), rng.choice(["tests/test_login.py", "docs/example.md", "fixtures/sample.env"])
        elif kind < 0.62:
            line, label = joined(rng.choice(digest), rng.choice([some(hexa, rng.choice([32, 40, 64])), str(uuid.UUID(int=rng.getrandbits(128))) + "0"])), 0
        elif kind < 0.72:
            line, label = rng.choice([prose(2) + " ", "id: ", "no. ", "card ", joined(rng.choice(secret), "")]) + some("0123456789", rng.randint(16, 24)), 0
        elif kind < 0.86:
            line, label = rng.choice([prose(2) + " ", "see ", "path = ", 'href="', joined(rng.choice(secret), "")]) + compound(), 0
        elif kind < 0.93:
            line, label = joined(rng.choice(secret + ["value", "key"]), rng.choice(placeholder)), 0
        else:
            line, label = prose(3) + " " + rng.choice([some(hexa, 40), "".join(rng.choice(syllables) for _ in range(9)) + "1", "20240101-000000-000000", "=" * 20 + "1"]), 0
        out.append({"text": f"{prose(3)} {line} {prose(2)}.", "path": path, "label": label})
    return out


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(F.length(whole), F.lit(1))


def _features(c: Column, path: Column) -> list[Column]:
    """The features of one candidate ``c`` (text, before, after), in the order of ``FEATURES``."""
    text, low = c["text"], F.lower(c["text"])
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    left, right = F.lower(F.substring(c["before"], -BEFORE, BEFORE)), F.substring(c["after"], 1, AFTER)
    without = F.regexp_replace(low, "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")", "")
    flag = lambda x: x.cast("double")
    return [
        F.log(F.length(text).cast("double")),
        _share(F.length(kinds), text),
        F.size(F.array_distinct(F.split(low, ""))).cast("double") / F.least(F.length(low), F.lit(36)),
        _share(F.length(F.regexp_replace(text, "[^0-9]", "")), text),
        _share(F.length(F.regexp_replace(text, "[^A-Z]", "")), text),
        flag(low.rlike("^[0-9a-f]+$")),
        _share(F.length(low) - F.length(F.regexp_replace(low, "[aeiou][bcdfghj-np-tv-z]", "x")), text),
        _share(F.length(low) - F.length(without), text),
        _share(F.length(low) - F.length(F.regexp_replace(low, r"(.{1,3})\1+", "$1")), text),
        flag(F.lower(path).rlike(EXAMPLE_PATHS)),
        flag(left.rlike(SECRET_WORDS)),
        flag(left.rlike(DIGEST_WORDS)),
        flag(left.rlike(ASSIGNED)),
        flag(right.rlike("^[\"']")),
        _share(F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")), text),
    ]


def _candidates(text: Column) -> Column:
    """All candidates of a text as an array of (text, before, after), before and after reaching to the
    neighbouring candidates."""
    found, between = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)
    return F.transform(found, lambda m, i: F.struct(m.alias("text"), F.get(between, i).alias("before"), F.get(between, i + 1).alias("after")))


def featured(findings: DataFrame) -> DataFrame:
    """(label, one column for each feature) of the first candidate of each of ``findings`` (text, path, label);
    rows with another label than 0 or 1, and those without a candidate, are left out."""
    path = F.coalesce("path", F.lit(""))
    first = findings.select(path.alias("path"), "label", F.get(_candidates(F.col("text")), F.lit(0)).alias("c")).where("c IS NOT NULL AND label IN (0, 1)")
    return first.select(F.col("label").cast("double").alias("label"), *[f.alias(name) for f, name in zip(_features(F.col("c"), F.col("path")), FEATURES, strict=True)])


def _assembled(rows: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def fit_forest(rows: DataFrame):
    """The forest of Spark's own library, on ``featured`` findings (a bounded sample, hence one partition)."""
    from pyspark.ml.classification import RandomForestClassifier

    rows = _assembled(rows).select("features", "label").coalesce(1)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)


def train_forest(spark: SparkSession, findings: DataFrame | None = None) -> list[tuple]:
    """Trees as nested tuples: (feature, threshold, left, right), or a leaf's probability.

    ``findings`` (text, path, label) may be the caller's own; without them the generated ones are used."""
    if findings is None:
        findings = literal_table(spark, labelled_findings(), FINDINGS)
    return trees_of(fit_forest(featured(findings)))


def trees_of(model) -> list[tuple]:
    """A fitted forest's trees as nested tuples."""

    def walk(node):
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return stats[1] / sum(stats)
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return [walk(tree.rootNode()) for tree in model._call_java("trees")]


def _forest(features: Column, trees: list[tuple]) -> Column:
    """The mean of the trees' probabilities as one expression over a struct of features."""

    def grown(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        feature, threshold, left, right = node
        return F.when(features[FEATURES[feature]] <= F.lit(float(threshold)), grown(left)).otherwise(grown(right))

    return reduce(lambda a, b: a + b, map(grown, trees)) / F.lit(float(len(trees)))


def _scored(docs: DataFrame, trees: list[tuple], text: str, path: str | None, found: str = "__found") -> DataFrame:
    """``docs`` with ``found``: an array of (text, before, after, score) for each row, null without candidates."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    fields = lambda c: [f.alias(n) for f, n in zip(_features(c, where), FEATURES, strict=True)]
    judged = F.transform(_candidates(F.col(text)), lambda c: F.struct(c["text"].alias("text"), c["before"].alias("before"), c["after"].alias("after"), F.struct(*fields(c)).alias("f")))
    scored = F.transform(judged, lambda c: F.struct(c["text"].alias("text"), c["before"].alias("before"), c["after"].alias("after"), _forest(c["f"], trees).alias("score")))
    return docs.withColumn(found, F.when(F.col(text).rlike(CANDIDATE), scored))


def secret_findings(docs: DataFrame, trees: list[tuple]) -> DataFrame:
    """One row for each candidate of each row of ``docs`` (doc_id, text, path): doc_id, finding (from 0),
    start (in characters from 0), length, sha256 of the candidate, score (0 to 1), is_secret (0.5 or more).

    Null and empty texts have no candidates, a null path counts as empty, a null doc_id is carried,
    repeated rows are scanned each, an empty table gives an empty result, other columns are ignored.
    Texts are scanned whole.
    """
    found = _scored(docs.select("doc_id", F.col("text").cast("string"), "path"), trees, "text", "path").where("__found IS NOT NULL")
    upto = F.aggregate(
        "__found",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda s, c: F.struct(
            (s["at"] + F.length(c["before"]) + F.length(c["text"])).alias("at"),
            F.array_append(s["starts"], s["at"] + F.length(c["before"])).alias("starts"),
        ),
        lambda s: s["starts"],
    )
    rows = found.select("doc_id", upto.alias("starts"), F.transform("__found", lambda c: F.struct(c["text"].alias("text"), c["score"].alias("score"))).alias("found"))
    rows = rows.select("doc_id", F.posexplode(F.arrays_zip("starts", "found")).alias("finding", "x"))
    return rows.select(
        "doc_id",
        "finding",
        F.col("x.starts").alias("start"),
        F.length("x.found.text").alias("length"),
        F.sha2(F.col("x.found.text"), 256).alias("sha256"),
        F.col("x.found.score").alias("score"),
        (F.col("x.found.score") >= 0.5).alias("is_secret"),
    )


def redact_secrets(docs: DataFrame, trees: list[tuple], path: str | None = "source") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``; all rows and other columns stay.

    Null and empty texts, and those without a candidate, stay as they are; long texts are scanned whole;
    repeated rows are treated alike; an empty table gives an empty result."""
    columns, found = docs.columns, fresh_name(docs, "__found")
    scored = _scored(docs, trees, "text", path if path in columns else None, found)
    kept = F.transform(found, lambda c: F.concat(c["before"], F.when(c["score"] >= 0.5, F.lit(MASK)).otherwise(c["text"])))
    text = F.concat(F.array_join(kept, ""), F.element_at(found, -1)["after"])
    return scored.withColumn("text", F.when(F.exists(found, lambda c: c["score"] >= 0.5), text).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in columns])


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates of all ``documents``, judged by the forest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    return secret_findings(docs, train_forest(spark))
