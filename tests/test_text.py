"""Text functions, flat files, scoring, mining, sampling, evaluation, model-backed scorers and streams."""

import collections
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from driftlens.functions import text as X
from driftlens.operators import mining as M
from driftlens.operators import model_clients as C
from driftlens.operators import profiles as P
from driftlens.operators import quality_model as Q
from driftlens.operators import scoring as S
from driftlens.plans import pipelines as R
from driftlens.plans import text_queries
from driftlens.shipping import ship_package
from driftlens.sources import tables as T
from driftlens.streaming import incremental

TAXONOMY = T.parse_taxonomy({"name": "t", "categories": [
    {"id": "design", "description": "design drawing", "seed_keywords": ["drawing"], "sub_categories": [{"id": "late", "description": "late design change", "seed_keywords": ["late", "change"]}, {"id": "bad", "seed_keywords": ["inadequate"]}]},
    {"id": "materials", "sub_categories": [{"id": "faulty", "description": "faulty material", "seed_keywords": ["faulty"]}]},
]})


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,number", [("1.5", 1.5), (" -2 ", -2.0), ("1e3", 1000.0), ("1_000", 1000.0), ("12d", None), ("", None), (None, None), ("nanx", None), (".5", 0.5)])
def test_number(spark, raw, number):
    assert one(spark, X.number("c"), raw) == number


def test_text_functions(spark):
    assert one(spark, X.strip("c"), "\t a \n") == "a"
    assert one(spark, X.normalise("c"), "  Café—ÉTÉ, ITP-123/b!\n x y ") == "café été itp-123/b x y"
    assert one(spark, X.normalise("c"), None) == ""
    assert str(one(spark, X.timestamp("c"), "22-Mar-25 16:00")) == "2025-03-22 16:00:00" and one(spark, X.timestamp("c"), "soon") is None
    assert one(spark, X.round4(F.col("c")), 0.12345, "double") == 0.1235
    assert X.plain_text("<b>re</b>work<!-- no --><br>a&lt;b&gt; c\x7f") == "re work a c" and X.plain_text(None) == ""
    assert one(spark, X.html_text_native("c"), "<p>a &amp; b<!-- x --></p>") == "a & b"
    ship_package(spark)
    assert one(spark, X.html_text("c"), "<p>a &amp; b</p>") == "a & b"


def test_periods(spark):
    names = ["plan_2025-04", "plan_202504_x", "HS-PfA38", "x c12 y", "nothing", "abc123456"]
    rows = spark.createDataFrame([(n,) for n in names], "s string").select(P.period_of_name(F.col("s")).alias("p"))
    assert [r["p"] for r in rows.collect()] == ["2025-04", "2025-04", "PfA38", "c12", "nothing", "abc123456"]
    assert one(spark, P.period_of_name(F.col("c"), r"(\d+)_(x)"), "plan_202504_x") == "202504-x"
    assert one(spark, P.programme_of_path(F.col("c"), "d"), "/a/outputs/prog/x.csv") == "prog" and one(spark, P.programme_of_path(F.col("c"), "d"), "/a/x.csv") == "d"
    files = spark.createDataFrame([("/r/b/2.xer", 1), ("/r/b/1.xer", 1), ("/r/a/9.xer", 1), ("/r/z2025-01.xer", 0)], "path string, depth int")
    assert [tuple(r) for r in P.discover_periods(files).collect()] == [("a", "/r/a/9.xer"), ("b", "/r/b/1.xer")]
    assert [tuple(r) for r in P.discover_periods(files.where("depth = 0")).collect()] == [("2025-01", "/r/z2025-01.xer")]
    pairs = P.period_pairs(spark.createDataFrame([("PfA9",), ("PfA10",), ("PfA10",)], "period string"))
    assert [tuple(r) for r in pairs.collect()] == [("PfA9", "PfA10")]


def test_profiles_and_labels(spark):
    rows = spark.createDataFrame([("a", "yes", "t"), (" ", "no", "t"), (None, "", "u"), ("b", "maybe", "u")], "x string, l string, k string")
    assert {r["column_name"]: r["null_fraction"] for r in P.null_profile(rows).collect()} == {"x": 0.5, "l": 0.25, "k": 0.0}
    assert P.null_profile(rows.where("false")).first()["null_fraction"] == 0.0
    stats = {(r["k"], r["is_total"]): (r["n_rows"], r["n_labeled"], r["yes_rate"]) for r in P.label_stats(rows, P.parse_label("l"), "k").collect()}
    assert stats == {("t", 0): (2, 2, 0.5), ("u", 0): (2, 0, None), (None, 1): (4, 2, 0.5)}
    assert [r["value"] for r in P.distinct_text(rows, "x").collect()] == ["a", "b"]


def test_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿id,text\n 1 ,"a ""quoted""\nline, two"\n2,\n', encoding="utf-8")
    rows = T.read_text_rows(spark, str(tmp_path / "r.csv"), "id", "text").orderBy("row_ord").collect()
    assert [(r["row_id"], r["text"]) for r in rows] == [("1", 'a "quoted"\nline, two'), ("2", "")]
    with pytest.raises(ValueError):
        T.read_csv(spark, str(tmp_path / "r.csv"), ("missing",))
    (tmp_path / "c.ndjson").write_text('{"row_id": "a", "parsed": {"x": 1}}\n\nbroken\n{"row_id": "a", "parsed": {"x": 2}}\n{"row_id": "", "parsed": {}}\n')
    assert [(r["row_id"], json.loads(r["parsed"])) for r in T.read_checkpoint(spark, str(tmp_path / "c.ndjson")).collect()] == [("a", {"x": 2})]
    memos = tmp_path / "outputs" / "prog"
    memos.mkdir(parents=True)
    (memos / "taskmemo_chunks_1.csv").write_text("chunk_id,text,reporting_period\nc1,hello,p1\nc2, ,p2\n")
    (memos / "taskmemo_chunks_2.csv").write_text("chunk_id,text,task_code,reporting_period\nc3,more,A,p1\n")
    kept, counts = P.aggregate_memos(T.read_memo_csvs(spark, str(tmp_path)))
    assert sorted((r["chunk_id"], r["task_code"], r["programme"]) for r in kept.collect()) == [("c1", "", "prog"), ("c3", "A", "prog")]
    assert counts.first().asDict() == {"n_periods": 2, "n_rows": 3, "n_kept": 2}
    assert T.write_csv(spark.createDataFrame([("a", ["x", "y"])], "k string, v array<string>"), str(tmp_path / "o.csv")) == 1
    assert (tmp_path / "o.csv").read_text(encoding="utf-8-sig") == "k,v\na,x; y\n"


def test_taxonomy(tmp_path):
    assert [(t.ord, t.category_id, t.sub_category_id) for t in TAXONOMY.subs] == [(0, "design", "late"), (1, "design", "bad"), (2, "materials", "faulty")]
    assert TAXONOMY.subs[1].label == "bad" and TAXONOMY.default_threshold == 0.35 and TAXONOMY.subs[0].category_seeds == ("drawing",)
    for bad in ({}, {"name": "x"}, {"name": "x", "categories": [{"id": "a"}]}, {"name": "x", "categories": [{"id": "a", "sub_categories": [{"id": "s"}, {"id": "s"}]}]}):
        with pytest.raises(ValueError):
            T.parse_taxonomy(bad)
    (tmp_path / "t.json").write_text(json.dumps({"name": "x", "default_threshold": 0.0, "categories": [{"id": "a", "sub_categories": [{"id": "s"}]}]}))
    assert T.load_taxonomy(str(tmp_path / "t.json")).default_threshold == 0.0


TEXTS = ["late design change of the drawing", "faulty material again and again", "", "unrelated words here now", "late late late change", "faulty drawing"]


def tfidf_by_hand(texts, targets, stop):
    def grams(t):
        w = [x for x in __import__("re").findall(r"\w\w+", t.lower()) if x not in stop]
        return collections.Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))

    docs = [grams(t) for t in texts]
    df = collections.Counter(g for d in docs for g in d)
    idf = {g: math.log((1 + len(docs)) / (1 + n)) + 1 for g, n in df.items() if 2 <= n <= 0.95 * len(docs)}

    def unit(d):
        v = {g: (1 + math.log(n)) * idf[g] for g, n in d.items() if g in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / norm for g, x in v.items()} if norm else {}

    return [[sum(x * unit(grams(t)).get(g, 0) for g, x in unit(d).items()) for t in targets] for d in docs]


def test_tfidf(spark):
    rows = spark.createDataFrame([(f"r{k}", k, t) for k, t in enumerate(TEXTS)], "row_id string, row_ord long, text string")
    stop = ["the", "of", "and"]
    scores = S.tfidf_scores(S.prepare(rows, stop), TAXONOMY.subs, stop_words=stop)
    want = tfidf_by_hand(TEXTS, [S.sub_text(t) for t in TAXONOMY.subs], stop)
    got = {(r["row_ord"], r["ord"]): r for r in scores.collect()}
    assert len(got) == 18 and all(abs(r["score_raw"] - want[i][j]) < 1e-9 for (i, j), r in got.items())
    assert got[0, 0]["signals"] == "late; change" and got[1, 2]["signals"] == "faulty"
    best = {r["row_id"]: r for r in S.row_scores(scores, 0.3).collect()}
    assert best["r1"]["top_sub_category_id"] == "faulty" and best["r2"]["top_sub_category_id"] == "late" and best["r2"]["top_score"] == 0.0
    assert best["r0"]["match_summary"].startswith("design/late:")
    names = [f"{t.category_id}/{t.sub_category_id}" for t in TAXONOMY.subs]
    wide = S.scores_wide(scores, names)
    assert wide.columns == ["row_id", *names] and wide.count() == 6
    empty = S.prepare(rows.where("false"), stop)
    assert S.tfidf_scores(empty, TAXONOMY.subs, stop_words=stop).count() == 0


def test_sample_command_keeps_all_columns(spark, tmp_path):
    (tmp_path / "in.csv").write_text("ref,cause,site,top_score\n" + "".join(f" r{k} ,text {k},north,9\n" for k in range(12)), encoding="utf-8")
    (tmp_path / "rows.csv").write_text("row_id,top_category_id,top_score\n" + "".join(f"r{k},c{k % 2},0.{k % 9}\n" for k in range(12)), encoding="utf-8")
    rows = T.read_csv(spark, str(tmp_path / "in.csv"), ("ref", "cause")).withColumn("row_id", X.strip("ref"))
    summaries = T.read_csv(spark, str(tmp_path / "rows.csv"), ("row_id", "top_category_id", "top_score")).withColumn("top_score", X.number("top_score"))
    chosen = R.sample_rows(rows, summaries, 6)
    assert chosen.columns == ["row_id", "ref", "cause", "site", "top_category_id", "top_sub_category_id", "top_score", "score_band"]
    found = chosen.collect()
    assert len(found) == 6 and {r["site"] for r in found} == {"north"} and all(r["top_score"] < 1 and r["top_sub_category_id"] == "" for r in found)


def test_seeds_and_embedding_texts_as_declared(spark):
    target = T.Target(0, "c", "s", "Label", "Words", ("Late CHANGE", "x"), ("Design",))
    texts = spark.createDataFrame([(target.ord, " ".join(target.seeds).upper())], "ord int, text string")
    assert texts.select(S.matched_seeds([target]).alias("m")).first()["m"] == list(target.seeds)[:5]
    assert C.embed_text(target).endswith(". ".join([*target.seeds, *target.category_seeds]))


def test_runs_and_clients(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{k}", k, t) for k, t in enumerate(TEXTS)], "row_id string, row_ord long, text string")
    client = C.FakeClient(TAXONOMY.subs)
    results = R.classify_many(rows, TAXONOMY, ["tfidf", "llm_embed", "llm_prompt"], client)
    combined = {(r["row_id"], r["sub_category_id"]): r for r in results["combined"].collect()}
    r = combined["r4", "late"]
    mean = (r["tfidf_score"] + r["llm_embed_score"] + r["llm_prompt_score"]) / 3
    assert len(combined) == 18 and abs(r["ensemble_score"] - mean) < 1e-4
    assert combined["r2", "late"]["llm_embed_score"] is None and combined["r2", "late"]["ensemble_score"] == 0.0
    assert results["llm_prompt"]["all_scores_sub"].count() == 15  # rows without text are not asked
    with pytest.raises(ValueError):
        R.classify(rows, TAXONOMY, "llm_embed")
    found = R.discover(rows, TAXONOMY, results["tfidf"]["row_scores"], min_df=2)
    assert "late" not in {r["phrase"] for r in found["keywords"].collect()}
    assert R.run_id(["tfidf"], TAXONOMY).split("-")[1] == "tfidf"
    rows.write.parquet(str(tmp_path / "in" / "1"))
    folder, out, state = str(tmp_path / "in" / "*"), str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        incremental.score_new_rows(spark, folder, out, state, TAXONOMY.subs, client).awaitTermination()
    rows.where("row_ord < 3").union(spark.createDataFrame([("new", 9, "late again")], rows.schema)).write.parquet(str(tmp_path / "in" / "2"))
    incremental.score_new_rows(spark, folder, out, state, TAXONOMY.subs, client).awaitTermination()
    assert sorted(r["row_id"] for r in spark.read.parquet(out).collect()) == ["new", "r0", "r1", "r3", "r4", "r5"]


def test_prompt_answers(spark):
    answer = {"sub_category_scores": [{"category_id": "design", "sub_category_id": "late", "score": 0.9, "reasoning": "x" * 300}, {"category_id": "design", "sub_category_id": "late", "score": "0.4"}, {"category_id": "no", "sub_category_id": "such", "score": 1}, {"category_id": "design", "sub_category_id": "bad", "score": "high"}]}
    rows = [("a", 0, "```json\n" + json.dumps(answer) + "\n```"), ("b", 1, "not json"), ("c", 2, None)]
    targets = T.targets_frame(spark, TAXONOMY.subs)
    got = S.prompt_scores(spark.createDataFrame(rows, "row_id string, row_ord long, response string"), targets)
    counted = collections.Counter((r["row_id"], r["sub_category_id"], r["score"]) for r in got.collect())
    assert counted == {("a", "late", 0.9): 1, ("a", "late", 0.4): 1, ("a", "bad", 0.0): 1, ("a", "faulty", 0.0): 1, **{(k, s, 0.0): 1 for k in "bc" for s in ("late", "bad", "faulty")}}
    assert max(len(r["signals"]) for r in got.collect()) == 200
    best = {r["row_id"]: r["top_category_id"] for r in S.row_scores(got, 0.5, needs_match=True).collect()}
    assert best == {"a": "design", "b": None, "c": None}


def test_keywords(spark):
    texts = ["ITP-900 failed pump check", "pump check failed again", "pump check 900 done", "other words"]
    rows = spark.createDataFrame([(f"r{k}", k, t, "x" if k < 3 else "y") for k, t in enumerate(texts)], "row_id string, row_ord long, text string, cat string")
    found = {r["phrase"]: r for r in M.keywords(rows, ["Pump"], min_df=2).collect()}
    assert set(found) == {"check", "pump check", "failed", "900"}
    assert found["check"]["doc_count"] == 3 and found["check"]["sample_row_ids"] == ["r0", "r1", "r2"]
    by = M.keywords(rows, by="cat", min_rows=2, min_df=2).collect()
    assert {r["cat"] for r in by} == {"x"}


def test_sampling(spark):
    rows = spark.createDataFrame([(k, "a" if k < 90 else "b" if k < 95 else "c") for k in range(100)], "row_id int, s string")
    counted = collections.Counter(r["s"] for r in M.stratified_sample(rows, ["s"], 30).collect())
    assert counted == {"a": 20, "b": 5, "c": 5}
    assert M.stratified_sample(rows, ["s"], 500).count() == 100 and M.stratified_sample(rows, ["s"], 2).count() == 2
    again = [r["row_id"] for r in M.stratified_sample(rows.repartition(7), ["s"], 30).orderBy("row_id").collect()]
    assert again == [r["row_id"] for r in M.stratified_sample(rows, ["s"], 30).orderBy("row_id").collect()]
    assert [one(spark, M.band(F.col("c")), x, "double") for x in (0.0, 0.2, 0.5, 1.0, -0.1)] == ["low", "med", "high", "high", "high"]


def test_evaluation(spark):
    schema = "row_id string, category_id string, sub_category_id string"
    labels = spark.createDataFrame([("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")], schema)
    predicted = spark.createDataFrame([("1", "a", "x", 0.4), ("1", "a", "x", 0.9), ("2", "a", "x", 0.5), ("9", "a", "x", 1.0)], schema + ", score double")
    out = R.evaluate(predicted, labels)
    rows = {(r["level"], r["sub_category_id"]): r for r in out["sub_summary"].collect()}
    assert (rows["micro", ""]["tp"], rows["micro", ""]["fp"], rows["micro", ""]["fn"]) == (1, 1, 2)
    assert rows["target", "x"]["precision"] == 0.5 and rows["target", "x"]["recall"] == 1.0 and rows["target", "x"]["f1"] == 0.6667
    assert rows["macro", ""]["n_labels"] == 3 and rows["macro", ""]["f1"] == 0.2222
    assert [(r["error"], r["row_id"], r["score"]) for r in out["sub_errors"].collect()] == [("fp", "2", 0.5), ("fn", "2", 0.0), ("fn", "3", 0.0)]
    assert {r["level"]: r["tp"] for r in out["category_summary"].collect()}["micro"] == 2
    sweep = {r["threshold"]: r["n_predictions"] for r in M.threshold_sweep(predicted, labels, [0.45, 0.95]).collect()}
    assert sweep == {0.45: 2, 0.95: 0}


def test_quality_model(spark):
    rows = spark.createDataFrame([(k, f"rework defect number {k}" if k % 2 else f"weather permit number {k}", bool(k % 2)) for k in range(60)], "row_id int, text string, label boolean")
    model, report = Q.train(rows)
    assert report["accuracy"] == 1.0 and report["n_yes"] == 30
    p = {r["row_id"]: r["ml_probability"] for r in Q.predict(model, rows.select("row_id", "text")).collect()}
    assert p[1] > 0.5 > p[2]
    with pytest.raises(ValueError):
        Q.train(rows.where("label"))


def test_windows(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert incremental.event_windows(events).agg(F.sum("n")).first()[0] == events.count()
    assert text_queries.TAXONOMY.subs


def test_vocabulary_holds_few_grams(spark):
    """The vocabulary is that of all n-grams, and what is held while counting follows its size."""
    draw = random.Random(5)
    texts = [" ".join(f"w{min(draw.randrange(60), draw.randrange(60))}" for _ in range(40)) for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    df, total = collections.Counter(), collections.Counter()
    for t in texts:
        words = t.split()
        found = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
        total.update(found)
        df.update(set(found))
    for most in (20, 150, 100_000):
        want = sorted((t for t in df if 2 <= df[t] <= 0.95 * 60), key=lambda t: (-total[t], t))[:most]
        got = S.vocabulary(rows, 60, [], most=most)
        assert got.df == {t: df[t] for t in want}
        assert max(got.grams.sizes()) <= 2 * most
