"""Command line: ``python -m driftlens.cli COMMAND ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import profiles as P
from .plans import pipelines as R
from .sources import tables as T


def session() -> SparkSession:
    return SparkSession.builder.appName("driftlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="driftlens", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, **options) -> None:
        sub = commands.add_parser(name)
        for a in arguments:
            sub.add_argument(a)
        for key, default in options.items():
            flag = "--" + key.replace("_", "-")
            sub.add_argument(flag, action="store_true") if default is False else sub.add_argument(flag, default=default, type=type(default) if default is not None else str)

    command("run-monthly", "current", "previous", programme="default", period="", previous_period="", out="outputs")
    command("run-batch", "root", programme="default", period_regex=None, out="outputs", skip_existing=None)
    command("aggregate-memos", "root", programme="default", out="outputs")
    command("export-schedule", "current", previous=None, out="outputs", all_tables=False)
    command("export-memos", "current", previous=None, programme="default", slipped_only=False, out="memos.csv")
    command("label-stats", "labels")
    command("train-quality-model", "labels", out="quality_model")
    command("profile", "current", previous=None)
    for engine in ("tfidf", "llm-embed", "llm-prompt"):
        command(f"classify-{engine}", "input", "taxonomy", id_column="row_id", text_column="text", threshold=None, base_url="http://localhost:11434", model="", backend="ollama", out="outputs")
    command("classify-multi", "input", "taxonomy", id_column="row_id", text_column="text", engines="tfidf", base_url="http://localhost:11434", model="", backend="ollama", out="outputs")
    command("sample", "input", "row_scores", id_column="row_id", text_column="text", total=1500, seed=42, out="sample.csv")
    command("eval", "labels", matches=None, all_scores=None, threshold=0.5, out="outputs")
    command("discover-keywords", "input", taxonomy=None, id_column="row_id", text_column="text", max_ngram=3, min_df=3, max_df=5000, limit=500, row_scores=None, by_category_out=None, out="keywords.csv")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    say = lambda value: print(json.dumps(value, indent=2, default=str))
    if a.command == "run-monthly":
        manifest = R.run_monthly(spark, a.current, a.previous, a.programme, a.period, a.previous_period, a.out)
        say({k: v for k, v in manifest.items() if k != "tables"})
    elif a.command == "run-batch":
        done = spark.read.parquet(a.skip_existing).select("reporting_period") if a.skip_existing else None
        results = R.run_batch(spark, a.root, a.programme, a.period_regex, done)
        results["summary"] = R.batch_summary(results)
        for name, df in results.items():
            T.write_parquet(df, f"{a.out}/{name}.parquet")
        say([r.asDict() for r in spark.read.parquet(f"{a.out}/summary.parquet").collect()])  # one row a comparison
    elif a.command == "aggregate-memos":
        rows, counts = P.aggregate_memos(T.read_memo_csvs(spark, a.root), a.programme)
        T.write_parquet(rows, f"{a.out}/memos.parquet")
        say(counts.first().asDict())
    elif a.command == "export-schedule":
        say(R.export_schedule(spark, a.current, a.previous, a.out, a.all_tables))
    elif a.command == "export-memos":
        say({"rows": T.write_csv(R.export_memos(spark, a.current, a.programme, a.previous, a.slipped_only), a.out, P.LABEL_COLUMNS)})
    elif a.command == "label-stats":
        rows = T.read_csv(spark, a.labels, ("is_quality_related", "memo_type_label"))
        say([r.asDict() for r in P.label_stats(rows, P.parse_label("is_quality_related"), "memo_type_label").collect()])
    elif a.command == "train-quality-model":
        from .operators.quality_model import train

        rows = T.read_csv(spark, a.labels, ("chunk_id", "text", "is_quality_related"))
        model, report = train(rows.select(rows["chunk_id"].alias("row_id"), "text", P.parse_label("is_quality_related").alias("label")))
        model.write().overwrite().save(a.out)
        say(report)
    elif a.command == "profile":
        say(R.profile_schedule(spark, a.current, a.previous))
    elif a.command.startswith("classify-"):
        from .operators.model_clients import HttpClient

        rows, taxonomy = T.read_text_rows(spark, a.input, a.id_column, a.text_column), T.load_taxonomy(a.taxonomy)
        client = HttpClient(a.base_url, a.model, a.backend)
        if a.command == "classify-multi":
            results = R.classify_many(rows, taxonomy, a.engines.split(","), client)
            results = {"combined": results.pop("combined"), **{f"{e}_{n}": df for e, tables in results.items() for n, df in tables.items()}}
        else:
            engine = a.command.removeprefix("classify-").replace("-", "_")
            results = R.classify(rows, taxonomy, engine, None if a.threshold is None else float(a.threshold), client)
        for name, df in results.items():
            T.write_parquet(df, f"{a.out}/{name}.parquet")
    elif a.command == "sample":
        summaries = T.read_csv(spark, a.row_scores, ("row_id", "top_category_id", "top_score"))
        from .functions.text import number, strip

        summaries = summaries.withColumn("top_score", number("top_score")).na.fill({"top_score": 0.0})
        rows = T.read_csv(spark, a.input, (a.id_column, a.text_column))
        chosen = R.sample_rows(rows.withColumn("row_id", strip(a.id_column)), summaries, a.total, a.seed)
        say({"rows": T.write_csv(chosen, a.out)})
    elif a.command == "eval":
        scores = T.read_scores(spark, a.matches, "fail") if a.matches else T.read_scores(spark, a.all_scores).where(f"score >= {float(a.threshold)}")
        for name, df in R.evaluate(scores, T.label_columns(T.read_csv(spark, a.labels, ("row_id", "category_id")))).items():
            T.write_parquet(df, f"{a.out}/{name}.parquet")
    elif a.command == "discover-keywords":
        rows = T.read_text_rows(spark, a.input, a.id_column, a.text_column)
        taxonomy = T.load_taxonomy(a.taxonomy) if a.taxonomy else None
        top = T.read_csv(spark, a.row_scores, ("row_id", "top_category_id")).where("top_category_id <> ''") if a.row_scores else None
        found = R.discover(rows, taxonomy, top, most=a.max_ngram, min_df=a.min_df, max_df=a.max_df, limit=a.limit)
        said = {"rows": T.write_csv(found["keywords"], a.out)}
        if top is not None and a.by_category_out:
            said["rows_by_category"] = T.write_csv(found["keywords_by_category"], a.by_category_out)
        say(said)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
