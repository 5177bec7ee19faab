"""Command line: prepare, report, profile, stream, train."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from fareloom.operators import correlation_matrix, describe_columns, null_counts
from fareloom.plans import news, prepare, regression, reports
from fareloom.session import build_session, scratch_path
from fareloom.sources import load_table, read_events, save_table
from fareloom.streaming import run_complete, show_forever

STREAMS = {
    "finance": lambda events: news.ranked(news.finance_by_country(events)),
    "devices": lambda events: news.ranked(news.device_usage(events)),
    "sessions": lambda events: news.ranked(news.active_sessions(events), "active_sessions"),
    "spikes": news.article_spikes,
    "bots": news.bot_users,
    "top-countries": news.finance_by_country,
    "exact-sessions": news.session_activity,
}
# Steps on the result of each micro-batch, for queries that need them.
AFTER = {"top-countries": news.top_countries, "exact-sessions": news.count_sessions}


def run_prepare(spark, args) -> None:
    schema = None if args.infer_zones else prepare.ZONE_SCHEMA
    zones = load_table(spark, args.zones, args.zones_format, schema)
    reports.write_prepared(load_table(spark, args.trips), zones, args.out)


def run_report(spark, args) -> None:
    reports.write_reports(spark, args.prepared, args.out)
    if args.show:
        for folder in reports.REPORTS:
            load_table(spark, f"{args.out.rstrip('/')}/{folder}").show(truncate=False)


def run_profile(spark, args) -> None:
    prepared = load_table(spark, args.prepared)
    prepared.printSchema()
    columns = len(prepared.columns)
    for profile in (describe_columns, null_counts):
        profile(prepared).show(columns, truncate=False)
    correlation_matrix(prepared).show(columns**2, truncate=False)


def run_stream(spark, args) -> None:
    options = {"path": args.path, "servers": args.servers, "topic": args.topic}
    bound = "maxOffsetsPerTrigger" if args.source == "kafka" else "maxFilesPerTrigger"
    if args.batch:
        options[bound] = str(args.batch)
    events = read_events(spark, args.source, starting=args.starting, **options)
    stream, post = STREAMS[args.query](events), AFTER.get(args.query)
    if args.out:
        run_complete(stream, args.out, post, args.partitions)
    elif post:
        raise SystemExit(f"{args.query} is written to a folder: give --out")
    else:
        show_forever(
            stream, args.checkpoint, partitions=args.partitions, rows=args.rows
        ).awaitTermination()


def run_train(spark, args) -> None:
    features = regression.FEATURE_SETS[args.features]
    trips = prepare.with_trip_time(load_table(spark, args.prepared))
    if args.tune and args.kind not in regression.GRIDS:
        raise SystemExit(f"--tune needs --kind {' or '.join(regression.GRIDS)}")
    # The random split is written once: training reads its input many times.
    used = trips.select(*dict.fromkeys([*features.columns, args.label]))
    part = F.when(F.rand(42) < 0.8, "train").otherwise("test")
    path = scratch_path(spark, "split")
    save_table(used.withColumn("split", part), path, partition_by=["split"])
    split = load_table(spark, path)
    train, test = (split.filter(F.col("split") == p).drop("split") for p in ("train", "test"))
    if args.tune:
        train = regression.complete_rows(train, features, args.label)
        encoder = regression.fit_features(train, features, args.scale)
        tuned = regression.cross_validate(
            train, args.kind, args.label, features, encoder=encoder
        )
        scores = regression.grid_scores(tuned, train)
        scores.show(len(tuned.avgMetrics), truncate=False)
        model = regression.whole_model(encoder, tuned)
        predictions = regression.predict(model, test, features, args.label)
    else:
        model = regression.fit(train, args.kind, args.label, features, args.scale)
        predictions = regression.predict(model, test, features, args.label)
    regression.metrics(predictions, args.label).show()
    regression.top_predictions(predictions, args.label, ["prediction"]).show(100)
    if args.model:
        regression.save_model(model, args.model)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fareloom")
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("prepare", help="raw trips and zones to one prepared table")
    job.add_argument("--trips", required=True)
    job.add_argument("--zones", required=True)
    job.add_argument("--zones-format", default="csv", choices=["csv", "parquet"])
    job.add_argument("--infer-zones", action="store_true", help="infer the CSV types")
    job.add_argument("--out", required=True)
    job.set_defaults(run=run_prepare)

    job = jobs.add_parser("report", help="all trip reports")
    job.add_argument("--prepared", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--show", action="store_true")
    job.set_defaults(run=run_report)

    job = jobs.add_parser("profile", help="schema, description, nulls, correlations")
    job.add_argument("--prepared", required=True)
    job.set_defaults(run=run_profile)

    job = jobs.add_parser("stream", help="a news query on the console until stopped")
    job.add_argument("query", choices=list(STREAMS))
    job.add_argument("--source", default="kafka", choices=["kafka", "text"])
    job.add_argument("--servers")
    job.add_argument("--topic", default="news_events")
    job.add_argument("--starting", default="latest")
    job.add_argument("--path")
    job.add_argument("--checkpoint")
    job.add_argument("--out", help="process what is there into this folder instead of printing")
    job.add_argument("--batch", type=int, help="most files or offsets of a micro-batch")
    job.add_argument("--partitions", type=int, help="state partitions")
    job.add_argument("--rows", type=int, default=1000, help="rows printed of a micro-batch")
    job.set_defaults(run=run_stream)

    job = jobs.add_parser("train", help="fit, score and save a regression")
    job.add_argument("--prepared", required=True)
    job.add_argument("--kind", default="linear", choices=list(regression.ESTIMATORS))
    job.add_argument("--label", default="total_amount")
    job.add_argument("--features", default="clean", choices=list(regression.FEATURE_SETS))
    job.add_argument("--scale", action="store_true")
    job.add_argument("--tune", action="store_true", help="cross-validate the full grid")
    job.add_argument("--model")
    job.set_defaults(run=run_train)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session("fareloom"), args)


if __name__ == "__main__":
    main()
