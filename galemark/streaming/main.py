"""Run the streaming jobs: spark-submit galemark/streaming/main.py JOB [options].

Jobs: `console` prints the enriched tables, `tables` stores them, `daily` keeps the sums of daily
aggregates, `payloads` keeps comments, short posts and daily air rows by key and stores rejects, `weekly` keeps the weekly means and the readings joined with them.  Messages come from Kafka (--servers) or from landed files (--landed).
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from galemark import fixed_values as fv
from galemark.session import build_session
from galemark.sources import envelope as env
from galemark.streaming import health, jobs


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=("console", "tables", "daily", "payloads", "weekly"))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--landed", help="folder of landed messages")
    parser.add_argument("--out", help="folder for results (all but console)")
    parser.add_argument("--checkpoints", help="checkpoint folder; default: spark.checkpoint.dir")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    parser.add_argument("--health", action="store_true", help="print a log record per batch")
    parser.add_argument("--health-out", help="folder to append log records to, with counts of rejects")
    found = parser.parse_args(argv)
    if found.job != "console" and not found.out:
        parser.error("--out is needed")
    return found


def source_of(spark: SparkSession, args: argparse.Namespace) -> Callable[[str], DataFrame]:
    """The messages of one topic, each as a stream of its own."""
    if args.servers:
        return lambda topic: env.kafka_envelope(spark, args.servers, [topic])
    return lambda topic: env.file_envelope(spark, args.landed, [topic])


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    source = source_of(spark, args)
    options = {"root": args.checkpoints, "once": args.once}
    if args.health:
        spark.streams.addListener(health.HealthListener())
    kept = None
    if args.health_out:
        kept, plain = health.HealthTable(spark, args.health_out), source
        spark.streams.addListener(kept)
        source = lambda topic: health.observed(plain(topic))
    if args.job == "console":
        started = jobs.start_console(source, **options)
    elif args.job == "tables":
        started = jobs.start_tables(source, args.out, **options)
    elif args.job == "daily":
        started = jobs.start_daily(source, f"{args.out}/daily", **options)
    elif args.job == "payloads":
        started = jobs.start_payloads(source, args.out, **options)
    elif not args.once:
        # Endless: rows written before are corrected as their means change.
        weather = env.parse_weather(source(fv.WEATHER_TOPIC))
        started = [
            jobs.start_weekly_means(weather, f"{args.out}/weekly_means", **options),
            jobs.start_corrected_metrics(weather, f"{args.out}/climate_metrics", **options),
        ]
    else:
        weather = env.parse_weather(source(fv.WEATHER_TOPIC))
        means, table = f"{args.out}/weekly_means", f"{args.out}/climate_metrics"
        started = [jobs.start_weekly_means(weather, means, **options)]
        # The readings take the means as stored, so these come first.
        started[0].awaitTermination()
        started.append(jobs.start_climate_metrics(weather, means, table, **options))
    if args.once:
        for query in started:
            query.awaitTermination()
        if kept:
            kept.flush()
    else:
        jobs.await_any(spark)


if __name__ == "__main__":
    run(build_session("galemark"), arguments())
