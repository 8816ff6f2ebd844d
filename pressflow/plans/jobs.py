"""The scheduled tasks as commands: publish, train, drain, run, compact, gold, load.

``spark-submit job.py <command> ...``, or call ``main`` with the arguments.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pressflow.fixed_values import MIN_CONTENT_CHARS, TOP_KEYWORDS_PER_DAY
from pressflow.operators.language import LanguageModel, trigram_counts
from pressflow.plans.pipeline import build_gold, load_database, load_warehouse
from pressflow.schemas import BRONZE, SILVER
from pressflow.session import configure
from pressflow.sinks.events import land_text, publish_kafka
from pressflow.sinks.lake import compact
from pressflow.sources.events import kafka_events, landed_events
from pressflow.sources.feeds import article_events, feed_items
from pressflow.sources.pages import extract_pages
from pressflow.streaming.ingest import SOURCE_FOLDERS, Ingest, without_redeliveries

# Layers whose batches can be merged, and their columns.
LAYERS = {"bronze": BRONZE, "silver": SILVER}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=help)

    publish = command("publish", "feeds and pages to article events")
    publish.add_argument("--feeds", required=True, help="table of feed_id, source, xml")
    publish.add_argument("--pages", help="table of page_id, source, url, html")
    publish.add_argument("--max-items", type=int, help="items at the head of each feed only")

    train = command("train", "labelled texts to a language model")
    train.add_argument("--labelled", required=True, help="table of text, lang")
    train.add_argument("--model", required=True)

    ingest = [command("drain", "ingest what is waiting"), command("run", "ingest until stopped")]
    for each in ingest:
        each.add_argument("--lake", required=True)
        each.add_argument("--model")
        each.add_argument("--min-content-chars", type=int, default=MIN_CONTENT_CHARS)
        each.add_argument("--batch-size", type=int, help="messages or files of a micro-batch at most")
        each.add_argument("--drop-copies-within", help="drop exact copies that follow in this time")
    ingest[1].add_argument("--interval", default="1 minute")
    for each in [publish, *ingest]:
        events = each.add_mutually_exclusive_group(required=True)
        events.add_argument("--events", help="folder of JSON lines")
        events.add_argument("--kafka", help="bootstrap servers")

    merge = command("compact", "merge the batches of a layer that were written so far")
    merge.add_argument("--lake", required=True)
    merge.add_argument("--layer", choices=sorted(LAYERS), required=True)
    merge.add_argument("--up-to", type=int, required=True, help="last batch to merge")

    gold = command("gold", "silver to gold tables")
    gold.add_argument("--lake", required=True)
    gold.add_argument("--top-keywords", type=int, default=TOP_KEYWORDS_PER_DAY)
    load = command("load", "gold tables to the warehouse")
    load.add_argument("--database", default="gold")
    load.add_argument("--jdbc", help="URL of a database to load instead of the session catalog")
    load.add_argument("--property", action="append", default=[], help="key=value for the JDBC connection")
    for each in (gold, load):
        each.add_argument("--gold", required=True)
    return parser.parse_args(argv)


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    pages = extract_pages(spark.read.parquet(args.pages)) if args.pages else None
    articles = article_events(feed_items(spark.read.parquet(args.feeds), args.max_items), pages)
    if args.kafka:
        publish_kafka(articles, args.kafka)
    else:
        land_text(articles, args.events)


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    model = LanguageModel.from_counts(spark.read.parquet(args.model)) if args.model else None
    job = Ingest(args.lake, model, args.min_content_chars)
    events: DataFrame = (
        kafka_events(spark, args.kafka, max_offsets_per_trigger=args.batch_size) if args.kafka
        else landed_events(spark, args.events, max_files_per_trigger=args.batch_size))
    if args.drop_copies_within:
        events = without_redeliveries(events, args.drop_copies_within)
    if args.command == "drain":
        print(job.drain(events))
    else:
        job.run_continuously(events, args.interval).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = configure(SparkSession.builder.appName(f"pressflow {args.command}").getOrCreate())
    if args.command == "publish":
        _publish(spark, args)
    elif args.command == "train":
        counts = trigram_counts(spark.read.parquet(args.labelled), "text", "lang")
        counts.write.mode("overwrite").parquet(args.model)
    elif args.command in ("drain", "run"):
        _ingest(spark, args)
    elif args.command == "compact":
        job = Ingest(args.lake)
        if args.layer == "bronze":
            job.compact_bronze(spark, args.up_to)
        else:
            compact(spark, job.layer(args.layer), LAYERS[args.layer], SOURCE_FOLDERS, args.up_to)
    elif args.command == "gold":
        silver = Ingest(args.lake).layer("silver")
        build_gold(spark, silver, args.gold, top_k=args.top_keywords).show(truncate=False)
    elif args.jdbc:
        properties = dict(p.split("=", 1) for p in args.property)
        load_database(spark, args.gold, args.jdbc, properties, args.database)
    else:
        load_warehouse(spark, args.gold, args.database).show(truncate=False)
