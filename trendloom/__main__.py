"""Run a job from the command line.

    python -m trendloom bronze    --root s3a://lake --checkpoints s3a://lake/_cp --servers broker:9092
                                  [--interval "30 seconds"] [--broker-option maxOffsetsPerTrigger=100000 ...]
    python -m trendloom silver    --root s3a://lake [--since 2024-01-31T00:00:00]
    python -m trendloom follow    --root s3a://lake --checkpoints s3a://lake/_cp --servers broker:9092
    python -m trendloom fold      --root s3a://lake
    python -m trendloom compact   --root s3a://lake
    python -m trendloom enrich    --root s3a://lake [--size 50] [--max-chars 800] [--list-size 4] [--retries 3] [--breaker 5] [--remember]
    python -m trendloom gold      --root s3a://lake
    python -m trendloom refresh   --root s3a://lake
    python -m trendloom documents --root s3a://lake [--model NAME]
    python -m trendloom ask       --root s3a://lake --questions s3a://lake/questions
    python -m trendloom report    --root s3a://lake
"""

from __future__ import annotations

import argparse
from datetime import datetime

from trendloom.plans import enrich, jobs
from trendloom.plans.refresh import refresh_gold
from trendloom.schemas import FEEDS
from trendloom.session import create_session
from trendloom.sources.messages import topic_stream
from trendloom.sources.tables import TableStore
from trendloom.streaming.bronze import await_feeds, start_feeds
from trendloom.streaming.keyed import start_silver


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trendloom", description="Trend analytics jobs")
    parser.add_argument("job", choices=[
        "bronze", "follow", "silver", "fold", "compact", "enrich", "gold", "refresh", "documents", "ask", "report"
    ])
    parser.add_argument("--root", required=True, help="folder of the table layers")
    parser.add_argument("--format", choices=["delta", "parquet"], help="default: delta if installed")
    parser.add_argument("--servers", default="localhost:9092", help="message brokers (bronze)")
    parser.add_argument("--checkpoints", help="folder of the stream checkpoints (bronze)")
    parser.add_argument("--by-day", action="store_true", help="split Bronze by day of arrival (bronze)")
    parser.add_argument("--since", type=datetime.fromisoformat, help="earliest Bronze arrival (silver)")
    parser.add_argument("--interval", default="30 seconds", help="time between triggers (bronze)")
    parser.add_argument("--broker-option", action="append", default=[], metavar="NAME=VALUE", help="option of the broker source (bronze)")
    parser.add_argument("--max-chars", type=int, help="budget of text per row; default: whole texts (enrich)")
    parser.add_argument("--list-size", type=int, default=enrich.LIST_SIZE, help="topics and entities kept (enrich)")
    parser.add_argument("--questions", help="Parquet table of question_id and question (ask)")
    parser.add_argument("--keep-seconds", type=float, default=3600, help="how long replaced versions of a table are kept for reads")
    parser.add_argument("--retries", type=int, default=0, help="calls after a failed one (enrich)")
    parser.add_argument("--breaker", type=int, help="failures in a row after which a task stops asking (enrich)")
    parser.add_argument("--remember", action="store_true", help="ask each text once (enrich)")
    parser.add_argument("--model", help="name under which vectors are kept between rebuilds (documents)")
    parser.add_argument("--size", type=int, default=enrich.RUN_SIZE, help="rows to enrich")
    parser.add_argument("--parallel-calls", type=int, help="tasks that call the model")
    return parser.parse_args()


def main() -> None:
    options = arguments()
    spark = create_session(f"trendloom-{options.job}")
    store = TableStore(spark, options.root, options.format, options.keep_seconds)
    if options.job in ("bronze", "follow"):
        broker = dict(pair.split("=", 1) for pair in options.broker_option)
        sources = {n: topic_stream(spark, feed.topic, options.servers, **broker) for n, feed in FEEDS.items()}
        checkpoints = options.checkpoints or f"{store.root}/_checkpoints"
    if options.job == "follow":
        await_feeds(spark, start_silver(sources, store, f"{checkpoints}/silver", every=options.interval))
    elif options.job == "bronze":
        await_feeds(spark, start_feeds(
            sources, store.path("bronze", ""), checkpoints, options.interval, store.format, options.by_day
        ))
    elif options.job == "silver":
        print(jobs.run_silver(store, since=options.since))
    elif options.job == "enrich":
        print(jobs.run_enrichment(
            store, size=options.size, parallel_calls=options.parallel_calls, max_chars=options.max_chars, list_size=options.list_size,
            retries=options.retries, breaker=options.breaker, remember=options.remember,
        ))
    elif options.job == "gold":
        print(jobs.run_gold(store))
    elif options.job == "documents":
        print(jobs.run_retrieval(store, model=options.model))
    elif options.job == "refresh":
        print(refresh_gold(store))
    elif options.job == "fold":
        print({f"bronze/{feed}": store.fold_stream("bronze", feed) for feed in FEEDS if store.exists("bronze", feed)})
    elif options.job == "compact":
        print({feed: store.compact("silver", feed) for feed in FEEDS if store.exists("silver", feed)})
    elif options.job == "ask":
        print(jobs.run_questions(store, spark.read.parquet(options.questions)))
    else:
        for name, rows in jobs.report(store).items():
            print(name, *rows, sep="\n  ")
    spark.stop()


if __name__ == "__main__":
    main()
