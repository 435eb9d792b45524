"""Command line of the jobs, for ``spark-submit`` or ``python -m pedalflow``.

Messages are in Kafka topics (``--broker``) or in folders of the same names (``--messages``).
"""

import argparse

from pyspark.sql import functions as F

from . import constants as c
from .operators.features import feature_rows, split
from .plans import forecast as fc
from .plans.publish import info_messages
from .session import build_session, stored
from .sources.channels import file_channel, kafka_channel, write_messages
from .sources.documents import read_documents, stream_documents
from .sources.summary import compact_summary, expire_summary, read_summary
from .streaming import jobs
from .streaming.scoring import start_score_job

USAGE_JOBS = {"usage-30m": (c.GRAIN_30M, c.DELAY_30M), "usage-1m": (c.GRAIN_1M, c.DELAY_1M)}


def _parser():
    parser = argparse.ArgumentParser(prog="pedalflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, help, messages=True):
        sub = commands.add_parser(name, help=help)
        if messages:
            place = sub.add_mutually_exclusive_group()
            place.add_argument("--broker", default=c.DEFAULT_BROKER)
            place.add_argument("--messages", help="folder of message files instead of a broker")
        return sub

    def streaming(sub, every=None):
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--every", default=every, help='time between micro-batches, such as "60 seconds"')
        sub.add_argument("--once", action="store_true", help="process what is there and end")

    for name, (grain, _) in USAGE_JOBS.items():
        sub = command(name, f"usage summary per {grain}")
        streaming(sub, "60 seconds")
        sub.add_argument("--out", required=True)
        sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        sub.add_argument("--show", action="store_true", help="also print each batch")
        sub.add_argument("--monitor", action="store_true", help="also print both windowed aggregates")
    sub = command("enrich", "status rows with the columns of their station")
    streaming(sub, "60 seconds")
    sub.add_argument("--out", required=True)
    sub = command("weather", "print weather messages")
    sub.add_argument("--every", default="10 seconds")
    sub.add_argument("--once", action="store_true")

    sub = command("publish-stations", "publish landed station list documents once")
    sub.add_argument("--documents", required=True)
    for name, every in {"publish-status": c.STATUS_CYCLE, "publish-weather": c.WEATHER_CYCLE}.items():
        sub = command(name, "publish landed documents as they come")
        streaming(sub, every)
        sub.add_argument("--documents", required=True)
        sub.add_argument("--city", default=c.DEFAULT_CITY)

    sub = command("train", "fit and judge the forecast, store the model", messages=False)
    sub.add_argument("--summary", required=True, help="dataset or CSV file of the usage summary")
    sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    sub.add_argument("--grain", help="window length, if the dataset holds several")
    place = sub.add_mutually_exclusive_group(required=True)
    place.add_argument("--model", help="folder of one model, replaced")
    place.add_argument("--models", help="folder of versions, to which one is added")
    sub.add_argument("--by-rows", type=int, help="take the n-th next row instead of the row one hour later")
    sub.add_argument("--cutoff", help="train before this time and test after it, instead of by hash")

    sub = command("score", "score the latest window of each city by the newest model", messages=False)
    streaming(sub, "60 seconds")
    sub.add_argument("--summary", required=True, help="dataset of the usage summary")
    sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    sub.add_argument("--grain", default=c.GRAIN_30M)
    sub.add_argument("--models", required=True, help="folder of published models")
    sub.add_argument("--out", required=True)

    sub = command("compact", "rewrite the batches of a usage summary as few files", messages=False)
    sub.add_argument("--summary", required=True)
    sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    sub.add_argument("--grain", required=True)
    sub.add_argument("--expire", type=float, metavar="SECONDS", help="also delete folders replaced longer ago than that")
    return parser


def _usage(spark, args, channel, every):
    grain, delay = USAGE_JOBS[args.command]
    feeds = channel(c.TOPIC_STATION_STATUS), channel(c.TOPIC_WEATHER)
    queries = [
        jobs.start_usage_job(
            spark, *feeds, args.out, args.checkpoint, grain, delay, args.format, every, args.show
        )
    ]
    if args.monitor:
        queries += jobs.start_window_monitors(spark, *feeds, args.checkpoint, grain, delay, every)
    return queries


def _publish(spark, args, channel, every):
    documents = stream_documents(spark, args.documents)
    if args.command == "publish-status":
        target = channel(c.TOPIC_STATION_STATUS)
        return [jobs.start_status_publisher(documents, target, args.checkpoint, args.city, every)]
    return [jobs.start_weather_publisher(documents, channel(c.TOPIC_WEATHER), args.checkpoint, args.city, every)]


def _train(spark, args):
    summary = read_summary(spark, args.summary, args.format, args.grain)
    rows = stored(split(feature_rows(summary, rows=args.by_rows), args.cutoff), "features")
    fitted = fc.fit_forecast(rows.where(F.col("part") == "train"))
    fc.metrics(fc.score(fitted.model, rows.where(F.col("part") == "test"))).show()
    for name, weight in fitted.importances:
        print(f"{name:16} {weight:.3f}")
    if args.models:
        print(f"version {fc.publish_model(fitted.model, args.models)}")
    else:
        fc.save_model(fitted.model, args.model)
    fc.forecast_latest(fitted.model, rows).select("city", "time_t1h", "prediction").show(truncate=False)


def _compact(spark, args):
    print(f"{compact_summary(spark, args.summary, args.grain, args.format)} folders rewritten")
    if args.expire is not None:
        print(f"{expire_summary(spark, args.summary, args.grain, args.expire)} folders deleted")


def main(argv=None):
    args = _parser().parse_args(argv)
    spark = build_session(f"pedalflow {args.command}")
    if args.command == "train":
        return _train(spark, args)
    if args.command == "compact":
        return _compact(spark, args)

    def channel(topic):
        return file_channel(f"{args.messages}/{topic}") if args.messages else kafka_channel(topic, args.broker)

    if args.command == "publish-stations":
        return write_messages(info_messages(read_documents(spark, args.documents)), channel(c.TOPIC_STATION_INFO))
    every = None if args.once else args.every
    if args.command in USAGE_JOBS:
        queries = _usage(spark, args, channel, every)
    elif args.command == "enrich":
        info, status = channel(c.TOPIC_STATION_INFO), channel(c.TOPIC_STATION_STATUS)
        queries = [jobs.start_enrich_job(spark, info, status, args.out, args.checkpoint, every)]
    elif args.command == "score":
        queries = [start_score_job(spark, args.summary, args.models, args.out, args.checkpoint, args.grain, args.format, every)]
    elif args.command == "weather":
        queries = [jobs.start_weather_console(spark, channel(c.TOPIC_WEATHER), every)]
    else:
        queries = _publish(spark, args, channel, every)
    return jobs.finish(*queries) if args.once else jobs.watch(spark, *queries)


if __name__ == "__main__":
    main()
