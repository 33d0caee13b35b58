"""Run the household application as streaming queries.

    spark-submit gridsense/app.py --messages <folder> --root <folder> [--fmt parquet]
    spark-submit gridsense/app.py --fmt kafka --option kafka.bootstrap.servers=.. \
        --option subscribe=<topics> --kafka kafka.bootstrap.servers=.. --root <folder>

Stage one (gauge roll-ups, counter differences, accepted and rejected
sub-meter sums) reads the message folder; stage two joins two of its topics
into the leak topic; with ``--store``, further queries keep raw readings and
results as datasets for the panels. Topics and checkpoints live under
``--root``, which should be in the cluster's shared storage. ``--once``
processes what is available and stops (a catch-up run, which may be repeated
any number of times); otherwise the queries run until one fails or is
stopped, like the reference's jobs.
"""

from __future__ import annotations

import argparse

from gridsense.plans import jobs
from gridsense.session import get_session
from gridsense.sources.io import read_messages
from gridsense.streaming.sinks import run_all, wait_for


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--messages", default=None, help="folder of (topic, payload) messages")
    p.add_argument("--root", required=True, help="folder for topics and checkpoints")
    p.add_argument("--fmt", default="parquet", help="parquet, json or kafka")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="source option (e.g. kafka.bootstrap.servers=host:9092, subscribe=..)")
    p.add_argument("--kafka", action="append", default=[], metavar="KEY=VALUE",
                   help="write topics to Kafka with these connector options")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--store", default=None, help="also keep raw readings and results as datasets here")
    p.add_argument("--compact-every", type=int, default=None,
                   help="compact result topics after so many batches and remove what their readers have read")
    p.add_argument("--counter-days", type=int, default=None,
                   help="hold so many days of each counter as state, whatever its history")
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    a = p.parse_args(argv)
    if a.fmt != "kafka" and not a.messages:
        p.error("--messages is needed unless --fmt kafka")
    if a.store and a.kafka:
        p.error("--store keeps folder topics; it does not read Kafka topics")

    spark = get_session(app_name="gridsense-household")
    trigger = {"availableNow": True} if a.once else None
    options = dict(kv.split("=", 1) for kv in a.option)
    kafka = dict(kv.split("=", 1) for kv in a.kafka) or None
    msgs = read_messages(spark, a.messages, fmt=a.fmt, stream=True, options=options,
                         max_files_per_trigger=a.max_files_per_trigger)
    def done(queries):
        if a.once:
            wait_for(queries)  # when one fails the others are stopped
        return queries

    started = done(jobs.start_household(
        msgs, a.root, trigger=trigger, kafka=kafka, compact_every=a.compact_every, store_root=a.store,
        counter_days=a.counter_days))
    if a.store:
        started += done([jobs.start_raw_store(msgs, a.store, trigger=trigger)])
    started += done([jobs.start_leak(spark, a.root, trigger=trigger, kafka=kafka)])
    if a.store:
        started += done(jobs.start_store(spark, a.root, a.store, trigger=trigger))
    if not a.once:
        run_all(started, spark=spark)


if __name__ == "__main__":
    main()
