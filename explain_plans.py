"""Write PLANS.md: the physical plan of every registered batch query, of the
partitioned write of raw readings, and of a micro-batch of each stateful stream.

Usage: ``python explain_plans.py [sf_dir]`` (default /root/testdata/sf0.1).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from gridsense.session import get_session
    spark = get_session("local[8]", "gridsense-plans", conf={
        "spark.sql.shuffle.partitions": "8", "spark.sql.maxMetadataStringLength": "400"})
    spark.sparkContext.setLogLevel("ERROR")
    from pyspark.sql import functions as F
    from gridsense.plans import jobs
    from gridsense.plans.queries import QUERIES
    from gridsense.sources import events as ev
    from gridsense.sources.io import read_messages, write_messages
    from gridsense.streaming.sinks import wait_for
    out = ["# Physical plans", "",
           f"`python explain_plans.py {sf_dir}`; `explain()` before execution (AQE may",
           "still coalesce partitions or turn a join into a broadcast at run time).", ""]

    def add(name, text):
        plan = re.sub(r"#\d+L?", "", text.strip())  # expression ids add noise
        plan = re.sub(r"file:/\S+/", "", plan)
        out.extend([f"## {name}", "", "```", plan, "```", ""])

    def explained(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    for name, q in QUERIES.items():
        if not name.startswith("stream_") and name != "store_twice":
            add(name, explained(q(spark, sf_dir)))

    # The raw store's write: its rows as they reach the writer.
    env = jobs.ingest_raw(ev.event_messages(spark, sf_dir, motion=True), sensors=ev.EVENT_SENSORS)
    parts = jobs.LAYOUT["raw"]
    rows = env.withColumn("month", F.trunc(F.to_date("DateTime"), "month"))
    add("write of raw readings", explained(rows.hint("rebalance", *map(F.col, parts)).sortWithinPartitions(*parts, "DateTime")))

    # One micro-batch of each stage-one stream and of the leak stream.
    from gridsense.session import new_work_path
    root = new_work_path(spark, "plans")
    once = {"availableNow": True}
    msgs = ev.event_messages(spark, sf_dir, motion=True, stream=True)
    src = write_messages(ev.counter_messages(spark, sf_dir), new_work_path(spark, "plans-src"))
    msgs = msgs.unionByName(read_messages(spark, src, stream=True))
    started = jobs.start_household(msgs, root, sensors=ev.EVENT_SENSORS, late_sensors=(ev.SUB_METER,), trigger=once)
    wait_for(started)
    leak = jobs.start_leak(spark, root, pairs=((ev.SUB_METER, ev.COUNTER),), trigger=once)
    wait_for([leak])
    for query in (*started, leak):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            query.explain()
        add(f"stream {query.name}", buf.getvalue())
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
