"""Time, exchanges and shuffled bytes per query: ``python -m checks.measure [sf_dir]``."""

from __future__ import annotations

import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from bench import HEADLINE
from checks.registry import QUERIES
from playlens.session import local_session

RUNS = 3


def shuffled_bytes(spark: SparkSession) -> int:
    """Bytes all finished stages of the session have written to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark._jvm.java.util.ArrayList()
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = store.stageList(none, False, False, quantiles, none)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | seconds | exchanges | shuffled KB |\n| --- | --- | --- | --- |")
    for key in argv[1:] or HEADLINE:
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times = []
        before = shuffled_bytes(spark)
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        moved = (shuffled_bytes(spark) - before) / RUNS
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"[ -]Exchange ", plan))
        seconds = statistics.median(times)
        print(f"| `{key}` | {seconds:.2f} | {exchanges} | {moved / 1024:.0f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
