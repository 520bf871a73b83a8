"""Global positions of rows in an order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import stored

LOCAL_BITS = 33  # of ``monotonically_increasing_id``: the row within its task


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its row numbers from 1 in the given order as the column ``name``.

    Rows are dealt to tasks by ranges of the order and written with their number in the task;
    the counts of the tasks, one row each, give the offsets. ``order`` should end in something
    that tells equal rows apart, so that many of them need not meet in one task. An
    empty table gives no rows.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = stored(dealt.withColumn("at_", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("at_", LOCAL_BITS)
    counts = sorted(tuple(r) for r in written.groupBy(task.alias("task_")).count().collect())  # a row for each task
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    offsets = df.sparkSession.createDataFrame(starts, "task_ long, start_ long")
    within = F.col("at_").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    joined = written.withColumn("task_", task).join(F.broadcast(offsets), "task_")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("start_") + within + 1).alias(name))
