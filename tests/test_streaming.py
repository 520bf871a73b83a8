"""The streaming load ends with the rows of the batch load."""

from __future__ import annotations

import datetime as dt

import pytest

from playlens.config import FLATTEN_B
from playlens.plans.flatten import flatten_new
from playlens.streaming.ingest import stream_flatten
from tests.conftest import DAY0
from tests.test_tables import event

FUTURE = (dt.date(2099, 1, 1) - DAY0).days


def keys(df):
    return sorted(r.surrogate_key for r in df.collect())


@pytest.fixture
def feed(spark, raw, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "flat")

    def load(*events, checkpoint="one", files=1000):
        raw(*events).write.mode("append").partitionBy("shard").parquet(source)
        stream_flatten(spark, source, target, str(tmp_path / checkpoint), FLATTEN_B, files).awaitTermination()
        return spark.read.parquet(target)

    return load


def test_stream_equals_batch_and_survives_a_lost_checkpoint(raw, feed):
    first = [event("loading", "a", day=d) for d in range(3)]
    second = [event("loading", "b", day=d) for d in range(2, 4)]
    feed(*first, *first)
    feed(*second, first[2])
    got = feed(first[0], checkpoint="two")
    assert keys(got) == keys(flatten_new(raw(*first, *second), FLATTEN_B))
    assert {r.event_date for r in got.collect()} == {DAY0 + dt.timedelta(days=d) for d in range(4)}


def test_no_row_is_too_late(raw, feed):
    rows = [
        [event("loading", "a", day=0), event("loading", "a", day=10)],
        [event("loading", "new", day=0), event("loading", "a", day=11)],
        [event("loading", "clock", day=FUTURE)],
        [event("loading", "b", day=11), event("loading", "c", day=1)],
    ]
    for part in rows:
        got = feed(*part, files=1)
    assert keys(got) == keys(flatten_new(raw(*sum(rows, [])), FLATTEN_B))
    got = feed(rows[0][0], rows[2][0], checkpoint="two")
    assert keys(got) == keys(flatten_new(raw(*sum(rows, [])), FLATTEN_B))
