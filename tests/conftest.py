from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from playlens.plans.split import typed_schema  # noqa: E402
from playlens.schema import RAW_EVENT  # noqa: E402
from playlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY0 = dt.date(2024, 1, 1)


def micros(day: int = 0, seconds: float = 0.0) -> int:
    """Epoch micros of a moment on the given day after 2024-01-01."""
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return int(start.timestamp() * 1_000_000) + day * 86_400_000_000 + int(seconds * 1_000_000)


def entry(key, text=None, number=None, real=None, single=None):
    return {
        "key": key,
        "value": {
            "string_value": text,
            "int_value": number,
            "float_value": single,
            "double_value": real,
        },
    }


@pytest.fixture
def raw(spark):
    """Builds raw events from dicts; anything not given is NULL."""

    def build(*events: dict):
        rows = []
        for e in events:
            row = dict.fromkeys(RAW_EVENT.names)
            row.update(e)
            if row["shard"] is None:
                row["shard"] = row["event_date"]
            rows.append(tuple(row[n] for n in RAW_EVENT.names))
        return spark.createDataFrame(rows, RAW_EVENT)

    return build


@pytest.fixture
def typed(spark):
    """Builds typed events from (name, user, day, columns) tuples."""
    schema = typed_schema()

    def build(*events: tuple):
        rows = []
        for name, user, day, columns in events:
            row = dict.fromkeys(schema.names)
            row.update(
                event_name=name,
                user_pseudo_id=user,
                event_date=DAY0 + dt.timedelta(days=day),
                event_timestamp=micros(day, 3600),
                app_version="1",
                geo_country="Vietnam",
            )
            row.update(columns)
            rows.append(tuple(row[n] for n in schema.names))
        return spark.createDataFrame(rows, schema)

    return build
