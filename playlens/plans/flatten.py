"""Staging: one flat row per event, and the narrow base table (jobs K1, K2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.config import BASE_COLUMNS, EXPERIMENT_PREFIX, LOCAL_ZONE, FlattenSpec
from playlens.functions.bags import Bag
from playlens.functions.dates import export_date, local_date_from_micros, local_date_from_millis
from playlens.functions.labels import surrogate_key, variant_label
from playlens.operators.keys import dedup_first, new_rows_only

KEY = "surrogate_key"
# Output column -> field of the raw event.
FIELDS = {
    "event_timestamp": "event_timestamp",
    "event_name": "event_name",
    "user_pseudo_id": "user_pseudo_id",
    "platform": "platform",
    "event_value_in_usd": "event_value_in_usd",
    "app_version": "app_info.version",
    "device_mobile_marketing_name": "device.mobile_marketing_name",
    "device_mobile_model_name": "device.mobile_model_name",
    "device_operating_system_version": "device.operating_system_version",
    "advertising_id": "device.advertising_id",
    "language": "device.language",
    "country": "geo.country",
    "city": "geo.city",
    "continent": "geo.continent",
}


def flatten(raw: DataFrame, spec: FlattenSpec, zone: str = LOCAL_ZONE) -> DataFrame:
    """Nested events as flat rows, still with duplicates; a narrow projection."""
    params, properties = Bag("event_params"), Bag("user_properties")
    day = (
        local_date_from_micros(F.col("event_timestamp"), zone)
        if spec.date_from_timestamp
        else export_date(F.col("event_date"))
    )
    level = (
        params.max_by_key("level", "string_value").try_cast("bigint")
        if spec.text_level
        else params.max_by_key("level", "int_value")
    )
    duration = (
        F.round(params.max_by_key("play_time", "double_value")).try_cast("bigint")
        if spec.rounded_duration
        else params.max_by_key("play_duration", "int_value")
    )
    actions = (
        params.concat_prefix(spec.action_prefix)
        if spec.action_prefix
        else params.concat_keys(spec.action_keys)
    )
    # The text-level game casts the largest text, the other takes the largest number;
    # they differ when the property repeats ("9" > "10" as text).
    current_level = (
        properties.max_by_key("current_level", "string_value").try_cast("bigint")
        if spec.text_level
        else properties.max_number_of_text("current_level")
    )
    exprs: dict[str, Column] = {out: F.col(src) for out, src in FIELDS.items()}
    exprs.update({o: params.max_by_key(*where) for o, where in spec.params.items()})
    exprs.update({o: properties.max_by_key(*where) for o, where in spec.properties.items()})
    exprs.update(
        {
            KEY: surrogate_key("user_pseudo_id", "event_timestamp", "event_name"),
            "event_date": day,
            "current_level": current_level,
            "first_open_date": local_date_from_millis(
                properties.max_by_key("first_open_time", "int_value"), zone
            ),
            "firebase_exp": variant_label(properties.max_by_prefix(EXPERIMENT_PREFIX)),
            "level": level,
            "play_duration": duration,
            "action_sequence": actions,
            "event_params_json": params.lifted(),
        }
    )
    return raw.select(*[exprs[c].alias(c) for c in spec.columns])


def unique_events(flat: DataFrame, spec: FlattenSpec) -> DataFrame:
    """One row per key. The key holds the timestamp, so ordering by time alone
    always ties; the content decides, to get the same row on every run.

    Columns read from the parameters follow from the parameter array, so hashing
    that array and the rest of the row covers them.
    """
    follows = {KEY, *spec.params, "level", "play_duration", "action_sequence"}
    content = F.xxhash64(*[c for c in flat.columns if c not in follows])
    return dedup_first(flat, KEY, [F.col("event_timestamp"), content])


def flatten_new(
    raw: DataFrame, spec: FlattenSpec, known: DataFrame | None = None, zone: str = LOCAL_ZONE
) -> DataFrame:
    """Flat, deduplicated rows of a load window that ``known`` does not hold yet.

    Deduplicating first lets the anti join reuse the partitioning by key. Both
    steps act on whole keys, so their order does not change the result.
    """
    unique = unique_events(flatten(raw, spec, zone), spec)
    return unique if known is None else new_rows_only(unique, known, KEY)


def base_columns(flat: DataFrame) -> list[str]:
    return [c for c in BASE_COLUMNS if c in flat.columns]


def event_base(
    flat: DataFrame,
    spec: FlattenSpec,
    run_date: dt.date,
    known: DataFrame | None = None,
) -> DataFrame:
    """Narrow base table from flat rows; later runs take only the recent days."""
    rows = flat
    if known is not None:
        oldest, newest = spec.later_window
        day = F.col("event_date")
        rows = rows.where(day >= F.lit(run_date - dt.timedelta(days=oldest)))
        if newest is not None:
            rows = rows.where(day <= F.lit(run_date - dt.timedelta(days=newest)))
    out = rows.select(*base_columns(flat))
    return out if known is None else new_rows_only(out, known, KEY)
