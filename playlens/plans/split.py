"""Split of the raw log into typed per-event tables.

All events live in one table partitioned by (event_date, event_name) whose
columns are the union of what the events carry. One scan of the raw day fills
it; a per-event table is a partition filter plus a projection of it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.config import DEFAULT_GAME, Game
from playlens.functions.bags import Bag, unfused
from playlens.functions.dates import export_date

BASE = (
    "user_pseudo_id", "user_id", "event_name", "event_date", "event_timestamp",
    "event_ts", "ga_session_id",
)
# Output column -> field of the raw event.
CONTEXT_FIELDS = {
    "geo_country": "geo.country",
    "geo_region": "geo.region",
    "geo_city": "geo.city",
    "device_category": "device.category",
    "device_os": "device.operating_system",
    "device_os_version": "device.operating_system_version",
    "device_brand": "device.mobile_brand_name",
    "device_model": "device.mobile_model_name",
    "device_language": "device.language",
    "app_version": "app_info.version",
    "app_id": "app_info.id",
    "install_store": "app_info.install_store",
    "install_source": "app_info.install_source",
    "traffic_name": "traffic_source.name",
    "traffic_medium": "traffic_source.medium",
    "traffic_source": "traffic_source.source",
}
# Output column -> user property.
CONTEXT_PROPERTIES = {
    "up_media_source": "media_source",
    "up_campaign": "campaign",
    "up_adset": "adset",
}
CONTEXT = (*CONTEXT_FIELDS, *CONTEXT_PROPERTIES, "ga_session_number")
VARIANT = "exp_variant"


def split_events(
    raw: DataFrame, game: Game = DEFAULT_GAME, names: Iterable[str] | None = None
) -> DataFrame:
    """Typed events of all configured names (or just ``names``) in one pass."""
    kept = list(game.events if names is None else names)
    name = F.col("event_name")
    in_context = name.isin(list(game.context_events))
    params, properties = Bag("event_params"), Bag("user_properties")

    rows = params.with_texts(raw.where(name.isin(kept)))

    def param(p: str) -> Column:
        # A parameter an event does not declare is dropped.
        declared = name.isin(game.owners(p))
        if p in game.numeric_params:
            return F.when(declared, params.first_num(p)).alias(p)
        # The condition sits on the key, so that the lookups still share their work.
        return params.first_str(F.when(declared, F.lit(p))).alias(p)

    cols: list[Column] = [
        F.col("user_pseudo_id"),
        unfused(F.col("user_id")).alias("user_id"),
        name,
        export_date(F.col("event_date")).alias("event_date"),
        F.col("event_timestamp"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        params.first_int_text("ga_session_id").alias("ga_session_id"),
        properties.first_property(game.screen_property).alias("current_screen"),
        *[F.when(in_context, F.col(src)).alias(out) for out, src in CONTEXT_FIELDS.items()],
        *[
            F.when(in_context, properties.first_property(key)).alias(out)
            for out, key in CONTEXT_PROPERTIES.items()
        ],
        # Kept on every row: session-1 journeys need it. event_table() hides it.
        params.first_int_text("ga_session_number").alias("ga_session_number"),
        *[param(p) for p in game.params],
    ]
    if game.variant_property:
        cols.append(properties.first_property(game.variant_property).alias(VARIANT))
    return rows.select(*cols)


def typed_schema(game: Game = DEFAULT_GAME) -> T.StructType:
    """Schema of the typed event table."""
    types: dict[str, T.DataType] = dict.fromkeys(
        (*BASE, "current_screen", *CONTEXT, *game.params), T.StringType()
    )
    types["event_date"] = T.DateType()
    types["event_timestamp"] = T.LongType()
    types["event_ts"] = T.TimestampType()
    types.update({p: T.DoubleType() for p in game.params if p in game.numeric_params})
    if game.variant_property:
        types[VARIANT] = T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def read_events(spark: SparkSession, root: str, game: Game = DEFAULT_GAME) -> DataFrame:
    """The stored typed event table (no schema inference)."""
    return spark.read.schema(typed_schema(game)).parquet(root)


def event_columns(name: str, game: Game = DEFAULT_GAME) -> list[str]:
    context = CONTEXT if name in game.context_events else ()
    return [*BASE, "current_screen", *context, *game.events[name]]


def event_table(events: DataFrame, name: str, game: Game = DEFAULT_GAME) -> DataFrame:
    """The table of one event: its rows and exactly its own columns."""
    return events.where(F.col("event_name") == name).select(*event_columns(name, game))


def all_events(events: DataFrame, game: Game = DEFAULT_GAME) -> DataFrame:
    """One view over all events with the columns every event has."""
    extra = [VARIANT] if game.variant_property else []
    return events.select(*BASE, "current_screen", "ga_session_number", *extra)


def aligned_union(events: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """All event tables stacked on six common columns, as a filter of one table."""
    kept = events.where(~F.col("event_name").isin(list(exclude))) if exclude else events
    return kept.select(
        "user_pseudo_id",
        "event_name",
        "event_timestamp",
        "current_screen",
        "minigame_id",
        F.when(F.col("event_name") == "ad_impression", F.col("value")).alias("imp_value"),
    )
