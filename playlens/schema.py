"""Spark schema of the raw analytics export, one row per event."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)

# A bag stays an array: keys may repeat, which a MapType would not allow.
BAG = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", VALUE)])
)

RAW_EVENT = T.StructType(
    [
        T.StructField("shard", T.StringType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("event_value_in_usd", T.DoubleType()),
        T.StructField("event_params", BAG),
        T.StructField("user_properties", BAG),
        T.StructField(
            "app_info", _struct("version", "id", "install_store", "install_source")
        ),
        T.StructField(
            "device",
            _struct(
                "category",
                "operating_system",
                "operating_system_version",
                "mobile_brand_name",
                "mobile_model_name",
                "mobile_marketing_name",
                "language",
                "advertising_id",
            ),
        ),
        T.StructField("geo", _struct("country", "region", "city", "continent")),
        T.StructField("traffic_source", _struct("name", "medium", "source")),
    ]
)
