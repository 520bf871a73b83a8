"""Registered queries: the Spark side next to the SQL it is compared with.

Every query reads the whole sample, as raw events or typed events in the stored
layout a real export has. Dates leave as ISO text so both engines print alike.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle as o
from playlens.config import DEFAULT_GAME, FLATTEN_A, FLATTEN_B, LOCAL_ZONE
from playlens.functions import dates, labels
from playlens.functions.bags import Bag
from playlens.functions.numbers import pct, per_mille, ratio
from playlens.operators import ads, cohorts, filters, keys, narrow, sessions
from playlens.plans import (
    census,
    daily_ads,
    delivery,
    flatten,
    funnel,
    incremental,
    journeys,
    ltv,
    minigames,
    parity,
    quality,
    reconcile,
    retention,
    split,
)
from playlens.session import scratch_dir
from playlens.sinks import commits, known_keys, ledger, tables, user_sets
from playlens.sources import sample, shards
from playlens.sources.sample import AS_OF, EXTENDED_GAME, event_store, raw_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
USER, TS, NAME = "user_pseudo_id", "event_timestamp", "event_name"


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text; everything else as it is."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def register(key: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            SQL[key] = sql
        return fn

    return keep


def on_raw(key: str, sql: str | None = None):
    """A query over raw events."""

    def keep(fn: Callable[[DataFrame], DataFrame]):
        register(key, sql)(lambda spark, sf_dir: fn(raw_store(spark, sf_dir)))
        return fn

    return keep


def on_events(key: str, sql: str | None = None, game=DEFAULT_GAME, **variant: bool):
    """A query over typed events."""

    def keep(fn: Callable[[DataFrame], DataFrame]):
        register(key, sql)(lambda spark, sf_dir: fn(event_store(spark, sf_dir, game, **variant)))
        return fn

    return keep


# --- scans -----------------------------------------------------------------

SHARD = ("shard", USER, TS, NAME)


@on_raw("shard_scan_day", o.sql(o.SCAN.format(tag="") + " WHERE d = DATE '2024-01-15'"))
def _(raw):
    return shards.one_day(raw, dt.date(2024, 1, 15)).select(*SHARD)


@on_raw(
    "shard_scan_range",
    o.sql(
        o.SCAN.format(tag="'first' AS run,") + " WHERE d BETWEEN DATE '2024-01-18' AND DATE '2024-01-19' "
        "UNION ALL " + o.SCAN.format(tag="'later' AS run,") + " WHERE d >= DATE '2024-01-18' "
        "UNION ALL " + o.SCAN.format(tag="'daily' AS run,") + " WHERE d = DATE '2024-01-19'"
    ),
)
def _(raw):
    run = dt.date(2024, 1, 20)
    windows = {
        "first": shards.load_window(raw, FLATTEN_B, run, first_run=True),
        "later": shards.load_window(raw, FLATTEN_B, run, first_run=False),
        "daily": shards.load_window(raw, FLATTEN_A, run, first_run=False),
    }
    tagged = [w.select(F.lit(tag).alias("run"), *SHARD) for tag, w in windows.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@on_events(
    "evt_scan",
    o.sql(
        f"SELECT {o.ID}, ev AS event_name, CAST(NULL AS VARCHAR) AS user_id, {o.iso('d')} AS event_date, "
        "CAST(sid AS VARCHAR) AS ga_session_id, scr AS current_screen, mg AS minigame_id, "
        "CAST(k % 5 AS VARCHAR) AS attempt, CASE WHEN k % 9 = 0 THEN 'x' ELSE CAST(k % 4 AS VARCHAR) END AS deaths, "
        "res AS result_by, dur AS play_duration, CAST(NULL AS VARCHAR) AS \"revive_Total\" FROM e WHERE ev = 'level_end'"
    ),
)
def _(events):
    return split.event_table(events, "level_end").drop("event_ts")


# --- projections -----------------------------------------------------------


def params() -> Bag:
    return Bag("event_params")


def properties() -> Bag:
    return Bag("user_properties")


@on_raw(
    "struct_fields",
    o.sql(
        f"SELECT {o.ID}, geo AS country, 'r' || (u % 4) AS region, ver AS version, "
        "'brand' || (u % 3) AS mobile_brand_name, 'src' || (u % 2) AS traffic FROM e"
    ),
)
def _(raw):
    return raw.select(
        USER, TS, "geo.country", "geo.region", "app_info.version", "device.mobile_brand_name",
        F.col("traffic_source.source").alias("traffic"),
    )


@on_raw(
    "kv_pivot_max",
    o.sql(
        f"SELECT {o.ID}, {o.PLACE_MAX} AS placement, sid AS session_id, res AS result, "
        "val_real AS paid, 'c' || (u % 5) AS campaign, "
        "CAST(u % 9 AS BIGINT) AS adset_number, CAST(NULL AS VARCHAR) AS adset_text FROM e"
    ),
)
def _(raw):
    return raw.select(
        USER,
        TS,
        params().max_by_key("placement", "string_value").alias("placement"),
        params().max_by_key("ga_session_id", "int_value").alias("session_id"),
        params().max_by_key("result", "string_value").alias("result"),
        params().max_by_key("value", "double_value").alias("paid"),
        properties().max_by_key("campaign", "string_value").alias("campaign"),
        properties().max_by_key("adset", "int_value").alias("adset_number"),
        properties().max_by_key("adset", "string_value").alias("adset_text"),
    )


@on_raw("kv_prefix_max", o.sql(f"SELECT {o.ID}, {o.ARM_MAX} AS experiment FROM e"))
def _(raw):
    return raw.select(
        USER, TS, properties().max_by_prefix("firebase_exp_").alias("experiment")
    )


@on_raw(
    "kv_first_str",
    o.sql(
        f"SELECT {o.ID}, 'p' || (k % 7) AS placement, dur AS play_duration, mg AS minigame_id, "
        "CASE WHEN ev IN ('level_start', 'level_end') THEN CAST(k % 5 AS VARCHAR) END AS attempt, "
        "CAST(sid AS VARCHAR) AS ga_session_id FROM e"
    ),
)
def _(raw):
    text = ("placement", "play_duration", "minigame_id", "attempt")
    return raw.select(
        USER,
        TS,
        *[params().first_str(p).alias(p) for p in text],
        params().first_int_text("ga_session_id").alias("ga_session_id"),
    )


@on_raw(
    "kv_first_num",
    o.sql(
        f"SELECT {o.ID}, val AS value, CASE WHEN dur <> 'bad' THEN CAST(dur AS DOUBLE) END AS seconds FROM e"
    ),
)
def _(raw):
    return raw.select(
        USER,
        TS,
        params().first_num("value").alias("value"),
        params().first_num("play_duration").alias("seconds"),
    )


@on_raw(
    "user_prop_first",
    o.sql(
        f"SELECT {o.ID}, scr AS screen, 'c' || (u % 5) AS campaign, CAST(u % 9 AS VARCHAR) AS adset, "
        "CAST(NULL AS VARCHAR) AS missing FROM e"
    ),
)
def _(raw):
    props = {"screen": "current_Screen", "campaign": "campaign", "adset": "adset", "missing": "none"}
    return raw.select(
        USER, TS, *[properties().first_property(k).alias(a) for a, k in props.items()]
    )


@on_raw("kv_fixed_concat", o.sql(f"SELECT {o.ID}, {o.STAGE_A['action_sequence']} AS actions FROM e"))
def _(raw):
    joined = params().concat_keys(FLATTEN_A.action_keys)
    return raw.select(USER, TS, joined.alias("actions"))


@on_raw("kv_ordered_concat", o.sql(f"SELECT {o.ID}, {o.STAGE_B['action_sequence']} AS actions FROM e"))
def _(raw):
    joined = params().concat_prefix(FLATTEN_B.action_prefix)
    return raw.select(USER, TS, joined.alias("actions"))


# Entries of the bag with a value in the double slot.
REALS = {
    "value": "val_real", "play_time": "k * 0.75",
    "play_duration": "CASE WHEN k % 13 <> 0 AND k % 2 = 1 THEN k + 0.5 END",
}


@on_raw(
    "kv_reproject",
    o.sql(
        "SELECT key, COUNT(*) AS entries, COUNT(txt) AS texts, CAST(SUM(num) AS BIGINT) AS numbers, "
        "ROUND(SUM(dbl), 4) AS reals, CAST(0 AS BIGINT) AS singles FROM x GROUP BY key",
        "x AS ("
        + " UNION ALL ".join(
            f"SELECT '{key}' AS key, CAST({txt} AS VARCHAR) AS txt, CAST({num} AS BIGINT) AS num, "
            f"CAST({REALS.get(key, 'NULL')} AS DOUBLE) AS dbl FROM e WHERE {cond}"
            for key, cond, txt, num in o.BAG_ENTRIES
        )
        + ")",
    ),
)
def _(raw):
    entries = raw.select(F.inline(params().lifted()))
    return entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count("string_value").alias("texts"),
        F.sum("int_value").alias("numbers"),
        F.round(F.sum("double_value"), 4).alias("reals"),
        F.count("float_value").alias("singles"),
    )


@on_raw("surrogate_key", o.sql(f"SELECT {o.ID}, {o.KEY} AS surrogate_key FROM e"))
def _(raw):
    return raw.select(USER, TS, labels.surrogate_key(USER, TS, NAME).alias("surrogate_key"))


@on_raw("variant_label", o.sql(f"SELECT {o.ID}, arm, arm_label AS label FROM e"))
def _(raw):
    arm = properties().first_property("firebase_exp_8")
    return raw.select(USER, TS, arm.alias("arm"), labels.variant_label(arm).alias("label"))


@on_raw("ad_format_group", o.sql("SELECT fmt AS ad_format, COALESCE(grp, 'OTHER') AS grp, COUNT(*) AS n FROM e GROUP BY fmt, grp"))
def _(raw):
    fmt = params().first_str("ad_format")
    rows = raw.select(fmt.alias("ad_format"))
    grouped = rows.withColumn("grp", labels.ad_format_group(F.col("ad_format")))
    return grouped.groupBy("ad_format", "grp").agg(F.count(F.lit(1)).alias("n"))


@on_raw(
    "local_date",
    o.sql(
        f"SELECT {o.ID}, {o.LOCAL_DAY} AS local_day, {o.iso('d')} AS export_day, {o.OPENED} AS opened, "
        "strftime(d, '%Y%m%d') AS day_text, date_diff('day', DATE '2024-01-01', d) AS offset_days FROM e"
    ),
)
def _(raw):
    day = dates.export_date(F.col("event_date"))
    opened = properties().max_by_key("first_open_time", "int_value")
    return raw.select(
        USER,
        TS,
        dates.local_date_from_micros(F.col(TS), LOCAL_ZONE).alias("local_day"),
        day.alias("export_day"),
        dates.local_date_from_millis(opened, LOCAL_ZONE).alias("opened"),
        F.date_format(day, "yyyyMMdd").alias("day_text"),
        dates.day_offset(day, F.lit(dt.date(2024, 1, 1))).cast("long").alias("offset_days"),
    )


# --- filters ---------------------------------------------------------------


@on_events(
    "filter_allow_deny",
    o.sql(
        f"SELECT {o.ID}, ver AS app_version, geo AS geo_country, scr AS current_screen FROM e "
        "WHERE ev = 'first_open' AND ver IN ('1.0.7', '1.0.9') AND geo <> 'China' AND scr <> 'Home'"
    ),
)
def _(events):
    rows = events.where(F.col(NAME) == "first_open")
    rows = filters.keep_listed(rows, "app_version", ["1.0.7", "1.0.9"])
    rows = filters.drop_listed(rows, "geo_country", ["China"])
    rows = filters.keep_listed(filters.drop_listed(rows, "geo_country", []), "app_version", [])
    return rows.where(filters.in_game(F.col("current_screen"))).select(
        USER, TS, "app_version", "geo_country", "current_screen"
    )


# --- cohorts and aggregations ---------------------------------------------

C = o.cohort(o.OUTSIDE)


@on_events(
    "cohort_identity",
    o.sql(f"SELECT usr AS user_pseudo_id, ver AS app_version, {o.iso('j')} AS join_date FROM c", C),
)
def _(events):
    return cohorts.cohort_identity(events, exclude_geo=["China"])


@on_events(
    "cohort_size",
    o.sql(
        f"SELECT ver AS app_version, {o.iso('j')} AS join_date, COUNT(DISTINCT usr) AS new_users FROM c GROUP BY ver, j",
        C,
    ),
)
def _(events):
    return cohorts.cohort_size(cohorts.cohort_identity(events, exclude_geo=["China"]))


@on_events(
    "daily_active",
    o.sql(
        f"SELECT DISTINCT usr AS user_pseudo_id, ver AS app_version, {o.iso('d')} AS event_date FROM e WHERE ev = 'session_start'"
    ),
)
def _(events):
    return cohorts.active_days(events, by=("app_version",))


@on_events(
    "user_day_ads",
    o.sql(
        f"SELECT usr AS user_pseudo_id, {o.iso('d')} AS event_date, "
        + ", ".join(
            f"{p}_imps, ROUND({p}_rev, 4) AS {p}_rev, {p}_seen" for p in ("total", *o.FMT)
        )
        + f" FROM ({o.USER_DAY})"
    ),
)
def _(events):
    days = ads.user_day_ads(events)
    return days.select(
        USER,
        "event_date",
        *[F.round(m, 4).alias(m) if m.endswith("_rev") else m for m in ads.metric_names()],
    )


@on_events(
    "ratio_of_sums",
    o.sql(
        "SELECT grp AS ad_group, ROUND(SUM(val) / COUNT(*) * 1000, 4) AS ecpm FROM e "
        "WHERE ev = 'ad_impression' GROUP BY grp"
    ),
)
def _(events):
    shown = events.where(F.col(NAME) == ads.IMPRESSION)
    groups = shown.groupBy(labels.ad_format_group(F.col("ad_format")).alias("ad_group"))
    return groups.agg(per_mille(F.sum("value"), F.count(F.lit(1))).alias("ecpm"))


@on_events(
    "mean_of_ratios",
    o.sql(
        "SELECT ver AS app_version, ROUND(AVG(n / CAST(users AS DOUBLE)), 6) AS sessions_per_user FROM "
        "(SELECT ver, d, COUNT(*) AS n, COUNT(DISTINCT usr) AS users FROM e WHERE ev = 'session_start' GROUP BY ver, d) "
        "GROUP BY ver"
    ),
)
def _(events):
    started = events.where(F.col(NAME) == "session_start")
    per_user = started.groupBy("app_version", "event_date", USER).agg(F.count(F.lit(1)).alias("n"))
    daily = per_user.groupBy("app_version", "event_date").agg(
        F.sum("n").alias("n"), F.count(USER).alias("users")
    )
    return daily.groupBy("app_version").agg(
        F.round(F.avg(ratio(F.col("n"), F.col("users"))), 6).alias("sessions_per_user")
    )


# --- windows and joins -----------------------------------------------------


@on_raw(
    "dedup_first",
    o.sql(
        "SELECT usr AS user_pseudo_id, strftime(d, '%Y%m%d') AS event_date, MIN(us) AS event_timestamp, "
        "arg_min(ev, us) AS event_name FROM e GROUP BY usr, d"
    ),
)
def _(raw):
    rows = raw.select(
        F.concat_ws("/", USER, "event_date").alias("key"), USER, "event_date", TS, NAME
    )
    copies = rows.unionByName(rows)
    return keys.dedup_first(copies, "key", [F.col(TS), F.col(NAME)]).drop("key")


@on_events(
    "next_start",
    o.sql(
        "SELECT usr AS user_pseudo_id, mg AS minigame_id, us AS event_timestamp, "
        "LEAD(us) OVER (PARTITION BY usr, mg ORDER BY us) AS next_start_ts FROM s",
        o.STARTS,
    ),
)
def _(events):
    starts = events.where(
        (F.col(NAME) == "level_start") & filters.in_game(F.col("minigame_id"))
    )
    return sessions.next_start(starts, [USER, "minigame_id"], TS)


@on_events(
    "interval_sessions",
    o.sql(
        "SELECT usr AS user_pseudo_id, mg AS minigame_id, start_us AS start_ts, last_us AS last_ts, members FROM t "
        "WHERE (last_us - start_us) / 1e6 / 60 <= 1440",
        f"{o.STARTS}, {o.MEMBERS}",
    ),
)
def _(events):
    return (
        minigames.minigame_sessions(events)
        .where("members > 0 AND minutes <= 1440")
        .select(USER, "minigame_id", "start_ts", "last_ts", "members")
    )


@on_events(
    "density_sessions",
    o.sql(
        "SELECT usr AS user_pseudo_id, mg AS minigame_id, start_us AS start_ts, last_us AS last_ts, members FROM t "
        "WHERE (last_us - start_us) / 1e6 / 60 <= 1440",
        f"{o.STARTS}, {o.MEMBERS}",
    ),
)
def _(events):
    # Parts of ten rows, so that many users of the sample are cut.
    return (
        minigames.minigame_sessions(events, bucketing=sessions.by_density(bucket_rows=10))
        .where("members > 0 AND minutes <= 1440")
        .select(USER, "minigame_id", "start_ts", "last_ts", "members")
    )


@on_events(
    "density_next_start",
    o.sql(
        "SELECT usr AS user_pseudo_id, mg AS minigame_id, us AS event_timestamp, "
        "LEAD(us) OVER (PARTITION BY usr, mg ORDER BY us) AS next_start_ts FROM s",
        o.STARTS,
    ),
)
def _(events):
    starts = events.where((F.col(NAME) == "level_start") & filters.in_game(F.col("minigame_id")))
    return sessions.next_start(starts, [USER, "minigame_id"], TS, sessions.by_density(bucket_rows=5))


@on_events(
    "session_ad_totals",
    o.sql(
        "SELECT mg AS minigame_id, COUNT(*) AS sessions, CAST(SUM(imps) AS BIGINT) AS impressions, "
        "ROUND(SUM(rev), 4) AS revenue FROM t WHERE (last_us - start_us) / 1e6 / 60 <= 1440 GROUP BY mg",
        f"{o.STARTS}, {o.MEMBERS}",
    ),
)
def _(events):
    return (
        minigames.minigame_sessions(events)
        .where("members > 0 AND minutes <= 1440")
        .groupBy("minigame_id")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("imps").alias("impressions"),
            F.round(F.sum("rev"), 4).alias("revenue"),
        )
    )


@on_raw(
    "new_rows_only",
    o.sql(f"SELECT {o.KEY} AS surrogate_key, usr AS user_pseudo_id FROM e WHERE ev NOT IN ('level_start', 'level_end')"),
)
def _(raw):
    keyed = raw.select(labels.surrogate_key(USER, TS, NAME).alias("surrogate_key"), USER, NAME)
    known = keyed.where(F.col(NAME).isin("level_start", "level_end"))
    with_null = known.select("surrogate_key").unionByName(
        known.groupBy().agg(F.max(F.lit(None).cast("string")).alias("surrogate_key"))
    )
    return keys.new_rows_only(keyed, with_null, "surrogate_key").select("surrogate_key", USER)


@on_events(
    "prev_day_cohort",
    o.sql(
        f"SELECT {o.iso('p.d')} AS date, p.back AS returned, q.n AS joined_day_before, "
        "ROUND(p.back * 100.0::DOUBLE / NULLIF(q.n, 0), 2) AS rate FROM g p LEFT JOIN g q ON q.d = p.d - 1",
        "j AS (SELECT usr, MIN(d) AS j FROM e WHERE ev = 'first_open' GROUP BY usr), "
        "a AS (SELECT DISTINCT usr, d FROM e WHERE ev = 'session_start'), "
        "g AS (SELECT a.d, COUNT(*) FILTER (j = d) AS n, COUNT(*) FILTER (d = j + 1) AS back FROM a JOIN j USING (usr) GROUP BY a.d)",
    ),
)
def _(events):
    joined = cohorts.cohort_identity(events, dims=())
    offset = F.datediff("event_date", "join_date")
    daily = (
        cohorts.active_days(events)
        .join(joined, USER)
        .groupBy("event_date")
        .agg(F.count_if(offset == 0).alias("joined"), F.count_if(offset == 1).alias("returned"))
    )
    before = daily.select(
        F.date_add("event_date", 1).alias("event_date"), F.col("joined").alias("joined_day_before")
    )
    return daily.join(before, "event_date", "left").select(
        F.col("event_date").alias("date"),
        "returned",
        "joined_day_before",
        pct(F.col("returned"), F.nullif("joined_day_before", F.lit(0))).alias("rate"),
    )


@on_events(
    "context_enrich",
    o.sql(
        "SELECT e.usr AS user_pseudo_id, e.us AS event_timestamp, CAST(e.sid AS VARCHAR) AS ga_session_id, "
        "e.mg AS minigame_id, x.geo AS geo_country, x.os AS device_os, x.ver AS app_version FROM e LEFT JOIN "
        "(SELECT sid, arg_min(geo, us) FILTER (geo IS NOT NULL) AS geo, arg_min(CASE WHEN u % 2 = 0 THEN 'Android' ELSE 'iOS' END, us) AS os, "
        "arg_min(ver, us) AS ver FROM e WHERE ev = 'session_start' GROUP BY sid) x ON x.sid = e.sid WHERE e.ev = 'level_end'"
    ),
)
def _(events):
    ends = split.event_table(events, "level_end").select(USER, TS, "ga_session_id", "minigame_id")
    context = split.event_table(events, "session_start")
    looked_up = ("geo_country", "device_os", "app_version")
    return keys.enrich(ends, context, [USER, "ga_session_id"], TS, looked_up)


@on_events(
    "union_events",
    o.sql(
        f"SELECT {o.ID}, ev AS event_name, scr AS current_screen, mg AS minigame_id, val AS imp_value FROM e"
    ),
)
def _(events):
    return split.aligned_union(events, exclude=["app_remove"])


@on_events(
    "union_active_ads",
    o.sql(
        f"SELECT usr AS user_pseudo_id, {o.iso('d')} AS event_date, CASE WHEN ev = 'session_start' THEN 1 ELSE 0 END AS is_active, "
        "grp, val AS rev FROM e WHERE ev IN ('session_start', 'ad_impression')"
    ),
)
def _(events):
    return ads.active_and_ads(events)


# --- writers ---------------------------------------------------------------

DAY_COUNTS = "SELECT {d} AS event_date, ev AS event_name, COUNT(*) AS n, COUNT(DISTINCT usr) AS users FROM e {w} GROUP BY ALL"


def day_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", NAME).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(USER).alias("users")
    )


@register(
    "day_replace",
    o.sql(DAY_COUNTS.format(d=o.iso("d"), w="WHERE d <> DATE '2024-01-15' OR ev IN ('level_start', 'level_end')")),
)
def _(spark, sf_dir):
    # A full table, then one day replaced by a version without most of its events.
    events = event_store(spark, sf_dir)
    root = scratch_dir(spark, "day-replace")
    tables.write_events(events, root)
    day = dt.date(2024, 1, 15)
    again = events.where(F.col(NAME).isin("level_start", "level_end") & (F.col("event_date") == F.lit(day)))
    tables.replace_day(again, root, day)
    return day_counts(split.read_events(spark, root))


@register("backfill", o.sql(DAY_COUNTS.format(d=o.iso("d"), w="")))
def _(spark, sf_dir):
    root = scratch_dir(spark, "backfill")
    raw = raw_store(spark, sf_dir)
    tables.backfill(raw, root, *shards.day_range(raw))
    return day_counts(split.read_events(spark, root))


@register(
    "incremental_append",
    o.sql(f"SELECT {o.KEY} AS surrogate_key, {o.iso('d')} AS event_date, usr AS user_pseudo_id FROM e"),
)
def _(spark, sf_dir):
    # Two loads whose windows overlap; the second is repeated.
    raw = raw_store(spark, sf_dir)
    root = scratch_dir(spark, "append")
    first = shards.between(raw, shards.day_range(raw)[0], dt.date(2024, 1, 20))
    second = shards.since(raw, dt.date(2024, 1, 10))
    for part in (first, second, second):
        flat = flatten.flatten(part, FLATTEN_B)
        rows = flatten.unique_events(flat, FLATTEN_B)
        tables.append_new(spark, rows, root, days_from=flat)
    return spark.read.parquet(root).select("surrogate_key", "event_date", USER)


@register("create_empty", o.sql(DAY_COUNTS.format(d=o.iso("d"), w="")))
def _(spark, sf_dir):
    # An empty table with the right columns, then filled; creating it again changes nothing.
    root = scratch_dir(spark, "empty")
    events = event_store(spark, sf_dir)
    layout = ("event_date", NAME)
    tables.create_empty(events, root, layout)
    events.write.mode("append").partitionBy(*layout).parquet(root)
    tables.create_empty(events, root, layout)
    return day_counts(tables.read_table(spark, root, events.schema))


@register("rebuild_report", o.retention(range(1, 8)))
def _(spark, sf_dir):
    root = scratch_dir(spark, "report")
    report = retention.retention_curve(event_store(spark, sf_dir), as_of=AS_OF)
    for _ in range(2):
        tables.rebuild_report(report, root)
    return spark.read.parquet(root)


@register("rebuild_report_marked", o.retention(range(1, 8)))
def _(spark, sf_dir):
    # An older report is replaced at once; who opened it before still reads it.
    report = retention.retention_curve(event_store(spark, sf_dir), as_of=AS_OF)
    table = commits.MarkedTable(spark, scratch_dir(spark, "report"), report.schema, day=None)
    old = table.replace_all(report.limit(1))
    table.replace_all(report)
    assert table.read(old).count() == 1
    return table.read()


@register("namespace_report", o.retention(range(1, 8)))
def _(spark, sf_dir):
    # The report as a table of a namespace, which is created unless it is there.
    name = f"playlens_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.create_namespace(spark, name, scratch_dir(spark, "namespace"))
    report = retention.retention_curve(event_store(spark, sf_dir), as_of=AS_OF)
    report.write.saveAsTable(f"{name}.r6_retention")
    return spark.table(f"{name}.r6_retention")


@register(
    "known_keys_append",
    o.sql(f"SELECT {o.KEY} AS surrogate_key, {o.iso('d')} AS event_date, usr AS user_pseudo_id FROM e"),
)
def _(spark, sf_dir):
    # The loads of incremental_append against keys kept in buckets.
    raw = raw_store(spark, sf_dir)
    name = f"playlens_{uuid.uuid4().hex}"
    root = scratch_dir(spark, "known-keys")
    tables.create_namespace(spark, name, f"{root}-catalog")
    known = known_keys.KnownKeys(spark, f"{name}.keys", buckets=8)
    first = shards.between(raw, shards.day_range(raw)[0], dt.date(2024, 1, 20))
    second = shards.since(raw, dt.date(2024, 1, 10))
    for number, part in enumerate((first, second, second)):
        rows = known.new_rows(flatten.unique_events(flatten.flatten(part, FLATTEN_B), FLATTEN_B))
        rows.select("surrogate_key", "event_date", USER).write.parquet(f"{root}/load={number}")
        known.add(spark.read.parquet(f"{root}/load={number}"))
    return spark.read.parquet(root).drop("load")


def two_arrivals(spark, sf_dir) -> tuple[str, Callable[[], None]]:
    """A source of the first half of the shards, and what adds the others and late files of the first ones."""
    raw, source = raw_store(spark, sf_dir), scratch_dir(spark, "source")
    late = (F.col("shard") > "20240115") | (F.col(TS) % 7 == 0)
    raw.where(~late).write.partitionBy("shard").parquet(source)
    return source, lambda: raw.where(late).write.mode("append").partitionBy("shard").parquet(source)


@register(
    "ledger_load",
    o.sql(f"SELECT {o.KEY} AS surrogate_key, {o.iso('d')} AS event_date, usr AS user_pseudo_id FROM e"),
)
def _(spark, sf_dir):
    # Every file is loaded once, late ones of old shards too.
    source, arrive = two_arrivals(spark, sf_dir)
    root, files = scratch_dir(spark, "ledger-flat"), ledger.Ledger(spark, scratch_dir(spark, "ledger"))
    ledger.load_pending(spark, source, root, files, FLATTEN_B)
    arrive()
    for _ in range(2):
        ledger.load_pending(spark, source, root, files, FLATTEN_B)
    table = commits.staging_table(spark, shards.read_raw(spark, source), root, FLATTEN_B)
    return table.read().select("surrogate_key", "event_date", USER)


@register("ledger_backfill", o.sql(DAY_COUNTS.format(d=o.iso("d"), w="WHERE d BETWEEN DATE '2024-01-14' AND DATE '2024-01-17'")))
def _(spark, sf_dir):
    # Days are built when their files arrive, and again if more of them do.
    source, arrive = two_arrivals(spark, sf_dir)
    root, files = scratch_dir(spark, "ledger-events"), ledger.Ledger(spark, scratch_dir(spark, "ledger"))
    days = dt.date(2024, 1, 14), dt.date(2024, 1, 17)
    ledger.resume_backfill(spark, source, root, files, *days)
    arrive()
    ledger.resume_backfill(spark, source, root, files, *days)
    return day_counts(split.read_events(spark, root))


@on_raw(
    "key_census",
    o.sql(
        "SELECT ev AS event_name, key, CASE WHEN (txt IS NOT NULL)::INT + (num IS NOT NULL)::INT + (dbl IS NOT NULL)::INT > 1 "
        "THEN 'several' WHEN txt IS NOT NULL THEN 'string' WHEN num IS NOT NULL THEN 'int' WHEN dbl IS NOT NULL THEN 'double' "
        "ELSE 'none' END AS slot, COUNT(*) AS n_rows FROM x GROUP BY ALL",
        "x AS ("
        + " UNION ALL ".join(
            f"SELECT ev, '{key}' AS key, CAST({txt} AS VARCHAR) AS txt, CAST({num} AS BIGINT) AS num, "
            f"CAST({REALS.get(key, 'NULL')} AS DOUBLE) AS dbl FROM e WHERE {cond}"
            for key, cond, txt, num in o.BAG_ENTRIES
        )
        + ")",
    ),
)
def _(raw):
    return census.key_census(raw)


@on_events(
    "reconcile_rows",
    o.sql(
        f"SELECT {o.iso('d')} AS event_date, ev AS event_name, usr AS user_pseudo_id, us AS event_timestamp, 'left only' AS status, "
        "NULL::VARCHAR AS columns, 1::BIGINT AS left_copies, 0::BIGINT AS right_copies FROM e WHERE (us // 1000000) % 97 = 0 UNION ALL "
        f"SELECT {o.iso('d')}, ev, usr, us, 'changed', 'current_screen', 1, 1 FROM e "
        "WHERE (us // 1000000) % 97 <> 0 AND (us // 1000000) % 89 = 1 UNION ALL "
        f"SELECT {o.iso('d')}, ev, usr, us + 1, 'right only', NULL, 0, 1 FROM e WHERE (us // 1000000) % 83 = 2"
    ),
)
def _(events):
    # A copy of the table with rows dropped, changed and added.
    second = F.floor(F.col(TS) / 1_000_000)
    screen = F.when(second % 89 == 1, F.lit("elsewhere")).otherwise(F.col("current_screen"))
    copy = events.where(second % 97 != 0).withColumn("current_screen", screen)
    more = events.where(second % 83 == 2).withColumn(TS, F.col(TS) + 1)
    return reconcile.differing_rows(events, copy.unionByName(more))


# --- checks ----------------------------------------------------------------

CHECK = (
    "SELECT '{check}' AS \"check\", '{col}' AS column_name, '{sev}' AS severity, CAST({n} AS BIGINT) AS failures, "
    "CASE WHEN {n} = 0 THEN 'pass' ELSE '{sev}' END AS status FROM {src}"
)


def check(name: str, col: str, n: str, sev: str = "error", src: str = "e") -> str:
    return CHECK.format(check=name, col=col, n=n, sev=sev, src=src)


@on_events(
    "dq_unique_notnull",
    o.sql(
        " UNION ALL ".join(
            [
                check("unique", "ga_session_id", "COUNT(*)", src="(SELECT sid FROM e GROUP BY sid HAVING COUNT(*) > 1)"),
                check("unique", "event_ts", "COUNT(*)", src="(SELECT us FROM e GROUP BY us HAVING COUNT(*) > 1)"),
                check("not_null", "user_pseudo_id", "COUNT(*) FILTER (usr IS NULL)"),
                check("not_null", "minigame_id", "COUNT(*) FILTER (mg IS NULL)"),
                check("not_null", "geo_country", "COUNT(*) FILTER (geo IS NULL OR ev NOT IN ('first_open', 'session_start'))", "warn"),
            ]
        )
    ),
)
def _(events):
    return (
        quality.unique(events, "ga_session_id")
        .unionByName(quality.unique(events, "event_ts"))
        .unionByName(
            quality.not_null(
                events, {USER: "error", "minigame_id": "error", "geo_country": "warn"}
            )
        )
    )


@on_events(
    "dq_relationship",
    o.sql(
        check(
            "relationship", "ga_session_id", "COUNT(*)", "warn",
            "e WHERE ev = 'level_end' AND sid NOT IN (SELECT sid FROM e WHERE ev = 'session_start')",
        )
    ),
)
def _(events):
    ends = split.event_table(events, "level_end")
    return quality.relationship(ends, split.event_table(events, "session_start"), "ga_session_id", "warn")


@on_events(
    "dq_accepted_values",
    o.sql(
        check("accepted_values", "event_name", "COUNT(*) FILTER (ev NOT IN ('first_open', 'session_start', 'level_start'))")
    ),
)
def _(events):
    return quality.accepted_values(events, NAME, ["first_open", "session_start", "level_start"])


@on_raw(
    "dq_staging",
    o.sql(
        " UNION ALL ".join(
            [
                check("unique", "surrogate_key", "0 * COUNT(*)"),
                *[check("not_null", c, "0 * COUNT(*)") for c in ("surrogate_key", "event_date", "event_name", "user_pseudo_id")],
                check("not_null", "ga_session_id", "0 * COUNT(*)", "warn"),
            ]
        )
    ),
)
def _(raw):
    return quality.staging_checks(flatten.flatten_new(raw, FLATTEN_A))


@on_raw(
    "dq_base",
    o.sql(
        " UNION ALL ".join(
            [
                check("unique", "surrogate_key", "0 * COUNT(*)"),
                *[check("not_null", c, "0 * COUNT(*)") for c in ("surrogate_key", "event_date")],
                # The parent table lacks one day.
                check("relationship", "surrogate_key", f"COUNT(*) FILTER ({o.LOCAL_DAY} LIKE '%-07')"),
            ]
        )
    ),
)
def _(raw):
    flat = flatten.flatten_new(raw, FLATTEN_A)
    base = flatten.event_base(flat, FLATTEN_A, AS_OF)
    return quality.base_checks(base, flat.where(F.dayofmonth("event_date") != 7))


@register(
    "delivery_order",
    "SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY version ORDER BY cohort_date) AS INTEGER) AS position "
    f"FROM ({o.ltv((0, 1, 3, 7))})",
)
def _(spark, sf_dir):
    report = ltv.cohort_ltv(event_store(spark, sf_dir), as_of=AS_OF)
    return delivery.with_position(report, "cohort_ltv", within=("version",))


@register("parity_raw_l2", o.parity())
def _(spark, sf_dir):
    raw = raw_store(spark, sf_dir)
    return parity.parity_report(raw, event_store(spark, sf_dir), days=shards.day_range(raw))


@register("parity_diff", o.parity(diff=True))
def _(spark, sf_dir):
    return parity.parity_diff(
        parity.parity_report(raw_store(spark, sf_dir), event_store(spark, sf_dir))
    )


# --- jobs ------------------------------------------------------------------


def with_count(flat: DataFrame) -> DataFrame:
    """The nested column is compared by its length; ``kv_reproject`` checks its content."""
    return flat.withColumn("params_n", F.size("event_params_json")).drop("event_params_json")


@on_raw("flatten_a", o.staged(o.STAGE_A, params=True))
def _(raw):
    return with_count(flatten.flatten_new(raw, FLATTEN_A))


@on_raw("flatten_b", o.staged(o.STAGE_B, params=True))
def _(raw):
    return with_count(flatten.flatten_new(raw, FLATTEN_B))


@on_raw("narrow_flatten_a", o.staged(o.STAGE_A, params=True))
def _(raw):
    return with_count(narrow.unique_events_narrow(raw, FLATTEN_A))


@on_raw("narrow_flatten_b", o.staged(o.STAGE_B, params=True))
def _(raw):
    return with_count(narrow.unique_events_narrow(raw, FLATTEN_B))


def two_loads(spark, sf_dir, spec):
    """Two daily runs of the staging and the base table; the second is repeated."""
    raw = raw_store(spark, sf_dir)
    flat_root, base_root = scratch_dir(spark, "flat"), scratch_dir(spark, "base")
    for day in (LOAD_DAY, LOAD_DAY + dt.timedelta(days=1), LOAD_DAY + dt.timedelta(days=1)):
        tables.load_flatten(spark, raw, flat_root, spec, day)
        tables.load_base(spark, spark.read.parquet(flat_root), base_root, spec, day)
    return spark.read.parquet(flat_root), spark.read.parquet(base_root)


LOAD_DAY = dt.date(2024, 1, 20)
# One game loads the day before each run; the other two days at first, then all from two days before on.
LOADED_A = "d BETWEEN DATE '2024-01-19' AND DATE '2024-01-20'"
LOADED_B = "d >= DATE '2024-01-18'"


@register("load_flatten_a", o.staged(o.STAGE_A, params=True, where=LOADED_A))
def _(spark, sf_dir):
    return with_count(two_loads(spark, sf_dir, FLATTEN_A)[0])


@register("load_flatten_b", o.staged(o.STAGE_B, params=True, where=LOADED_B))
def _(spark, sf_dir):
    return with_count(two_loads(spark, sf_dir, FLATTEN_B)[0])


def two_marked_loads(spark, sf_dir, spec):
    """The same runs, each visible as a whole once its marker is in place."""
    raw = raw_store(spark, sf_dir)
    flat_root, base_root = scratch_dir(spark, "marked-flat"), scratch_dir(spark, "marked-base")
    table = commits.staging_table(spark, raw, flat_root, spec)
    for day in (LOAD_DAY, LOAD_DAY + dt.timedelta(days=1), LOAD_DAY + dt.timedelta(days=1)):
        commits.load_flatten(spark, raw, flat_root, spec, day)
        commits.load_base(spark, table.read(), base_root, spec, day)
    base = commits.MarkedTable(spark, base_root, flatten.event_base(table.read(), spec, LOAD_DAY).schema)
    return table.read(), base.read()


@register("marked_flatten_a", o.staged(o.STAGE_A, params=True, where=LOADED_A))
def _(spark, sf_dir):
    return with_count(two_marked_loads(spark, sf_dir, FLATTEN_A)[0])


@register("marked_base_b", o.staged(o.STAGE_B, o.BASE_NAMES, where=LOADED_B))
def _(spark, sf_dir):
    return two_marked_loads(spark, sf_dir, FLATTEN_B)[1]


# The later base run takes staging rows of the day before by their local date.
BASED_A = f"d = DATE '2024-01-19' OR (d = DATE '2024-01-20' AND {o.LOCAL_DAY} = '2024-01-20')"


@register("load_base_a", o.staged(o.STAGE_A, o.BASE_NAMES, where=BASED_A))
def _(spark, sf_dir):
    return two_loads(spark, sf_dir, FLATTEN_A)[1]


@register("load_base_b", o.staged(o.STAGE_B, o.BASE_NAMES, where=LOADED_B))
def _(spark, sf_dir):
    return two_loads(spark, sf_dir, FLATTEN_B)[1]


@on_raw("event_base", o.staged(o.STAGE_A, o.BASE_NAMES))
def _(raw):
    return flatten.event_base(flatten.flatten_new(raw, FLATTEN_A), FLATTEN_A, AS_OF)


@on_raw("event_base_b", o.staged(o.STAGE_B, o.BASE_NAMES))
def _(raw):
    return flatten.event_base(flatten.flatten_new(raw, FLATTEN_B), FLATTEN_B, AS_OF)


# Every column of the typed table: what events of a kind carry in the sample, else NULL.
CONTEXT_ONLY = {
    "geo_country": "geo", "geo_region": "'r' || (u % 4)", "geo_city": "'city' || (u % 10)",
    "device_category": "'mobile'", "device_os": "CASE WHEN u % 2 = 0 THEN 'Android' ELSE 'iOS' END",
    "device_os_version": "CAST(10 + u % 4 AS VARCHAR)", "device_brand": "'brand' || (u % 3)",
    "device_model": "'model' || (u % 6)", "device_language": "'en'", "app_version": "ver",
    "app_id": "'game.app'", "install_store": "'store'", "traffic_name": "'organic'",
    "traffic_source": "'src' || (u % 2)", "up_media_source": "med", "up_campaign": "'c' || (u % 5)",
    "up_adset": "CAST(u % 9 AS VARCHAR)",
}
OWN_ONLY = {
    "minigame_id": "mg", "attempt": f"CASE WHEN {o.BOTH} THEN CAST(k % 5 AS VARCHAR) END",
    "deaths": f"CASE WHEN {o.END} THEN CASE WHEN k % 9 = 0 THEN 'x' ELSE CAST(k % 4 AS VARCHAR) END END",
    "result_by": f"CASE WHEN {o.END} THEN res END", "play_duration": "dur", "value": "val", "ad_format": "fmt",
    "currency": f"CASE WHEN {o.AD} THEN 'USD' END", "ad_platform": f"CASE WHEN {o.AD} THEN 'pf' || (k % 3) END",
    "ad_source": f"CASE WHEN {o.AD} THEN 's' || (k % 2) END",
}
EVERY = {
    "user_pseudo_id": "usr", "event_name": "ev", "event_date": o.iso("d"), "event_timestamp": "us",
    "event_ts": "us", "ga_session_id": "CAST(sid AS VARCHAR)", "current_screen": "scr",
    "ga_session_number": "CAST(snum AS VARCHAR)",
}


def typed_sql() -> str:
    sources = EVERY | OWN_ONLY | {
        c: f"CASE WHEN ev IN ('first_open', 'session_start') THEN {v} END" for c, v in CONTEXT_ONLY.items()
    }
    kinds = {f.name: "DOUBLE" if isinstance(f.dataType, T.DoubleType) else "VARCHAR" for f in split.typed_schema()}
    return ", ".join(f'{sources.get(c, f"CAST(NULL AS {k})")} AS "{c}"' for c, k in kinds.items())


@register("layer2_split", o.sql(f"SELECT {typed_sql()} FROM e"))
def _(spark, sf_dir):
    # All columns of all events, written in the table's layout and read back.
    root = scratch_dir(spark, "split")
    tables.write_events(split.split_events(raw_store(spark, sf_dir)), root)
    return split.read_events(spark, root).withColumn("event_ts", F.unix_micros("event_ts"))


WITHOUT = {"some_without_session": True}


@on_events("r2_minigame", o.minigame(20, o.SOME_WITHOUT_SESSION), **WITHOUT)
def _(events):
    return minigames.minigame_sessions_report(events)


@on_events("r2_minigame_day", o.minigame(1440, o.SOME_WITHOUT_SESSION), **WITHOUT)
def _(events):
    return minigames.minigame_sessions_report(events, max_session_min=1440)


@on_events("r3_funnel", o.funnel())
def _(events):
    return funnel.funnel_monetization(events)


@on_events("r4_ltv", o.ltv((0, 1, 3, 7)))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF)


@on_events("r5_daily_ads", o.daily())
def _(events):
    return daily_ads.daily_ads(events)


@on_events("r6_retention", o.retention(range(1, 8)))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF)


@on_events("r8_play", o.play())
def _(events):
    return minigames.play_results(events)


# The same reports with their list parameters set.
TWO = ["1.0.8", "1.0.9"]
LISTED = "ver IN ('1.0.8', '1.0.9')"
FILTERED = LISTED + " AND geo NOT IN ('China', 'Japan')"
ABROAD = ["China", "Japan"]


@on_events("r2_minigame_versions", o.minigame(1440, o.SOME_WITHOUT_SESSION, LISTED), **WITHOUT)
def _(events):
    return minigames.minigame_sessions_report(events, versions=TWO, max_session_min=1440)


@on_events("r3_funnel_filtered", o.funnel(where=FILTERED))
def _(events):
    return funnel.funnel_monetization(events, versions=TWO, exclude_geo=ABROAD)


@on_events("r4_ltv_filtered", o.ltv((0, 1, 3, 7), where=FILTERED))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, versions=TWO, exclude_geo=ABROAD)


@on_events("r5_daily_ads_versions", o.daily(listed=LISTED))
def _(events):
    return daily_ads.daily_ads(events, versions=TWO)


@on_events("r5_daily_ads_sessions", o.daily(join_event="session_start"))
def _(events):
    return daily_ads.daily_ads(events, cohort_event="session_start")


@on_events("r6_retention_versions", o.retention(range(1, 8), where=LISTED))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF, versions=TWO)


@on_events("r8_play_versions", o.play(listed=LISTED))
def _(events):
    return minigames.play_results(events, versions=TWO)


# --- documented variants ---------------------------------------------------

GEO = ("app_version", "geo_country")
GEO_NAMES = "ver AS version, geo AS geo_country"


@on_events("v1_ltv_d30", o.ltv((0, 1, 3, 7, 14, 30)))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, horizons=(0, 1, 3, 7, 14, 30))


@on_events("v1_ltv_without_fanout", o.ltv((0, 1, 3, 7), fan=False))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, fanout="fix")


@on_events("v2_retention_d30", o.retention((1, 3, 7, 14, 30)))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF, days=(1, 3, 7, 14, 30))


@on_events("v2_retention_rolling", o.retention(range(1, 8), rolling=True))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF, mode="rolling")


def stored_sets(spark, sf_dir) -> user_sets.UserSets:
    """The sets of all days, added in two parts; the newest days are added again."""
    events = event_store(spark, sf_dir)
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    sets = user_sets.UserSets(spark, scratch_dir(spark, "user-sets"))
    cut = first + (last - first) / 2
    sets.add_days(events, first, cut)
    for _ in range(2):
        sets.add_days(events, cut + dt.timedelta(days=1), last)
    return sets


@register("r6_from_sets", o.retention(range(1, 8)))
def _(spark, sf_dir):
    return user_sets.retention_from_sets(stored_sets(spark, sf_dir), as_of=AS_OF)


@register("v2_rolling_from_sets", o.retention(range(1, 8), rolling=True))
def _(spark, sf_dir):
    return user_sets.retention_from_sets(stored_sets(spark, sf_dir), as_of=AS_OF, mode="rolling")


@register(
    "trailing_active_from_sets",
    o.sql(
        f"SELECT {o.iso('x.d')} AS event_date, COUNT(DISTINCT a.usr) AS users FROM "
        "(SELECT DISTINCT d FROM e WHERE ev = 'session_start') x JOIN "
        "(SELECT DISTINCT usr, d FROM e WHERE ev = 'session_start') a ON date_diff('day', a.d, x.d) BETWEEN 0 AND 6 GROUP BY x.d"
    ),
)
def _(spark, sf_dir):
    return user_sets.trailing_active(stored_sets(spark, sf_dir), days=7)


def kept_report(spark, sf_dir, kind) -> DataFrame:
    """All days with part of one day missing, then that day as it is."""
    events = event_store(spark, sf_dir)
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    day = first + (last - first) / 2
    report = incremental.CohortReport(spark, scratch_dir(spark, f"kept-{kind}"), kind)
    partly = (F.col("event_date") != F.lit(day)) | (F.col(TS) % 3 == 0)
    report.replace_days(events.where(partly), first, last)
    report.replace_days(events, day, day)
    return report.read(AS_OF)


@register("incremental_ltv", SQL["r4_ltv"])
def _(spark, sf_dir):
    return kept_report(spark, sf_dir, "ltv")


@register("incremental_retention", SQL["r6_retention"])
def _(spark, sf_dir):
    return kept_report(spark, sf_dir, "retention")


@on_events("v3_ltv_by_country", o.ltv((0, 1, 3, 7), dims="ver, geo", names=GEO_NAMES))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, dims=GEO)


NETWORK = ("app_version", "up_media_source")
NETWORK_NAMES = "ver AS version, med AS up_media_source"


@on_events("v3_ltv_by_network", o.ltv((0, 1, 3, 7), dims="ver, med", names=NETWORK_NAMES))
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, dims=NETWORK)


@on_events("v3_retention_by_network", o.retention(range(1, 8), dims="ver, med", names=NETWORK_NAMES))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF, dims=NETWORK)


@on_events("v3_retention_by_country", o.retention(range(1, 8), dims="ver, geo", names=GEO_NAMES))
def _(events):
    return retention.retention_curve(events, as_of=AS_OF, dims=GEO)


@on_events("v4_daily_ads_by_version", o.daily(by_version=True))
def _(events):
    return daily_ads.daily_ads(events, by_version=True)


@on_events(
    "v4_daily_ads_all_active", o.daily(cohort_only=False, join_event="session_start")
)
def _(events):
    return daily_ads.daily_ads(events, cohort_event="session_start", cohort_only=False)


@on_events(
    "v4_daily_ads_engagement", o.daily(active="user_engagement", base=o.SOME_WITHOUT_SESSION), **WITHOUT
)
def _(events):
    return daily_ads.daily_ads(events, active_event="user_engagement")


@on_events("v5_funnel_active_cohort", o.funnel(event="session_start", where="TRUE"))
def _(events):
    return funnel.funnel_monetization(events, cohort_event="session_start", exclude_geo=())


@on_events("v5_funnel_native_ads", o.funnel(native=True))
def _(events):
    return funnel.funnel_monetization(events, extra_formats={"NATIVE": ("NATIVE",)})


@on_events("v6_play_attempts", o.play(means=True))
def _(events):
    return minigames.play_results(events, extra_means=("attempt", "deaths"))


@on_events("v6_play_results", o.play(results=("win", "quit", "draw")))
def _(events):
    return minigames.play_results(events, results=("win", "quit", "draw"))


@on_events("v6_play_one_minigame", o.play(where="mg = 'PushTheBall'"))
def _(events):
    return minigames.play_results(events, only=("PushTheBall",))


@on_events(
    "v6_play_by_level",
    o.play(
        key="CASE WHEN k % 19 <> 0 THEN CAST(k AS BIGINT) END", name="level",
        where="k % 19 <> 0 AND k BETWEEN 1 AND 40", base=o.PURCHASES,
    ),
    game=EXTENDED_GAME,
    purchases=True,
)
def _(events):
    return minigames.play_results(events, key="level", level_range=(1, 40))


@on_events(
    "v7_all_events",
    o.sql(
        f"SELECT {o.ID}, ev AS event_name, {o.iso('d')} AS event_date, CAST(NULL AS VARCHAR) AS user_id, "
        "CAST(sid AS VARCHAR) AS ga_session_id, scr AS current_screen, CAST(snum AS VARCHAR) AS ga_session_number FROM e"
    ),
)
def _(events):
    return split.all_events(events).drop("event_ts")


@on_events(
    "v8_variant_summary",
    o.sql(
        "SELECT variant, COUNT(DISTINCT usr) AS users, CAST(SUM(CAST(day_row AS INTEGER)) AS BIGINT) AS active_user_days, "
        "COUNT(grp) AS impressions, ROUND(COALESCE(SUM(val), 0.0), 2) AS revenue, "
        "ROUND(COALESCE(SUM(val), 0.0) / SUM(CAST(day_row AS INTEGER)), 6) AS arpdau, "
        "ROUND(SUM(COALESCE(val, 0.0)) / NULLIF(COUNT(grp), 0) * 1000, 4) AS ecpm, "
        "ROUND(COALESCE(SUM(val), 0.0) / COUNT(DISTINCT usr), 6) AS arpu FROM z GROUP BY variant",
        "a AS (SELECT DISTINCT usr, d, arm_label AS variant FROM e WHERE ev = 'session_start' AND arm IS NOT NULL "
        "AND usr IN (SELECT usr FROM e WHERE ev = 'first_open')), "
        "z AS (SELECT usr, variant, TRUE AS day_row, NULL AS grp, NULL::DOUBLE AS val FROM a UNION ALL "
        "SELECT a.usr, a.variant, FALSE, e.grp, e.val FROM a JOIN e ON e.usr = a.usr AND e.d = a.d WHERE e.ev = 'ad_impression')",
        o.PURCHASES,
    ),
    game=EXTENDED_GAME,
    purchases=True,
)
def _(events):
    return daily_ads.variant_summary(events)


@on_events(
    "v9_journey_edges",
    o.sql(
        "SELECT a AS from_step, b AS to_step, COUNT(*) AS transitions, COUNT(DISTINCT usr) AS users FROM "
        "(SELECT usr, ev AS a, LEAD(ev) OVER (PARTITION BY usr ORDER BY us, ev) AS b FROM e WHERE snum = 1) "
        "WHERE b IS NOT NULL GROUP BY a, b"
    ),
)
def _(events):
    return journeys.journey_edges(events)


@on_events(
    "v9_journey_versions",
    o.sql(
        "SELECT a AS from_step, b AS to_step, COUNT(*) AS transitions, COUNT(DISTINCT usr) AS users FROM "
        "(SELECT usr, ev AS a, LEAD(ev) OVER (PARTITION BY usr ORDER BY us, ev) AS b FROM e WHERE snum = 1) "
        f"WHERE b IS NOT NULL AND usr IN (SELECT usr FROM e WHERE ev = 'first_open' AND {LISTED}) GROUP BY a, b"
    ),
)
def _(events):
    return journeys.journey_edges(events, versions=TWO, new_users_only=True)


@on_events(
    "v4_daily_ads_all_installed", o.daily(cohort_only=False)
)
def _(events):
    return daily_ads.daily_ads(events, cohort_only=False)


@on_events(
    "v9_journey_screens",
    o.sql(
        "SELECT a AS from_step, b AS to_step, COUNT(*) AS transitions, COUNT(DISTINCT usr) AS users FROM "
        "(SELECT usr, scr AS a, LEAD(scr) OVER (PARTITION BY usr ORDER BY us, scr) AS b FROM e WHERE snum = 1) "
        "WHERE b IS NOT NULL GROUP BY a, b"
    ),
)
def _(events):
    return journeys.journey_edges(events, step="current_screen")


@on_events(
    "v10_event_reach",
    o.sql(
        "SELECT c.ver AS version, ev AS event_name, COUNT(DISTINCT e.usr) AS users, n.new_users, "
        "ROUND(COUNT(DISTINCT e.usr) * 100.0::DOUBLE / n.new_users, 2) AS reach_pct FROM c JOIN e USING (usr) "
        "JOIN (SELECT ver, COUNT(DISTINCT usr) AS new_users FROM c GROUP BY ver) n ON n.ver = c.ver "
        "WHERE e.snum = 1 GROUP BY c.ver, ev, n.new_users",
        o.cohort(),
    ),
)
def _(events):
    return journeys.event_reach(events)


@on_events(
    "v11_ltv_purchases",
    o.ltv((0, 1, 3, 7), base=o.PURCHASES, event="in_app_purchase"),
    game=EXTENDED_GAME,
    purchases=True,
)
def _(events):
    return ltv.cohort_ltv(events, as_of=AS_OF, revenue=("in_app_purchase", "value"))
