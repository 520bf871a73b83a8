"""Maps the sample ``events`` table onto the raw export's shape.

Each sample row (event_id, ts, user_id, event_type, value, props) becomes one
nested raw event; every field is a formula of the user number ``u``, the number
``k`` inside ``props`` and the time, written as SQL text. The map is row by row: no shuffle. The two
stores write the result in the layout a real export has, so queries run against
partitioned tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import DEFAULT_GAME, Game
from playlens.functions.dates import utc_micros
from playlens.plans.split import read_events, split_events
from playlens.session import scratch_dir
from playlens.sinks.tables import write_events
from playlens.sources.shards import read_raw

AS_OF = dt.date(2024, 1, 31)
SCREENS = ["Home", "PushTheBall", "RedLightGreenLight", "StealTheBrainrot"]
PIECE_ROWS = 8_000  # of a stored file of nested events: some 4 KB each when unpacked, against 60 bytes stored
VALUELESS = "(u % 9 = 4 OR k % 23 = 0)"
COUNTRIES = ["Vietnam", "Brazil", "Japan"]
FORMATS = ["BANNER", "mrec", "MEDIUM_RECT", "Interstitial", "rewarded", "native"]
ARMS = ["1", "TRUE", "0", "f", "2", "3", "Ctl", None]
EVENT_NAMES = {
    "signup": "first_open",
    "view": "session_start",
    "click": "level_start",
    "error": "level_end",
    "purchase": "ad_impression",
}
# The same catalogue with a purchase event, a level parameter and an experiment arm.
EXTENDED_GAME = Game(
    events={
        **DEFAULT_GAME.events,
        "level_start": (*DEFAULT_GAME.events["level_start"], "level"),
        "level_end": (*DEFAULT_GAME.events["level_end"], "level"),
        "in_app_purchase": ("value", "currency"),
    },
    variant_property="firebase_exp_8",
)


def _quoted(text: str | None) -> str:
    return "CAST(NULL AS STRING)" if text is None else f"'{text}'"


def _pick(names: list[str | None], index: str) -> str:
    return f"get(array({', '.join(_quoted(n) for n in names)}), CAST({index} AS INT))"


def _entry(key: str, text: str = "NULL", number: str = "NULL", real: str = "NULL") -> str:
    """SQL of one bag entry."""
    return (
        f"named_struct('key', '{key}', 'value', named_struct("
        f"'string_value', CAST({text} AS STRING), 'int_value', CAST({number} AS BIGINT), "
        f"'float_value', CAST(NULL AS DOUBLE), 'double_value', CAST({real} AS DOUBLE)))"
    )


def _bag(always: list[str], optional: list[tuple[str, list[str]]]) -> str:
    """SQL of a bag of entries, some of them only under a condition.

    Arrays are joined, as filtering one takes a lambda, and Spark interprets all that is below a lambda.
    """
    some = [f"if({cond}, array({', '.join(entries)}), array())" for cond, entries in optional]
    return f"concat(array({', '.join(always)}), {', '.join(some)})"


def _params(screen: str) -> str:
    playing, ending, paying = "kind IN ('click', 'error')", "kind = 'error'", "kind = 'purchase'"
    result = _pick(["win", "lose", "quit"], "(k DIV 4) % 4")
    return _bag(
        [
            _entry("ga_session_id", number="u * 1000 + dayofmonth(ts)"),
            _entry("ga_session_number", number="(dayofmonth(ts) - 1) DIV 10 + 1"),
            _entry("engagement_time_msec", number="k * 100"),
            _entry("current_screen", text=f"'ep_' || {screen}"),
            _entry("placement", text="'p' || k % 7"),
        ],
        [
            # A repeated key: the first and the largest entry differ.
            ("k % 6 = 0", [_entry("placement", text="'q' || k % 5")]),
            (
                f"{playing} AND k % 17 <> 0",
                [_entry("minigame_id", text=_pick(SCREENS, "(k DIV 3) % 4"))],
            ),
            (
                playing,
                [
                    _entry("attempt", number="k % 5"),
                    _entry("level", text="if(k % 19 = 0, 'L', string(k))", number="k"),
                    _entry("play_type", text="'t' || k % 3"),
                    _entry("play_index", number="k"),
                ],
            ),
            (
                ending,
                [
                    _entry("deaths", text="if(k % 9 = 0, 'x', string(k % 4))"),
                    _entry(
                        "play_duration",
                        text="if(k % 13 = 0, 'bad', NULL)",
                        number="if(k % 13 <> 0 AND k % 2 = 0, k, NULL)",
                        real="if(k % 13 <> 0 AND k % 2 = 1, k + 0.5D, NULL)",
                    ),
                    _entry("play_time", real="k * 0.75D"),
                    _entry("lose_by", text="'l' || k % 6"),
                ],
            ),
            (
                f"{ending} AND (k DIV 4) % 4 < 3",
                [_entry("result_by", text=result), _entry("result", text=result)],
            ),
            (
                paying,
                [
                    # All impressions of some users, and some of all, come without a value.
                    _entry(
                        "value",
                        text=f"if(k % 7 = 0 AND NOT {VALUELESS}, value, NULL)",
                        number=f"if(k % 7 <> 0 AND k % 5 = 0 AND NOT {VALUELESS}, floor(value), NULL)",
                        real=f"if(k % 7 <> 0 AND k % 5 <> 0 AND NOT {VALUELESS}, value, NULL)",
                    ),
                    _entry("currency", text="'USD'"),
                    _entry("ad_format", text=_pick(FORMATS, "k % 6")),
                    _entry("ad_network", text="'n' || k % 4"),
                    _entry("network_name", text="'nn' || k % 3"),
                    _entry("ad_platform", text="'pf' || k % 3"),
                    _entry("ad_source", text="'s' || k % 2"),
                    _entry("ad_duration", number="k % 31"),
                ],
            ),
            ("k % 2 = 0", [_entry("action_seq_10", text="'ten' || k")]),
            ("k % 3 = 0", [_entry("action_seq_2", text="'two' || k")]),
            ("k % 5 = 0", [_entry("action_seq_1", text="'one' || k")]),
        ],
    )


def _properties(screen: str) -> str:
    return _bag(
        [
            _entry("current_Screen", text=screen),
            _entry("current_screen", text=f"'up_' || {screen}"),
            _entry("current_level", text="if(k % 19 = 0, 'x', string(k))"),
            _entry("first_open_time", number="1701388800000 + (u % 60) * 43200000"),
            _entry("campaign", text="'c' || u % 5"),
            _entry("adset", number="u % 9"),
            _entry("media_source", text="'m' || u % 4"),
        ],
        [
            ("u % 8 <> 7", [_entry("firebase_exp_8", text=_pick(ARMS, "u % 8"))]),
            ("k % 24 = 1", [_entry("firebase_exp_9", text="'zz'")]),
        ],
    )


def _record(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw events are made of, one narrow row each."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "ts",
        F.col("user_id").alias("u"),
        F.col("event_type").alias("kind"),
        "value",
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
        F.date_format("ts", "yyyyMMdd").alias("shard"),
        utc_micros(F.col("ts")).alias("event_timestamp"),
    )


def by_shard(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows dealt by shard in pieces of about ``piece_rows``, each in order of its shards.

    The files of the sample may be few and cannot all be split, and a day may have any number of rows; the hash
    lets a cut fall inside a day, even inside an instant.
    """
    pieces = max(1, -(-rows.count() // piece_rows))  # from the footers of the files
    at = F.xxhash64(*rows.columns).alias("at_")
    dealt = rows.select("*", at).repartitionByRange(pieces, "shard", "at_")
    return dealt.drop("at_").sortWithinPartitions("shard")


def raw_events(
    spark: SparkSession, sf_dir: str, *, some_without_session: bool = False, purchases: bool = False
) -> DataFrame:
    """Raw nested events, one per sample row.

    ``some_without_session`` gives every 13th user engagement events in place of
    session starts; ``purchases`` turns a tenth of the impressions into
    purchases.
    """
    rows = sample_rows(spark, sf_dir)
    return nested(rows, some_without_session=some_without_session, purchases=purchases)


def nested(rows: DataFrame, *, some_without_session: bool = False, purchases: bool = False) -> DataFrame:
    """The raw events of ``sample_rows``, in their order."""
    names = dict(EVENT_NAMES)
    cases = [f"WHEN kind = '{sample}' THEN '{ours}'" for sample, ours in names.items()]
    # Users who installed before the log begins: sessions, but no first open.
    cases.insert(0, "WHEN kind = 'signup' AND u % 29 = 5 THEN 'session_start'")
    if some_without_session:
        cases.insert(0, "WHEN kind = 'view' AND u % 13 = 0 THEN 'user_engagement'")
    if purchases:
        cases.insert(0, "WHEN kind = 'purchase' AND k % 10 = 3 THEN 'in_app_purchase'")
    screen = _pick(SCREENS, "k % 4")
    missing = "CAST(NULL AS STRING)"
    columns = {
        "shard": "shard",
        "event_date": "shard",
        "event_timestamp": "event_timestamp",
        "event_name": f"CASE {' '.join(cases)} END",
        # A lambda keeps Spark from fusing it all into one method too long to be compiled, as ``bags.unfused`` does.
        "user_pseudo_id": "get(transform(array(CAST(u AS STRING)), x -> x), 0)",
        "user_id": missing,
        "platform": "if(u % 2 = 0, 'ANDROID', 'IOS')",
        "event_value_in_usd": "if(kind = 'purchase', value, NULL)",
        "event_params": _params(screen),
        "user_properties": _properties(screen),
        "app_info": _record(
            version="'1.0.' || (7 + (u + if(k % 10 = 0, 1, 0)) % 3)",
            id="'game.app'",
            install_store="'store'",
            install_source=missing,
        ),
        "device": _record(
            category="'mobile'",
            operating_system="if(u % 2 = 0, 'Android', 'iOS')",
            operating_system_version="CAST(10 + u % 4 AS STRING)",
            mobile_brand_name="'brand' || u % 3",
            mobile_model_name="'model' || u % 6",
            mobile_marketing_name="'phone' || u % 6",
            language="'en'",
            advertising_id="'ad' || u",
        ),
        "geo": _record(
            country=f"CASE WHEN u % 7 = 0 THEN 'China' WHEN u % 11 = 0 THEN NULL "
            f"ELSE {_pick(COUNTRIES, 'u % 3')} END",
            region="'r' || u % 4",
            city="'city' || u % 10",
            continent="'Asia'",
        ),
        "traffic_source": _record(name="'organic'", medium=missing, source="'src' || u % 2"),
    }
    return rows.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


# Frames over stored tables of this driver process, by session and variant.
_stores: dict[tuple, DataFrame] = {}


def raw_store(spark: SparkSession, sf_dir: str, **variant: bool) -> DataFrame:
    """The raw events as a stored dataset partitioned by shard, written once."""
    key = (spark.sparkContext.applicationId, sf_dir, "raw", *sorted(variant.items()))
    if key not in _stores:
        root = scratch_dir(spark, "raw")
        # Dealt and sorted while narrow: the nested rows are many times as wide and go straight to their files.
        nested(by_shard(sample_rows(spark, sf_dir)), **variant).write.partitionBy("shard").parquet(root)
        _stores[key] = read_raw(spark, root)
    return _stores[key]


def event_store(
    spark: SparkSession, sf_dir: str, game: Game = DEFAULT_GAME, **variant: bool
) -> DataFrame:
    """The typed event table split from the raw events, written once."""
    key = (spark.sparkContext.applicationId, sf_dir, repr(game), *sorted(variant.items()))
    if key not in _stores:
        root = scratch_dir(spark, "events")
        write_events(split_events(raw_store(spark, sf_dir, **variant), game), root)
        _stores[key] = read_events(spark, root, game)
    return _stores[key]
