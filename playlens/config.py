"""Per-game configuration: which events exist, which parameters they carry and
how the nested export is flattened. A new game is a new config value."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Event names with the parameters that belong to each of them.
# ---------------------------------------------------------------------------
EVENT_PARAMS: dict[str, tuple[str, ...]] = {
    "first_open": (),
    "session_start": (),
    "user_engagement": ("engagement_time_msec",),
    "loading": (),
    "enter_home": (),
    "level_start": ("minigame_id", "attempt"),
    "level_end": (
        "minigame_id", "attempt", "deaths", "result_by", "play_duration", "revive_Total",
    ),
    "checkpoint_reached": ("minigame_id", "checkpoint_index", "revives_per_cp"),
    "item_click": ("item_id", "item_category"),
    "click_change_outfit_button": (),
    "click_shop_button": (),
    "click_quest_button": (),
    "mode_clicked": ("mode_id",),
    "enter_survival_mode_lobby": (),
    "exit_survival_mode_lobby": (),
    "survial_session_start": (),
    "survial_session_end": ("result",),
    "ad_impression": (
        "value", "currency", "ad_format", "ad_unit_name", "ad_platform", "ad_source",
    ),
    "app_request_show_ad": ("ad_context", "feature", "ad_format", "placement"),
    "ad_start_show": ("ad_context", "feature", "ad_format", "placement"),
    "ad_show_complete": (
        "ad_unit_id", "value", "feature", "time", "ad_network", "ad_platform",
        "ad_context", "ad_format", "placement",
    ),
    "ad_show_failed": (
        "ad_format", "placement", "feature", "ad_context", "fail_detail", "fail_reason",
    ),
    "ad_request_success": ("ad_format", "time", "load_attempt_number"),
    "ad_request_failed": ("fail_reason", "ad_format", "time"),
    "ad_reward": ("reward_value", "ad_unit_code"),
    "app_remove": (),
    "os_update": ("previous_os_version",),
    "app_update": ("previous_app_version",),
    "app_exception": ("fatal", "timestamp", "engagement_time_msec"),
    "firebase_campaign": (
        "campaign_info_source", "medium", "source", "gclid", "gad_source",
        "click_timestamp", "gad_campaignid",
    ),
}
CONTEXT_EVENTS = ("first_open", "session_start")
REVENUE_PARAMS = ("value", "reward_value")
# Built as a table but not part of the all-events view the session report reads.
NOT_IN_SESSION_REPORT = ("app_remove",)
SCREEN_PROPERTY = "current_Screen"
HOME = "Home"
LOCAL_ZONE = "Asia/Ho_Chi_Minh"
DEFAULT_EXCLUDED_GEO = ("China",)
DEFAULT_MAX_SESSION_MIN = 20


@dataclass(frozen=True)
class Game:
    """What the split of the raw log needs to know about one game."""

    events: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(EVENT_PARAMS))
    context_events: tuple[str, ...] = CONTEXT_EVENTS
    numeric_params: tuple[str, ...] = REVENUE_PARAMS
    screen_property: str = SCREEN_PROPERTY
    # User property holding the experiment arm; None leaves the column out.
    variant_property: str | None = None

    @property
    def params(self) -> list[str]:
        """All parameter names of all events, each once, in order of appearance."""
        return list(dict.fromkeys(p for own in self.events.values() for p in own))

    def owners(self, param: str) -> list[str]:
        return [e for e, own in self.events.items() if param in own]


DEFAULT_GAME = Game()


@dataclass(frozen=True)
class FlattenSpec:
    """How one game's staging table is derived from the raw event.

    ``params``/``properties`` map an output column to (key, value slot); the
    remaining fields name the few columns whose derivation differs by game.
    """

    columns: tuple[str, ...]
    params: dict[str, tuple[str, str]]
    properties: dict[str, tuple[str, str]]
    date_from_timestamp: bool
    text_level: bool
    rounded_duration: bool
    action_keys: tuple[str, ...] = ()
    action_prefix: str | None = None
    # Days before the run date: (first run, later runs) as (oldest, newest);
    # newest None leaves the range open.
    first_window: tuple[int, int | None] = (1, 1)
    later_window: tuple[int, int | None] = (1, 1)


# ---------------------------------------------------------------------------
# Output columns, parameter keys and value slots of both games.
# ---------------------------------------------------------------------------
_SHARED_PARAMS: dict[str, tuple[str, str]] = {
    "ga_session_id": ("ga_session_id", "int_value"),
    "ga_session_number": ("ga_session_number", "int_value"),
    "start_type": ("play_type", "string_value"),
    "play_index": ("play_index", "int_value"),
    "lose_by": ("lose_by", "string_value"),
    "result_by": ("result", "string_value"),
    "ad_format": ("ad_format", "string_value"),
    "ad_network": ("ad_network", "string_value"),
    "ad_duration": ("ad_duration", "int_value"),
    "value": ("value", "double_value"),
    "currency": ("currency", "string_value"),
    "placement": ("placement", "string_value"),
    "feature_placement": ("feature_placement", "string_value"),
    "feature_name": ("feature_name", "string_value"),
    "feature_duration": ("feature_duration", "int_value"),
    "button_name": ("button_name", "string_value"),
    "button_placement": ("button_placement", "string_value"),
    "ad_type": ("ad_type", "string_value"),
    "ad_unit_name": ("ad_unit_name", "string_value"),
    "reason": ("reason", "string_value"),
    "resource_type": ("resource_type", "string_value"),
    "engagement_time_msec": ("engagement_time_msec", "int_value"),
    "resource_amount": ("resource_amount", "int_value"),
}
_SHARED_PROPERTIES: dict[str, tuple[str, str]] = {
    "campaign": ("campaign", "string_value"),
    "adset": ("adset", "string_value"),
}
_COLUMNS_A = (
    "surrogate_key", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
    "platform", "app_version", "device_mobile_marketing_name",
    "device_mobile_model_name", "device_operating_system_version", "language",
    "country", "city", "continent", "current_level", "first_open_date", "campaign",
    "adset", "firebase_exp", "ga_session_id", "ga_session_number", "level",
    "start_type", "play_index", "play_duration", "lose_by", "action_sequence",
    "result_by", "ad_format", "ad_network", "ad_platform", "ad_source", "ad_duration",
    "value", "currency", "event_value_in_usd", "placement", "current_screen",
    "feature_placement", "feature_name", "feature_duration", "button_name",
    "button_placement", "ad_type", "ad_unit_name", "reason", "resource_type",
    "engagement_time_msec", "resource_amount", "event_params_json",
)
_AFTER_OS_VERSION = _COLUMNS_A.index("device_operating_system_version") + 1
_COLUMNS_B = tuple(
    c
    for c in (
        *_COLUMNS_A[:_AFTER_OS_VERSION], "advertising_id", *_COLUMNS_A[_AFTER_OS_VERSION:],
    )
    if c != "ad_source"
)
EXPERIMENT_PREFIX = "firebase_exp_"

FLATTEN_A = FlattenSpec(
    columns=_COLUMNS_A,
    params={
        **_SHARED_PARAMS,
        "ad_platform": ("ad_platform", "string_value"),
        "ad_source": ("ad_source", "string_value"),
    },
    properties={
        **_SHARED_PROPERTIES,
        "current_screen": ("current_screen", "string_value"),
    },
    date_from_timestamp=True,
    text_level=True,
    rounded_duration=False,
    action_keys=tuple(f"action_seq_{i}" for i in range(1, 6)),
)
FLATTEN_B = FlattenSpec(
    columns=_COLUMNS_B,
    params={
        **_SHARED_PARAMS,
        "ad_platform": ("network_name", "string_value"),
        "current_screen": ("current_screen", "string_value"),
    },
    properties=dict(_SHARED_PROPERTIES),
    date_from_timestamp=False,
    text_level=False,
    rounded_duration=True,
    action_prefix="action_seq_",
    first_window=(2, 1),
    later_window=(2, None),
)

# Columns of the narrow base table; advertising_id only where the game has it.
BASE_COLUMNS = (
    "surrogate_key", "event_name", "event_timestamp", "event_date", "user_pseudo_id",
    "ga_session_number", "ga_session_id", "app_version",
    "device_mobile_marketing_name", "device_mobile_model_name",
    "device_operating_system_version", "advertising_id", "language", "country", "city",
    "continent", "first_open_date", "current_level", "campaign", "adset",
    "current_screen", "firebase_exp",
)
