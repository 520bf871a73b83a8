"""Keys and labels derived from single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Experiment arm spelled in the export -> label.
VARIANT_LABELS = {"B": ("1", "true", "t"), "A": ("0", "false", "f"), "C": ("2",), "D": ("3",)}
# Ad format group -> upper-case prefixes of the reported format.
AD_FORMAT_PREFIXES = {
    "BANNER": ("BANNER",),
    "MREC": ("MREC", "MEDIUM_"),
    "INTER": ("INTER",),
    "REWARDED": ("REWARD",),
}
OTHER_FORMAT = "OTHER"


def surrogate_key(user: str, micros: str, name: str) -> Column:
    """MD5 (hex) of user, timestamp and event name; NULL without a timestamp."""
    return F.md5(
        F.concat(
            F.coalesce(F.col(user), F.lit("null")),
            F.col(micros).cast("string"),
            F.coalesce(F.col(name), F.lit("null")),
        )
    )


def variant_label(raw: Column) -> Column:
    """Experiment arm as A/B/C/D; anything else keeps its own spelling."""
    pairs = [
        F.lit(text)
        for label, spellings in VARIANT_LABELS.items()
        for spelling in spellings
        for text in (spelling, label)
    ]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(raw)), raw)


def ad_format_group(fmt: Column, extra: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Ad format group by prefix; unknown and NULL formats are ``OTHER``."""
    group = F.lit(OTHER_FORMAT)
    for name, prefixes in {**AD_FORMAT_PREFIXES, **(extra or {})}.items():
        for prefix in prefixes:
            group = F.when(F.upper(fmt).startswith(prefix), F.lit(name)).otherwise(group)
    return group
