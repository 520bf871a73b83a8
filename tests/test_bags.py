"""Bag lookups on the rows where the two families differ."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playlens.functions.bags import Bag
from playlens.functions.labels import ad_format_group, surrogate_key, variant_label
from tests.conftest import entry

P = "event_params"


def one(df, *cols):
    return tuple(df.select(*cols).first())


def test_first_match_and_max_differ_on_repeated_keys(raw):
    df = raw({P: [entry("a", text="b"), entry("a", text="z"), entry("a", text=None)]})
    bag = Bag(P)
    assert one(df, bag.first_str("a"), bag.max_by_key("a", "string_value")) == ("b", "z")


def test_first_match_without_value_hides_later_ones(raw):
    df = raw({P: [entry("a"), entry("a", text="later")]})
    bag = Bag(P)
    assert one(df, bag.first_str("a"), bag.max_by_key("a", "string_value")) == (None, "later")


@pytest.mark.parametrize("bag_value", [[], None])
def test_empty_and_missing_bag(raw, bag_value):
    df = raw({P: bag_value})
    bag = Bag(P)
    got = one(
        df,
        bag.first_str("a"),
        bag.first_num("a"),
        bag.max_by_key("a", "int_value"),
        bag.max_by_prefix("a"),
        bag.concat_prefix("a"),
        bag.concat_keys(["a", "b"]),
    )
    assert got == (None, None, None, None, None, "")


def test_text_prefers_string_then_int_then_double_then_float(raw):
    rows = [
        entry("s", text="t", number=1, real=2.5),
        entry("i", number=1, real=2.5),
        entry("d", real=2.5, single=7.25),
        entry("f", single=7.25),
    ]
    df = raw({P: rows})
    bag = Bag(P)
    assert one(df, *[bag.first_str(k) for k in "sidf"]) == ("t", "1", "2.5", "7.25")


def test_number_prefers_double_then_float_then_int_then_text(raw):
    rows = [
        entry("d", text="9", number=1, real=2.5, single=3.5),
        entry("f", text="9", number=1, single=3.5),
        entry("i", text="9", number=1),
        entry("s", text="9.5"),
        entry("x", text="no number"),
    ]
    bag = Bag(P)
    got = one(raw({P: rows}), *[bag.first_num(k) for k in "dfisx"])
    assert got == (2.5, 3.5, 1.0, 9.5, None)


def test_properties_ignore_the_double_slot(raw):
    bag = Bag("user_properties")
    df = raw({"user_properties": [entry("a", real=1.5), entry("b", number=4)]})
    assert one(df, bag.first_property("a"), bag.first_property("b")) == (None, "4")


def test_prefix_treats_underscore_as_any_character(raw):
    df = raw({P: [entry("exp_1", text="a"), entry("expX2", text="c"), entry("other", text="z")]})
    assert one(df, Bag(P).max_by_prefix("exp_")) == ("c",)


def test_ordered_concat_sorts_keys_as_text_and_skips_nulls(raw):
    rows = [entry("s_2", text="two"), entry("s_10", text="ten"), entry("s_3")]
    bag = Bag(P)
    got = one(raw({P: rows}), bag.concat_prefix("s_"), bag.concat_keys(["s_2", "s_3", "s_10"]))
    assert got == ("ten|two", "two|ten")


def test_staged_texts_give_the_same_values(raw):
    df = raw({P: [entry("a", number=3)]}, {P: None})
    bag = Bag(P)
    staged = bag.with_texts(df)
    assert [r[0] for r in staged.select(bag.first_str("a")).collect()] == ["3", None]


def test_max_number_of_text_compares_numbers(raw):
    df = raw({P: [entry("l", text="9"), entry("l", text="10"), entry("l", text="x")]})
    bag = Bag(P)
    assert one(df, bag.max_number_of_text("l"), bag.max_by_key("l", "string_value")) == (10, "x")


def test_surrogate_key_nulls(raw):
    df = raw(
        {"user_pseudo_id": None, "event_timestamp": 5, "event_name": None},
        {"user_pseudo_id": "null", "event_timestamp": 5, "event_name": "null"},
        {"user_pseudo_id": "u", "event_timestamp": None, "event_name": "e"},
    )
    keys = [
        r[0] for r in df.select(surrogate_key("user_pseudo_id", "event_timestamp", "event_name")).collect()
    ]
    assert keys[0] == keys[1] and keys[2] is None


def test_labels(spark):
    arms = ["1", "TRUE", "t", "0", "False", "f", "2", "3", "Ctl", None]
    rows = spark.createDataFrame([(a,) for a in arms], "a string").select(variant_label(F.col("a")))
    assert [r[0] for r in rows.collect()] == ["B", "B", "B", "A", "A", "A", "C", "D", "Ctl", None]
    formats = ["Banner_x", "mrec", "medium_rectangle", "MEDIUM", "inter", "Rewarded", "native", None]
    rows = spark.createDataFrame([(a,) for a in formats], "a string").select(
        ad_format_group(F.col("a"))
    )
    assert [r[0] for r in rows.collect()] == [
        "BANNER", "MREC", "MREC", "OTHER", "INTER", "REWARDED", "OTHER", "OTHER",
    ]
