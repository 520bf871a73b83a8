"""Reading values out of a key/value bag (``array<struct<key, value>>``).

Lookups use ``array_position`` on generated code rather than one lambda filter per
column: Spark interprets lambdas element by element, and a wide table reads dozens
of keys from each bag. What all columns of a projection have in common (the keys,
the bag sorted by slot) is computed once per row as a common subexpression. Spark
does not share expressions that hold a lambda, so a projection that reads many keys
as text stages that step in a column of its own (``with_texts``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = ("string_value", "int_value", "float_value", "double_value")


def _at(values: Column, keys: Column, key: str | Column) -> Column:
    # array_position is 1-based with 0 for "absent"; get() turns -1 into NULL.
    return F.get(values, (F.array_position(keys, key) - 1).cast("int"))


def unfused(column: Column) -> Column:
    """The same value, taken through a lambda.

    Spark leaves a projection that holds a lambda out of whole-stage code. A very
    wide projection needs that: fused, it becomes one method above the 8000 bytes
    the JVM compiles and runs interpreted (measured: almost three times slower).
    """
    return F.get(F.transform(F.array(column), lambda x: x), 0)


class Bag:
    """Column expressions over one bag column.

    A ``key`` may also be a column that is NULL on rows that must not read it.
    """

    def __init__(self, column: str) -> None:
        self.column = column
        self._slots: dict[str, Column] = {}
        self._ranked: dict[str, tuple[Column, Column]] = {}

    @cached_property
    def entries(self) -> Column:
        return F.col(self.column)

    @cached_property
    def keys(self) -> Column:
        return F.col(f"{self.column}.key")

    def with_texts(self, df: DataFrame) -> DataFrame:
        """``df`` with the entries as text in a helper column that lookups then use."""
        name = f"_{self.column}_texts"
        staged = df.withColumn(name, self.texts)
        self.texts = F.col(name)
        return staged

    def slot(self, name: str) -> Column:
        """One value slot of all entries, next to ``keys``."""
        if name not in self._slots:
            self._slots[name] = F.col(f"{self.column}.value.{name}")
        return self._slots[name]

    @cached_property
    def texts(self) -> Column:
        """All entries as text, whichever slot is filled."""
        return F.transform(
            F.col(f"{self.column}.value"),
            lambda v: F.coalesce(
                v["string_value"],
                v["int_value"].cast("string"),
                v["double_value"].cast("string"),
                v["float_value"].cast("string"),
            ),
        )

    def _rank(self, slot: str) -> tuple[Column, Column]:
        if slot not in self._ranked:
            pairs = F.sort_array(
                F.arrays_zip(self.keys.alias("k"), self.slot(slot).alias("v")), asc=False
            )
            self._ranked[slot] = (pairs["k"], pairs["v"])
        return self._ranked[slot]

    # -- first entry with a key ---------------------------------------------

    def first_slot(self, key: str | Column, slot: str) -> Column:
        """One value slot of the first entry."""
        return _at(self.slot(slot), self.keys, key)

    def first_str(self, key: str | Column) -> Column:
        """The first entry as text, whichever slot is filled."""
        return _at(self.texts, self.keys, key)

    def first_num(self, key: str | Column) -> Column:
        """The first entry as a double; unparsable text becomes NULL.

        Read slot by slot: only the entry that is asked for gets parsed.
        """
        return F.coalesce(
            self.first_slot(key, "double_value"),
            self.first_slot(key, "float_value"),
            self.first_slot(key, "int_value").cast("double"),
            self.first_slot(key, "string_value").try_cast("double"),
        )

    def first_property(self, key: str | Column) -> Column:
        """The first entry as text, from the text or the integer slot."""
        return F.coalesce(
            self.first_slot(key, "string_value"),
            self.first_slot(key, "int_value").cast("string"),
        )

    def first_int_text(self, key: str | Column) -> Column:
        """Integer slot of the first entry, as text."""
        return self.first_slot(key, "int_value").cast("string")

    # -- all entries with a key ---------------------------------------------

    def max_by_key(self, key: str, slot: str) -> Column:
        """Largest non-NULL slot value among all entries with ``key``.

        The bag is sorted once per slot in descending (key, value) order with
        NULLs last, so the first hit is the maximum even when a key repeats.
        """
        keys, values = self._rank(slot)
        return _at(values, keys, key)

    def max_number_of_text(self, key: str) -> Column:
        """Largest integer among the texts of all entries with ``key``."""
        hits = F.filter(self.entries, lambda e: e["key"] == F.lit(key))
        return F.array_max(
            F.transform(hits, lambda e: e["value"]["string_value"].try_cast("bigint"))
        )

    def max_by_prefix(self, prefix: str) -> Column:
        """Largest text among keys LIKE ``prefix%`` (``_`` matches any character)."""
        hits = F.filter(self.entries, lambda e: e["key"].like(prefix + "%"))
        return F.array_max(F.transform(hits, lambda e: e["value"]["string_value"]))

    def concat_keys(self, keys: Sequence[str], sep: str = "|") -> Column:
        """Texts of the given keys in the given order; missing ones skipped."""
        return F.array_join(
            F.array(*[self.max_by_key(k, "string_value") for k in keys]), sep
        )

    def concat_prefix(self, prefix: str, sep: str = "|") -> Column:
        """Texts of keys LIKE ``prefix%`` in key order; NULL without any."""
        hits = F.filter(
            self.entries,
            lambda e: e["key"].like(prefix + "%") & e["value"]["string_value"].isNotNull(),
        )
        pairs = F.array_sort(
            F.transform(
                hits,
                lambda e: F.struct(
                    e["key"].alias("k"), e["value"]["string_value"].alias("v")
                ),
            )
        )
        return F.when(F.size(hits) > 0, F.array_join(pairs["v"], sep))

    def lifted(self) -> Column:
        """The bag with the value slots lifted next to the key."""
        return F.arrays_zip(
            self.keys.alias("key"), *[self.slot(s).alias(s) for s in SLOTS]
        )
