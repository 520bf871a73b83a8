"""Data-quality checks; each returns report rows, nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.operators.keys import missing_parents

ERROR, WARN = "error", "warn"


def _row(check: str, column: str, severity: str, failures: Column) -> list[Column]:
    failures = F.coalesce(failures, F.lit(0)).cast("long")
    return [
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, "pass").otherwise(severity).alias("status"),
    ]


def unique(df: DataFrame, column: str, severity: str = ERROR) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    repeated = (
        df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("unique", column, severity, F.col("n"))
    )


def not_null(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """NULL counts of all columns (name -> severity) in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(*_row("not_null", c, severity, F.col(c))) for c, severity in columns.items()]
    )
    return counts.select(F.inline(rows))


def relationship(
    child: DataFrame, parent: DataFrame, column: str, severity: str = ERROR
) -> DataFrame:
    """Child rows whose key is missing in the parent."""
    return (
        missing_parents(child, parent, column)
        .agg(F.sum("n_rows").alias("n"))
        .select(*_row("relationship", column, severity, F.col("n")))
    )


def accepted_values(
    df: DataFrame, column: str, allowed: Sequence[str], severity: str = ERROR
) -> DataFrame:
    """Rows with a value outside the list; NULLs pass."""
    return df.agg(F.count_if(~F.col(column).isin(list(allowed))).alias("n")).select(
        *_row("accepted_values", column, severity, F.col("n"))
    )


def key_checks(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Uniqueness of a key and NULL counts of columns in one pass over the table.

    Rows become one per key first, combined before the shuffle, so NULL keys or copies
    of one key do not gather in a task.
    """
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns]
    )
    totals = per_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
        *[F.sum(f"_{c}").alias(f"_{c}") for c in columns],
    )
    rows = [F.struct(*_row("unique", key, ERROR, F.col("_repeated")))]
    rows += [F.struct(*_row("not_null", c, severity, F.col(f"_{c}"))) for c, severity in columns.items()]
    return totals.select(F.inline(F.array(*rows)))


def staging_checks(flat: DataFrame) -> DataFrame:
    """The checks every staging table runs after a build."""
    return key_checks(
        flat,
        "surrogate_key",
        {
            "surrogate_key": ERROR,
            "event_date": ERROR,
            "event_name": ERROR,
            "user_pseudo_id": ERROR,
            "ga_session_id": WARN,
        },
    )


def base_checks(base: DataFrame, flat: DataFrame) -> DataFrame:
    """The checks of the base table, with its keys looked up in staging."""
    own = key_checks(base, "surrogate_key", {"surrogate_key": ERROR, "event_date": ERROR})
    return own.unionByName(relationship(base, flat, "surrogate_key"))


def report_checks(report: DataFrame, key: str) -> DataFrame:
    """A report's key column is unique and set."""
    return key_checks(report, key, {key: ERROR})
