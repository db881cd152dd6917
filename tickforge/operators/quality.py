"""Checks on columns, keys and references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Error that names every missing column; needs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_single_instant(df: DataFrame, at: str = "timestamp") -> None:
    """Error unless all rows share one timestamp."""
    span = df.agg(F.min(at).alias("a"), F.max(at).alias("b"), F.count(F.lit(1)).alias("n"), F.count(at).alias("m")).first()
    if span["n"] == 0 or span["n"] != span["m"] or span["a"] != span["b"]:
        raise ValueError("rows do not share one timestamp")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_count(*columns: str) -> Column:
    """Rows with a null in any of the columns."""
    return F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def too_long_count(column: str, limit: int) -> Column:
    return F.count_if(F.length(column) > limit)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def constraint_report(
    table: str,
    df: DataFrame,
    key: list[str],
    not_null: list[str],
    max_length: dict[str, int],
    references: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Rows (table, rule, violations): one per rule, zero when it holds."""
    counts = [null_count(c).alias(f"not_null:{c}") for c in not_null]
    counts += [too_long_count(c, n).alias(f"max_length:{c}") for c, n in max_length.items()]
    parts = []
    if counts:
        flat = df.agg(*counts)
        names = flat.columns
        parts.append(flat.unpivot([], [f"`{n}`" for n in names], "rule", "violations"))
    parts.append(
        duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"unique:{'+'.join(key)}").alias("rule"), "violations")
    )
    for column, (parent, parent_column) in (references or {}).items():
        # One row per referenced value before the join: a value used often stays cheap.
        used = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            orphans(used, column, parent, parent_column)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
            .select(F.lit(f"reference:{column}").alias("rule"), "violations")
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(table).alias("table_name"), "rule", F.col("violations").cast("long").alias("violations"))
