"""Merging a generated dataset with a curated one, and keeping rows in order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overlay(base: DataFrame, over: DataFrame, key: str, fields: Iterable[str]) -> DataFrame:
    """Rows of both by key; a field that ``over`` sets explicitly (its name is in ``_set``) replaces the base's, null or not.

    The base's position ``_ord`` stays; rows only in ``over`` come after all others.
    """
    b = base.select(F.col(key), F.lit(True).alias("_has"), F.col("_ord").alias("_b_ord"), *[F.col(f).alias(f"_b_{f}") for f in fields])
    o = over.select(F.col(key), F.col("_set"), F.col("_ord").alias("_o_ord"), *[F.col(f).alias(f"_o_{f}") for f in fields])
    both = b.join(o, key, "full")
    pick = lambda f: F.when(F.col("_has").isNull() | F.array_contains(F.coalesce("_set", F.array().cast("array<string>")), f), F.col(f"_o_{f}")).otherwise(F.col(f"_b_{f}"))
    return both.select(key, *[pick(f).alias(f) for f in fields], F.when(F.col("_has").isNull(), 1).otherwise(0).alias("_new"), F.coalesce("_b_ord", "_o_ord").alias("_ord"))


#: Rows of a task where tables are dealt in proportion to their size.
TASK_ROWS = 250_000


def parts_for(table: DataFrame) -> int:
    """So many partitions that a task of ``table`` has some TASK_ROWS rows, however large it is; stored tables know their counts."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // TASK_ROWS))


def upsert(base: DataFrame, over: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Rows of ``over`` replace those of ``base`` with their keys whole; the position of the key's first row stays.

    One aggregate: the last row and the first position of a key are combined before the shuffle.  Where most
    keys have few rows, combining only sorts each task's rows once more: with ``parts``, rows are dealt to so
    many tasks first.
    """
    both = base.withColumn("_rank", F.lit(0)).unionByName(over.withColumn("_rank", F.lit(1)))
    if parts:
        both = both.repartition(parts, *keys)
    values = [c for c in base.columns if c not in keys and c != "_ord"]
    place = F.struct("_rank", "_ord")
    got = both.groupBy(*keys).agg(F.max_by(F.struct(*values, F.lit(0).alias("_")), place).alias("_last"), F.min(place).alias("_first"))
    return got.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in values], F.col("_first._rank").alias("_new"), F.col("_first._ord").alias("_ord"))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, the number ``discarded`` of rows that it replaced, and ``first``, the order of the key's first row, whose position it takes.

    One aggregate, combined before the shuffle, so a key of very many rows costs no more than another.
    """
    values = [c for c in df.columns if c not in keys]
    place = F.struct(*order)
    got = df.groupBy(*keys).agg(F.max_by(F.struct(*values), place).alias("_last"), F.min(place).alias("first"), (F.count("*") - 1).alias("discarded"))
    return got.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in values], "discarded", "first")


def suppress(df: DataFrame, rules: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that no rule names, and rules that name no row."""
    return df.join(rules, keys, "left_anti"), rules.join(df, keys, "left_anti")


def union_ordered(*parts: DataFrame) -> DataFrame:
    """All rows, with the number of the part that each comes from."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("_src_ord", F.lit(k))
        out = p if out is None else out.unionByName(p)
    return out


def fill_down(df: DataFrame, value: str, by: list[str], order: list[str], out: str) -> DataFrame:
    """The last non-null ``value`` up to each row."""
    return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
