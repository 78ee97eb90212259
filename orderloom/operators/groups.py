"""Values of a whole group, given to every row or folded to one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, share_of
from .joins import attach


def with_group(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add aggregates over each group to its rows (missing keys form a group)."""
    side = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return attach(df, side, keys)


def value_from_row(
    df: DataFrame, keys: Sequence[str], cond: Column, value: Column | str, out: str,
    fallback: Column | str | None = None, among: DataFrame | None = None,
) -> DataFrame:
    """Greatest value among the group's qualifying rows, or the row's own fallback.

    The qualifying rows are looked for in ``among``, where that is cheaper to make than df.
    """
    side = (df if among is None else among).filter(cond).groupBy(*keys).agg(F.max(col(value)).alias("__found"))
    found = attach(df, side, keys)
    result = F.col("__found") if fallback is None else F.coalesce(F.col("__found"), col(fallback))
    return found.withColumn(out, result).drop("__found")


def first_of_group(df: DataFrame, keys: Sequence[str], order: str, value: Column | str, out: str) -> DataFrame:
    """Keep a value on the rows that come first in their group, 0 elsewhere; ties all keep it."""
    grouped = with_group(df, keys, __first=F.min(order))
    kept = F.when(F.col("__first") == F.col(order), col(value)).otherwise(F.lit(0))
    return grouped.withColumn(out, kept).drop("__first")


def prorate(df: DataFrame, keys: Sequence[str], weight: str, total: Column | str, out: str) -> DataFrame:
    """Split a group's total over its rows by weight, each rounded to the cent.

    No remainder is redistributed. A missing total or a zero weight sum gives a missing share.
    """
    grouped = with_group(df, keys, __weights=F.sum(weight))
    return grouped.withColumn(out, share_of(F.col(weight), col(total), F.col("__weights"))).drop("__weights")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows with the least order value of their key, ties kept; missing sorts last."""
    side = df.groupBy(*keys).agg(F.min(order).alias(order))
    return attach(df, side, [*keys, order], "left_semi")


def keep_last(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str | None = None) -> DataFrame:
    """Greatest value among the rows with the last order of each group; missing sorts last."""
    best = F.max(F.struct(F.col(order).isNull().alias("n"), F.col(order).alias("k"), F.col(value).alias("v")))
    return df.groupBy(*keys).agg(best.getField("v").alias(out or value))


def hypothetical_dense_rank(
    df: DataFrame, keys: Sequence[str], order: str, constant, out: str, descending: bool = True
) -> DataFrame:
    """Dense rank a constant would take among the group's order values.

    Descending puts missing values first, ascending puts them last.
    """
    k, c = F.col(order), F.lit(constant)
    ahead = k > c if descending else k < c
    rank = 1 + F.count_distinct(F.when(ahead, k))
    if descending:
        rank = rank + F.max(k.isNull().cast("int"))
    return df.groupBy(*keys).agg(rank.cast("int").alias(out))


def listagg_by(
    df: DataFrame, keys: Sequence[str], value: str, order: str | None = None,
    sep: str = ", ", descending: bool = False, out: str = "list",
) -> DataFrame:
    """Values of a group as one text, ordered; the value itself breaks ties.

    The result is one text per group, so this is for short lists such as months or countries.
    """
    order = order or value
    direction = "DESC NULLS FIRST" if descending else "ASC NULLS LAST"
    tie = "" if order == value else f", `{value}` ASC NULLS LAST"
    text = F.expr(
        f"listagg(cast(`{value}` as string), '{sep}') WITHIN GROUP (ORDER BY `{order}` {direction}{tie})"
    )
    return df.groupBy(*keys).agg(text.alias(out))


def pivot_latest(
    df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str], agg_col: str
) -> DataFrame:
    """One column per listed value, holding the greatest agg_col."""
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.max(agg_col))
