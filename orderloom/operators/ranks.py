"""Ranks that never sort a whole group, or a whole table, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import BLOCK, attach


def _rows_before(counted: DataFrame, keys: Sequence[str], order: str, out: str, block: int, span: int) -> DataFrame:
    """Add how many rows of the group have a smaller order value.

    ``counted`` has one row per group and order value, with the number of rows in ``__n``. ``span`` is how far
    apart the values may lie. A block is a run of neighbouring order values; rows before = rows of earlier blocks + rows of
    the same block before the value. Where there can be more blocks than a block has values, earlier blocks are counted
    the same way, over runs of blocks; so no window holds more than twice ``block`` rows, dense or sparse.
    """
    if span <= block:
        window = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return counted.withColumn(out, F.coalesce(F.sum("__n").over(window), F.lit(0)))
    name = f"{order}b"
    marked = counted.withColumn(name, F.expr(f"`{order}` div {block}"))
    in_block = W.partitionBy(*keys, name).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    blocks = marked.groupBy(*keys, name).agg(F.sum("__n").alias("__n"))
    earlier = _rows_before(blocks, keys, name, f"{name}_earlier", block, -(-span // block)).drop("__n")
    local = marked.withColumn(f"{name}_local", F.sum("__n").over(in_block))
    return (
        attach(local, earlier, [*keys, name])
        .withColumn(out, F.coalesce(F.col(f"{name}_local"), F.lit(0)) + F.coalesce(F.col(f"{name}_earlier"), F.lit(0)))
        .drop(name, f"{name}_local", f"{name}_earlier")
    )


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, weight: str | None = None, block: int = BLOCK,
    span: int | None = None,
) -> DataFrame:
    """RANK over (keys) by whole-number columns, ascending, missing last; ties share a rank.

    A row counts as often as ``weight`` says, once without it.

    Copies collapse to one counted position before anything is sorted, and positions are
    ranked column by column in blocks, so neither a hot group nor a hot tie is one task.
    ``span`` is how far apart the values of one group may lie; each power of ``block`` in it costs a level of
    blocks. Without it there are two, enough for 2**32; values beyond a span are ranked as well, by a longer sort.
    """
    sort_cols = [f"__o{i}" for i in range(len(order))]
    last = F.lit(2**63 - 1)
    span = span or block * block
    rows = df.withColumns({s: F.coalesce(F.col(o).cast("bigint"), last) for s, o in zip(sort_cols, order)})
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    positions = rows.groupBy(*keys, *sort_cols).agg(size.alias("__n"))
    *leading, final = sort_cols
    ranked = _rows_before(positions, [*keys, *leading], final, "__before", block, span)
    rank = F.col("__before") + 1
    for i, column in enumerate(leading):
        group = [*keys, *leading[:i]]
        counted = positions.groupBy(*group, column).agg(F.sum("__n").alias("__n"))
        before = _rows_before(counted, group, column, f"__before{i}", block, span).drop("__n")
        ranked = attach(ranked, before, [*group, column])
        rank = rank + F.col(f"__before{i}")
    ranked = ranked.select(*keys, *sort_cols, rank.cast("bigint").alias(out))
    return attach(rows, ranked, [*keys, *sort_cols]).drop(*sort_cols)


def rank_distinct(df: DataFrame, column: str, out: str, descending: bool = True) -> DataFrame:
    """DENSE_RANK of a calendar column over the whole table (missing first when descending).

    Only the distinct values are ranked, so the one-task sort is bounded by the calendar.
    """
    order = F.desc_nulls_first(column) if descending else F.asc_nulls_last(column)
    ranks = df.select(column).distinct().withColumn(out, F.dense_rank().over(W.orderBy(order)))
    return attach(df, ranks, [column])
