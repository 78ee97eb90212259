"""Bringing frames to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import cut, cut_bytes


def conform(
    df: DataFrame, schema: T.StructType, widths: Mapping[str, int] | None = None, byte_widths: Mapping[str, int] | None = None
) -> DataFrame:
    """Exactly the schema's columns, in its order and types; absent ones are missing values.

    Texts are cut to their declared widths, in characters or in bytes of UTF-8 (whole characters).
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns outside the schema: {unknown}")
    have = set(df.columns)
    narrow = {c: cut(c, n) for c, n in (widths or {}).items() if c in have}
    narrow |= {c: cut_bytes(c, n) for c, n in (byte_widths or {}).items() if c in have}
    if narrow:
        df = df.withColumns(narrow)
    return df.selectExpr(*[
        f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema
    ])


def split_rejects(df: DataFrame, casts: Mapping[str, str], reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Rows whose columns all take their new types (cast), and the others with the reason."""
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in casts.items()}
    why = F.concat_ws("; ", *[F.when(b, F.lit(f"{c} is not {casts[c]}")) for c, b in bad.items()])
    marked = df.withColumn(reason, why)
    good = marked.filter(F.col(reason) == "").drop(reason)
    good = good.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})
    return good, marked.filter(F.col(reason) != "")


def marked_rejects(df: DataFrame, casts: Mapping[str, str], reason: str = "reject_reason") -> DataFrame:
    """All rows once: columns cast to their new types, the reason where one does not fit, and then the values as given.

    The given values of column c are in ``c_given``; they and the reason are missing for rows that fit.
    """
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in casts.items()}
    why = F.concat_ws("; ", *[F.when(b, F.lit(f"{c} is not {casts[c]}")) for c, b in bad.items()])
    marked = df.withColumn(reason, F.nullif(why, F.lit("")))
    marked = marked.withColumns({f"{c}_given": F.when(F.col(reason).isNotNull(), F.col(c)) for c in casts})
    return marked.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})


def too_wide(widths: Mapping[str, int]) -> Column:
    """Which texts exceed their declared widths; an empty text where none does."""
    return F.concat_ws("; ", *[
        F.when(F.length(c) > width, F.lit(f"{c} is longer than {width}")) for c, width in widths.items()
    ])


def split_too_wide(df: DataFrame, widths: Mapping[str, int], reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Rows whose texts fit the declared widths, and the others with the reason."""
    marked = df.withColumn(reason, too_wide(widths))
    return marked.filter(F.col(reason) == "").drop(reason), marked.filter(F.col(reason) != "")


def stack(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
