"""Equi-joins: attaching group results, lookups, dimension roles, as-of, anti joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Values per block of a sorted run: what one task sorts at most of one key.
BLOCK = 65536
# Bits of a key filter: 2,048 blocks of 4 KB, 8 MB in all.
KEY_BITS = 1 << 26


def _join(df: DataFrame, side: DataFrame, pairs: Mapping[str, str], equals: str, how: str) -> DataFrame:
    """Equi-join on ``{df column: side column}``, without the side's key columns."""
    semi = how in ("left_semi", "left_anti")
    taken = set(df.columns) & (set(side.columns) - set(pairs.values()))
    if taken and not semi:
        raise ValueError(f"columns on both sides: {sorted(taken)}")
    if semi:
        side = side.select(*pairs.values())
    keys = {right: f"__r_{i}" for i, right in enumerate(pairs.values())}
    if len(keys) < len(pairs):
        raise ValueError("a side column may be matched once")
    cond = " AND ".join(f"`{left}` {equals} `{keys[right]}`" for left, right in pairs.items())
    joined = df.join(side.withColumnsRenamed(keys), F.expr(cond), how)
    return joined if semi else joined.drop(*keys.values())


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``side`` on equally named keys, where two missing keys count as equal.

    The null-safe keys give both inputs a shuffle of their own, also when ``side`` is an
    aggregate that is already partitioned by the keys. That is what lets Spark split the
    partition of a hot key of ``df``.
    """
    return _join(df, side, {k: k for k in keys}, "<=>", how)


def attach_observed(df: DataFrame, side: DataFrame, keys: Sequence[str], seen: Observation) -> DataFrame:
    """``attach`` that tells how far the side multiplies the rows, counted while the plan runs.

    ``seen`` gets rows_before, rows_after and greatest_fan_out. The side's rows are counted by key, which is combined before it
    is shuffled, so a key of many rows costs no more than another.
    """
    sizes = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("__times"))
    counted = attach(df, sizes, keys)
    times = F.coalesce("__times", F.lit(1))
    watched = counted.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.coalesce(F.sum(times), F.lit(0)).alias("rows_after"),
                              F.coalesce(F.max("__times"), F.lit(0)).alias("greatest_fan_out"))
    return attach(watched.drop("__times"), side, keys)


def fan_out(*seen: Observation) -> dict[str, int]:
    """What ``attach_observed`` counted in a plan, or in all pieces of one, after they have run."""
    counts = [_counted(one) for one in seen]
    return {name: (max if name == "greatest_fan_out" else sum)(c[name] for c in counts) for name in counts[0]}


def _counted(seen: Observation) -> dict[str, int]:
    """Zeros where Spark found the part empty and left it out."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in e.java_exception.getClass().getName():
            raise
        return {"rows_before": 0, "rows_after": 0, "greatest_fan_out": 0}


def match(df: DataFrame, side: DataFrame, on: Mapping[str, str] | Sequence[str], how: str = "left") -> DataFrame:
    """Join on plain equality of ``{df column: side column}``; missing keys match nothing.

    The side's key columns are left out of the result; its other columns must be new.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    return _join(df, side, pairs, "=", how)


def lookup(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str] | Sequence[str], default: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join to a dimension, with default values for its columns where it has no row.

    Spark broadcasts the dimension if its measured size allows, else it shuffles both sides.
    """
    joined = match(df, dim, on, "left")
    if default:
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})
    return joined


def role_join(
    df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]], one_pass: bool | None = None
) -> DataFrame:
    """Look one dimension up in several roles: ``{df key column: {dim column: output name}}``.

    A dimension that is small enough to broadcast is joined once per role. A larger one is resolved in one pass (``one_pass``
    says which, where its size is not to decide): the distinct combinations of the role keys are turned into one row per role,
    these meet the dimension, and are turned back, so that the rows themselves are shuffled once instead of once per
    role. That asks for a dimension with one row per key, and fails where there are more.
    """
    if one_pass is None:
        one_pass = len(roles) > 1 and not small_enough(dim)
    if one_pass:
        return _roles_in_one_pass(df, dim, key, roles)
    for role_key, wanted in roles.items():
        side = dim.select(F.col(key), *[F.col(c).alias(name) for c, name in wanted.items()])
        df = match(df, side, {role_key: key}, "left")
    return df


def small_enough(df: DataFrame) -> bool:
    """Spark's estimate of the frame lies below its limit for broadcasts."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= _broadcast_limit(df)


def _broadcast_limit(df: DataFrame) -> int:
    """What the session broadcasts at most, in bytes; -1 for nothing."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _roles_in_one_pass(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    wanted = sorted({c for names in roles.values() for c in names})
    tuples = df.select(*roles).distinct()
    by_role = [F.struct(F.lit(i).alias("i"), F.col(k).alias("k")) for i, k in enumerate(roles)]
    asked = tuples.withColumn("__role", F.explode(F.array(*by_role))).select(
        *roles, F.col("__role.i").alias("__i"), F.col("__role.k").alias("__k"))
    side = dim.select(F.col(key).alias("__key"), F.struct(*wanted).alias("__found"))
    found = match(asked.filter("__k IS NOT NULL"), side, {"__k": "__key"}, "inner")
    once = F.when(F.count("__found") > 1, F.raise_error(F.lit(f"{key} is not unique in the dimension"))).otherwise(F.first("__found"))
    one = found.groupBy(*roles, "__i").agg(once.alias("__found"))
    back = one.groupBy(*roles).agg(*[F.first(F.when(F.col("__i") == i, F.col("__found")), True).alias(f"__r{i}") for i in range(len(roles))])
    names = [F.col(f"__r{i}.{c}").alias(name) for i, cols in enumerate(roles.values()) for c, name in cols.items()]
    return attach(df, back.select(*roles, *names), list(roles))


def in_force(
    dim: DataFrame, keys: Sequence[str], effective: str, value: str, at: int | Sequence[int], out_at: str = "at"
) -> DataFrame:
    """Value of each key in force at one or more points: that of its latest start <= the point.

    A start that is missing counts as later than every point, so it is never in force. On a
    tie the greater value wins. The points are a list in the query: each is a maximum over its
    key's rows, combined before they are shuffled, and only the results are spread over points.
    """
    points = [at] if isinstance(at, int) else sorted(set(at))
    start = F.struct(F.col(effective).alias("k"), F.col(value).alias("v"))
    latest = [F.max(F.when(F.col(effective) <= p, start)).alias(f"__p{i}") for i, p in enumerate(points)]
    by_point = F.array(*[F.struct(F.lit(p).alias("at"), F.col(f"__p{i}").alias("last")) for i, p in enumerate(points)])
    spread = dim.groupBy(*keys).agg(*latest).select(*keys, F.explode(by_point).alias("__p"))
    return spread.filter("__p.last IS NOT NULL").select(
        *keys, F.col("__p.at").alias(out_at), F.col("__p.last.v").alias(value))


def as_of(
    df: DataFrame, dim: DataFrame, key: Mapping[str, str] | Sequence[str], at: str, effective: str, value: str, out: str,
    block: int = BLOCK, span: int | None = None,
) -> DataFrame:
    """Add to every row the value of its key in force at the row's own point: that of the latest start up to it.

    Points and starts (whole numbers or days) of a key lie in one sorted run, cut into blocks of neighbouring values; within a
    block the last start is carried forward, and what an earlier block ends with is carried over blocks the same way. So
    neither a key with many starts nor one with many rows is one task's. Points are looked up once per key and
    value. Of equal starts the greater value wins; missing points and starts match nothing. ``span`` is how far apart the values
    of a key may lie; each power of ``block`` in it costs a level, without it there are two.
    """
    pairs = dict(key) if isinstance(key, Mapping) else {k: k for k in key}
    keys = [f"__k{i}" for i in range(len(pairs))]
    mine = {k: F.col(c) for k, c in zip(keys, pairs)}
    rows = df.withColumns({**mine, "__t": _whole(df, at)})
    points = rows.select(*keys, "__t").dropna().distinct()
    starts = dim.select(*[F.col(c).alias(k) for k, c in zip(keys, pairs.values())], _whole(dim, effective).alias("__t"),
                        F.col(value).alias("__value")).dropna(subset=[*keys, "__t"])
    starts = starts.groupBy(*keys, "__t").agg(F.struct(F.max("__value").alias("v")).alias("__start"))
    cells = points.withColumn("__point", F.lit(True)).join(starts, [*keys, "__t"], "full")
    carried = _carried(cells, keys, "__t", "__start", block, span or block * block, 0)
    found = carried.filter("__point").select(*keys, "__t", F.col("__start.v").alias(out))
    return match(rows, found, [*keys, "__t"]).drop(*keys, "__t")


def _whole(df: DataFrame, column: str):
    """A whole-number or day column as a long."""
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("bigint")
    if kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{column} is {kind}; a whole number or a day is needed")
    return F.col(column).cast("bigint")


def _carried(cells: DataFrame, keys: Sequence[str], order: str, start: str, block: int, span: int, last: int) -> DataFrame:
    """Cells with the start of the row itself or the nearest one before it (``last`` 0), or before it only (-1)."""
    if span <= block:
        window = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, last)
        return cells.withColumn(start, F.last(start, True).over(window))
    name, end = f"{order}b", f"{start}_end"
    marked = cells.withColumn(name, F.expr(f"(`{order}` - pmod(`{order}`, {block})) div {block}"))
    window = W.partitionBy(*keys, name).orderBy(order).rowsBetween(W.unboundedPreceding, last)
    ends = marked.groupBy(*keys, name).agg(F.max_by(start, F.when(F.col(start).isNotNull(), F.col(order))).alias(end))
    before = _carried(ends, keys, name, end, block, -(-span // block), -1)
    local = marked.withColumn(start, F.last(start, True).over(window))
    return attach(local, before, [*keys, name]).withColumn(start, F.coalesce(start, end)).drop(name, end)


def insert_missing(state: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State plus the new rows whose keys it does not hold yet."""
    missing = match(new, state.select(*keys).distinct(), list(keys), "left_anti")
    return state.unionByName(missing)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Null-aware NOT IN: one missing value in ``other`` excludes every row.

    Spark ships ``other`` to every task for this, so it must be a list of known small size.
    """
    other_column = other_column or column
    return df.sparkSession.sql(
        f"SELECT * FROM {{df}} WHERE `{column}` NOT IN (SELECT `{other_column}` FROM {{other}})",
        df=df, other=other,
    )


def key_bits(df: DataFrame, most: int = KEY_BITS) -> int:
    """As many bits of a key filter as the session's limit for broadcasts allows, up to ``most``; whole blocks, at least one."""
    return max(1 << 15, min(most, 8 * _broadcast_limit(df)) >> 15 << 15)


def among_keys(df: DataFrame, keys: DataFrame, on: Mapping[str, str], bits: int = KEY_BITS) -> DataFrame:
    """Rows whose key may be one of those in ``keys`` (``{df column: keys column}``): none of such a key is lost, a few others stay.

    A Bloom filter of one hash: a key sets one of ``bits`` bits. It is broadcast, as 4 KB blocks of bits of which there are
    ``bits`` / 32,768 at most, so its size is bounded however many keys there are (8 MB as set here); with
    more keys than about a tenth of the bits it keeps more and more rows. Where the session's limit for broadcasts lies below
    that size, all rows stay.
    """
    if bits // 8 > _broadcast_limit(df):
        return df

    def place(columns: list[str]):
        return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(bits))

    at = place(list(on.values()))
    blocks = keys.groupBy(F.bitmap_bucket_number(at).alias("__block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    placed = df.withColumn("__at", place(list(on))).withColumn("__own", F.bitmap_bucket_number("__at"))
    met = placed.join(F.broadcast(blocks), F.col("__own") == F.col("__block"), "inner")
    bit = F.bitmap_bit_position("__at")
    octet = F.conv(F.hex(F.substr("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.filter(F.call_function("shiftright", octet, (bit % 8).cast("int")) % 2 == 1).select(*[F.col(f"`{c}`") for c in df.columns])
