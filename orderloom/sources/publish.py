"""Publishing months of a table: replace them whole, in one step, and leave every other month as it is.

A table's folder holds one folder a run; the newest manifest (see versions) says which run each month is read from. Runs only
add folders, so nobody reads a month that is half written, and an exchange of months is one rename.

    part=rows/run=R/ord_mo_yr_id=M/cntry_grp=G      rows of a run
    part=aside/run=R/...                            rows of that run that broke a rule, with the reason
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.dates import as_months
from ..functions.text import col
from ..operators.shape import marked_rejects
from .versions import Taken, Versions

MONTH = "ord_mo_yr_id"
GROUP = "cntry_grp"
PART, RUN, REASON = "part", "run", "reject_reason"
ROWS, ASIDE = "rows", "aside"


def country_group(country: Column | str) -> Column:
    """Partition group of a country number."""
    country = col(country)
    arms = None
    for name, members in fixed.COUNTRY_GROUPS.items():
        cond = country.isin(*members)
        arms = F.when(cond, name) if arms is None else arms.when(cond, name)
    return arms.otherwise(fixed.OTHER_GROUP)


def in_its_group(country: Column | str, group: Column | str = GROUP) -> Column:
    """Why a row may not go into its country group; missing where it may."""
    return F.when(~col(group).eqNullSafe(country_group(country)), F.lit("another country group"))


@dataclass(frozen=True)
class Published:
    """What a publishing run did: the version it made, its rows per month, and how many rows it kept aside."""

    path: str
    version: int
    run: str
    counts: DataFrame
    aside: int


def deal(df: DataFrame, path: str, partition_cols: Iterable[str], run: str, **counts: Column) -> dict[str, int]:
    """Write a frame into two places in one pass: rows with a reject reason aside, the others as rows; returns the counts.

    They are taken in the stage that writes, so a repeated task counts once. ``counts`` are conditions on rows.
    """
    cols, fits = list(partition_cols), F.col(REASON).isNull()
    placed = df.withColumns({PART: F.when(fits, F.lit(ROWS)).otherwise(F.lit(ASIDE)), RUN: F.lit(run)})
    if cols:
        # Rebalancing splits a partition that holds most of the rows over several files.
        placed = placed.hint("rebalance", PART, *cols)
    seen = Observation()
    wanted = {ROWS: fits, ASIDE: ~fits} | {name: fits & cond for name, cond in counts.items()}
    watched = placed.observe(seen, *[F.count(F.when(cond, 1)).alias(name) for name, cond in wanted.items()])
    watched.write.mode("append").option("compression", "zstd").partitionBy(PART, RUN, *cols).parquet(path)
    return seen.get


def publish(
    df: DataFrame | Iterable[DataFrame], path: str, months: Iterable[int], partition_cols: Iterable[str] = (MONTH, GROUP),
    reason: Column | None = None, add: bool = False, notes: Mapping[str, object] | None = None,
) -> Published:
    """Replace the given months of a table by the rows of a frame, all months in one write and one step.

    Frames of one schema, pieces of a job, are written one after the other and take effect in the same one step; each is asked
    for when the one before it is written.
    A month without rows ends up empty, as does a country group that lost its last order. Rows of other months, and rows with a
    ``reason`` (text, missing for good rows), are not published: they are counted and kept aside in the same write, see
    ``kept_aside``. ``add`` adds to the months instead; ``notes`` go into the version's manifest. Two runs that publish at a time both take effect; of a month
    that both replace the later one's rows stay, whole.
    """
    months, cols = as_months(months), list(partition_cols)
    run, counts = uuid.uuid4().hex, Counter()
    elsewhere = F.when(F.col(MONTH).isin(*months), F.lit(None)).otherwise(F.lit("another month"))
    why = F.nullif(F.concat_ws("; ", elsewhere, *([] if reason is None else [reason])), F.lit(""))
    for df in [df] if isinstance(df, DataFrame) else df:
        counts.update(deal(df.withColumn(REASON, why), path, cols, run, **{str(m): F.col(MONTH) == m for m in months}))
    spark = df.sparkSession
    versions, version = Versions(spark, path), None
    while version is None:
        newest = versions.newest()
        facts = versions.read(newest)
        held = facts.get("months", {})
        made = {m: v for m, v in held.items() if add or int(m) not in months}
        for m in map(str, months):
            if counts[m]:
                before = made.get(m, {"runs": [], "rows": 0})
                made[m] = {"runs": [*before["runs"], run], "rows": before["rows"] + counts[m]}
        try:
            version = versions.commit(newest, {
                "months": made, "schema": df.schema.json(), "partition_cols": cols, "run": run,
                **(notes or {}), "published": {str(m): counts[str(m)] for m in months}, "aside": counts[ASIDE]})
        except Taken:
            pass
    return Published(path, version, run, _counts(spark, {m: counts[str(m)] for m in months}), counts[ASIDE])


def _counts(spark: SparkSession, rows: dict[int, int]) -> DataFrame:
    return spark.createDataFrame([(int(m), n) for m, n in sorted(rows.items())], f"{MONTH} int, row_count bigint")


def month_counts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows per month that a version's run wrote, as counted in its write; months it emptied too."""
    return _counts(spark, Versions(spark, path).read(version).get("published", {}))


def read_table(spark: SparkSession, path: str, version: int | None = None, months: Iterable[int] | None = None) -> DataFrame:
    """A published table as of a version, the newest one without a number. Only the months' folders are listed."""
    versions = Versions(spark, path)
    facts = versions.read(version)
    if not facts:
        raise ValueError(f"nothing is published in {path}")
    schema = T.StructType.fromJson(json.loads(facts["schema"]))
    wanted = None if months is None else set(as_months(months))
    folders = [f"{versions.root}/{PART}={ROWS}/{RUN}={run}/{MONTH}={m}" for m, v in sorted(facts["months"].items())
               for run in v["runs"] if wanted is None or int(m) in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(T.StructType([*schema, T.StructField(PART, T.StringType()), T.StructField(RUN, T.StringType())]))
    return stored.option("basePath", versions.root).parquet(*folders).select(*schema.names)


def kept_aside(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows that the run of a version did not publish, with the reason."""
    versions = Versions(spark, path)
    facts = versions.read(version)
    schema = T.StructType([*T.StructType.fromJson(json.loads(facts["schema"])), T.StructField(REASON, T.StringType())])
    if not facts["aside"]:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("basePath", f"{versions.root}/{PART}={ASIDE}/{RUN}={facts['run']}")
    return stored.parquet(f"{versions.root}/{PART}={ASIDE}/{RUN}={facts['run']}").select(*schema.names)


def changed_since(spark: SparkSession, path: str, version: int) -> tuple[int, tuple[int, ...]]:
    """The newest version and the months that are read from other runs in it than in an earlier version.

    Without that version (0, or one that was forgotten) they are all months.
    """
    versions = Versions(spark, path)
    newest, known = versions.newest(), {*versions.numbers()}
    before, now = (versions.read(n).get("months", {}) if n in known else {} for n in (version, newest))
    return newest, tuple(sorted(int(m) for m in {*before, *now} if before.get(m) != now.get(m)))


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Forget all versions but the newest ``keep`` and delete the months of runs that only those named; returns how many folders.

    Runs that no version names are left alone: one of them may be about to be published.
    """
    versions = Versions(spark, path)
    numbers = sorted(versions.numbers())
    old, held = numbers[:-keep], numbers[-keep:]

    def named(some: list[int]) -> set[tuple[str, str]]:
        return {(run, m) for n in some for m, v in versions.read(n)["months"].items() for run in v["runs"]}

    gone = named(old) - named(held)
    versions.forget(old)
    for run, month in gone:
        versions.drop(f"{PART}={ROWS}", f"{RUN}={run}", f"{MONTH}={month}")
    return len(gone)


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and reload a whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def tolerant_load(df: DataFrame, casts: dict[str, str], path: str, reject_path: str) -> tuple[int, int]:
    """Load the rows that fit their types, keep the others as given with the reason; returns both counts.

    The input is read once: one write deals the rows, and the two folders then take the place of the old ones. A column
    that is cast is in both, typed, and beside it in the rejects as it was given (``<column>_given``).
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.load-{uuid.uuid4().hex}"
    marked = marked_rejects(df, casts, REASON)
    counts = deal(marked, staging, (), "load")
    for part, target in ((ROWS, path), (ASIDE, reject_path)):
        old = Versions(spark, target)
        old.drop()
        if counts[part]:
            old.fs.mkdirs(old.at().getParent())
            old.fs.rename(Versions(spark, staging).at(f"{PART}={part}", f"{RUN}=load"), old.at())
        else:
            spark.createDataFrame([], marked.schema).write.parquet(target)
    Versions(spark, staging).drop()
    return counts[ROWS], counts[ASIDE]


def read_published(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A published table with its declared column order and types, partition columns included."""
    stored = read_table(spark, path, version)
    return stored.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema],
        *[c for c in stored.columns if c not in schema.names],
    )


def gather_statistics(spark: SparkSession, table: str, partition: dict[str, object] | None = None) -> None:
    """Table and column statistics, or row count and size of one partition."""
    if partition is None:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        return
    spec = ", ".join(f"{k}={v!r}" for k, v in partition.items())
    spark.sql(f"ANALYZE TABLE {table} PARTITION ({spec}) COMPUTE STATISTICS")


def jdbc_reader(
    spark: SparkSession, url: str, table: str, split_on: str, bounds: tuple[int, int], parts: int, **options: str
) -> DataFrame:
    """A database table read by many tasks at once, split on a numeric column.

    For the move from one database to another: read here, write with the JDBC writer or
    to files. No row passes the driver.
    """
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_on,
        lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts), **options,
    ).load()
