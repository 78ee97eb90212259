"""What follows a published month: views that are stored, and a catalog table with statistics."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .publish import MONTH, PART, ROWS, RUN, Published, changed_since, gather_statistics, publish, read_table
from .versions import Versions

SEEN = "orderloom.version"


def refresh_view(
    spark: SparkSession, base: str, path: str, build: Callable[[DataFrame], DataFrame], partition_cols: Iterable[str] = (MONTH,),
) -> Published | None:
    """Bring a stored view of a published table up to date from its changed months alone; None if none changed.

    ``build`` makes the view's rows of the table's; every row of the view must come from rows of its own month. The view
    remembers which version of the table it was made from. Months whose rows come from other runs since then are
    read and made anew, also those that became empty; no other month is read.
    """
    version, months = changed_since(spark, base, Versions(spark, path).read().get("base", 0))
    if not months:
        return None
    return publish(build(read_table(spark, base, version, months)), path, months, partition_cols, notes={"base": version})


def register_table(spark: SparkSession, name: str, path: str, columns: Sequence[str] = ()) -> tuple[int, ...]:
    """Make or update a catalog table over a published one, with statistics; returns the months it took up.

    Months that changed since the last call get their partitions anew, and these their row counts and sizes. ``columns`` get
    bounds, missing and distinct counts, which read those columns of the whole table.
    """
    versions = Versions(spark, path)
    facts = versions.read()
    schema = T.StructType.fromJson(json.loads(facts["schema"]))
    cols = facts["partition_cols"]
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(cols)}) LOCATION '{versions.root}'")
    seen = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"] == SEEN]
    version, months = changed_since(spark, path, int(seen[0]) if seen else 0)
    facts = versions.read(version)
    text = {f.name for f in schema if isinstance(f.dataType, T.StringType)}

    def spec(values: Iterable[tuple[str, str]]) -> str:
        return ", ".join(f"`{c}` = '{v}'" if c in text else f"`{c}` = {v}" for c, v in values)

    for month in months:
        held = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec([(MONTH, str(month))])})").collect()
        if held:
            old = ", ".join(f"PARTITION ({spec(p.split('=', 1) for p in r[0].split('/'))})" for r in held)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {old}")
        runs = facts["months"].get(str(month), {"runs": []})["runs"]
        if len(runs) > 1:
            raise ValueError(f"month {month} is made of {len(runs)} runs; a partition has one folder, so publish it whole")
        added = []
        for run in runs:
            at = (f"{PART}={ROWS}", f"{RUN}={run}", f"{MONTH}={month}")
            for below in _leaves(versions, at, len(cols) - 1):
                values = [tuple(p.split("=", 1)) for p in (f"{MONTH}={month}", *below)]
                added.append(f"PARTITION ({spec(values)}) LOCATION '{'/'.join((versions.root, *at, *below))}'")
        if added:
            spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
            gather_statistics(spark, name, {MONTH: month})
    if columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SEEN}' = '{version}')")
    return months


def _leaves(versions: Versions, at: tuple[str, ...], depth: int) -> list[tuple[str, ...]]:
    """Partition folders below a month, one or more levels down."""
    if not depth:
        return [()]
    return [(n, *below) for n in versions.folders(*at) if "=" in n for below in _leaves(versions, (*at, n), depth - 1)]


def partition_rows(spark: SparkSession, name: str) -> DataFrame:
    """(partition, row_count) of every partition of a catalog table, by its statistics; no data are read."""
    made = []
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = [p.split("=", 1) for p in r[0].split("/")]
        spec = ", ".join(f"`{c}` = '{v}'" for c, v in values)
        told = {x[0]: x[1] for x in spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({spec})").collect()}
        rows = re.search(r"(\d+) rows", told.get("Partition Statistics", ""))
        made.append((r[0], int(rows[1]) if rows else None))
    return spark.createDataFrame(made, "`partition` string, row_count bigint")


def column_bounds(spark: SparkSession, name: str, columns: Iterable[str]) -> DataFrame:
    """(column, least, greatest, missing) of analysed columns, by the catalog's statistics."""
    made = []
    for c in columns:
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name} {c}").collect()}
        made.append((c, told.get("min"), told.get("max"), int(told["num_nulls"]) if str(told.get("num_nulls")).isdigit() else None))
    return spark.createDataFrame(made, "`column` string, least string, greatest string, missing bigint")
