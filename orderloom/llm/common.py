"""Reading the text tables, storing stages in the shared folder, and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import drop_stored as drop_stored, release as release, stored as stored

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names; other columns never clash with its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]], schema: str) -> DataFrame:
    """Apply a function of one Arrow batch; ``make`` runs once a task, so it may load tables."""
    arrow = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        work = make()
        for batch in batches:
            columns = work(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow's form of a Spark schema; taken on the driver, as it needs the session."""
    return to_arrow_schema(StructType.fromDDL(ddl))
