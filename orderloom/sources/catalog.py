"""Named source tables: files, catalog tables, databases over JDBC, or frames at hand."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import in_months
from .schemas import SOURCES


class Sources(Mapping):
    """Source frames by name, each read with only the columns the plans use.

    A table is given as a frame, or as reader settings: ``{"table": name}``, or
    ``{"format": "parquet" | "orc" | "csv" | "jdbc" | ..., "path": ..., **options}``.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Mapping[str, str]]):
        self.spark = spark
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self._typed(name, self._load(self._tables[name]))

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def raw(self, name: str) -> DataFrame:
        """All columns of a table, as stored."""
        return self._load(self._tables[name])

    def _load(self, given) -> DataFrame:
        if isinstance(given, DataFrame):
            return given
        settings = dict(given)
        if "table" in settings:
            return self.spark.table(settings["table"])
        reader = self.spark.read.format(settings.pop("format", "parquet"))
        path = settings.pop("path", None)
        reader = reader.options(**settings)
        return reader.load(path) if path is not None else reader.load()

    @staticmethod
    def _typed(name: str, df: DataFrame) -> DataFrame:
        """Declared columns in declared types; a column that fits already is left bare for pushdown."""
        schema = SOURCES.get(name)
        if schema is None:
            return df
        have = {c.lower(): c for c in df.columns}
        lost = [f.name for f in schema if f.name not in have]
        if lost:
            raise ValueError(f"{name} lacks {lost}")
        types = {f.name.lower(): f.dataType for f in df.schema}
        return df.select(*[
            (F.col(have[f.name]) if types[f.name] == f.dataType else F.col(have[f.name]).cast(f.dataType)).alias(f.name)
            for f in schema
        ])


def read_month(df: DataFrame, months, date_col: str) -> DataFrame:
    """Rows of the given months (None: all), as a range on the timestamp column."""
    return df if months is None else df.filter(in_months(date_col, months))
