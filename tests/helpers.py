"""Small frames for tests."""

from pyspark.sql import types as T

from orderloom.sources.schemas import SOURCES


def source(spark, name, rows):
    """Rows of a source table given as dicts; columns left out are missing values."""
    schema = SOURCES[name]
    known = set(schema.names)
    for r in rows:
        assert set(r) <= known, set(r) - known
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def records(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def one(spark, expr, **values):
    """Value of an expression over one row of literals."""
    fields = [T.StructField(k, kind, True) for k, (_, kind) in values.items()]
    df = spark.createDataFrame([tuple(v for v, _ in values.values())], T.StructType(fields))
    return df.select(expr.alias("x")).first()["x"]
