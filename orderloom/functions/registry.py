"""The mart's own SQL functions, for queries written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    # month counter (year * 12 + month) -> yyyymm
    "ymm2ym": ("ymm INT", "INT", "CAST(floor((ymm - 1) / 12) * 100 + (ymm - 1) % 12 + 1 AS INT)"),
    # yyyymm -> month counter
    "ym2ymm": ("ym INT", "INT", "CAST(floor(ym / 100) * 12 + ym % 100 AS INT)"),
    # whole number that stands for a text
    "str2int": ("name STRING", "BIGINT", "CAST(conv(substring(md5(name), 1, 15), 16, 10) AS BIGINT)"),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL; Spark inlines them into the plan."""
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
