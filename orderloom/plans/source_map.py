"""Which order system is in force for which country and affiliate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import listagg_by
from ..operators.joins import in_force, match


def sources_by_month(source_map: DataFrame, focus: int | Sequence[int]) -> DataFrame:
    """Per system in force at each focus month: its countries and its affiliates as lists.

    A country or affiliate belongs to the system of its latest launch up to the month.
    """
    def belongs(keys: list[str]) -> DataFrame:
        return in_force(source_map, keys, "launch_mo_yr_id", "new_system_nm", focus, "focus_ym").withColumnRenamed(
            "new_system_nm", "src"
        )

    # Both lists are as short as the list of countries.
    countries = listagg_by(
        belongs(["cntry_id", "aff_id"]), ["focus_ym", "src"], "cntry_id", order="aff_id", out="cntry_list"
    )
    affiliates = listagg_by(belongs(["aff_id"]), ["focus_ym", "src"], "aff_id", out="aff_list")
    return match(
        countries, affiliates.select(F.col("focus_ym").alias("a_ym"), F.col("src").alias("a_src"), "aff_list"),
        {"focus_ym": "a_ym", "src": "a_src"}, "left",
    )
