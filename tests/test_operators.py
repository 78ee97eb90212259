import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderloom.operators import groups, joins, ranks, shape
from orderloom.sources.schemas import MART

from .helpers import frame, records


def test_attach_treats_missing_keys_as_equal_and_match_does_not(spark):
    left = frame(spark, "k string, v int", [("a", 1), (None, 2)])
    right = frame(spark, "k string, w int", [("a", 10), (None, 20)])
    assert records(joins.attach(left, right, ["k"])) == [("a", 1, 10), (None, 2, 20)]
    assert records(joins.match(left, right, ["k"])) == [("a", 1, 10), (None, 2, None)]


def test_match_refuses_ambiguous_columns(spark):
    left = frame(spark, "k string, v int", [("a", 1)])
    with pytest.raises(ValueError):
        joins.match(left, left, ["k"])


def test_lookup_default_and_roles(spark):
    facts = frame(spark, "a int, b int", [(1, 2), (2, 9)])
    dim = frame(spark, "id int, name string", [(1, "one"), (2, "two")])
    assert records(joins.lookup(facts, dim, {"b": "id"}, {"name": "-"})) == [(1, 2, "two"), (2, 9, "-")]
    roles = joins.role_join(facts, dim, "id", {"a": {"name": "a_name"}, "b": {"name": "b_name"}})
    assert records(roles) == [(1, 2, "one", "two"), (2, 9, "two", None)]


def test_value_from_row_falls_back(spark):
    rows = frame(spark, "g string, ok boolean, v string", [("a", True, "x"), ("a", False, "y"), ("b", False, "z"), (None, True, "n")])
    got = groups.value_from_row(rows, ["g"], F.col("ok"), "v", "out", fallback="v")
    assert records(got, "g", "v", "out") == [("a", "x", "x"), ("a", "y", "x"), ("b", "z", "z"), (None, "n", "n")]


def test_first_of_group_keeps_ties(spark):
    rows = frame(spark, "g int, ln int, q int", [(1, 1, 4), (1, 2, 4), (2, 1, 5), (2, 1, 6)])
    assert records(groups.first_of_group(rows, ["g"], "ln", "q", "kept")) == [
        (1, 1, 4, 4), (1, 2, 4, 0), (2, 1, 5, 5), (2, 1, 6, 6)]


def test_prorate_adds_up_within_half_a_cent_per_line(spark):
    rng = random.Random(1)
    lines = [(o, rng.randint(1, 10**6), 0) for o in range(20) for _ in range(rng.randint(1, 9))]
    df = frame(spark, "o int, cents int, x int", lines).selectExpr(
        "o", "CAST(cents / 100 AS DECIMAL(18,2)) AS w", "CAST(1000 + o AS DECIMAL(18,2)) AS total")
    sums = groups.prorate(df, ["o"], "w", "total", "share").groupBy("o").agg(
        F.sum("share").alias("s"), F.first("total").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert len(sums) == 20
    assert all(abs(r["s"] - r["t"]) <= r["n"] * 0.005 for r in sums)


def test_earliest_keeps_ties_and_puts_missing_last(spark):
    rows = frame(spark, "k string, d int", [("a", 1), ("a", 1), ("a", 2), ("b", None), (None, 3), ("c", None), ("c", 7)])
    assert records(groups.earliest_per_key(rows, ["k"], "d")) == [("a", 1), ("a", 1), ("b", None), ("c", 7), (None, 3)]


def test_keep_last_takes_the_greater_on_a_tie_and_missing_as_last(spark):
    rows = frame(spark, "k string, d int, v string", [("a", 1, "z"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 9, "o")])
    assert records(groups.keep_last(rows, ["k"], "d", "v")) == [("a", "y"), ("b", "n")]


def test_hypothetical_rank_and_missing_values(spark):
    rows = frame(spark, "k string, d int", [("a", 5), ("a", 5), ("a", 3), ("a", None), ("b", 1)])
    assert records(groups.hypothetical_dense_rank(rows, ["k"], "d", 4, "r")) == [("a", 3), ("b", 1)]
    assert records(groups.hypothetical_dense_rank(rows, ["k"], "d", 4, "r", descending=False)) == [("a", 2), ("b", 2)]


def test_in_force_is_the_latest_start_up_to_the_point(spark):
    dim = frame(spark, "k int, start int, sys string", [(1, 202101, "old"), (1, 202104, "a"), (1, 202104, "b"), (1, 202105, "next"), (2, None, "never")])
    assert records(joins.in_force(dim, ["k"], "start", "sys", 202104)) == [(1, 202104, "b")]
    assert records(joins.in_force(dim, ["k"], "start", "sys", [202101, 202105])) == [(1, 202101, "old"), (1, 202105, "next")]
    facts = frame(spark, "id int, k int, ym int", [(1, 1, 202012), (2, 1, 202104), (3, 1, 209912), (4, 3, 202104), (5, 2, 202104)])
    assert records(joins.as_of(facts, dim, ["k"], "ym", "start", "sys", "in_force"), "id", "in_force") == [
        (1, None), (2, "b"), (3, "next"), (4, None), (5, None)]


def test_listagg_orders_by_another_column(spark):
    rows = frame(spark, "g int, v int, o int", [(1, 10, 2), (1, 9, 1), (1, 11, 1)])
    assert records(groups.listagg_by(rows, ["g"], "v", order="o", out="t")) == [(1, "9, 11, 10")]
    assert records(groups.listagg_by(rows, ["g"], "v", descending=True, out="t")) == [(1, "11, 10, 9")]


def test_not_in_is_null_aware(spark):
    rows = frame(spark, "m int", [(1,), (2,), (None,)])
    assert records(joins.not_in(rows, "m", frame(spark, "m int", [(1,)]))) == [(2,)]
    assert records(joins.not_in(rows, "m", frame(spark, "m int", [(1,), (None,)]))) == []
    assert len(records(joins.not_in(rows, "m", frame(spark, "m int", [])))) == 3


def test_insert_missing(spark):
    state = frame(spark, "src string, m int, f int", [("A", 1, 3)])
    new = frame(spark, "src string, m int, f int", [("A", 1, 0), ("A", 2, 0)])
    assert records(joins.insert_missing(state, new, ["src", "m"])) == [("A", 1, 3), ("A", 2, 0)]


@pytest.mark.parametrize("block", [1, 3, 65536])
def test_rank_in_group_equals_the_window_rank(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-6, 6)]), rng.choice([None, *range(7)])) for _ in range(400)]
    df = frame(spark, "k string, x int, y int", rows)
    order = W.partitionBy("k").orderBy(F.asc_nulls_last("x"), F.asc_nulls_last("y"))
    assert records(ranks.rank_in_group(df, ["k"], ["x", "y"], "r", block=block)) == records(df.withColumn("r", F.rank().over(order)))
    single = W.partitionBy("k").orderBy(F.asc_nulls_last("x"))
    assert records(ranks.rank_in_group(df, ["k"], ["x"], "r", block=block)) == records(df.withColumn("r", F.rank().over(single)))


def test_rank_counts_rows_by_weight(spark):
    df = frame(spark, "k int, x int, n int", [(1, 1, 2), (1, 2, 1), (1, 3, 1)])
    assert records(ranks.rank_in_group(df, ["k"], ["x"], "r", weight="n"), "x", "r") == [(1, 1), (2, 3), (3, 4)]


def test_rank_distinct_puts_missing_first_when_descending(spark):
    df = frame(spark, "m int", [(202101,), (202103,), (202103,), (None,)])
    assert records(ranks.rank_distinct(df, "m", "r")) == [(202101, 3), (202103, 2), (202103, 2), (None, 1)]


def test_conform_orders_casts_and_fills(spark):
    got = shape.conform(frame(spark, "ord_id string, ord_qty double", [("7", 1.5)]), MART)
    assert got.schema.names == MART.names and [f.dataType for f in got.schema] == [f.dataType for f in MART]
    row = got.first()
    assert row["ord_id"] == 7 and float(row["ord_qty"]) == 1.5 and row["inv_cd"] is None
    with pytest.raises(ValueError):
        shape.conform(frame(spark, "other int", [(1,)]), MART)


def test_split_rejects_names_the_reason(spark):
    df = frame(spark, "id int, a string, b string", [(1, "5", "2021-01-01"), (2, "x", "2021-01-01"), (3, "x", "y"), (4, None, None)])
    good, bad = shape.split_rejects(df, {"a": "int", "b": "date"})
    assert records(good, "id", "a") == [(1, 5), (4, None)]
    assert records(bad, "id", "reject_reason") == [(2, "a is not int"), (3, "a is not int; b is not date")]
