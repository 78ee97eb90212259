import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import fixed
from orderloom.functions import dates, text

from .helpers import frame, one

S, L, I, N = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()
D = T.DecimalType(38, 6)


def column(spark, kind, values, expr):
    df = frame(spark, T.StructType([T.StructField("i", I), T.StructField("c", kind)]), list(enumerate(values)))
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_blank_text_is_missing(spark):
    assert column(spark, S, ["  ", "", " a ", None], text.blank_to_null("c")) == [None, None, "a", None]


def test_first_filled_prefers_the_first_that_is_not_blank(spark):
    assert one(spark, text.first_filled("a", "b"), a=("   ", S), b=("040", S)) == "040"


def test_missing_text_counts_as_empty_when_joined(spark):
    assert one(spark, text.join_text("a", "b"), a=(None, S), b=("x", S)) == "x"
    assert one(spark, text.join_text("a", "b"), a=(None, S), b=(None, S)) is None


def test_text_to_number_rounds(spark):
    assert column(spark, S, ["1.7", " 42 ", " ", "040", "-2.5"], text.to_long("c")) == [2, 42, None, 40, -3]


def test_dirty_text_is_missing_only_in_the_tolerant_form(spark):
    assert column(spark, S, ["x", "1.0"], text.try_to_long("c")) == [None, 1]
    with pytest.raises(Exception):
        column(spark, S, ["x"], text.to_long("c"))


def test_digits(spark):
    assert column(spark, S, ["R-12", "none", None], text.digits_to_long("c")) == [12, None, None]


def test_account_prefix(spark):
    expr = text.to_long(text.drop_prefix("c", fixed.SRC2_ACCOUNT_PREFIX))
    assert column(spark, S, ["57012345", "12345", "570"], expr) == [12345, 12345, None]


def test_padding(spark):
    assert column(spark, S, [" ann ", " ", "longer name"], text.pad_name("c", 7)) == ["annXXXX", None, "longer "]
    assert column(spark, I, [93005, 5], text.pad_number("c", 6)) == ["093005", "000005"]


def test_base_item_code_daily_and_history(spark):
    codes = ["1234EN", "123A", "123AB", "12345", "A123B5", "123A5B", "1234a5B", " 1234EN ", None, "12"]
    assert column(spark, S, codes, text.base_item_code("c", width=15)) == [
        "1234", "123A", "123", "12345", "A123", "123", "1234a5", "1234", None, "12"]
    assert column(spark, S, codes, text.base_item_code("c", test_from=4)) == [
        "1234", "123", "123", "12345", "A123", "123", "1234a5", "1234", None, "12"]


def test_base_item_code_is_cut_to_its_width_first(spark):
    long_code = "1234567890123456EN"
    assert column(spark, S, [long_code], text.base_item_code("c", width=15)) == ["123456789012345"]
    assert column(spark, S, [long_code], text.base_item_code("c")) == ["1234567890123456"]


def test_greatest_needs_every_argument(spark):
    assert one(spark, text.greatest_or_null("a", "b"), a=(1, I), b=(2, I)) == 2
    assert one(spark, text.greatest_or_null("a", "b"), a=(1, I), b=(None, I)) is None


def test_ratio_of_zero(spark):
    assert one(spark, text.ratio("a", "b"), a=(1.0, T.DoubleType()), b=(0.0, T.DoubleType())) is None
    assert one(spark, text.ratio("a", "b", 0.0), a=(1.0, T.DoubleType()), b=(0.0, T.DoubleType())) == 0.0


@pytest.mark.parametrize("amount, part, whole, share", [
    ("30", "90", "100", "27.00"), ("70", "90", "100", "63.00"), ("1", "1", "3", "0.33"), ("1", "2", "3", "0.67"),
    ("0.01", "1", "2", "0.01"), ("-0.01", "1", "2", "-0.01"), ("5", "1", "0", None), ("5", None, "1", None),
    ("9999999999999.99", "9999999999999.98", "9999999999999.99", "9999999999999.98"),
    ("0.004", "0.5", "0.4", "0.01"), ("12.345", "1", "1", "12.35"), ("0.0049", "1", "1", "0.00"), ("-12.345", "-1", "-1", "-12.35"),
])
def test_share_is_rounded_half_away_from_zero(spark, amount, part, whole, share):
    d = {k: (None if v is None else Decimal(v), D) for k, v in dict(a=amount, p=part, w=whole).items()}
    got = one(spark, text.share_of(F.col("a"), F.col("p"), F.col("w")), **d)
    assert got == (None if share is None else Decimal(share))


def test_text_number_is_stable(spark):
    a, b = column(spark, S, ["annXXXX", "annXXXX"], text.text_number("c"))
    assert a == b and 0 <= a < 2**60


def test_line_clock(spark):
    assert one(spark, dates.clock_from_key("d", "t"), d=(20210405, I), t=(93005, I)) == dt.datetime(2021, 4, 5, 9, 30, 5)
    assert column(spark, I, [20210405, 0, 20210231, None], dates.day_from_key("c")) == [dt.datetime(2021, 4, 5), None, None, None]


def test_keys(spark):
    moment = dt.datetime(2021, 1, 31, 23, 30)
    assert column(spark, N, [moment], dates.month_key("c")) == [202101]
    assert column(spark, N, [moment], dates.day_key("c")) == [20210131]
    assert column(spark, I, [20210431], dates.month_of_day_key("c")) == [202104]


def test_month_counter(spark):
    counters = [24093, 24242, 24252]
    months = [200709, 202002, 202012]
    assert column(spark, I, counters, dates.ymm2ym("c")) == months
    assert column(spark, I, months, dates.ym2ymm("c")) == counters
    assert [dates.month_from_counter(n) for n in counters] == months


def test_history_covers_150_months():
    from orderloom.plans.history import history_months

    assert len(history_months()) == 150 and history_months()[0] == 200709 and history_months()[-1] == 202002


@pytest.mark.parametrize("detroit, johannesburg", [
    ("2021-01-31 23:30", "2021-02-01 06:30"),
    ("2021-07-31 23:30", "2021-08-01 05:30"),
    ("2021-11-07 01:30", "2021-11-07 08:30"),  # shown twice: read as standard time
    ("2021-11-07 00:30", "2021-11-07 06:30"),
    ("2021-11-07 02:30", "2021-11-07 09:30"),
    ("2021-03-14 02:30", "2021-03-14 09:30"),  # skipped
])
def test_zone_shift(spark, detroit, johannesburg):
    parse = "%Y-%m-%d %H:%M"
    shifted = dates.shift_zone("c", fixed.SRC2_ZONE, fixed.MART_ZONE_SRC2)
    assert column(spark, N, [dt.datetime.strptime(detroit, parse)], shifted) == [dt.datetime.strptime(johannesburg, parse)]


def test_month_list_helpers():
    assert dates.month_range(202011, 202102) == (202011, 202012, 202101, 202102)
    assert dates.previous_month(202101) == 202012 and dates.next_month(202012) == 202101
    assert dates.as_months([202102, 202101, 202102]) == (202101, 202102)
    with pytest.raises(ValueError):
        dates.as_months([202113])


def test_month_filters_agree_with_the_month_key(spark):
    days = [dt.datetime(2020, 12, 31, 23, 59, 59), dt.datetime(2021, 1, 1), dt.datetime(2021, 2, 28), dt.datetime(2021, 3, 1), None]
    assert column(spark, N, days, dates.in_months("c", (202101, 202102))) == [False, True, True, False, None]
    assert column(spark, N, days[:4], dates.in_months("c", (202012, 202103))) == [True, False, False, True]
    assert column(spark, I, [20201231, 20210101, 20210231, 20210301], dates.key_in_months("c", 202101)) == [False, True, False, False]
    assert column(spark, N, days[:2], dates.in_months("c", None)) == [True, True]


def test_a_list_of_months_is_its_months_one_by_one(spark):
    keys = [20210100, 20210101, 20210131, 20210150, 20210200, 20210228, 20210301, 20211301, 20210001, 20210399, None]
    frame = spark.createDataFrame([(k,) for k in keys], "k int")

    def kept(months):
        return sorted(r[0] for r in frame.filter(dates.key_in_months("k", months)).collect())

    for months in ((202101,), (202101, 202102), (202101, 202103), (202101, 202102, 202103)):
        assert kept(months) == sorted(k for m in months for k in kept((m,)))
    assert kept((202101, 202102)) == [20210101, 20210131, 20210228]
    assert kept(None) == [20210101, 20210131, 20210228, 20210301]
    months = spark.createDataFrame([(k,) for k in (200811, 200812, 200813, 200901, 200903, None)], "k int")
    for listed in ((200812, 200901), (200812, 200901, 200903)):
        assert sorted(r[0] for r in months.filter(dates.month_in("k", listed)).collect()) == list(listed)
    assert months.filter(dates.month_in("k", None)).count() == 4


def test_no_timestamp_is_in_no_month(spark):
    frame = spark.createDataFrame([(dt.datetime(2021, 1, 1),), (None,)], "t timestamp_ntz")
    assert frame.filter(dates.in_months("t", None)).count() == frame.filter(dates.in_months("t", (202101,))).count() == 1
