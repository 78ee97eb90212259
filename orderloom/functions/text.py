"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
NUMBER = "decimal(38,6)"  # amounts and quantities whose scale the tables do not declare


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text; blank text is missing."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First argument that is not blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def join_text(*cols: Column | str) -> Column:
    """Concatenation in which a missing part counts as empty and all-missing is missing."""
    return F.nullif(F.concat_ws("", *[col(c) for c in cols]), F.lit(""))


def cut(c: Column | str, n: int) -> Column:
    """First n characters (a cast to a sized text type does not cut in Spark)."""
    return F.substring(col(c), 1, n)


def cut_bytes(c: Column | str, n: int) -> Column:
    """The whole characters that lie within the first n bytes of the text in UTF-8."""
    octets = col(c).cast("binary")
    # A character that the border cuts begins at most three bytes before it; the byte after a whole one continues nothing.
    ends = F.when(F.octet_length(octets) <= n, n)
    for end in (n, n - 1, n - 2, n - 3):
        ends = ends.when(~F.hex(F.substring(octets, end + 1, 1)).between("80", "BF"), end)
    return F.when(F.octet_length(octets) <= n, col(c)).otherwise(F.decode(F.substr(octets, F.lit(1), ends), "UTF-8"))


def to_long(c: Column | str) -> Column:
    """Text to whole number, rounding a fraction; blank is missing, other text an error."""
    return blank_to_null(c).cast("decimal(38,0)").cast("bigint")


def try_to_long(c: Column | str) -> Column:
    """As to_long, but text that is no number is missing. For join keys."""
    return blank_to_null(c).try_cast("decimal(38,0)").try_cast("bigint")


def to_money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def digits_to_long(c: Column | str) -> Column:
    """Number made of the digits of a text."""
    return to_long(F.regexp_replace(col(c), "[^0-9]", ""))


def drop_prefix(c: Column | str, prefix: str) -> Column:
    """Text without the prefix, if it has it."""
    c = col(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def pad_number(c: Column | str, width: int) -> Column:
    """Number as text of a fixed width, zeros on the left."""
    return F.lpad(col(c).cast("string"), width, "0")


def pad_name(c: Column | str, width: int, fill: str = "X") -> Column:
    """Trimmed name padded on the right; a blank name stays missing."""
    return F.rpad(blank_to_null(c), width, fill)


def text_number(c: Column | str) -> Column:
    """Whole number that stands for a text: its leading 60 digest bits."""
    return F.conv(F.substring(F.md5(col(c)), 1, 15), 16, 10).cast("bigint")


def base_item_code(c: Column | str, test_from: int = 5, width: int | None = None) -> Column:
    """Item code without its market suffix.

    A capital letter at or after position ``test_from`` marks a suffix; the code then ends
    before its first capital at position 4 or later. Daily loads test from 5 (the first
    three also cut the code to 15 characters), the history load tests from 4.
    """
    code = F.trim(col(c))
    if width is not None:
        code = blank_to_null(cut(code, width))
    else:
        code = F.nullif(code, F.lit(""))
    suffixed = F.substr(code, F.lit(test_from)).rlike("[A-Z]")
    return F.when(suffixed, F.regexp_extract(code, "^(.{3}[^A-Z]*)", 1)).otherwise(code)


def sql_list(values) -> str:
    """Values as a SQL list."""
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def recode(c: Column | str, mapping: dict, default: Column | None = None) -> Column:
    """Value mapping as one CASE; missing without a default."""
    c = col(c)
    arms = None
    for key, value in mapping.items():
        arms = F.when(c == key, F.lit(value)) if arms is None else arms.when(c == key, F.lit(value))
    return arms if default is None else arms.otherwise(default)


def flag(cond: Column) -> Column:
    """'true' where the condition holds, else 'false' (also when it is unknown)."""
    return F.when(cond, F.lit("true")).otherwise(F.lit("false"))


def greatest_or_null(*cols: Column | str) -> Column:
    """Greatest of the arguments; missing as soon as one of them is."""
    cols = [col(c) for c in cols]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.greatest(*cols))


def ratio(a: Column | str, b: Column | str, default=None) -> Column:
    """a / b, missing (or the default) where b is zero."""
    value = F.try_divide(col(a), F.nullif(col(b), F.lit(0)))
    return value if default is None else F.coalesce(value, F.lit(default))


def share_of(amount: Column, part: Column, whole: Column) -> Column:
    """amount * part / whole, rounded half away from zero to the cent.

    Worked in whole millionths, so nothing but the result is rounded. amount * part may have 25 digits before the point.
    """
    units = [(c.cast(NUMBER) * 1_000_000).cast("decimal(38,0)") for c in (amount, part, whole)]
    product = units[0] * units[1]
    bottom = F.abs(units[2]) * 10_000  # of a cent
    sign = F.signum(product.cast("double")) * F.signum(units[2].cast("double"))
    over = F.abs(product) % bottom
    whole_cents = F.when(units[2] != 0, F.call_function("div", F.abs(product), bottom) + (over >= bottom - over).cast("int"))
    return (whole_cents * sign.cast("int") / 100).cast(MONEY)
