"""Column helpers with the null, rounding and date rules the contract jobs rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(28,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def clean_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def same_or_both_null(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def decode(c: Column, *pairs_and_default) -> Column:
    """Value lookup in which a null key matches a null input."""
    args = list(pairs_and_default)
    default = args.pop() if len(args) % 2 else F.lit(None)
    out = default if isinstance(default, Column) else F.lit(default)
    for key, value in reversed(list(zip(args[::2], args[1::2]))):
        hit = c.eqNullSafe(F.lit(key))
        out = F.when(hit, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def _any_null(cols: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a | b, (c.isNull() for c in cols))


def greatest_strict(*cols: Column) -> Column:
    """Greatest value, null as soon as one argument is null."""
    return F.when(~_any_null(cols), F.greatest(*cols))


def least_strict(*cols: Column) -> Column:
    return F.when(~_any_null(cols), F.least(*cols))


def non_zero(c: Column) -> Column:
    """Divisor guard: zero counts as one."""
    return F.when(c == 0, F.lit(1).cast("decimal(28,2)")).otherwise(c)


def ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / non_zero(den).cast("double")


def round_by_currency(
    df: DataFrame, amount: str, currency: str, precision: DataFrame, out: str, default_digits: int = 2
) -> DataFrame:
    """Round to the digits of the row's currency (``precision``: currency, digits).

    The precision table has one row per currency, so it is broadcast; ``round`` needs a
    literal scale, hence one branch per scale from 0 to 4, the scale of the result; currencies
    with more digits are rounded there.
    """
    dim = F.broadcast(precision.select(F.col("currency").alias(currency), "digits"))
    digits = F.coalesce(F.col("digits"), F.lit(default_digits))
    picked = reduce(
        lambda acc, n: acc.when(digits == n, F.round(F.col(amount), n).cast("decimal(28,4)")),
        range(1, 5),
        F.when(digits == 0, F.round(F.col(amount), 0).cast("decimal(28,4)")),
    ).otherwise(F.round(F.col(amount), 4).cast("decimal(28,4)"))
    return df.join(dim, currency, "left").withColumn(out, picked).drop("digits")


def period_of(day: Column) -> Column:
    """Period id yyyymm of a date."""
    return F.year(day) * 100 + F.month(day)


def period_start(prd: Column) -> Column:
    return F.make_date((prd / 100).cast("int"), prd % 100, F.lit(1))


def month_label(prd: Column) -> Column:
    return F.upper(F.date_format(period_start(prd), "MMM"))


def inclusive_days(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1


def shift_period(prd: int, months: int) -> int:
    """Plain-number period arithmetic for building column lists."""
    n = (prd // 100) * 12 + prd % 100 - 1 + months
    return (n // 12) * 100 + n % 12 + 1


def period_list(first: int, last: int) -> list[int]:
    out = []
    while first <= last:
        out.append(first)
        first = shift_period(first, 1)
    return out


def replace_segment(text: Column, keep: int, value: Column, sep: str = ":") -> Column:
    """First ``keep`` non-empty segments followed by ``value``."""
    parts = F.filter(F.split(text, sep), lambda s: F.length(s) > 0)
    kept = [F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i in range(keep)]
    return F.concat_ws(sep, *kept, value)


def to_identifier(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "_")


def number_or(text: Column, sentinel: int = -1) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(sentinel).cast("bigint"))


def account_class(number: Column) -> Column:
    # fixed values: account number ranges and their activity types
    return (
        F.when(number.between(1000, 1999), "Unbilled")
        .when(number.between(2000, 2999), "Contract Liability")
        .when(number.between(3000, 9999), "Revenue")
    )


def flag_at(indicators: Column, position: int, length: int = 1) -> Column:
    return F.substring(indicators, position, length)


def with_flag(indicators: Column, position: int, value: Column | str) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.overlay(indicators, value, F.lit(position))


def label_of(column_name: Column) -> Column:
    return F.initcap(F.replace(F.lower(column_name), F.lit("_"), F.lit(" ")))


def effective_on(as_of: Column, start: Column, end: Column) -> Column:
    """Whether ``as_of`` lies in [start, end]; a null bound is open."""
    return as_of.between(F.coalesce(start, as_of), F.coalesce(end, as_of))


def convert(amount: Column, f_rate: Column, g_rate: Column, kind: str, reporting_via_functional: bool = True) -> Column:
    """Transaction amount in currency ``kind`` (T, F or R).

    Waterfall reports take the reporting amount through the functional rate
    (amount x g x f); the billing view applies the reporting rate alone.
    """
    if kind == "T":
        return amount
    if kind == "F":
        return amount * f_rate
    if kind == "R":
        return amount * g_rate * f_rate if reporting_via_functional else amount * g_rate
    raise ValueError(f"unknown currency kind {kind!r}")
