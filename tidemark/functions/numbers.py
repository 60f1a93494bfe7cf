"""Numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"


def to_double(x: Column) -> Column:
    """A number, or null; only digits, a point, a sign and an exponent count."""
    x = F.trim(x)
    return F.when(x.rlike(NUMBER), x.try_cast("double"))


def plain_number(x: Column) -> Column:
    """A number with thousands commas."""
    return to_double(F.replace(x, F.lit(","), F.lit("")))


def money_number(x: Column) -> Column:
    """A number as statements show it: commas, dollar signs, brackets for losses; dashes are null."""
    return to_double(F.translate(F.replace(F.trim(x), F.lit("("), F.lit("-")), ",$)", ""))


def whole_number(x: Column) -> Column:
    x = F.trim(F.replace(x, F.lit(","), F.lit("")))
    return F.when(x.rlike(r"^[+-]?\d+$"), x.try_cast("bigint"))


def flag(x: Column) -> Column:
    return F.coalesce(F.trim(x).isin("1", "true", "True", "yes"), F.lit(False))


def amount(number: Column, unit: Column) -> Column:
    """A number in thousands, millions or billions."""
    unit = F.upper(F.coalesce(unit, F.lit("")))
    factor = F.when(unit.isin("MILLION", "M"), 1e6).when(unit.isin("BILLION", "B"), 1e9).when(unit.isin("THOUSAND", "K"), 1e3).otherwise(1.0)
    return plain_number(number) * factor


def scaled_fact(value: Column, scale: Column, sign: Column) -> Column:
    """An inline fact's value after scale (power of ten) and sign; whole numbers without decimals."""
    number = money_number(value)
    power = F.when(scale.rlike(r"^[+-]?\d+$"), scale.try_cast("int"))
    number = number * F.coalesce(F.pow(F.lit(10.0), power), F.lit(1.0))
    number = F.when(sign == "-", -F.abs(number)).otherwise(number)
    whole = F.when(F.abs(number) < 9e18, number.try_cast("bigint").cast("string"))
    text = F.when((number == F.floor(number)) & whole.isNotNull(), whole).otherwise(number.cast("string"))
    plain = (F.coalesce(scale, F.lit("")) == "") & (F.coalesce(sign, F.lit("")) == "")
    return F.when(plain | number.isNull(), value).otherwise(text)


def backoff(attempts: Column, base: float = 2.0, cap: int = 3600) -> Column:
    """Seconds until the next try, after `attempts` failures before this one."""
    return F.least(F.lit(float(cap)), F.lit(base) * F.pow(F.lit(2.0), attempts + 1))


def name_threshold(name: Column) -> Column:
    """How similar names must be, by their number of words."""
    words = F.size(F.filter(F.split(name, " "), lambda w: w != ""))
    return F.when(words <= 1, 0.95).when(words == 2, 0.92).otherwise(0.88)
