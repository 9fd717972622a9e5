"""Guarded ratios, unit equations, dates and ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of URL ids, as bytes in hexadecimal.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
NUMBER = r"(-?[0-9]+\.?[0-9]*)"


def rounded(x: Column, digits: int) -> Column:
    """Halves away from 0, as the decimal number that ``x`` stands for: 79.975 is 79.98 whatever its nearest double."""
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded; null where whole is 0."""
    return rounded(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100, digits)


def share(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; 0 where whole isn't positive."""
    return F.when(whole > 0, rounded(part / whole * 100, digits)).otherwise(F.lit(0.0))


def idle_state(days: Column) -> Column:
    return F.when(days <= 1, "ACTIVO").when(days <= 3, "ALERTA").otherwise("INACTIVO")


def alert(present: Column, percent_range: Column, percent_present: Column, range_min: float = 85.0, present_min: float = 90.0) -> Column:
    return F.when(present <= 0, "NO REGISTRADA").when(percent_range < range_min, "FUERA DE RANGO").when(percent_present < present_min, "INCOMPLETA").otherwise("OK")


def severity(alert_: Column) -> Column:
    return F.when(alert_ == "NO REGISTRADA", 3).when(alert_ == "FUERA DE RANGO", 2).when(alert_ == "INCOMPLETA", 1).otherwise(0)


def unit_equation(x: Column) -> Column:
    """struct(factor, offset) of a linear unit equation in x; nulls where it isn't one or divides by 0. Numbers may be negative."""
    text = F.replace(F.lower(x), F.lit(" "))
    get = lambda pattern, i: F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))
    shift = r"(?:([+-])" + NUMBER + r")?$"
    forms = {"times": "^x\\*" + NUMBER + shift, "by": "^" + NUMBER + "\\*x" + shift, "over": "^x/" + NUMBER + shift, "plain": "^x" + shift}
    number = lambda c: c.cast("double")
    factor = F.when(text.rlike(forms["times"]), number(get(forms["times"], 1))).when(text.rlike(forms["by"]), number(get(forms["by"], 1)))
    factor = factor.when(text.rlike(forms["over"]), F.try_divide(F.lit(1.0), number(get(forms["over"], 1)))).when(text.rlike(forms["plain"]), F.lit(1.0))
    sign = F.coalesce(get(forms["times"], 2), get(forms["by"], 2), get(forms["over"], 2), get(forms["plain"], 1))
    size = F.coalesce(get(forms["times"], 3), get(forms["by"], 3), get(forms["over"], 3), get(forms["plain"], 2))
    offset = F.when(factor.isNotNull(), F.coalesce(number(size) * F.when(sign == "-", -1.0).otherwise(1.0), F.lit(0.0)))
    return F.struct(F.round(factor, 10).alias("factor"), F.round(offset, 10).alias("offset"))


def converted(value: Column, factor: Column, offset: Column) -> Column:
    """A value in its target unit; null where no conversion is known."""
    return value * factor + offset


def url_id(seed: Column) -> Column:
    """The name-based id (version 5) of a seed in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(F.trim(seed), "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def step_seconds(size: Column, unit: Column) -> Column:
    """A step in whole seconds; a blank or unknown unit means seconds; halves go to the even neighbour."""
    name = F.upper(F.trim(F.coalesce(unit, F.lit(""))))
    factor = F.when(name == "MS", 0.001).when(name == "MIN", 60.0).when(name == "H", 3600.0).otherwise(1.0)
    return F.bround(size * factor, 0).cast("long")
