"""Dates of many spellings, reference dates and steps of time as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of dates in the order in which they are tried. Letters stand for day, month, short month name,
#: year of four and of two digits; T for a time of day behind it.
SPELLINGS = ("d/m/Y T", "Y-m-d T", "d/b/Y T", "d-b-Y T", "Y/m/d T", "m/d/Y T", "d/m/Y", "Y-m-d", "d/b/Y", "d-b-Y", "Y/m/d", "m/d/Y", "d/m/y T", "d-b-y T", "m/d/y T", "d/m/y", "d-b-y", "m/d/y")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Fixed value: years of two digits from this one on are of the last century.
PIVOT = 69
_PARTS = {"d": r"(\d{1,2})", "m": r"(\d{1,2})", "b": "(?i)(" + "|".join(MONTHS) + ")", "Y": r"(\d{4})", "y": r"(\d{2})"}


def spelled(x: Column, spelling: str) -> Column:
    """The time that a text of one spelling means; null if it isn't of it, or no such day or time exists."""
    day, _, time = spelling.partition(" ")
    letters = [c for c in day if c in _PARTS]
    pattern = "^" + "".join(_PARTS.get(c, c) for c in day) + (r"\s+(\d{1,2}):(\d{1,2}):(\d{1,2})" if time else "") + "$"
    part = lambda i: F.nullif(F.regexp_extract(x, pattern, i), F.lit("")).cast("int")
    found = {c: part(i) for i, c in enumerate(letters, 1)}
    if "b" in found:
        name = F.lower(F.regexp_extract(x, pattern, letters.index("b") + 1))
        found["m"] = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), name), F.lit(0)).cast("int")
    if "y" in found:
        found["Y"] = found["y"] + F.when(found["y"] >= PIVOT, 1900).otherwise(2000)
    clock = [part(len(letters) + i) for i in (1, 2, 3)] if time else [F.lit(0)] * 3
    seconds = F.when(clock[2] < 60, clock[2])  # Spark would take 60 for the next minute
    return F.when(found["Y"] > 0, F.try_make_timestamp(found["Y"], found["m"], found["d"], clock[0], clock[1], seconds))


def parsed(x: Column, spellings: tuple[str, ...] = SPELLINGS) -> Column:
    """The first spelling that fits what stands before ' : '; null where none does."""
    plain = F.trim(F.split_part(x, F.lit(" : "), F.lit(1)))
    return F.coalesce(*(spelled(plain, s) for s in spellings))


def spud_date(x: Column) -> Column:
    """An ISO date of a day, short month and year of two digits; null of anything else."""
    return F.date_format(spelled(x, "d-b-y"), "yyyy-MM-dd")


def date_in_name(name: Column, last_year: Column) -> Column:
    """The date in a file's name: dd-mm-yyyy, or yyyymmdd by itself from 1900 to ``last_year``; an invalid first match gives null."""
    long_, short = r"(\d{2})[-_](\d{2})[-_](\d{4})", r"(?:^|\D)(\d{4})(\d{2})(\d{2})(?!\d)"
    number = lambda pattern, i: F.nullif(F.regexp_extract(name, pattern, i), F.lit("")).cast("int")
    made = lambda y, m, d: F.when(y > 0, F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0))).cast("date")
    year = number(short, 1)
    return F.when(name.rlike(long_), made(number(long_, 3), number(long_, 2), number(long_, 1))).when(year.between(F.lit(1900), last_year), made(year, number(short, 2), number(short, 3)))


def reference_date(start: Column, name: Column, header: Column, as_of: Column) -> Column:
    """The date of a log: of its first value, else in its name, else of its header, else ``as_of``."""
    return F.coalesce(parsed(start).cast("date"), date_in_name(name, F.year(as_of) + 5), parsed(header).cast("date"), as_of)


def sample_time(day: Column, clock: Column, base: Column, index: Column, step: int = 5) -> Column:
    """A sample's time of its day (28/Jul/2025) and clock (00:00:05); where either can't be read, so many steps of seconds after ``base``."""
    return F.coalesce(spelled(F.concat_ws(" ", day, clock), "d/b/Y T"), F.timestamp_seconds(F.unix_timestamp(base) + index * step))


def download_suffix(first: Column, yesterday: Column) -> Column:
    """How a file is marked whose data begin on a day: not to be downloaded, new, or with the days before yesterday."""
    days = F.date_diff(yesterday, first)
    return F.when(days < 0, "NO_DOWNLOAD_MIN_DATE_TOO_RECENT").when(days == 0, "_nws").otherwise(F.concat(F.lit("_"), days.cast("string")))


def page_day(x: Column) -> Column:
    """A day as the pages write it: 05-Mar-24."""
    return F.date_format(x, "dd-MMM-yy")
