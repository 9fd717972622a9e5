"""Column names and expressions that several operators use."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def found_path(path: str | Callable[[], str]) -> str:
    """A path, or what names it: workers call that themselves, as a file may lie elsewhere on each machine."""
    return path if isinstance(path, str) else path()


def fresh(taken: list[str], name: str) -> str:
    """``name``, or a longer one that no column has in any case of letters."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
