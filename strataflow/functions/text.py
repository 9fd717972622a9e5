"""Text normalisers, name components and category rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes and suffixes that a curve name loses, the first that fits of each.
CURVE_PREFIXES = ("DBA_", "WC_", "KZ_", "RAW_", "WSGD_", "DIR-", "GEO-")
CURVE_SUFFIXES = ("_EST", "_CALC", "_RT", "_CORR", "_FINAL", "_PROMEDIO", "_REPROCESSED")
#: Families of variables, each with the words that tell it and its kinds in order.
CATEGORIES = [
    ("PRESION", ("pressure", "presion"), [("AIRE", ("air", "aire")), ("BACK", ("back", "contraPresion")), ("CASING", ("casing", "revestimiento")), ("GUINCHE", ("guinche", "winch"))]),
    ("FLUJO", ("flow", "flujo", "caudal"), [("ENTRADA", ("in", "entrada", "ingreso")), ("SALIDA", ("out", "salida", "egreso"))]),
    ("STATUS", ("status", "estado"), [("BIT", ("bit", "broca")), ("SLIP", ("slip", "deslizamiento")), ("SDAQ", ("sdaq", "sistema")), ("WC", ("wc", "control")), ("WPDA", ("wpda", "procesamiento"))]),
    ("TORQUE", ("torque", "par"), [("RAW", ("raw", "crudo", "sin procesar")), ("ROTARY", ("rotary", "rotatorio"))]),
    ("H2S", ("h2s", "sulfuro"), [("PILETA", ("pileta", "pit", "tanque")), ("PISO", ("piso", "floor", "suelo"))]),
]
#: Factors of the score for a family's general category with one of its kinds, and otherwise.
KIND_FACTORS = {("PRESION", "AIRE"): 0.9, ("FLUJO", "ENTRADA"): 0.95, ("STATUS", "BIT"): 0.85, ("TORQUE", "RAW"): 0.9}
INCOMPATIBLE_FACTOR = 0.5


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def comparable(x: Column) -> Column:
    """Lower case, n for ñ, runs of separators as a blank, no brackets."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(x), "ñ", "n"), r"[_:(/\-.)]+", " ")
    return collapse(F.regexp_replace(plain, r"[\[\]()]", ""))


def well_name(x: Column) -> Column:
    """Upper case, N for Ñ, only letters, digits, underscores, blanks and - . ( ) /, the last as -."""
    plain = F.regexp_replace(F.regexp_replace(F.upper(x), "Ñ", "N"), r"(?U)[^\w\s\-.()/]", "")
    return collapse(F.regexp_replace(plain, "/", "-"))


def curve_name(x: Column) -> Column:
    plain = F.trim(F.upper(x))
    # alternatives are tried in order, so the first prefix that fits goes, and once only
    plain = F.regexp_replace(plain, "^(?:" + "|".join(CURVE_PREFIXES) + ")", "")
    plain = F.regexp_replace(plain, "(?:" + "|".join(CURVE_SUFFIXES) + ")$", "")
    return F.regexp_replace(F.regexp_replace(plain, r"[\s.\-/()]+", "_"), "[^A-Z0-9_]", "")


def normal(x: Column) -> Column:
    return F.lower(collapse(x))


def tag(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def first_number(x: Column) -> Column:
    found = F.regexp_extract(x, r"(\d+)", 1)
    return F.when(found != "", found)


def canonical_url(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(x), r"[#?].*$", ""), "/+$", "")


def strip_marks(x: Column) -> Column:
    """Without the literal M$ that well lists carry."""
    return F.regexp_replace(x, r"M\$", "")


def rig_alias(x: Column) -> Column:
    return F.when(x.like("FB%") | x.like("PAE%"), F.replace(x, F.lit("-"), F.lit(" "))).otherwise(x)


def any_of(x: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(x, F.lit(w))
    return found


def category(x: Column) -> Column:
    """The category of a variable's name: substrings decide, in the order of the table."""
    plain, out = comparable(x), None
    for family, words, kinds in CATEGORIES:
        inner = None
        for kind, hints in kinds:
            inner = F.when(any_of(plain, hints), f"{family}_{kind}") if inner is None else inner.when(any_of(plain, hints), f"{family}_{kind}")
        value = inner.otherwise(f"{family}_GENERAL")
        out = F.when(any_of(plain, words), value) if out is None else out.when(any_of(plain, words), value)
    return out.otherwise("GENERAL")


def compatible(a: Column, b: Column) -> Column:
    """Equal categories, a family's general one with any of its kinds, or the general category with any."""
    same_family = F.substring_index(a, "_", 1) == F.substring_index(b, "_", 1)
    return (a == b) | (same_family & (a.endswith("_GENERAL") | b.endswith("_GENERAL"))) | (a == "GENERAL") | (b == "GENERAL")


def category_factor(a: Column, b: Column) -> Column:
    out = F.when(~compatible(a, b), F.lit(INCOMPATIBLE_FACTOR))
    for (family, kind), factor in KIND_FACTORS.items():
        general, special = f"{family}_GENERAL", f"{family}_{kind}"
        out = out.when(((a == general) & (b == special)) | ((a == special) & (b == general)), F.lit(factor))
    return out.otherwise(F.lit(1.0))


def name_parts(x: Column) -> Column:
    """struct(code, number, suffix, field) of a well name; all null where no form fits.

    Forms in order: FIELD.code-number, CODE-number, and the last word before a number, each with an optional letter
    behind it. A code of four letters loses the last where a letter follows; of a long dotted one the last part counts.
    """
    dotted, plain = r"([A-Z]+)\.([a-zA-Z]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?", r"([A-Z.\-]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?"
    last_word = r"([A-Z]+)[\s\-]+(\d+)(?:.*[(]([A-Z])[)])?.*"
    get = lambda pattern, i: F.nullif(F.regexp_extract(x, pattern, i), F.lit(""))
    code, suffix = F.replace(F.regexp_extract(x, plain, 1), F.lit("-"), F.lit("")), get(plain, 3)
    code = F.when((F.length(code) == 4) & suffix.isNotNull(), F.substring(code, 1, 3)).when((F.length(code) > 6) & F.contains(code, F.lit(".")), F.substring_index(code, ".", -1)).otherwise(code)
    is_dotted, is_plain, is_last = x.rlike(dotted), x.rlike(plain), x.rlike(last_word)
    pick = lambda a, b, c: F.when(is_dotted, a).when(is_plain, b).when(is_last, c)
    return F.struct(
        pick(F.upper(get(dotted, 2)), code, get(last_word, 1)).alias("code"),
        pick(get(dotted, 3), get(plain, 2), get(last_word, 2)).alias("number"),
        pick(get(dotted, 4), suffix, get(last_word, 3)).alias("suffix"),
        F.when(is_dotted, get(dotted, 1)).alias("field"),
    )


def has_suffix(well: Column) -> Column:
    """Whether a well's name ends with a letter or has one in brackets."""
    return F.contains(well, F.lit("(")) | F.translate(well, "- ", "").rlike("[A-Z]$")


def without_half(x: Column) -> Column:
    """Words in upper case; where the second half repeats the first, one half of them."""
    words = F.split(collapse(F.upper(x)), " ")
    half = F.floor(F.size(words) / 2).cast("int")
    twice = (F.size(words) > 1) & (F.size(words) % 2 == 0) & (F.slice(words, F.lit(1), half) == F.slice(words, half + 1, half))
    return F.array_join(F.when(twice, F.slice(words, F.lit(1), half)).otherwise(words), " ")


def file_name(path: Column) -> Column:
    """The last part of a path, in lower case."""
    return F.lower(F.element_at(F.split(path, "/"), -1))


def context(text: Column, start: Column, end: Column, width: int = 40) -> Column:
    """struct(before, match, after) of a span, counted from 0, with up to ``width`` characters either way."""
    first = F.greatest(start - width, F.lit(0))
    part = lambda lo, hi: F.substring(text, (lo + 1).cast("int"), (hi - lo).cast("int"))
    return F.struct(part(first, start).alias("before"), part(start, end).alias("match"), part(end, end + width).alias("after"))


def nth_start(text: Column, needle: Column, occurrence: Column) -> Column:
    """Where the needle occurs for the n-th time (both from 0), in any case and without overlap; null if it doesn't.

    Behind the n-th cut at the needle, all the parts before it and the needles between them have been passed.
    """
    parts = F.split(F.lower(text), F.concat(F.lit("\\Q"), F.lower(needle), F.lit("\\E")), -1)
    before = F.aggregate(F.slice(parts, F.lit(1), (occurrence + 1).cast("int")), F.lit(0), lambda n, p: n + F.length(p))
    return F.when((F.length(needle) > 0) & (F.size(parts) > occurrence + 1), before + occurrence * F.length(needle))


def summary(*parts: Column) -> Column:
    """The parts that aren't empty, with blanks between."""
    return F.concat_ws(" ", *(F.nullif(F.trim(p), F.lit("")) for p in parts))
