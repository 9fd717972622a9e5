"""Mentions and observations in fragments of documents: lexicons, patterns, scalings and references.

Spans need a regular-expression engine that tells where it matched, so lexicons and patterns run in Arrow batches; a
fragment is a row, and what its matches suppress is decided within it. All else is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as texts

#: Kinds of terms with the rule's name, its confidence and its terms.
LEXICONS = (
    ("manufacturer", "manufacturer.lexicon.v1", 1.0, ("National Oilwell Varco", "NOV", "Emerson", "Honeywell", "ABB", "Siemens", "Rockwell")),
    ("variable", "variable.lexicon.v2", 0.99, ("Hook Load", "Hookload", "Peso Gancho", "Standpipe Pressure", "Weight on Bit", "Rate of Penetration", "Flow In", "Flow Out")),
    ("physical_quantity", "quantity.lexicon.v2", 0.98, ("Flow Rate", "Temperature", "Pressure", "Torque", "Depth", "Rotary Speed")),
    ("system", "system.lexicon.v1", 0.98, ("Top Drive System", "Mud Circulation System", "Hydraulic System", "Control System", "Hoisting System")),
    ("subsystem", "subsystem.lexicon.v1", 0.98, ("Brake Subsystem", "Lubrication Subsystem", "Cooling Subsystem", "Hoisting Subsystem", "Pump Subsystem")),
    ("equipment", "equipment.lexicon.v1", 0.97, ("Top Drive", "Mud Pump", "Drawworks", "Standpipe Manifold", "Trip Tank", "Rotary Table")),
    ("sensor", "sensor.lexicon.v1", 0.97, ("Load Pin Sensor", "Pressure Sensor", "Temperature Sensor", "Flow Sensor", "Torque Sensor")),
    ("instrument", "instrument.lexicon.v1", 0.97, ("Pressure Transmitter", "Flowmeter", "Gauge", "Indicator", "Controller", "PLC", "HMI")),
    ("process", "process.lexicon.v1", 0.96, ("Drilling", "Circulating", "Tripping", "Reaming", "Cementing", "Connections")),
    ("engineering_unit", "unit.lexicon.v1", 1.0, ("klbf", "psi", "rpm", "gpm", "ft", "in", "m", "degC", "degF", "mA", "A", "V", "%", "counts", "pulses")),
    ("mnemonic", "mnemonic.lexicon.v1", 0.95, ("HKLD", "SPP", "WOB", "ROP", "FLOWIN", "FLOWOUT", "RPM", "TQA")),
)
#: Kinds of patterns with the rule's name, its confidence, the pattern (a group 'value' is what counts) and whether case matters.
PATTERNS = (
    ("standard", "standard.regex.v1", 1.0, r"\b(?:WITSML(?:\s+\d+(?:\.\d+)*)?|API\s+(?:RP|Spec|STD)\s*\d+[A-Z-]*|ISO\s+\d+(?:-\d+)?|IEC\s+\d+(?:-\d+)*)\b", False),
    ("model", "model.regex.v1", 0.99, r"\b(?:Model|Modelo)\s*[:\-]?\s*(?P<value>[A-Z0-9][A-Z0-9./_-]{1,40})\b", True),
    ("alias", "alias.regex.v1", 0.94, r"\b(?:alias|aka|also called|also referred to as)\s+(?P<value>[A-Za-z0-9][A-Za-z0-9 ./_-]{1,60})", False),
    ("abbreviation", "abbreviation.regex.v1", 0.95, r"\b[A-Za-z][A-Za-z ]{2,60}\((?P<value>[A-Z]{2,12})\)", True),
    ("tag", "tag.regex.v2", 1.0, r"\b[A-Za-z][A-Za-z0-9]*(?:[-_][A-Za-z0-9]+){1,6}\b", True),
    ("identifier", "identifier.regex.v1", 0.96, r"\b(?:ID|Identifier|Identificador)\s*[:#-]?\s*(?P<value>[A-Z0-9][A-Z0-9._/-]{2,40})\b", False),
    ("range", "range.regex.v1", 0.99, r"\b\d+(?:\.\d+)?\s*(?:to|-|–)\s*\d+(?:\.\d+)?(?:\s*(?:klbf|psi|rpm|gpm|ft|in|m|degC|degF|mA|A|V|%))?\b", False),
    ("raw_signal", "raw_signal.regex.v1", 1.0, r"\b(?:4\s*(?:-|–|to)\s*20\s*mA|0\s*(?:-|–|to)\s*10\s*V|\d+\s*counts?|\d+\s*pulses?)\b", False),
    ("formula", "formula.regex.v1", 0.99, r"\b(?:Formula|Equation|Ecuacion|Ecuación)\s*:\s*(?P<value>[A-Za-z][A-Za-z0-9_ ]{0,30}\s*=\s*[A-Za-z0-9_ ()+\-*/.]+)", False),
    ("number", "number.regex.v1", 0.9, r"\b\d+(?:\.\d+)?\b", True),
    ("document_reference", "document_reference.regex.v1", 0.96, r"\b(?:Document|Doc\.)\s+(?P<value>(?:[A-Z]{2,10}(?:\s+(?:RP|Spec|STD))?\s*\d+[A-Z-]*|[A-Z]{2,10}-\d{2,6}|[A-Za-z0-9._/-]{3,40}))\b", False),
)
#: A number or range gives way to these kinds; explicit scalings; references to figures, tables and sections.
STRONGER = frozenset({"tag", "identifier", "model", "document_reference"})
SCALING = r"(?i)(\d+(?:\.\d+)?)\s*(mA|V|counts?|pulses?)\s*=\s*(\d+(?:\.\d+)?)\s*(klbf|psi|rpm|gpm|ft|in|m|degC|degF|%)"
REFERENCE = r"(?i)\b(figure|fig\.?|table|section)\s+(\d+(?:\.\d+)*)\b"

Match = tuple[int, int, str, str, float]  # start, end, kind, rule, confidence


#: What a text must hold for a pattern to match, in lower case; one of each group. Digits are told by ``DIGIT``.
NEEDED = {
    "standard": ("witsml", "api", "iso", "iec"), "model": ("model",), "alias": ("alias", "aka", "also called", "also referred to as"), "abbreviation": ("(",), "tag": ("-", "_"), "identifier": ("id",),
    "formula": ("formula", "equation", "ecuaci"), "document_reference": ("document", "doc."),
}
DIGIT = re.compile(r"\d")
DIGIT_KINDS = frozenset({"range", "raw_signal", "number"})
#: Letters that match one of ASCII where case doesn't matter, but aren't its other case.
FOLDED = {"\u017f": "s", "\u0131": "i", "\u0130": "i"}


class Rules:
    """All rules, compiled: one pattern for each lexicon finds its terms of one run of letters, another each longer term, longest first.

    A term or pattern is searched in texts only that hold what it needs, which plain search tells much faster.
    """

    def __init__(self) -> None:
        alone = lambda x: re.compile(rf"(?<![A-Za-z0-9]){x}(?![A-Za-z0-9])", re.IGNORECASE)
        self.lexicons = []
        for kind, rule, confidence, terms in LEXICONS:
            runs = [t for t in terms if t.isascii() and t.isalnum()]  # whole runs: no two overlap
            longer = sorted((t for t in terms if t not in runs), key=len, reverse=True)
            self.lexicons.append((kind, rule, confidence, [(t.lower(), alone(re.escape(t))) for t in longer], tuple(t.lower() for t in runs), alone(f"(?:{'|'.join(runs)})") if runs else None))
        self.patterns = [(kind, rule, confidence, re.compile(p, 0 if cased else re.IGNORECASE), NEEDED.get(kind)) for kind, rule, confidence, p, cased in PATTERNS]

    def matches(self, text: str) -> list[Match]:
        found: list[Match] = []
        plain = text
        for letter, other in () if text.isascii() else FOLDED.items():
            plain = plain.replace(letter, other)
        plain = plain.lower()
        for kind, rule, confidence, longer, runs, any_run in self.lexicons:
            taken: list[tuple[int, int]] = []
            for term, pattern in longer:
                if term in plain:
                    for m in pattern.finditer(text):
                        if not any(lo <= m.start() and m.end() <= hi for lo, hi in taken):
                            taken.append(m.span())
            if any(r in plain for r in runs):
                found += [(*m.span(), kind, rule, confidence) for m in any_run.finditer(text) if not any(lo <= m.start() and m.end() <= hi for lo, hi in taken)]
            found += [(lo, hi, kind, rule, confidence) for lo, hi in taken]
        digits = DIGIT.search(text) is not None
        for kind, rule, confidence, pattern, needed in self.patterns:
            if any(x in plain for x in needed) if needed else digits or kind not in DIGIT_KINDS:
                group = "value" if "value" in pattern.groupindex else 0
                found += [(*m.span(group), kind, rule, confidence) for m in pattern.finditer(text)]
        return found


def accepted(matches: list[Match]) -> list[Match]:
    """Matches that none before them suppresses: by start, the longer, the surer, then by kind and rule.

    A number inside another kind's match goes, and so does a range that overlaps a stronger kind, a number inside
    one, and a match of the same kind and span. Matches that end before the next begins can't matter to it.
    """
    kept: list[Match] = []
    near: list[Match] = []
    for m in sorted(matches, key=lambda m: (m[0], m[0] - m[1], -m[4], m[2], m[3])):
        start, end, kind = m[:3]
        near = [x for x in near if x[1] > start or x[1] == x[0] or start == end]
        for lo, hi, other, _, _ in near:
            inside = lo <= start and end <= hi
            if (
                (kind == "number" and inside and other != "number")
                or (kind == "range" and start < hi and end > lo and other in STRONGER)
                or (kind == other and (start, end) == (lo, hi))
                or (kind in ("number", "range") and inside and other in STRONGER)
            ):
                break
        else:
            kept.append(m)
            near.append(m)
    return kept


MENTIONS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("confidence", T.DoubleType())]))


def mentions(fragments: DataFrame, key: list[str], body: str) -> DataFrame:
    """key, start, end, kind, rule, confidence, mention, normalized, context of each mention; places count characters from 0."""
    schema = T.StructType([*(fragments.schema[k] for k in key), T.StructField(body, T.StringType()), T.StructField("_found", MENTIONS)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules()
        names = [f.name for f in MENTIONS.elementType]
        for batch in batches:
            found = [[dict(zip(names, m, strict=True)) for m in accepted(rules.matches(x))] if x else [] for x in batch.column(body).to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("rule", pa.string()), ("confidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], schema.names)

    rows = fragments.select(*key, body).mapInArrow(find, schema).select(*key, body, F.inline("_found"))
    around = texts.context(F.col(body), F.col("start"), F.col("end"))
    rows = rows.withColumn("context", around)
    return rows.select(*key, "start", "end", "kind", "rule", "confidence", F.col("context.match").alias("mention"), texts.normal(F.col("context.match")).alias("normalized"), "context")


def scalings(fragments: DataFrame, key: list[str], body: str) -> DataFrame:
    """A row for each explicit scaling, such as '4 mA = 0 psi', with its ordinal from 1."""
    groups = F.arrays_zip(*(F.regexp_extract_all(F.col(body), F.lit(SCALING), F.lit(i)).alias(n) for i, n in enumerate(("original", "raw_value", "raw_unit", "value", "unit"))))
    rows = fragments.select(*key, F.posexplode(groups).alias("ordinal", "x"))
    return rows.select(*key, (F.col("ordinal") + 1).cast("long").alias("ordinal"), *(F.col(f"x.{n}").alias(n) for n in ("original", "raw_value", "raw_unit", "value", "unit")))


def scaled_units(scalings_: DataFrame, units: DataFrame) -> DataFrame:
    """Scalings with the catalogue's engineering unit (unit_id, symbol), by symbol in any case; 'proposed' where there is none, 'alternative' of several."""
    known = units.groupBy(texts.normal(F.col("symbol")).alias("_key")).agg(F.min("unit_id").alias("unit_id"), F.count("*").alias("_n"))
    rows = scalings_.withColumn("_key", texts.normal(F.col("unit"))).join(known, "_key", "left")
    return rows.withColumn("status", F.when(F.col("_n").isNull(), "proposed").when(F.col("_n") > 1, "alternative").otherwise("resolved")).drop("_key", "_n")


def composite_scalings(scalings_: DataFrame, key: list[str]) -> DataFrame:
    """The line through a fragment's first and last scaling of one pair of units: factor and offset from raw to engineering values."""
    ends = scalings_.groupBy(*key, F.lower("raw_unit").alias("raw_unit"), F.lower("unit").alias("unit")).agg(
        F.count("*").alias("points"), *(f(F.struct(F.col("raw_value").cast("double").alias("x"), F.col("value").cast("double").alias("y"))).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi")))
    ).filter("lo.x < hi.x")
    factor = (F.col("hi.y") - F.col("lo.y")) / (F.col("hi.x") - F.col("lo.x"))
    return ends.select(*key, "raw_unit", "unit", "points", factor.alias("factor"), (F.col("lo.y") - factor * F.col("lo.x")).alias("offset"))


def references(fragments: DataFrame, key: list[str], body: str) -> DataFrame:
    """References to figures, tables and sections, with their number and how often the fragment had the same one before."""
    groups = F.arrays_zip(*(F.regexp_extract_all(F.col(body), F.lit(REFERENCE), F.lit(i)).alias(n) for i, n in enumerate(("reference", "kind", "number"))))
    rows = fragments.select(*key, groups.alias("_all")).select(*key, "_all", F.posexplode("_all").alias("ordinal", "x"))
    same = F.filter(F.slice("_all", F.lit(1), F.col("ordinal")), lambda y: F.lower(y["reference"]) == F.lower(F.col("x.reference")))
    kind = F.rtrim(F.lower(F.col("x.kind")), F.lit("."))
    return rows.select(*key, F.col("ordinal").cast("long").alias("ordinal"), F.col("x.reference").alias("reference"), F.when(kind == "fig", "figure").otherwise(kind).alias("kind"), F.col("x.number").alias("number"), F.size(same).cast("long").alias("occurrence"))


def resolved_references(references_: DataFrame, targets: DataFrame, scope: str) -> DataFrame:
    """With the id of the target (scope, kind, number, target_id) of the same document; null where there is none."""
    last = targets.groupBy(scope, "kind", "number").agg(F.max("target_id").alias("target_id"))
    return references_.join(last, [scope, "kind", "number"], "left")


def section_numbers(sections: DataFrame, scope: str, title: str, id_: str) -> DataFrame:
    """Targets from sections whose title begins with a number."""
    number = F.regexp_extract(title, r"^(\d+(?:\.\d+)*)\b", 1)
    return sections.select(scope, F.lit("section").alias("kind"), number.alias("number"), F.col(id_).alias("target_id")).filter("number <> ''")


def fragment_hash(version: Column, kind: Column, ordinal: Column, normalized: Column, *trace: Column) -> Column:
    """The hash of a fragment's version, kind, ordinal, normalised text and trace (page, section, table, figure, paragraph); a null is empty."""
    parts = [F.coalesce(p.cast("string"), F.lit("")) for p in (version, kind, ordinal, normalized, *trace)]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def attribute_value(attributes: Column, key: str) -> Column:
    """The value of the last pair (key, value) of an array that has the key; null if none does."""
    return F.try_element_at(F.filter(attributes, lambda a: a["key"] == key), F.lit(-1))["value"]


def extraction_metrics(mentions_: DataFrame, document: str) -> DataFrame:
    """How many mentions each document has, of each kind and rule."""
    return mentions_.groupBy(document, "kind", "rule").agg(F.count("*").alias("n"))
