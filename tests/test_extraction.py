"""Mentions against a plain version, and references and scalings on a page of text."""

import random
import re

from pyspark.sql import functions as F

from strataflow.operators import extraction as x
from strataflow.plans import extraction as plans

SF = "/root/testdata/sf0.001"


def plain(text):
    found = []
    for kind, rule, sure, terms in x.LEXICONS:
        for term in sorted(terms, key=len, reverse=True):
            for m in re.finditer(rf"(?<![A-Za-z0-9]){re.escape(term)}(?![A-Za-z0-9])", text, re.I):
                if not any(k == kind and a <= m.start() and m.end() <= b for a, b, k, _, _ in found):
                    found.append((m.start(), m.end(), kind, rule, sure))
    for kind, rule, sure, pattern, cased in x.PATTERNS:
        for m in re.finditer(pattern, text, 0 if cased else re.I):
            found.append((*m.span("value" if "value" in m.re.groupindex else 0), kind, rule, sure))
    kept = []
    for m in sorted(found, key=lambda m: (m[0], -(m[1] - m[0]), -m[4], m[2], m[3])):
        drop = False
        for a, b, k, _, _ in kept:
            overlaps, inside = m[0] < b and m[1] > a, m[0] >= a and m[1] <= b
            drop |= m[2] == "number" and inside and k != "number"
            drop |= m[2] == "range" and overlaps and k in x.STRONGER
            drop |= m[2] == k and (m[0], m[1]) == (a, b)
            drop |= m[2] in ("number", "range") and inside and k in x.STRONGER
        if not drop:
            kept.append(m)
    return kept


def test_mentions_equal_a_plain_version(spark):
    rng = random.Random(4)
    pieces = [t for _, _, _, terms in x.LEXICONS for t in terms] + ["P-101_A", "Model XK-7", "4 mA", "4-20 mA", "12.5 to 20 psi", "ID: ABC-1", "Doc. API-100", "alias HKLD", "Mud Weight (MW)", "Formula: a = b + 1", "7 counts", "ñ", "0–10 V", "ISO 9001", "x", "3.14"]
    texts = [" ".join(rng.choice(pieces) + rng.choice(["", ",", "-", ";", "("]) for _ in range(rng.randint(0, 25))) for _ in range(250)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {}
    for r in x.mentions(df, ["k"], "t").collect():
        t = texts[r["k"]]
        assert r["mention"] == t[r["start"] : r["end"]] and r["context"]["before"] == t[max(0, r["start"] - 40) : r["start"]] and r["context"]["after"] == t[r["end"] : r["end"] + 40]
        got.setdefault(r["k"], []).append((r["start"], r["end"], r["kind"], r["rule"], r["confidence"]))
    for k, t in enumerate(texts):
        assert sorted(got.get(k, [])) == sorted(plain(t or "")), t
    kinds = {m[2] for found in got.values() for m in found}
    assert len(kinds) >= 18


def test_query_mentions(spark):
    bodies = {r["p_partkey"]: r["body"] for r in plans.fragments(spark, SF).collect()}
    got = sorted((r["p_partkey"], r["start"], r["end"], r["kind"]) for r in plans.mentions(spark, SF).collect())
    assert got == sorted((k, a, b, kind) for k, t in bodies.items() for a, b, kind, _, _ in plain(t))


def test_references_and_scalings(spark):
    df = spark.createDataFrame([(1, "See Fig. 2, figure 2 and FIGURE 2; table 1.2, Section 3. 4 mA = 0 psi, 20 mA = 100 psi"), (2, None)], "k int, t string")
    assert [(r["kind"], r["number"], r["occurrence"]) for r in x.references(df, ["k"], "t").orderBy("ordinal").collect()] == [("figure", "2", 0), ("figure", "2", 0), ("figure", "2", 1), ("table", "1.2", 0), ("section", "3", 0)]
    line = x.composite_scalings(x.scalings(df, ["k"], "t"), ["k"]).first()
    assert (line["points"], line["factor"], line["offset"]) == (2, 6.25, -25.0)
    assert x.mentions(df.filter(F.lit(False)), ["k"], "t").count() == 0


class _Counted:
    """A compiled pattern that notes how often a text is searched for it."""

    def __init__(self, pattern, calls):
        self.pattern, self.calls = pattern, calls

    def __getattr__(self, name):
        return getattr(self.pattern, name)

    def finditer(self, text):
        self.calls.append(self.pattern.pattern)
        return self.pattern.finditer(text)


def test_a_text_is_searched_only_for_what_it_may_hold(monkeypatch):
    calls = []
    compile_ = re.compile
    monkeypatch.setattr(x.re, "compile", lambda *a: _Counted(compile_(*a), calls))
    rules = x.Rules()
    assert rules.matches("Nothing of note came up while the crew had lunch") == []
    assert len(calls) <= 3


def test_matches_are_those_of_each_term_and_pattern_by_itself():
    rng = random.Random(3)
    words = [t for _, _, _, terms in x.LEXICONS for t in terms] + ["Model X-12", "aka Foo 1", "Some Name (ABC)", "TAG-01_b", "ID: ABC-9", "5 to 7 psi", "4 \u2013 20 mA", "12 counts", "ECUACI\u00d3N: a = 3", "Doc. XYZ-12", "ISO 9001-2", "p\u017fi", "\u0131d: 77x", "\u0130SO 12", "HOO\u212a LOAD", "\u0663", "\u0664 to \u0665", "and", "\u00e9"]
    rules = x.Rules()
    for _ in range(3000):
        text = "".join(rng.choice(["", "(", "-", " "]) + rng.choice([str, str.upper, str.lower])(rng.choice(words)) + rng.choice([" ", ")", ", ", "_"]) for _ in range(rng.randint(1, 8)))
        expected = []
        for kind, rule, confidence, terms in x.LEXICONS:
            taken = []
            for term in sorted(terms, key=len, reverse=True):
                found = re.finditer(rf"(?<![A-Za-z0-9]){re.escape(term)}(?![A-Za-z0-9])", text, re.IGNORECASE)
                taken += [m.span() for m in found if not any(lo <= m.start() and m.end() <= hi for lo, hi in taken)]
            expected += [(*span, kind, rule, confidence) for span in taken]
        for kind, rule, confidence, pattern, cased in x.PATTERNS:
            compiled = re.compile(pattern, 0 if cased else re.IGNORECASE)
            expected += [(*m.span("value" if "value" in compiled.groupindex else 0), kind, rule, confidence) for m in compiled.finditer(text)]
        assert sorted(rules.matches(text)) == sorted(expected)
