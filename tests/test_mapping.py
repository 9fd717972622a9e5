"""Curve mapping and well identification against plain versions that try all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.functions import similarity, text
from strataflow.operators import mapping, wells
from strataflow.plans import wells as plans

SF = "/root/testdata/sf0.001"


def test_similar_pairs_lose_none(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 14))) for _ in range(150)})
    left, right = spark.createDataFrame([(w,) for w in words], "a string"), spark.createDataFrame([(w[::-1],) for w in words], "b string")
    for least in (60.0, 70.0, 85.0, 100.0):
        got = {(r["a"], r["b"]) for r in similarity.similar_pairs(left, right, "a", "b", least).collect()}
        assert got == {(x, y[::-1]) for x in words for y in words if similarity.ratio(x, y[::-1]) >= least}


def comparable(x):
    x = re.sub(r"[\[\]()]", "", re.sub(r"[_:(/\-.)]+", " ", (x or "").lower().replace("ñ", "n")))
    return " ".join(x.split())


def test_map_curves(spark):
    rng = random.Random(2)
    names = ["Hook Load", "Casing Pressure", "casing presure", "Flow In", "Flow Out", "flow", "Torque", "torque raw", "Bit Status", "H2S piso", "WHP", "ñandú (x)", "pump", "Air pressure"]
    spell = lambda: "".join(c for c in rng.choice(names) if rng.random() > 0.08) + rng.choice(["", "", "_", " 1", ".x"])
    curves = [(i, i % 2, rng.choice([None, "", "()", *[spell() for _ in range(12)]])) for i in range(300)]
    rules = [(i, i % 2, rng.choice([c[2] for c in curves if c[2]]), 900 + i, i % 3 == 0) for i in range(12)]
    variables = [(100 + i, i % 2, i, spell(), rng.choice([None, "", ",".join(spell() for _ in range(3))])) for i in range(40)]
    cats = {r["x"]: r["c"] for r in spark.createDataFrame([(t,) for t in {comparable(x) for x in [*(c[2] for c in curves), *(v[3] for v in variables), *(a for v in variables for a in (v[4] or "").split(","))]}], "x string").select("x", text.category(F.col("x")).alias("c")).collect()}
    pairs = [(x, y) for x in set(cats.values()) for y in set(cats.values())]
    fit = {(r["a"], r["b"]): (r["ok"], r["f"]) for r in spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.compatible(F.col("a"), F.col("b")).alias("ok"), text.category_factor(F.col("a"), F.col("b")).alias("f")).collect()}
    want = {}
    for key, rig, raw in curves:
        want[key] = (None, None, False, None, None)
        if not raw:
            continue
        exact = [r for r in rules if r[1] == rig and r[2] == raw]
        plain = comparable(raw)
        own = [v for v in variables if v[1] == rig]
        if exact:
            want[key] = (exact[-1][3], exact[-1][0], exact[-1][4], mapping.EXACT, 100)
        elif plain:
            alias = [v[0] for v in own if v[4] and plain in [comparable(a) for a in v[4].split(",")]]
            if alias:
                want[key] = (alias[0], None, False, mapping.ALIAS, 100)
                continue
            options = {}
            for v in own:
                for t in [v[3], *(v[4].split(",") if v[4] else [])]:
                    t = comparable(t)
                    if t and fit[cats[plain], cats[t]][0]:
                        options[t] = v[0]
            best = max(options, key=lambda t: similarity.ratio(plain, t), default=None)  # the first of equal ones
            if best is not None and similarity.ratio(plain, best) >= 70:
                score = int(similarity.ratio(plain, best) * fit[cats[plain], cats[best]][1])
                if score >= 70:
                    want[key] = (options[best], None, False, mapping.FUZZY, score)
    c = spark.createDataFrame(curves, "curve_id int, rig_id int, mnemonic string")
    r = spark.createDataFrame(rules, "rule_id int, rig_id int, mnemonic string, variable_id int, imports boolean")
    v = spark.createDataFrame(variables, "variable_id int, rig_id int, position int, name string, aliases string")
    got = {x["curve_id"]: tuple(x)[1:] for x in mapping.map_curves(c, r, v).collect()}
    assert got == want and {x[3] for x in want.values()} == {None, mapping.EXACT, mapping.ALIAS, mapping.FUZZY}


def well_name(x):
    x = re.sub(r"[^\w\s\-.()/]+", "", (x or "").upper().replace("Ñ", "N")).replace("/", "-")
    return " ".join(x.split())


def parts(x):
    if m := re.search(r"([A-Z]+)\.([a-zA-Z]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?", x):
        return m[2].upper(), m[3], m[4], m[1]
    if m := re.search(r"([A-Z.\-]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?", x):
        code = m[1].replace("-", "")
        if len(code) == 4 and m[3]:
            code = code[:3]
        elif len(code) > 6 and "." in code:
            code = code.split(".")[-1]
        return code, m[2], m[3], None
    if m := re.search(r"([A-Z]+)[\s\-]+(\d+)(?:.*[(]([A-Z])[)])?.*", x):
        return m[1], m[2], m[3], None
    return None, None, None, None


def variants(code, number, suffix, field):
    out = {f"{code}-{number}", f"{code} {number}"}
    for end in [f"{number}{suffix}", f"{number}({suffix})", f"{number} ({suffix})"] if suffix else []:
        out |= {f"{code}-{end}", f"{code}.{suffix}-{number}", f"{code} {end}"}
        if field:
            out |= {f"{field}.{code.lower()}-{end}", f"{field}.{code}-{end}"}
    if field:
        out |= {f"{field}.{c}{s}{number}" for c in (code, code.lower()) for s in "- "}
    return sorted(out)


def token_sort(a, b):
    return similarity.ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def identify(name, uwi, listed, fields):
    if uwi:
        hit = [w for w in listed if w["uwi"] and w["uwi"].upper() == uwi.upper()]
        if hit:
            return hit[0]["well_id"], "uwi", 100.0
    code, number, suffix, prefix = parts(well_name(name))
    if not number:
        return None
    word = prefix or code
    found = [(f, 100.0) for f in fields if f["code"] and f["code"].upper() == word.upper()]
    found += [(f, s) for f in fields if (s := token_sort(word, f["name"].upper())) >= 60]
    seen = set()
    for f, _ in sorted(found, key=lambda x: -x[1]):
        if f["field_id"] in seen:
            continue
        seen.add(f["field_id"])
        names = variants(f["code"] or code, number, suffix, prefix)
        best, best_score = None, 0
        for w in [w for w in listed if w["field_id"] == f["field_id"]] + [w for w in listed if w["field_id"] is None]:
            if (re.search(r"\d+", w["name"]) or [None])[0] != number:
                continue
            tail = "(" in w["name"] or re.search(r"[A-Z]$", w["name"].replace("-", "").replace(" ", ""))
            score = max(token_sort(n, well_name(w["name"])) for n in names)
            if score >= 85:
                tie = best is not None and score == best_score and bool(suffix) and tail and ("(" not in best["name"] or len(w["name"]) > len(best["name"]))
                if score > best_score or tie:
                    best, best_score = w, score
        if best:
            return best["well_id"], "name", best_score
    return None


def test_wells_are_identified_as_by_trying_all(spark):
    files, listed, fields = plans.sides(spark, SF)
    rows, all_wells, all_fields = files.collect(), sorted(listed.collect(), key=lambda w: w["well_id"]), sorted(fields.collect(), key=lambda f: f["field_id"])
    got = {r["file_id"]: (r["well_id"], r["method"], round(r["score"], 4)) for r in wells.identify_wells(files, listed, fields).collect()}
    known = {}
    want = {}
    for r in rows:
        key = (r["name"], r["uwi"])
        if key not in known:
            known[key] = identify(*key, all_wells, all_fields)
        if known[key]:
            want[r["file_id"]] = (known[key][0], known[key][1], round(known[key][2], 4))
    assert got == want and len({m for _, m, _ in want.values()}) == 2


def test_simple_well_names(spark):
    listed = spark.createDataFrame([(1, "LMC-12", 5, None), (2, "LMC-12(H)", 5, None), (3, "LMC-120", 5, None), (4, "ZZ-12", None, "u1")], "well_id long, name string, field_id int, uwi string")
    fields = spark.createDataFrame([(5, "Las Marías", "LMC")], "field_id int, name string, code string")
    files = spark.createDataFrame([(1, "LMC 12", None), (2, "lmc-12 (H)", None), (3, "x", "U1"), (4, "nada", None), (5, None, "")], "file_id int, name string, uwi string")
    got = {r["file_id"]: (r["well_id"], r["method"]) for r in wells.identify_wells(files, listed, fields).collect()}
    assert got == {1: (1, "name"), 2: (2, "name"), 3: (4, "uwi")}


def by_pattern(name, uwi, listed, fields):
    if uwi and (hit := [w for w in listed if w["uwi"] == uwi]):
        return hit[0]["well_id"], 0
    x = re.sub(r"^(T/P|T-P|C/D|C-D|[A-Z]{1,2}/[A-Z]{1,2})\s+", "", name.upper().strip()).replace("/", "-")
    x = re.sub(r"\s*-\s*", "-", re.sub(r"[^\w\s.\-()]", "", x))
    x = re.sub(r"-+$", "", " ".join(x.split()))
    m = re.search(r"([A-Z.()]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?\.?\)?$", x)
    if not m:
        return None
    code, number, behind, letter = re.sub(r"[-()]", "", m[1]), m[2], bool(m[3]), None
    if len(code) == 4 and not any(f["code"] and f["code"].upper() == code for f in fields):
        code, letter = code[:3], code[3]
    for f in fields:
        if f["code"] and f["code"].upper() == code:
            refined = f["code"] + (f".{letter}" if letter else "") + f"-{number}"
            own = [w for w in listed if w["field_id"] == f["field_id"]]
            tries = [lambda n: n == refined, lambda n: n.startswith(refined)]  # noqa: B023
            if letter or behind:
                tries.append(lambda n: re.match(re.escape(f["code"]) + ".*-" + number, n))  # noqa: B023
            for rank, fits in enumerate(tries, 1):
                if hit := [w["well_id"] for w in own if fits(w["name"])]:
                    return hit[0], rank
    return None


def compared(x):
    x = re.sub(r"[().]", " ", (x or "").upper().replace("Ñ", "N"))
    x = re.sub(r"\s*-\s*", "-", re.sub(r"[^\w\s\-]", "", x))
    words = x.split()
    half = len(words) // 2
    return " ".join(words[:half] if len(words) > 1 and len(words) % 2 == 0 and words[:half] == words[half:] else words)


def by_words(name, uwi, listed, fields):
    if uwi and uwi.strip() and (hit := [w for w in listed if w["uwi"] and w["uwi"].upper() == compared(uwi)]):
        return hit[0]["well_id"], "uwi", 100.0
    if not name or not name.strip():
        return None
    coded = lambda c: next((f for f in fields if f["code"] and f["code"].upper() == c.upper()), None)
    plain = " ".join(re.sub(r"[^\w\s\-.()]", " ", name.upper().replace("Ñ", "N")).split())
    m = re.search(r"^(.*?)(?:[\s\-]|(?=\d))(\d+)(?:[\s(\-/]*([A-Z]))?\.?\)?$", plain)
    if m:
        main, number, ending = m[1].strip(" .-()"), m[2], m[3]
    else:
        first = re.search(r"\d+", plain)
        if not first:
            return None
        number, ending = first[0], None
        main = plain[: plain.rfind(number)].strip(" .-()")
    code = middle = words = None
    if main:
        c = main.replace("(", "").replace(")", "").strip()
        short = lambda x: 2 <= len(x) <= 4 and x.isalnum() and not x.isdigit()
        two = re.match(r"^([A-Z]{2,3})[\s.]?([A-Z0-9])$", c)
        for fits, x, y in ((" " in c and short(c.replace(" ", "")), c.replace(" ", ""), None), (short(c), c, None), (two, two and two[1], two and two[2]), (len(c) == 4 and short(c), c[:3], c[3:])):
            if fits and coded(x):
                code, middle, words = x, y, coded(x)["name"]
                break
        else:
            words = main
    found = {f["field_id"]: 100 for f in fields if code and f["code"] and f["code"].upper() == code.upper()}
    if compared(words or code):
        for f in fields:
            s = similarity.token_set_ratio(compared(words or code), compared(f["name"])) if f["name"] else 0
            if s >= 60 and s > found.get(f["field_id"], 0):
                found[f["field_id"]] = s
    for field_id, _ in sorted(found.items(), key=lambda x: -x[1]):
        f = next(x for x in fields if x["field_id"] == field_id)
        n = number + (ending or "")
        own = (f["code"] or code or "").strip().upper()
        names = []
        joined = lambda x: [f"{x}.{middle}-{n}", f"{x}{middle}-{n}"] if middle else [f"{x}-{n}"]  # noqa: B023, E731
        if own:
            names += joined(own)
        title = compared(f["name"] or words)
        if title:
            names.append(f"{title}-{n}")
            initials = "".join(w[0] for w in title.split() if w[0].isalnum())
            if initials and initials != own:
                names += joined(initials)
        raw = compared(words)
        if raw and raw not in (own, title):
            names.append(f"{raw}-{n}")
        names = {re.sub(r"\s*-\s*", "-", x.strip()).replace(".-", "-").replace(". -", "-") for x in names} | {compared(name)}
        if code:
            names |= set(joined(code))
        if words and compared(words) != compared(f["name"]):
            names.add(f"{compared(words)}-{n}")
        best = None
        for x in sorted(names):
            for w in listed:
                if compared(x) and w["field_id"] == field_id and (re.search(r"\d+", w["name"]) or [None])[0] == number:
                    s = similarity.token_set_ratio(compared(x), compared(w["name"]))
                    if s >= 85 and (best is None or s > best[1]):
                        best = (w["well_id"], s)
        if best:
            return best[0], "name", best[1]
    return None


def test_wells_by_words(spark):
    files, listed, fields = plans.sides(spark, SF)
    all_wells, all_fields = sorted(listed.collect(), key=lambda w: w["well_id"]), sorted(fields.collect(), key=lambda f: f["field_id"])
    found = wells.identify_wells_by_words(files, listed, fields.withColumnRenamed("name", "field")).collect()
    got = {r["file_id"]: (r["well_id"], r["method"], round(r["score"], 4)) for r in found}
    known, want = {}, {}
    for r in files.collect():
        key = (r["name"], r["uwi"])
        if key not in known:
            known[key] = by_words(*key, all_wells, all_fields)
        if known[key]:
            want[r["file_id"]] = (known[key][0], known[key][1], round(known[key][2], 4))
    assert got == want and len(want) > 100


def test_wells_by_pattern(spark):
    files, listed, fields = plans.sides(spark, SF)
    all_wells, all_fields = sorted(listed.collect(), key=lambda w: w["well_id"]), sorted(fields.collect(), key=lambda f: f["field_id"])
    got = {r["file_id"]: (r["well_id"], r["rank"]) for r in wells.wells_by_pattern(files, listed, fields).collect()}
    want = {r["file_id"]: x for r in files.collect() if (x := by_pattern(r["name"], r["uwi"], all_wells, all_fields))}
    assert got == want and len(want) > 50


@pytest.mark.parametrize("value, expected", [("José Álvarez-12", "JOSÉ ÁLVAREZ-12"), ("Año/7 #", "ANO-7"), ("a  b", "A B")])
def test_well_names_keep_letters(spark, value, expected):
    assert spark.createDataFrame([(value,)], "x string").select(text.well_name(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize("value, occurrence, expected", [("Figure 1 and figure 1", 1, 13), ("aAa", 2, 2), ("abc", 0, None), ("aa.a", 0, None)])
def test_nth_start(spark, value, occurrence, expected):
    needle = "figure 1" if "igure" in value else "a" if value == "aAa" else "z."
    assert spark.range(1).select(text.nth_start(F.lit(value), F.lit(needle), F.lit(occurrence))).first()[0] == expected
