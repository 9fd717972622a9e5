import datetime
import itertools
import random
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.functions import dates, similarity, text, values


def slow_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd é", max_size=12), st.text("abcd é", max_size=12))
def test_common_subsequence(a, b):
    assert similarity.common_subsequence(a, b) == slow_lcs(a, b)


def test_ratios():
    assert similarity.ratio("", "") == 100.0
    assert similarity.ratio("abc", "abd") == pytest.approx(200 * 2 / 6)
    assert similarity.token_set_ratio("a b c", "c b") == 100.0
    assert similarity.token_set_ratio("", "a") == 0.0


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value, expected", [("Presión_Casing (psi)", "presión casing psi"), ("Año: A/B-C.d", "ano a b c d"), (None, None)])
def test_comparable(spark, value, expected):
    assert one(spark, value, text.comparable) == expected


@pytest.mark.parametrize("value, expected", [("wc_torque_est", "TORQUE"), ("RAW_DBA_x.y", "DBA_X_Y"), ("a (b)", "A_B_")])
def test_curve_name(spark, value, expected):
    assert one(spark, value, text.curve_name) == expected


@pytest.mark.parametrize("value, expected", [("PZ.xp-1654", ("XP", "1654", None, "PZ")), ("LMC-12(H)", ("LMC", "12", "H", None)), ("ABCD 7 K", ("ABC", "7", "K", None)), ("NQ.CASE-337", ("CASE", "337", None, "NQ")), ("nada", (None, None, None, None))])
def test_name_parts(spark, value, expected):
    assert tuple(one(spark, value, text.name_parts)) == expected


def test_categories(spark):
    rows = [("Casing pressure", "PRESION_CASING"), ("flow out", "FLUJO_SALIDA"), ("status", "STATUS_GENERAL"), ("depth", "GENERAL")]
    for value, expected in rows:
        assert one(spark, value, text.category) == expected
    pairs = spark.createDataFrame([("FLUJO_ENTRADA", "FLUJO_SALIDA", 0.5), ("FLUJO_GENERAL", "FLUJO_ENTRADA", 0.95), ("GENERAL", "H2S_PISO", 1.0), ("TORQUE_RAW", "TORQUE_GENERAL", 0.9), ("PRESION_AIRE", "FLUJO_SALIDA", 0.5)], "a string, b string, want double")
    assert pairs.filter(text.category_factor(F.col("a"), F.col("b")) != F.col("want")).count() == 0


@pytest.mark.parametrize("value, expected", [("x*0.3048", (0.3048, 0.0)), ("x/2-1", (0.5, -1.0)), ("x+273.15", (1.0, 273.15)), ("(x-32)*5/9", (None, None)), ("x/0", (None, None)), (None, (None, None)), ("x*-2", (-2.0, 0.0)), ("x/-4", (-0.25, 0.0)), ("x+-5", (1.0, -5.0)), ("x--5", (1.0, 5.0)), ("-2 * X + 1", (-2.0, 1.0)), ("x *\t2", (None, None))])
def test_unit_equation(spark, value, expected):
    assert tuple(one(spark, value, values.unit_equation)) == expected


@pytest.mark.parametrize("value", ["doc:1", " padded ", "ñandú", ""])
def test_url_id(spark, value):
    assert one(spark, value, values.url_id) == str(uuid.uuid5(uuid.NAMESPACE_URL, value.strip()))


def test_step_seconds(spark):
    rows = spark.createDataFrame([(2.5, "S", 2), (3.5, None, 4), (2.0, "min", 120), (1500.0, "MS", 2), (1.0, "H", 3600)], "v double, u string, want long")
    assert rows.filter(values.step_seconds(F.col("v"), F.col("u")) != F.col("want")).count() == 0


FORMATS = ["%d/%m/%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%d/%b/%Y %H:%M:%S", "%d-%b-%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%d/%m/%Y", "%Y-%m-%d", "%d/%b/%Y", "%d-%b-%Y", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%y %H:%M:%S", "%d-%b-%y %H:%M:%S", "%m/%d/%y %H:%M:%S", "%d/%m/%y", "%d-%b-%y", "%m/%d/%y"]


def test_dates_as_python_reads_them(spark):
    rng = random.Random(5)
    number = lambda: rng.choice(["0", "1", "5", "07", "12", "13", "28", "30", "31", "69", "68", "2024", "1999", "24", "59", "60"])
    cells = ["", " ", "nada", "5-Mar-2024 : start", " 1/2/03 ", "05/MAR/24", "0000-01-01", "29/02/2023", "29/02/2024"]
    for _ in range(1500):
        s = rng.choice("/-")
        month = rng.choice([number(), rng.choice(["Jan", "feb", "SEP", "Dic"])])
        cells.append(f"{number()}{s}{month}{s}{number()}" + rng.choice(["", f" {number()}:{number()}:{number()}"]))
    want = []
    for cell in cells:
        found = None
        for f in FORMATS:
            try:
                found = datetime.datetime.strptime(cell.split(" : ")[0].strip(), f)
                break
            except ValueError:
                continue
        want.append(found)
    got = spark.createDataFrame(list(enumerate(cells)), "k int, x string").select("k", dates.parsed(F.col("x")).cast("timestamp_ntz").alias("at")).collect()
    assert {r["k"]: r["at"] for r in got} == dict(enumerate(want)) and sum(w is not None for w in want) > 100
