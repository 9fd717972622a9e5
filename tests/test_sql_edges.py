"""Small tables on which queries differed from their SQL."""

import os

from strataflow.plans import catalogue
from tests import oracle

SF = "/root/testdata/sf0.001"


def differs(spark, folder, query: str, **tables: str) -> str:
    """What a query has otherwise than its SQL on sf0.001 with some tables replaced by what SQL text selects."""
    import duckdb

    for t in oracle.TABLES:
        path = f"{folder}/{t}.parquet"
        if t in tables:
            duckdb.connect().sql(f"COPY ({tables[t]}) TO '{path}' (FORMAT parquet)")
        elif os.path.exists(f"{SF}/{t}.parquet"):
            os.symlink(f"{SF}/{t}.parquet", path)
    return oracle.compare(catalogue.queries()[query](spark, str(folder)), oracle.connect(str(folder)), catalogue.oracle_sql()[query])


def series(values: list[float]) -> str:
    """Events of one user, a minute apart."""
    return f"SELECT k AS event_id, TIMESTAMP '2024-01-01' + to_minutes(k) AS ts, 1 AS user_id, 'view' AS event_type, v[k] AS value, '{{}}' AS props FROM (SELECT CAST({values} AS DOUBLE[]) AS v), range(1, {len(values) + 1}) r(k)"


#: A percentile of its gradients lies one unit in the last place off where the product is rounded before the sum.
LIMIT_SERIES = [48.43, 102.5, 2.52, 41.07, 14.85, 24.92, 28.78, 3.02, 25.1, 13.98, 94.39, 58.77, 161.97, 40.67, 7.38, 122.02, 43.39, 61.08, 0.36, 74.22, 73.79, 22.72, 205.09, 35.77, 35.96, 68.94, 0.68, 6.0, 43.65, 35.24, 5.42, 2.86, 0.33, 58.1, 152.65, 50.9, 13.75, 73.23, 13.0, 133.42, 69.85, 205.17, 109.72, 98.94, 39.2, 4.7, 48.77, 24.91, 82.25, 145.85, 148.85, 64.75, 25.3, 1.25, 100.85, 64.34, 168.38, 104.5, 216.31, 127.55, 40.71, 30.65, 52.09, 27.08, 3.25, 20.05, 28.81, 174.64]


def test_gradient_peaks_at_the_limit(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_gradient_peaks", events=series(LIMIT_SERIES)) == ""


def test_spaced_peaks_at_the_limit(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_spaced_peaks", events=series(LIMIT_SERIES)) == ""


#: Values that equal a fence once quartiles are rounded to six decimals.
FENCE_SERIES = [3.28, 19.65, 67.6, 36.49, 86.73, 71.52, 62.36, 10.35, 42.09, 22.65, 94.81, 27.35, 53.96, 57.66, 24.12, 2.23, 23.78, 3.69, 22.54, 26.18, 25.01, 3.07, 4.92, 112.61, 0.03, 45.64, 233.9, 0.29, 19.05, 21.87, 22.92, 43.6, 33.76, 134.47, 1.31, 52.4, 66.15, 71.31, 2.5, 10.1, 58.03, 27.29, 9.12, 27.33, 100.48, 39.53, 3.98, 46.18, 116.92, 15.12, 23.3, 121.19, 17.91, 20.05, 10.44, 229.95, 103.46, 26.0, 9.02, 64.14, 41.18, 121.68, 53.59, 5.02, 8.58, 3.16]
BOX_SERIES = [9.77, 62.71, 20.9, 33.0, 25.98, 15.95, 0.89, 11.18, 13.94, 19.51, 5.76, 182.34, 18.87, 105.19, 37.66, 27.43, 0.66, 5.03, 4.46, 40.15, 38.77, 50.17, 45.27, 44.17, 25.4, 49.93, 19.17, 56.31, 38.21, 32.81, 31.42, 19.82, 38.57, 9.26, 79.36, 10.05, 4.83, 3.24, 86.39, 37.28, 84.94, 12.1, 105.46, 59.55, 192.1, 31.99, 50.06, 15.8, 80.36, 10.19, 32.12, 10.84, 44.66, 21.34, 0.82, 17.57, 127.49, 0.6, 7.69, 21.58, 108.45, 38.3, 76.17, 10.87, 39.16, 91.97, 4.96]


def test_regimes_on_the_fence(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_regimes_cv", events=series(FENCE_SERIES)) == ""


def test_outliers_on_the_fence(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_outliers", events=series(BOX_SERIES)) == ""


def test_boxplot_on_the_fence(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_boxplot", events=series(BOX_SERIES)) == ""


#: The power at a quarter is 257805.445.
HALF_SERIES = [77.37, 66.54, 128.13, 25.38, 89.19, 41.62, 31.33, 33.61, 48.93, 0.86, 28.18, 6.74, 22.91, 33.37, 1.14, 28.23, 12.3, 78.01, 10.09, 58.15, 122.33, 89.23, 35.24, 5.12, 38.68, 73.63, 46.72, 34.24, 20.27, 164.42, 28.53, 7.36, 14.89, 3.17, 62.08, 126.6, 54.08, 64.94, 8.51, 7.66, 70.11, 123.32, 17.51, 23.65, 19.49, 30.07, 11.03, 2.79, 9.04, 13.87, 17.44, 25.33, 53.17, 184.89, 49.89, 100.62, 10.27, 12.46, 34.86, 10.57]


def test_power_that_is_half_of_a_decimal(spark, tmp_path):
    assert differs(spark, tmp_path, "curve_spectrum", events=series(HALF_SERIES)) == ""


def test_equal_moments_take_the_first_row(spark, tmp_path):
    lines = "SELECT k // 2 AS l_orderkey, 1 AS l_partkey, 1 AS l_suppkey, 1 AS l_linenumber, 5.0 AS l_quantity, 1.0 AS l_extendedprice, 0.02 AS l_discount, 0.0 AS l_tax, CASE WHEN k % 4 IN (0, 3) THEN 'R' ELSE 'A' END AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP '1996-01-01' AS l_shipdate FROM range(300) r(k)"
    assert differs(spark, tmp_path, "reviewed_items", lineitem=lines) == ""


def test_equal_moments_take_the_first_of_several_files(spark, tmp_path):
    import duckdb

    lines = "SELECT k // 4 AS l_orderkey, 1 AS l_partkey, 1 AS l_suppkey, 1 AS l_linenumber, 5.0 AS l_quantity, 1.0 AS l_extendedprice, 0.02 AS l_discount, 0.0 AS l_tax, CASE WHEN k % 4 IN (0, 3) THEN 'R' ELSE 'A' END AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP '1996-01-01' AS l_shipdate FROM range(400) r(k)"
    parts, whole = tmp_path / "parts", tmp_path / "whole"
    (parts / "lineitem.parquet").mkdir(parents=True)
    whole.mkdir()
    for i, order in enumerate(("k", "-k")):  # the second file has at its top what the first has at its end
        duckdb.connect().sql(f"COPY (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER () AS k FROM ({lines})) WHERE k % 4 {'< 2' if i == 0 else '>= 2'} ORDER BY {order}) TO '{parts}/lineitem.parquet/part-{i}.parquet' (FORMAT parquet)")
    duckdb.connect().sql(f"COPY (FROM read_parquet(['{parts}/lineitem.parquet/part-0.parquet', '{parts}/lineitem.parquet/part-1.parquet'])) TO '{whole}/lineitem.parquet' (FORMAT parquet)")
    for t in oracle.TABLES:
        for folder in (parts, whole):
            if t != "lineitem" and os.path.exists(f"{SF}/{t}.parquet"):
                os.symlink(f"{SF}/{t}.parquet", folder / f"{t}.parquet")
    assert oracle.compare(catalogue.queries()["reviewed_items"](spark, str(parts)), oracle.connect(str(whole)), catalogue.oracle_sql()["reviewed_items"]) == ""


def test_checkpoint_times_have_no_trailing_zeros(spark, tmp_path):
    for i, moment in enumerate(("2024-03-01 10:00:00.25", "2024-03-01 10:00:00")):
        (own := tmp_path / str(i)).mkdir()
        assert differs(spark, own, "last_checkpoint", events=f"SELECT k AS event_id, TIMESTAMP '{moment}' AS ts, 1 AS user_id, 'view' AS event_type, 1.0 AS value, '{{\"k\": ' || k || '}}' AS props FROM range(9) r(k)") == ""
