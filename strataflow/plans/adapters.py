"""Views of the supplied tables in the shape that the operators expect, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, parts = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    facts = lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(parts.select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    money = lambda c: c.cast("decimal(18,4)")
    missing = (F.col("l_linenumber") == 1) & (F.col("l_tax") < 0.01)
    present = F.col("l_quantity") * (1 - F.col("l_tax") * 2)
    hours, seen = money(F.col("l_quantity")), money(F.when(missing, 0).otherwise(present))
    inside = money(F.when(missing, 0).otherwise(present * (1 - F.col("l_discount"))))
    outside, is_under, none = seen - inside, F.col("l_partkey") % 2 == 0, F.lit(0).cast("decimal(18,4)")
    return facts.select(
        F.col("l_suppkey").alias("rig_id"),
        F.col("o_custkey").alias("well_id"),
        F.to_date("l_shipdate").alias("date"),
        F.concat("p_type", F.lit("-"), "l_returnflag", "l_linestatus").alias("variable_name"),
        F.when(F.col("l_linenumber") <= 4, "SI").otherwise("NO").alias("requerido"),
        F.col("p_type").alias("tipo_variable"),
        F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, "psi").alias("unidad_pae"),
        F.when(F.col("p_size") % 2 == 0, "bar").otherwise("").alias("unidad_nov"),
        hours.alias("horas"),
        seen.alias("value_present"),
        (hours - seen).alias("value_null"),
        inside.alias("value_range_in"),
        F.when(is_under, outside).otherwise(none).alias("value_under_min"),
        F.when(is_under, none).otherwise(outside).alias("value_above_out"),
    )


def wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine of ten customers; facts of the others have a well that isn't known."""
    return table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def rigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("s_nationkey") % 3 == 0, "WO").when(F.col("s_nationkey") % 3 == 1, "PER").otherwise("PUL")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), kind.alias("rig_type"))


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series for each user: value by time."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("series"), "ts", F.col("event_id").alias("row"), F.col("event_type").alias("mnemonic"), "value")


QUALITY_SQL = """
quality_hours AS (
  SELECT *, horas - value_present AS value_null, CASE WHEN is_under THEN value_present - value_range_in ELSE 0 END AS value_under_min, CASE WHEN is_under THEN 0 ELSE value_present - value_range_in END AS value_above_out
  FROM (SELECT l_suppkey AS rig_id, o_custkey AS well_id, CAST(l_shipdate AS DATE) AS date,
         p_type || '-' || l_returnflag || l_linestatus AS variable_name,
         CASE WHEN l_linenumber <= 4 THEN 'SI' ELSE 'NO' END AS requerido, p_type AS tipo_variable,
         CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'psi' END AS unidad_pae, CASE p_size % 2 WHEN 0 THEN 'bar' ELSE '' END AS unidad_nov, l_partkey % 2 = 0 AS is_under,
         CAST(l_quantity AS DECIMAL(18,4)) AS horas,
         CAST(CASE WHEN l_linenumber = 1 AND l_tax < 0.01 THEN 0 ELSE l_quantity * (1 - l_tax * 2) END AS DECIMAL(18,4)) AS value_present,
         CAST(CASE WHEN l_linenumber = 1 AND l_tax < 0.01 THEN 0 ELSE l_quantity * (1 - l_tax * 2) * (1 - l_discount) END AS DECIMAL(18,4)) AS value_range_in
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)
), rigs AS (
  SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_nationkey % 3 = 0 THEN 'WO' WHEN s_nationkey % 3 = 1 THEN 'PER' ELSE 'PUL' END AS rig_type FROM supplier
), wells AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 10 <> 3)
"""
CURVE_SQL = "curve AS (SELECT user_id AS series, ts, event_id AS row, event_type AS mnemonic, value FROM events)"
