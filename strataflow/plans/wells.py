"""Well-identification queries: customers are wells, nations fields, orders log files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import wells
from .adapters import table
from .registry import query


def _letter(x) -> F.Column:
    return F.char((x % 26 + 65).cast("long"))


def sides(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, wells, fields): wells are named by their field's code, some with a letter, and files misspell them."""
    n, k = F.col("n_nationkey"), F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select(n, F.concat(_letter(n), _letter(n * 7 + 3), F.when(n % 3 == 0, "X").otherwise(""), F.when(n % 5 == 0, "Q").otherwise("")).alias("code"))
    fields = nation.select(n.alias("field_id"), F.concat(F.lit("El "), F.lower("code"), F.lit("al")).alias("name"), F.when(n % 7 != 6, F.col("code")).alias("code"))
    number = (k % 400).cast("string")
    name = F.concat("code", F.when(k % 9 == 4, ".").when(k % 9 == 5, " ").otherwise("-"), number, F.when(k % 4 == 1, "(H)").when(k % 4 == 3, "H").otherwise(""))
    named = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == n)  # 25 rows
    found = named.select(k.alias("well_id"), name.alias("name"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("field_id"), F.when(k % 11 == 0, F.concat(F.lit("ar-"), k.cast("string"))).alias("uwi"))
    o = F.col("o_orderkey")
    spelled = (
        F.when(o % 7 == 0, F.concat("code", F.lit("-"), number)).when(o % 7 == 1, F.concat("code", F.lit(" "), number, F.lit(" (H)"))).when(o % 7 == 2, F.concat("code", F.lit("/"), number, F.lit("H")))
        .when(o % 7 == 3, F.concat("code", F.lit("."), F.lower("code"), F.lit("-"), number)).when(o % 7 == 4, F.concat(F.lit("T/P "), "code", F.lit("é - "), number)).when(o % 7 == 5, F.lower(F.concat("code", F.lit("-"), number))).otherwise("sin numero")
    )
    files = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(named, F.col("o_custkey") == k).select(o.alias("file_id"), spelled.alias("name"), F.when(o % 13 == 0, F.concat(F.lit("AR-"), k.cast("string"))).alias("uwi"))
    return files, found, fields


@query("well_match")
def well_match(spark, sf_dir):
    return wells.identify_wells(*sides(spark, sf_dir)).select("file_id", "well_id", "method", F.round("score", 4).alias("score"))


@query("well_by_pattern")
def well_by_pattern(spark, sf_dir):
    return wells.wells_by_pattern(*sides(spark, sf_dir))


@query("well_match_by_words")
def well_match_by_words(spark, sf_dir):
    files, found, fields = sides(spark, sf_dir)
    return wells.identify_wells_by_words(files, found, fields.withColumnRenamed("name", "field")).withColumn("score", F.round("score", 4))


@query("well_entries", r"""SELECT p_partkey, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(upper(trim(x)), '^(T/P|T-P|C/D|C-D|[A-Z]{1,2}/[A-Z]{1,2})\s+', ''), '/', '-'), '[^A-Z0-9_\s.\-()]', '', 'g'), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')), '-+$', '') AS entry
  FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 't/p ' WHEN 1 THEN 'ab/C ' WHEN 2 THEN 'ABC/d ' ELSE '' END || p_brand || CASE p_size % 3 WHEN 0 THEN ' - ' WHEN 1 THEN '/7 --' ELSE '' END AS x FROM part)""")
def well_entries(spark, sf_dir):
    size = F.col("p_size")
    before = F.when(size % 4 == 0, "t/p ").when(size % 4 == 1, "ab/C ").when(size % 4 == 2, "ABC/d ").otherwise("")
    behind = F.when(size % 3 == 0, " - ").when(size % 3 == 1, "/7 --").otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", wells.refined_entry(F.concat(before, "p_brand", behind)).alias("entry"))
