"""Selection, matching and synchronisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knowledge, relational
from .adapters import table
from .registry import query


@query("latest_snapshot", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_snapshot(spark, sf_dir):
    return relational.latest_snapshot(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "o_orderstatus")


@query("invalid_pairs_not_in", """SELECT c_custkey, c_nationkey FROM customer WHERE (c_custkey, c_nationkey) NOT IN
  (SELECT o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F')""")
def invalid_pairs_not_in(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    used = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_nationkey")
    return relational.not_in_pairs(customers, used, ["c_custkey", "c_nationkey"])


SOURCE_SQL = "s AS (SELECT p_partkey, p_name, CASE WHEN p_brand LIKE '%1' THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_size <> 11), t AS (SELECT p_partkey, p_name, p_size, p_brand FROM part WHERE p_size <> 13)"


def _sync_sides(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    source = part.filter("p_size <> 11").select("p_partkey", "p_name", F.when(F.col("p_brand").like("%1"), F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"))
    return source, part.filter("p_size <> 13").select("p_partkey", "p_name", "p_size", "p_brand")


@query("sync_diff", f"""WITH {SOURCE_SQL} SELECT p_partkey, CASE WHEN t.p_name IS NULL THEN 'insert' WHEN s.p_name IS NULL THEN 'delete' ELSE 'update' END AS action
  FROM s FULL JOIN t USING (p_partkey) WHERE t.p_name IS NULL OR s.p_name IS NULL OR s.p_size <> t.p_size OR s.p_name <> t.p_name""")
def sync_diff(spark, sf_dir):
    return relational.sync_changes(*_sync_sides(spark, sf_dir), "p_partkey")


@query("sync_result", f"WITH {SOURCE_SQL} SELECT s.p_partkey, s.p_name, s.p_size, t.p_brand FROM s LEFT JOIN t USING (p_partkey)")
def sync_result(spark, sf_dir):
    return relational.synced(*_sync_sides(spark, sf_dir), "p_partkey")


@query("latest_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, sf_dir):
    found = relational.first_by(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return found.select("o_custkey", "o_orderkey", "o_totalprice")


@query("interval_nearest_event", """SELECT a.o_orderkey, b.o_orderkey AS event_key FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderstatus = 'O' AND a.o_orderkey <> b.o_orderkey
  AND abs(date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))) <= 15 WHERE a.o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate DESC, b.o_orderkey DESC) = 1""")
def interval_nearest_event(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    left = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    right = orders.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("event_key"), F.col("o_custkey").alias("event_cust"), F.col("o_orderdate").alias("event_date"))
    pairs = relational.nearest_in_band(left, right, "o_custkey", "event_cust", "o_orderdate", "event_date", 15).filter("o_orderkey <> event_key")
    return relational.first_by(pairs, ["o_orderkey"], [F.desc("event_date"), F.desc("event_key")]).select("o_orderkey", "event_key")


@query("or_join_rewrite", """SELECT c_custkey, s_suppkey FROM customer JOIN (SELECT s_suppkey, s_nationkey AS a, s_suppkey % 25 AS b FROM supplier) ON c_nationkey = a OR c_nationkey = b""")
def or_join_rewrite(spark, sf_dir):
    side = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("a"), (F.col("s_suppkey") % 25).alias("b"))
    return relational.either_key_join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("n")), side, "n", ["a", "b"]).select("c_custkey", "s_suppkey")


@query("state_share", "SELECT coalesce(o_orderstatus, 'NULL') AS state, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 2) AS pct FROM orders GROUP BY 1")
def state_share(spark, sf_dir):
    return relational.state_shares(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("insert_if_missing", "SELECT p_partkey, p_type FROM part WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_partkey)")
def insert_if_missing(spark, sf_dir):
    present = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"))
    return relational.missing_rows(table(spark, sf_dir, "part").select("p_partkey", "p_type"), present, ["p_partkey"])


@query("provenance_join", """SELECT DISTINCT r_name, n_name, c_mktsegment, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey WHERE lower(p_type) LIKE '%pressure%' OR l_quantity > 45""")
def provenance_join(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).filter(F.contains(F.lower("p_type"), F.lit("pressure")) | (F.col("l_quantity") > 45))
    chain = [(t("orders"), "l_orderkey", "o_orderkey"), (t("customer"), "o_custkey", "c_custkey"), (t("nation"), "c_nationkey", "n_nationkey"), (t("region"), "n_regionkey", "r_regionkey")]
    return knowledge.chained(lines, chain, ["r_name", "n_name", "c_mktsegment", "o_orderstatus"])
