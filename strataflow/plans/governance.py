"""Queries of consolidation, integrity, review, registries, plans and explanations over stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance as g
from .adapters import table
from .registry import query


def _t(spark, sf_dir, name, *columns):
    return table(spark, sf_dir, name).select(*columns)


@query("conflict_decisions", """WITH v AS (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS m, min(l_linestatus) AS lo, max(l_linestatus) AS hi, count_if(l_quantity > 45) AS a, max(CASE WHEN l_quantity > 45 THEN l_linestatus END) AS w FROM lineitem GROUP BY ALL),
  s AS (SELECT l_partkey, l_suppkey, CAST(sum(m) AS BIGINT) AS members, min(lo) AS lo, max(hi) AS hi, bool_and(lo = hi) AS split, sum(a) AS a, max(w) AS w FROM v GROUP BY ALL)
  SELECT l_partkey, l_suppkey, members, CASE WHEN split THEN 'split_by_version' WHEN a = 1 THEN 'accepted_wins' ELSE 'review' END AS decision, CASE WHEN NOT split AND a = 1 THEN w END AS winner FROM s WHERE members > 1 AND lo <> hi""")
def conflict_decisions(spark, sf_dir):
    return g.conflict_decisions(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "l_linestatus", "l_returnflag", F.col("l_quantity") > 45)


_FACTS_SQL = "a AS (SELECT o_custkey AS claim, o_orderpriority AS value FROM orders WHERE o_orderstatus = 'F'), e AS (SELECT c_custkey AS claim, c_nationkey AS version, CASE WHEN c_custkey % 3 = 0 THEN (SELECT string_agg(DISTINCT value, '|' ORDER BY value) FROM a WHERE a.claim = c_custkey) ELSE 'old' END AS signature FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_custkey AS claim FROM customer WHERE c_custkey % 7 = 0)"


@query("fact_changes", f"""WITH {_FACTS_SQL}, n AS (SELECT claim, string_agg(DISTINCT value, '|' ORDER BY value) AS signature FROM a GROUP BY 1), j AS (SELECT coalesce(n.claim, e.claim) AS claim, n.signature AS s, e.signature AS t, version AS v FROM n FULL JOIN e ON n.claim = e.claim WHERE e.claim IS NULL OR e.signature IS NOT NULL OR n.claim IS NOT NULL OR true),
  k AS (SELECT j.*, CASE WHEN j.claim IN (SELECT claim FROM b) THEN 'blocked' WHEN s IS NULL THEN 'invalidate' WHEN v IS NULL THEN 'create' WHEN s = t THEN 'reuse' ELSE 'supersede' END AS action FROM j) SELECT claim, action, CAST(CASE action WHEN 'create' THEN 1 WHEN 'supersede' THEN v + 1 ELSE v END AS BIGINT) AS version, coalesce(s, t) AS signature FROM k""")
def fact_changes(spark, sf_dir):
    accepted = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("claim"), F.col("o_orderpriority").alias("value"))
    now = accepted.groupBy("claim").agg(F.array_join(F.array_sort(F.collect_set("value")), "|").alias("s"))
    key = F.col("c_custkey")
    active = table(spark, sf_dir, "customer").filter(key % 2 == 0).select(key.alias("claim"), F.col("c_nationkey").alias("version")).join(now, "claim", "left")
    active = active.select("claim", "version", F.when(F.col("claim") % 3 == 0, F.col("s")).otherwise("old").alias("signature"))
    return g.fact_changes(accepted, active, _t(spark, sf_dir, "customer", key.alias("claim")).filter("claim % 7 = 0"), "claim", "value")


@query("integrity_problems", """WITH f AS (SELECT p_partkey AS fact, p_brand || p_type AS claim, p_size AS version, p_size > 40 AS active FROM part) SELECT DISTINCT claim AS subject, 'duplicate_version' AS problem FROM (SELECT claim FROM f GROUP BY claim, version HAVING count(*) > 1) UNION ALL SELECT claim, 'multiple_active' FROM f WHERE active GROUP BY 1 HAVING count(*) > 1
  UNION ALL SELECT fact || '', 'missing_support' FROM f WHERE fact NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""")
def integrity_problems(spark, sf_dir):
    facts = _t(spark, sf_dir, "part", F.col("p_partkey").alias("fact"), F.concat("p_brand", "p_type").alias("claim"), F.col("p_size").alias("version"), (F.col("p_size") > 40).alias("active"))
    return g.integrity_problems(facts, table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("fact")), "claim", "fact")


_ITEMS_SQL = "i AS (SELECT o_orderkey AS item, o_custkey AS target, CASE o_orderstatus WHEN 'P' THEN 'open' ELSE 'approved' END AS state FROM orders), d AS (SELECT l_orderkey AS item, CASE WHEN l_returnflag = 'R' THEN 'reject' WHEN l_returnflag = 'A' THEN 'approve' ELSE 'defer' END AS decision, l_linenumber * 1000 + l_quantity * 10 + l_discount AS moment FROM lineitem WHERE l_linenumber < 3)"


def _items(spark, sf_dir):
    return _t(spark, sf_dir, "orders", F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("target"), F.when(F.col("o_orderstatus") == "P", "open").otherwise("approved").alias("state"))


@query("review_items", f"WITH {_ITEMS_SQL} SELECT c_custkey AS target FROM customer WHERE c_custkey NOT IN (SELECT target FROM i WHERE state = 'open')")
def review_items(spark, sf_dir):
    return g.review_items(_t(spark, sf_dir, "customer", F.col("c_custkey").alias("target")), _items(spark, sf_dir), "target")


@query("reviewed_items", f"WITH {_ITEMS_SQL}, l AS (SELECT item, arg_max(decision, moment) AS decision FROM d WHERE decision <> 'defer' GROUP BY 1) SELECT item, CASE WHEN state = 'open' AND decision = 'approve' THEN 'approved' WHEN state = 'open' AND decision = 'reject' THEN 'rejected' ELSE state END AS state FROM i LEFT JOIN l USING (item)")
def reviewed_items(spark, sf_dir):
    flag = F.col("l_returnflag")
    moment = F.col("l_linenumber") * 1000 + F.col("l_quantity") * 10 + F.col("l_discount")
    place = F.struct("_metadata.file_path", "_metadata.row_index")  # of equal moments the first row of the first file
    decisions = table(spark, sf_dir, "lineitem").filter("l_linenumber < 3").select(F.col("l_orderkey").alias("item"), F.when(flag == "R", "reject").when(flag == "A", "approve").otherwise("defer").alias("decision"), moment.alias("at"), place.alias("place"))
    return g.reviewed(_items(spark, sf_dir), decisions, "item").select("item", "state")


@query("contradictions", "SELECT l_orderkey AS source, l_returnflag AS kind, count(DISTINCT l_suppkey) AS targets FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag IN ('R', 'A') GROUP BY 1, 2 HAVING count(DISTINCT l_suppkey) > 1")
def contradictions(spark, sf_dir):
    relations = _t(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("source"), F.col("l_returnflag").alias("kind"), F.col("l_suppkey").alias("target"), (F.col("l_linestatus") == "O").alias("active"))
    return g.contradictions(relations, ["R", "A"])


_REGISTRY_SQL = """e AS (SELECT 'p' || p_partkey AS id, lower(p_type) AS kind, CASE WHEN p_size % 3 > 0 THEN 'u' || p_size % 3 END AS unit FROM part UNION ALL SELECT 's' || s_suppkey, 'supplier', 'u' || s_nationkey % 2 + 1 FROM supplier), r AS (SELECT DISTINCT 'p' || l_partkey AS source, CASE WHEN l_linenumber < 4 THEN 'made_by' ELSE 'sold_by' END AS kind, 's' || l_suppkey + CASE WHEN l_quantity > 49 THEN 100000 ELSE 0 END AS target FROM lineitem WHERE l_quantity > 30),
  s AS (SELECT * FROM (VALUES ('small', 'made_by', 'supplier'), ('large', 'sold_by', 'supplier'), ('promo', 'made_by', 'supplier')) t(sk, k, tk))"""


def _registry(spark, sf_dir):
    size = F.col("p_size") % 3
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    parts = _t(spark, sf_dir, "part", text("p", F.col("p_partkey")).alias("id"), F.lower("p_type").alias("kind"), F.when(size > 0, text("u", size)).alias("unit"))
    suppliers = _t(spark, sf_dir, "supplier", text("s", F.col("s_suppkey")), F.lit("supplier"), text("u", F.col("s_nationkey") % 2 + 1))
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 30")
    relations = lines.select(text("p", F.col("l_partkey")).alias("source"), F.when(F.col("l_linenumber") < 4, "made_by").otherwise("sold_by").alias("kind"), text("s", F.col("l_suppkey") + F.when(F.col("l_quantity") > 49, 100000).otherwise(0)).alias("target")).distinct()
    shapes = spark.createDataFrame([("small", "made_by", "supplier"), ("large", "sold_by", "supplier"), ("promo", "made_by", "supplier")], "source_kind string, kind string, target_kind string")
    return parts.union(suppliers), relations, shapes, spark.createDataFrame([("small", "made_by"), ("large", "sold_by")], "entity_kind string, kind string")


@query("registry_problems", f"""WITH {_REGISTRY_SQL} SELECT source || ':' || r.kind || ':' || target AS subject, CASE WHEN a.id IS NULL OR b.id IS NULL THEN 'unknown_end' WHEN sk IS NULL THEN 'shape_not_allowed' ELSE 'unit_mismatch' END AS problem FROM r LEFT JOIN e a ON a.id = source LEFT JOIN e b ON b.id = target LEFT JOIN s ON sk = a.kind AND k = r.kind AND tk = b.kind WHERE a.id IS NULL OR b.id IS NULL OR sk IS NULL OR a.unit <> b.unit
  UNION ALL SELECT id || ':' || q, 'missing_relation' FROM e JOIN (VALUES ('small', 'made_by'), ('large', 'sold_by')) t(n, q) ON n = kind WHERE NOT EXISTS (SELECT 1 FROM r WHERE source = id AND r.kind = q)""")
def registry_problems(spark, sf_dir):
    return g.registry_problems(*_registry(spark, sf_dir))


_RECIPES = [("MEDIUM", ["find", "trace", "explain"]), ("SMALL", ["find"]), ("LARGE", ["find", "compare"])]


@query("question_plans", "WITH r AS (SELECT * FROM (VALUES ('MEDIUM', ['find', 'trace', 'explain']), ('SMALL', ['find']), ('LARGE', ['find', 'compare'])) t(q, s)), x AS (SELECT p_partkey AS question, unnest(range(1, len(s) + 1)) AS sequence, s FROM part JOIN r ON q = p_type) SELECT question, sequence, s[sequence] AS stage, CASE WHEN sequence > 1 THEN s[sequence - 1] END AS follows FROM x")
def question_plans(spark, sf_dir):
    return g.plan_of(_t(spark, sf_dir, "part", F.col("p_partkey").alias("question"), F.col("p_type").alias("question_type")), spark.createDataFrame(_RECIPES, "question_type string, stages array<string>"))


_EXPLAINED_SQL = "x AS (SELECT o_orderkey AS explanation, o_custkey AS target FROM orders WHERE o_orderkey % 5 > 0), p AS (SELECT l_orderkey AS explanation, l_linenumber || '' AS code, CASE WHEN l_linenumber = 1 THEN o_custkey ELSE l_suppkey * 3 END AS fact FROM lineitem JOIN orders ON o_orderkey = l_orderkey), f AS (SELECT c_custkey AS fact FROM customer WHERE c_custkey % 4 > 0)"


@query("explanation_problems", f"""WITH {_EXPLAINED_SQL} SELECT explanation || '' AS subject, 'target_missing' AS problem FROM x WHERE target NOT IN (SELECT fact FROM f) UNION ALL SELECT code, 'orphan_part' FROM p WHERE explanation NOT IN (SELECT explanation FROM x) UNION ALL SELECT code, 'unknown_fact' FROM p WHERE fact NOT IN (SELECT fact FROM f)
  UNION ALL SELECT code, 'code_not_unique' FROM p GROUP BY explanation, code HAVING count(*) > 1 UNION ALL SELECT explanation || '', 'target_not_covered' FROM x WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.explanation = x.explanation AND p.fact = x.target)""")
def explanation_problems(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("explanation"), F.col("l_linenumber").cast("string").alias("code"), F.when(F.col("l_linenumber") == 1, F.col("o_custkey")).otherwise(F.col("l_suppkey") * 3).alias("fact"))
    explained = orders.filter("o_orderkey % 5 > 0").select(F.col("o_orderkey").alias("explanation"), F.col("o_custkey").alias("target"))
    return g.explanation_problems(explained, parts, _t(spark, sf_dir, "customer", F.col("c_custkey").alias("fact")).filter("fact % 4 > 0"))


@query("workflow_counts", """WITH s AS (SELECT l_orderkey AS run, l_linenumber AS step, min(l_returnflag) AS name, count(*) AS outputs FROM lineitem GROUP BY 1, 2), i AS (SELECT *, coalesce(lag(outputs) OVER (PARTITION BY run ORDER BY step), 0) AS inputs FROM s)
  SELECT run, step, name, CASE WHEN step < 4 THEN inputs ELSE 0 END AS inputs, CASE WHEN step < 4 THEN outputs ELSE 0 END AS outputs, CASE WHEN step < 4 THEN 'COMPLETED' WHEN step = 4 THEN 'AWAITING_REVIEW' ELSE 'PENDING' END AS state FROM i""")
def workflow_counts(spark, sf_dir):
    steps = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("step")).agg(F.min("l_returnflag").alias("name"), F.count("*").alias("outputs"))
    return g.workflow_counts(steps, 4)


@query("stale_runs", "SELECT event_id AS run, CASE WHEN event_type = 'view' AND date_sub('hour', ts, TIMESTAMP '2024-01-20') >= 24 THEN 'failed' WHEN event_type = 'view' THEN 'running' ELSE 'done' END AS state FROM events")
def stale_runs(spark, sf_dir):
    runs = _t(spark, sf_dir, "events", F.col("event_id").alias("run"), F.when(F.col("event_type") == "view", "running").otherwise("done").alias("state"), F.col("ts").alias("started"))
    return g.stale_runs(runs, F.lit("2024-01-20").cast("timestamp_ntz"), 24).select("run", "state")


@query("unmatched_mentions", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def unmatched_mentions(spark, sf_dir):
    return g.unmatched(_t(spark, sf_dir, "customer", "c_custkey"), table(spark, sf_dir, "orders").filter("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("sole_approved", "SELECT o_custkey, CASE WHEN n = 1 THEN one END AS o_orderkey, CASE n WHEN 0 THEN 'none' WHEN 1 THEN 'approved' ELSE 'several' END AS status FROM (SELECT o_custkey, count_if(o_orderstatus = 'P') AS n, max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS one FROM orders GROUP BY 1)")
def sole_approved(spark, sf_dir):
    return g.sole_approved(_t(spark, sf_dir, "orders", "o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "P", "approved").otherwise("open").alias("state")), "o_custkey", "o_orderkey")


@query("schema_rows", """WITH b AS (SELECT p_brand, p_size % 5 AS t, p_partkey, p_name, p_type FROM part) SELECT p_brand, t AS "table", CASE t WHEN 0 THEN 'attribute' WHEN 1 THEN 'relationship' WHEN 2 THEN 'derived_from' END AS kind, p_name AS name, CASE WHEN t = 0 THEN p_type END AS type, CASE WHEN t = 1 THEN p_type END AS target FROM b WHERE t < 3""")
def schema_rows(spark, sf_dir):
    t = F.col("p_size") % 5
    body = _t(spark, sf_dir, "part", "p_brand", t.alias("table"), (F.col("p_partkey") + 2).alias("row"), F.array("p_name", F.concat(F.lit(" "), "p_type")).alias("cells"))
    title = F.when(t == 0, "Attribute name").when(t == 1, " Relationships").when(t == 2, "Derived From").otherwise("x")
    heads = _t(spark, sf_dir, "part", "p_brand", t.alias("table"), F.lit(1).cast("long").alias("row"), F.array(title, F.lit("b")).alias("cells")).distinct()
    return g.schema_rows(heads.union(body), "p_brand", "table", "row", "cells")
