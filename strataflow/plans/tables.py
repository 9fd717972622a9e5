"""Queries of filters, look-ups, updates and table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import records, relational
from .adapters import table
from .registry import query


def _t(spark, sf_dir, name, *columns):
    return table(spark, sf_dir, name).select(*columns)


@query("stale_rows", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def stale_rows(spark, sf_dir):
    active = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return relational.not_in_column(_t(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), active, "o_custkey").select("o_orderkey")


@query("with_ids_of", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 48)")
def with_ids_of(spark, sf_dir):
    return relational.with_ids_of(_t(spark, sf_dir, "part", "p_partkey"), "p_partkey", table(spark, sf_dir, "lineitem").filter("l_quantity > 48"), "l_partkey")


@query("update_join", "SELECT c_custkey, CASE WHEN s_name IS NOT NULL THEN s_name ELSE c_name END AS c_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey AND s_nationkey <> c_nationkey")
def update_join(spark, sf_dir):
    on = [F.col("s.s_suppkey") == F.col("t.c_custkey"), F.col("s.s_nationkey") != F.col("t.c_nationkey")]
    return relational.updated(_t(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey"), table(spark, sf_dir, "supplier"), on, "c_name", "s_name").drop("c_nationkey")


@query("found_in_list", "SELECT p_partkey, EXISTS (SELECT 1 FROM part b WHERE b.p_size > 40 AND lower(trim(b.p_name)) = lower(trim(a.p_name)) AND b.p_brand = a.p_brand) AS found FROM part a")
def found_in_list(spark, sf_dir):
    part = _t(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    listed = part.filter("p_size > 40").select(F.concat(F.lit(" "), F.upper("p_name")).alias("p_name"), "p_brand")
    return relational.found_in_list(part, ["p_name", "p_brand"], listed).select("p_partkey", "found")


@query("joined_first_rows", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 25 ORDER BY l_orderkey, l_linenumber, l_partkey, p_name LIMIT 20")
def joined_first_rows(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").join(table(spark, sf_dir, "part").filter("p_size > 25"), F.col("l_partkey") == F.col("p_partkey"), "left")
    order = [F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("p_name")]
    return relational.first_rows(rows, order, 20).select("l_orderkey", "l_linenumber", "p_name")


@query("using_join", "SELECT doc_id, lang, quality FROM labels JOIN documents USING (doc_id)")
def using_join(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents", "doc_id", "lang"), "doc_id").select("doc_id", "lang", "quality")


_HOSTS_SQL = "SELECT CASE page_id % 4 WHEN 0 THEN 'https://docs.example.com/' WHEN 1 THEN 'http://example.com.evil.org/' WHEN 2 THEN 'ftp://example.com/' ELSE 'https://Other.net/' END || page_id AS url FROM pages"


def _hosts(spark, sf_dir):
    key = F.col("page_id")
    host = F.when(key % 4 == 0, "https://docs.example.com/").when(key % 4 == 1, "http://example.com.evil.org/").when(key % 4 == 2, "ftp://example.com/").otherwise("https://Other.net/")
    return _t(spark, sf_dir, "pages", F.concat(host, key.cast("string")).alias("url"))


@query("allowed_urls", f"SELECT url, regexp_matches(url, '^https?://([^/]*\\.)?(example\\.com|other\\.net)/', 'i') AS allowed FROM ({_HOSTS_SQL})")
def allowed_urls(spark, sf_dir):
    return _hosts(spark, sf_dir).select("url", relational.allowed_url(F.col("url"), ["example.com", "other.net"]).alias("allowed"))


@query("discovered_urls", f"SELECT DISTINCT url FROM ({_HOSTS_SQL}) WHERE regexp_matches(url, '^https?://([^/]*\\.)?example\\.com/') ORDER BY url LIMIT 50")
def discovered_urls(spark, sf_dir):
    return relational.discovered(_hosts(spark, sf_dir), "url", ["example.com"], 50)


@query("resumed_urls", f"SELECT url FROM ({_HOSTS_SQL}) WHERE url > 'https://d' ORDER BY url LIMIT 30")
def resumed_urls(spark, sf_dir):
    return relational.after(_hosts(spark, sf_dir), "url", "https://d", 30)


_STATE_SQL = "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'PENDIENTE' WHEN 'O' THEN 'OK' END AS state, o_custkey % 3 = 0 AS active, CASE WHEN o_custkey % 2 = 0 THEN o_custkey % 10 END AS tenant FROM orders"


def _states(spark, sf_dir):
    status, key = F.col("o_orderstatus"), F.col("o_custkey")
    return _t(spark, sf_dir, "orders", "o_orderkey", F.when(status == "F", "PENDIENTE").when(status == "O", "OK").alias("state"), (key % 3 == 0).alias("active"), F.when(key % 2 == 0, key % 10).alias("tenant"))


@query("pending_rows", f"SELECT o_orderkey, 'listed' AS kind FROM ({_STATE_SQL}) WHERE state IN ('PENDIENTE', NULL) UNION ALL SELECT o_orderkey, 'or null' FROM ({_STATE_SQL}) WHERE state = 'PENDIENTE' OR state IS NULL")
def pending_rows(spark, sf_dir):
    found = [relational.pending(_states(spark, sf_dir), "state", ["PENDIENTE"], n).select("o_orderkey", F.lit(k).alias("kind")) for n, k in ((False, "listed"), (True, "or null"))]
    return found[0].union(found[1])


@query("own_or_global", f"SELECT o_orderkey FROM ({_STATE_SQL}) WHERE active AND (tenant = 4 OR tenant IS NULL)")
def own_or_global(spark, sf_dir):
    return relational.own_or_global(_states(spark, sf_dir), "tenant", 4, "active").select("o_orderkey")


@query("same_text", "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON upper(replace(s_name, 'Supplier', 'x')) = upper(replace(c_name, 'Customer', 'X'))")
def same_text(spark, sf_dir):
    s, c = _t(spark, sf_dir, "supplier", "s_suppkey", F.replace("s_name", F.lit("Supplier"), F.lit("x")).alias("a")), _t(spark, sf_dir, "customer", "c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("X")).alias("b"))
    return s.join(c, relational.same_text(F.col("a"), F.col("b"))).select("s_suppkey", "c_custkey")


@query("clock_cells", "SELECT event_id, regexp_matches(x, '^[0-9]{2}:[0-9]{2}$') AS is_clock FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%H:%M') WHEN 1 THEN strftime(ts, '%H:%M:%S') ELSE event_type END AS x FROM events)")
def clock_cells(spark, sf_dir):
    key = F.col("event_id")
    x = F.when(key % 3 == 0, F.date_format("ts", "HH:mm")).when(key % 3 == 1, F.date_format("ts", "HH:mm:ss")).otherwise(F.col("event_type"))
    return _t(spark, sf_dir, "events", "event_id", x.rlike("^[0-9]{2}:[0-9]{2}$").alias("is_clock"))


@query("largest_like", "SELECT max(o_orderdate)::VARCHAR AS value FROM orders WHERE o_orderpriority LIKE '_-HI%'")
def largest_like(spark, sf_dir):
    return relational.largest_match(table(spark, sf_dir, "orders"), "_-HI%", "o_orderpriority", "o_orderdate").select(F.date_format("value", "yyyy-MM-dd HH:mm:ss").alias("value"))


@query("best_of_sources", "WITH r AS (SELECT s_nationkey AS k, s_acctbal AS score, 0 AS turn, s_suppkey AS id FROM supplier UNION ALL SELECT c_nationkey, c_acctbal, 1, c_custkey FROM customer) SELECT k, max(score) AS score FROM r GROUP BY k")
def best_of_sources(spark, sf_dir):
    s, c = _t(spark, sf_dir, "supplier", F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("score")), _t(spark, sf_dir, "customer", F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("score"))
    return relational.best_of([s, c], "k", "score")


@query("counted_since", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND nullif(user_id % 4, 0) IS NOT NULL GROUP BY 1")
def counted_since(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("mapped", F.nullif(F.col("user_id") % 4, F.lit(0)))
    return relational.counted_since(rows, "ts", F.lit("2024-01-05").cast("timestamp_ntz"), "mapped", "event_type")


@query("lineage_versions", "SELECT page_id, row_number() OVER (PARTITION BY url ORDER BY page_id) AS version FROM pages")
def lineage_versions(spark, sf_dir):
    return relational.lineage_versions(_t(spark, sf_dir, "pages", "page_id", "url"), "url", ["page_id"]).select("page_id", "version")


@query("latest_normalised", "SELECT DISTINCT ON (upper(trim(p_name))) upper(trim(p_name)) AS p_name, p_partkey FROM part ORDER BY upper(trim(p_name)), p_size DESC, p_partkey DESC")
def latest_normalised(spark, sf_dir):
    rows = _t(spark, sf_dir, "part", F.concat(F.when(F.col("p_size") % 2 == 0, " ").otherwise(""), "p_name").alias("p_name"), "p_partkey", "p_size")
    return relational.latest_of(rows, ["p_name"], [F.desc("p_size"), F.desc("p_partkey")]).select("p_name", "p_partkey")


_SIDES_SQL = "t AS (SELECT p_partkey, p_name, p_size FROM part WHERE p_size < 30), s AS (SELECT p_partkey, upper(p_name) AS p_name, p_size FROM part WHERE p_size > 20)"


def _sides(spark, sf_dir):
    part = _t(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    return part.filter("p_size < 30"), part.filter("p_size > 20").withColumn("p_name", F.upper("p_name"))


@query("upserted_rows", f"WITH {_SIDES_SQL} SELECT * FROM t WHERE p_partkey NOT IN (SELECT p_partkey FROM s) UNION ALL SELECT * FROM s")
def upserted_rows(spark, sf_dir):
    return relational.upserted(*_sides(spark, sf_dir), "p_partkey")


@query("inserted_rows", f"WITH {_SIDES_SQL} SELECT * FROM t UNION ALL SELECT * FROM s WHERE p_partkey NOT IN (SELECT p_partkey FROM t)")
def inserted_rows(spark, sf_dir):
    return relational.inserted(*_sides(spark, sf_dir), "p_partkey")


@query("replaced_rows", "SELECT p_partkey, NULL::VARCHAR AS p_name, p_size FROM part WHERE p_size > 20")
def replaced_rows(spark, sf_dir):
    target, source = _sides(spark, sf_dir)
    return relational.replaced(target, source.drop("p_name"))


@query("file_names", "SELECT page_id, lower(list_last(string_split('/In/' || page_id || '/' || CASE page_id % 2 WHEN 0 THEN 'A_b.LAS' ELSE url END, '/'))) AS name FROM pages")
def file_names(spark, sf_dir):
    path = F.concat(F.lit("/In/"), F.col("page_id").cast("string"), F.lit("/"), F.when(F.col("page_id") % 2 == 0, "A_b.LAS").otherwise(F.col("url")))
    return _t(spark, sf_dir, "pages", "page_id", text.file_name(path).alias("name"))


@query("placeholder_ids")
def placeholder_ids(spark, sf_dir):
    return _t(spark, sf_dir, "part", "p_partkey", records.placeholder_id(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))).alias("event_id"))


@query("report_events", """WITH r AS (SELECT o_orderkey AS report_id, 'E' || o_custkey AS event_key, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '7' ELSE '8' END AS event_code, o_orderdate AS start_date FROM orders)
  SELECT event_key, report_id, CAST(event_code AS INT) AS type_event, CASE event_code WHEN '1' THEN 'P' WHEN '7' THEN 'W' ELSE 'R' END AS letter FROM r WHERE event_key NOT IN (SELECT 'E' || s_suppkey FROM supplier) QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY start_date DESC, report_id DESC) = 1""")
def report_events(spark, sf_dir):
    status = F.col("o_orderstatus")
    reports = _t(spark, sf_dir, "orders", F.col("o_orderkey").alias("report_id"), F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("event_key"), F.when(status == "F", "1").when(status == "O", "7").otherwise("8").alias("event_code"), F.col("o_orderdate").alias("start_date"))
    events = _t(spark, sf_dir, "supplier", F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("event_key"))
    return records.report_events(reports, events).select("event_key", "report_id", "type_event", "letter")


@query("download_windows", "SELECT l_suppkey, coalesce(max(CASE WHEN l_tax > 0.02 THEN l_shipdate END), TIMESTAMP '2001-06-15')::VARCHAR AS since, coalesce(max(CASE WHEN l_discount > 0.09 THEN l_shipdate END), TIMESTAMP '2001-06-15')::VARCHAR AS until FROM lineitem GROUP BY 1")
def download_windows(spark, sf_dir):
    at = F.col("l_shipdate")
    rows = _t(spark, sf_dir, "lineitem", "l_suppkey", F.when(F.col("l_tax") > 0.02, at).alias("a"), F.when(F.col("l_discount") > 0.09, at).alias("b"))
    found = records.download_window(rows, "l_suppkey", "a", "b", F.lit("2001-06-15 10:00:00").cast("timestamp_ntz"))
    return found.select("l_suppkey", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("since", "until")))


@query("newest_files", "SELECT o_custkey, arg_max('f' || o_orderkey, (o_orderdate, 'f' || o_orderkey)) AS path FROM orders GROUP BY 1")
def newest_files(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders", "o_custkey", F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("path"), "o_orderdate")
    return records.newest_file(rows, "o_custkey", "path", "o_orderdate")


@query("plan_steps", "SELECT l_orderkey, l_linenumber, row_number() OVER w AS sequence, lag(l_linenumber) OVER w AS follows FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)")
def plan_steps(spark, sf_dir):
    return records.plan_steps(_t(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").distinct(), "l_orderkey", "l_linenumber")


@query("queue_transitions", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'OK' ELSE 'ERROR_' || upper(regexp_replace(o_orderpriority, '[^A-Za-z0-9]+', '_', 'g')) END AS state FROM orders")
def queue_transitions(spark, sf_dir):
    return records.queue_transition(_t(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))).select("o_orderkey", "state")


@query("canonical_json", """SELECT p_partkey, '{"brand":"' || p_brand || '","name":' || CASE WHEN p_size % 2 = 0 THEN '"' || p_name || '"' ELSE 'null' END || ',"size":' || p_size || '}' AS json FROM part""")
def canonical_json(spark, sf_dir):
    fields = {"size": F.col("p_size"), "name": F.when(F.col("p_size") % 2 == 0, F.col("p_name")), "brand": F.col("p_brand")}
    return _t(spark, sf_dir, "part", "p_partkey", records.canonical_json(fields).alias("json"))


@query("last_values", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_name END AS value, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 2 END AS keys FROM part")
def last_values(spark, sf_dir):
    pair = lambda k, v: F.struct(F.lit(k).alias("key") if isinstance(k, str) else k.alias("key"), F.col(v).alias("value"))
    pairs = F.array(pair("a", "p_name"), pair(F.when(F.col("p_size") % 2 == 0, "a").otherwise("b"), "p_type"))
    found = records.last_values(pairs)
    return _t(spark, sf_dir, "part", "p_partkey", F.try_element_at(found, F.lit("a")).alias("value"), F.size(found).alias("keys"))


@query("json_arrays", "SELECT conv_id, '[' || string_agg('\"' || role || '\"', ',' ORDER BY turn) || ']' AS roles, count(*) AS n FROM conversations GROUP BY 1")
def json_arrays(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    text_ = rows.select("conv_id", F.to_json(F.col("r.role")).alias("roles"))
    return text_.select("conv_id", "roles", F.size(F.from_json("roles", "array<string>")).cast("long").alias("n"))


@query("typed_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def typed_json(spark, sf_dir):
    return _t(spark, sf_dir, "events", "event_id", F.from_json("props", "k long")["k"].alias("k"))
