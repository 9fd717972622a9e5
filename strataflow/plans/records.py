"""Queries of cleaning, events, configurations and catalogue checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import records
from .adapters import rigs, table
from .registry import query


@query("without_blank", "SELECT p_partkey FROM part WHERE NOT (trim(CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_name END) = '' AND trim(CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END) = '')")
def without_blank(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.col("p_name")).alias("a"), F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("b"))
    return records.without_blank(part, ["a", "b"]).select("p_partkey")


@query("range_labels", """SELECT o_orderkey, o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' OR o_orderdate + INTERVAL 90 DAY BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' AS either,
  o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' AND o_orderdate + INTERVAL 90 DAY BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' AS both_ FROM orders""")
def range_labels(spark, sf_dir):
    at = F.col("o_orderdate")
    found = records.in_range_labels(at, at + F.expr("INTERVAL 90 DAYS"), F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").select("o_orderkey", found["either"].alias("either"), found["both"].alias("both_"))


_CELL_SQL = "CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%H:%M') WHEN 1 THEN (o_orderkey % 24) || ':' || (o_orderkey % 70) WHEN 2 THEN strftime(o_orderdate, '%d-%b-%y') WHEN 3 THEN '' WHEN 4 THEN ' 7-feb-68 ' WHEN 5 THEN o_orderpriority END"


def _cell():
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    return F.when(k % 7 == 0, F.date_format(at, "HH:mm")).when(k % 7 == 1, F.concat((k % 24).cast("string"), F.lit(":"), (k % 70).cast("string"))).when(k % 7 == 2, F.date_format(at, "dd-MMM-yy")).when(k % 7 == 3, "").when(k % 7 == 4, " 7-feb-68 ").when(k % 7 == 5, F.col("o_orderpriority"))


@query("record_times", f"""SELECT o_orderkey, CAST(CASE WHEN contains(trim(x), ':') AND length(trim(x)) <= 5 THEN try_strptime('2024-06-01 ' || trim(x), '%Y-%m-%d %H:%M') ELSE try_strptime(trim(x), '%d-%b-%y') END AS VARCHAR) AS at FROM (SELECT o_orderkey, {_CELL_SQL} AS x FROM orders)""")
def record_times(spark, sf_dir):
    at = records.record_time(_cell(), F.lit("2024-06-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("spud_dates", f"SELECT o_orderkey, strftime(try_strptime(trim({_CELL_SQL}), '%d-%b-%y'), '%Y-%m-%d') AS day FROM orders")
def spud_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.spud_date(F.trim(_cell())).alias("day"))


#: How DuckDB writes the spellings of dates.
_FORMATS = {s: s.replace("d", "%d").replace("m", "%m").replace("b", "%b").replace("Y", "%Y").replace("y", "%y").replace("T", "%H:%M:%S") for s in dates.SPELLINGS}
_JAVA = {"d": "d", "m": "M", "b": "MMM", "Y": "yyyy", "y": "yy", "T": "HH:mm:ss"}
_DATE_SQL = "CASE o_orderkey % 20 " + " ".join(f"WHEN {i} THEN strftime(t, '{f}')" for i, f in enumerate(_FORMATS.values())) + " WHEN 18 THEN '31/02/' || o_orderkey ELSE strftime(t, '%d/%m/%Y') || ' : start' END"
_TIMED_SQL = f"timed AS (SELECT o_orderkey, {_DATE_SQL} AS x FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS t FROM orders))"
_PARSE_SQL = "coalesce(" + ", ".join(f"CASE WHEN regexp_full_match(d, '{dates_pattern}') THEN try_strptime(d, '{f}') END" for f, dates_pattern in ((f, "".join({"d": r"\d{1,2}", "m": r"\d{1,2}", "b": "[A-Za-z]{3}", "Y": r"\d{4}", "y": r"\d{2}", "T": r"\d{1,2}:\d{1,2}:\d{1,2}"}.get(c, c) for c in s)) for s, f in _FORMATS.items())) + ")"


def _dated(spark, sf_dir):
    k = F.col("o_orderkey")
    at = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86400).cast("decimal(18,6)"))
    found = F.when(k % 20 == 18, F.concat(F.lit("31/02/"), k.cast("string")))
    for i, s in enumerate(dates.SPELLINGS):
        found = found.when(k % 20 == i, F.date_format(at, "".join(_JAVA.get(c, c) for c in s)))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.otherwise(F.concat(F.date_format(at, "dd/MM/yyyy"), F.lit(" : start"))).alias("x"))


@query("date_parsing", f"WITH {_TIMED_SQL} SELECT o_orderkey, CAST({_PARSE_SQL} AS VARCHAR) AS at FROM (SELECT o_orderkey, trim(split_part(x, ' : ', 1)) AS d FROM timed)")
def date_parsing(spark, sf_dir):
    return _dated(spark, sf_dir).select("o_orderkey", F.date_format(dates.parsed(F.col("x")), "yyyy-MM-dd HH:mm:ss").alias("at"))


_NAME_SQL = "'RIG' || o_custkey || CASE o_orderkey % 6 WHEN 0 THEN '_' || strftime(o_orderdate, '%d-%m-%Y') || '_1' WHEN 1 THEN '_' || strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN '_99-99-2024_20240131' WHEN 3 THEN '_18991231' WHEN 4 THEN strftime(o_orderdate, '_%d_%m_%Y') ELSE '' END || '.las'"
_NAMED_SQL = r"""CASE WHEN regexp_matches(name, '\d{2}[-_]\d{2}[-_]\d{4}') THEN try_strptime(replace(regexp_extract(name, '(\d{2}[-_]\d{2}[-_]\d{4})', 1), '_', '-'), '%d-%m-%Y')
  WHEN CAST(nullif(regexp_extract(name, '(?:^|\D)(\d{4})\d{4}(?:\D|$)', 1), '') AS INT) BETWEEN 1900 AND 2030 THEN try_strptime(regexp_extract(name, '(?:^|\D)(\d{8})(?:\D|$)', 1), '%Y%m%d') END"""


def _file_name():
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    middle = F.when(k % 6 == 0, F.concat(F.lit("_"), F.date_format(at, "dd-MM-yyyy"), F.lit("_1"))).when(k % 6 == 1, F.concat(F.lit("_"), F.date_format(at, "yyyyMMdd"))).when(k % 6 == 2, "_99-99-2024_20240131").when(k % 6 == 3, "_18991231").when(k % 6 == 4, F.date_format(at, "_dd_MM_yyyy")).otherwise("")
    return F.concat(F.lit("RIG"), F.col("o_custkey").cast("string"), middle, F.lit(".las"))


@query("dates_in_names", f"SELECT o_orderkey, CAST(CAST({_NAMED_SQL} AS DATE) AS VARCHAR) AS day FROM (SELECT o_orderkey, {_NAME_SQL} AS name FROM orders)")
def dates_in_names(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.date_in_name(_file_name(), F.lit(2030)).cast("string").alias("day"))


@query("reference_dates", f"""WITH {_TIMED_SQL}, n AS (SELECT o_orderkey, {_NAME_SQL} AS name FROM orders), p AS (SELECT o_orderkey, name, {_PARSE_SQL} AS found FROM (SELECT o_orderkey, name, trim(split_part(x, ' : ', 1)) AS d FROM timed JOIN n USING (o_orderkey)))
  SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderkey % 3 = 0 THEN CAST(found AS DATE) END, CAST({_NAMED_SQL} AS DATE), CASE WHEN o_orderkey % 3 = 1 THEN CAST(found AS DATE) END, DATE '2025-01-01') AS VARCHAR) AS day FROM p""")
def reference_dates(spark, sf_dir):
    rows = _dated(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", _file_name().alias("name")), "o_orderkey")
    at = lambda i: F.when(F.col("o_orderkey") % 3 == i, F.col("x"))
    return rows.select("o_orderkey", dates.reference_date(at(0), F.col("name"), at(1), F.lit("2025-01-01").cast("date")).cast("string").alias("day"))


@query("sample_times", """SELECT event_id, CAST(CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '2025-07-28' + to_seconds(event_id * 5) ELSE date_trunc('second', ts) END AS VARCHAR) AS at FROM events""")
def sample_times(spark, sf_dir):
    day, clock = F.date_format("ts", "dd/MMM/yyyy"), F.date_format("ts", "HH:mm:ss")
    at = dates.sample_time(F.when(F.col("event_id") % 8 != 0, day).otherwise("nan"), F.when(F.col("event_id") % 8 != 4, clock), F.lit("2025-07-28").cast("timestamp"), F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("download_suffixes", "SELECT o_orderkey, CASE WHEN d < 0 THEN 'NO_DOWNLOAD_MIN_DATE_TOO_RECENT' WHEN d = 0 THEN '_nws' ELSE '_' || d END AS suffix, strftime(o_orderdate, '%d-%b-%y') AS day FROM (SELECT *, DATE '1998-06-15' - CAST(o_orderdate AS DATE) AS d FROM orders)")
def download_suffixes(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.download_suffix(F.to_date("o_orderdate"), F.lit("1998-06-15").cast("date")).alias("suffix"), dates.page_day(F.col("o_orderdate")).alias("day"))


@query("name_variants", """WITH p AS (SELECT s_suppkey, 'LMC' AS c, CAST(s_suppkey AS VARCHAR) AS n, CASE WHEN s_suppkey % 2 = 0 THEN 'H' END AS s, CASE WHEN s_suppkey % 3 = 0 THEN 'PZ' END AS f FROM supplier),
  e AS (SELECT *, unnest(CASE WHEN s IS NULL THEN [n] ELSE [n, n || s, n || '(' || s || ')', n || ' (' || s || ')'] END) AS e FROM p),
  v AS (SELECT s_suppkey, c || '-' || e AS v FROM e UNION SELECT s_suppkey, c || ' ' || e FROM e UNION SELECT s_suppkey, c || '.' || s || '-' || n FROM p WHERE s IS NOT NULL
    UNION SELECT s_suppkey, f || '.' || c || '-' || e FROM e WHERE f IS NOT NULL UNION SELECT s_suppkey, f || '.' || lower(c) || '-' || e FROM e WHERE f IS NOT NULL UNION SELECT s_suppkey, f || '.' || unnest([c, lower(c)]) || ' ' || n FROM p WHERE f IS NOT NULL)
  SELECT s_suppkey, string_agg(v, '|' ORDER BY v) AS variants FROM v GROUP BY s_suppkey""")
def name_variants(spark, sf_dir):
    key = F.col("s_suppkey")
    found = records.name_variants(F.lit("LMC"), key.cast("string"), F.when(key % 2 == 0, "H"), F.when(key % 3 == 0, "PZ"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(found, "|").alias("variants"))


@query("event_cascade", """WITH r AS (SELECT s_suppkey AS rig_id, CASE WHEN s_nationkey % 3 = 0 THEN 'WO' WHEN s_nationkey % 3 = 1 THEN 'PER' ELSE 'PUL' END AS kind FROM supplier),
  a AS (SELECT l_suppkey AS rig_id, max(l_orderkey) AS a FROM lineitem WHERE l_quantity > 49 AND l_tax > 0.075 GROUP BY 1), b AS (SELECT l_suppkey AS rig_id, max(l_orderkey) AS b FROM lineitem WHERE l_quantity > 48 AND l_discount > 0.095 GROUP BY 1)
  SELECT rig_id, coalesce(a, b) AS event_id, CASE WHEN a IS NOT NULL THEN 'active' WHEN b IS NOT NULL THEN 'report' ELSE 'placeholder' END AS origin,
  CASE kind WHEN 'PER' THEN 1 WHEN 'PUL' THEN 8 ELSE 7 END AS type_event, CASE kind WHEN 'PER' THEN 'P' WHEN 'PUL' THEN 'R' ELSE 'W' END AS letter FROM r LEFT JOIN a USING (rig_id) LEFT JOIN b USING (rig_id)""")
def event_cascade(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("rig_id"), F.col("l_orderkey").alias("event_id"), "l_quantity", "l_tax", "l_discount")
    files = rigs(spark, sf_dir).select(F.col("id").alias("rig_id"), "rig_type")
    found = records.event_cascade(files, lines.filter("l_quantity > 49 and l_tax > 0.075D"), lines.filter("l_quantity > 48 and l_discount > 0.095D"), ["rig_id"])
    type_, letter = records.placeholder_event(F.col("rig_type"))
    return found.select("rig_id", "event_id", "origin", type_.alias("type_event"), letter.alias("letter"))


@query("configuration", """WITH f AS (SELECT p_brand, p_type, CASE WHEN p_size > 10 THEN 'W' || p_size END AS a, 'R' || p_size % 20 AS b FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1)
  SELECT DISTINCT p_brand, p_type, unnest([a, b]) AS mnemonic FROM f""".replace("SELECT DISTINCT p_brand, p_type, unnest([a, b]) AS mnemonic FROM f", "SELECT DISTINCT p_brand, p_type, mnemonic FROM (SELECT p_brand, p_type, unnest([a, b]) AS mnemonic FROM f) WHERE mnemonic IS NOT NULL"))
def configuration(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumns({"a": F.when(F.col("p_size") > 10, F.concat(F.lit("W"), F.col("p_size").cast("string"))), "b": F.concat(F.lit("R"), (F.col("p_size") % 20).cast("string"))})
    return records.configuration(part, "p_brand", "p_type", "a", "b", ["p_partkey"])


@query("ambiguous_aliases", "SELECT lower(trim(p_name)) AS alias, p_brand, count(DISTINCT p_partkey) AS meanings FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_partkey) > 1")
def ambiguous_aliases(spark, sf_dir):
    return records.ambiguous_aliases(table(spark, sf_dir, "part"), "p_name", "p_brand", "p_partkey")


@query("last_checkpoint", "WITH r AS (SELECT json_extract_string(props, '$.k') AS value, ts FROM events) SELECT arg_max(value, ts) AS value, CAST(max(ts) AS VARCHAR) AS at FROM r WHERE value IS NOT NULL")
def last_checkpoint(spark, sf_dir):
    found = records.last_checkpoint(table(spark, sf_dir, "events"), "props", "$.k", "ts", F.col("_metadata.row_index"))
    return found.select("value", F.col("at").cast("string").alias("at"))


@query("hierarchy_problems", """WITH h AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN p_partkey + 1 WHEN p_partkey % 10 = 2 THEN p_partkey - 1 WHEN p_partkey % 10 = 3 THEN -1 ELSE p_partkey - 1 END AS p FROM part)
  SELECT k AS key, 'unknown_parent' AS problem FROM h WHERE p IS NOT NULL AND p NOT IN (SELECT k FROM h) UNION ALL SELECT a.k, 'cycle' FROM h a JOIN h b ON a.p = b.k AND b.p = a.k""")
def hierarchy_problems(spark, sf_dir):
    key = F.col("p_partkey")
    parent = F.when(key % 10 == 0, None).when(key % 10 == 1, key + 1).when(key % 10 == 2, key - 1).when(key % 10 == 3, F.lit(-1)).otherwise(key - 1)
    return records.hierarchy_problems(table(spark, sf_dir, "part").select("p_partkey", parent.alias("parent")), "p_partkey", "parent")


@query("synonym_problems")
def synonym_problems(spark, sf_dir):
    sets = table(spark, sf_dir, "part").select("p_partkey", F.array("p_type", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.col("p_brand"))).alias("terms"))
    return records.synonym_problems(sets, "p_partkey", "terms")
