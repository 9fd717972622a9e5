"""Queries of mentions, scalings and references in fragments that describe parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import extraction as x
from .adapters import table
from .registry import query

_TEXT_SQL = """CASE p_size % 4 WHEN 0 THEN 'The Mud Pump P-' || p_partkey || '_A of Model XK-' || p_size || ' reads Hook Load 0 to ' || p_size * 10 || ' klbf, see Figure ' || p_size % 5 || ', fig. ' || p_size % 5 || ' and figure ' || p_size % 5 || '.'
  WHEN 1 THEN p_name || ': 4 mA = 0 psi, 20 MA = ' || p_size || '.5 PSI; 7 counts = ' || p_size || ' rpm (Table 2.1, section ' || p_size || '). Emerson Pressure Transmitter 4-20 mA'
  WHEN 2 THEN 'Standpipe Pressure (SPP) also called ' || p_name || ' ' || p_size || '; Formula: y = x * ' || p_size || ' + 1. WITSML 1.4.1, API RP 13D, ID: ZZ-' || p_partkey || ' Document ISO 9001' ELSE p_name || ' ' || p_type || ' ' || p_size || '%' END"""


def fragments(spark, sf_dir) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    s, k = size.cast("string"), key.cast("string")
    five = (size % 5).cast("string")
    join = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    body = (
        F.when(size % 4 == 0, join("The Mud Pump P-", k, "_A of Model XK-", s, " reads Hook Load 0 to ", (size * 10).cast("string"), " klbf, see Figure ", five, ", fig. ", five, " and figure ", five, "."))
        .when(size % 4 == 1, join(F.col("p_name"), ": 4 mA = 0 psi, 20 MA = ", s, ".5 PSI; 7 counts = ", s, " rpm (Table 2.1, section ", s, "). Emerson Pressure Transmitter 4-20 mA"))
        .when(size % 4 == 2, join("Standpipe Pressure (SPP) also called ", F.col("p_name"), " ", s, "; Formula: y = x * ", s, " + 1. WITSML 1.4.1, API RP 13D, ID: ZZ-", k, " Document ISO 9001"))
        .otherwise(join(F.col("p_name"), " ", F.col("p_type"), " ", s, "%"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", body.alias("body"))


FRAGMENTS_SQL = f"f AS (SELECT p_partkey, p_brand, p_size, {_TEXT_SQL} AS body FROM part)"
_S = x.SCALING.replace("'", "''")
_R = x.REFERENCE


@query("mentions")
def mentions(spark, sf_dir):
    return x.mentions(fragments(spark, sf_dir), ["p_partkey"], "body").select("p_partkey", "start", "end", "kind", "rule", "confidence", "mention", "normalized", F.col("context.before").alias("before"), F.col("context.after").alias("after"))


@query("document_mentions")
def document_mentions(spark, sf_dir):
    return x.extraction_metrics(x.mentions(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text"), "doc_id")


SCALINGS_SQL = f"""{FRAGMENTS_SQL}, s AS (SELECT p_partkey, p_brand, unnest(range(1, len(o) + 1)) AS ordinal, unnest(o) AS original, unnest(a) AS raw_value, unnest(b) AS raw_unit, unnest(c) AS value, unnest(d) AS unit FROM (SELECT p_partkey, p_brand,
  regexp_extract_all(body, '{_S}', 0) AS o, regexp_extract_all(body, '{_S}', 1) AS a, regexp_extract_all(body, '{_S}', 2) AS b, regexp_extract_all(body, '{_S}', 3) AS c, regexp_extract_all(body, '{_S}', 4) AS d FROM f))"""


@query("explicit_scalings", f"WITH {SCALINGS_SQL} SELECT * EXCLUDE (p_brand) FROM s")
def explicit_scalings(spark, sf_dir):
    return x.scalings(fragments(spark, sf_dir), ["p_partkey"], "body")


_UNITS = [(1, "PSI"), (2, "rpm"), (3, "RPM"), (4, "klbf")]


@query("scaled_units", f"WITH {SCALINGS_SQL}, u AS (SELECT * FROM (VALUES {', '.join(map(str, _UNITS))}) t(unit_id, symbol)), k AS (SELECT lower(symbol) AS k, min(unit_id) AS unit_id, count(*) AS n FROM u GROUP BY 1) SELECT p_partkey, ordinal, unit_id, CASE WHEN n IS NULL THEN 'proposed' WHEN n > 1 THEN 'alternative' ELSE 'resolved' END AS status FROM s LEFT JOIN k ON k.k = lower(unit)")
def scaled_units(spark, sf_dir):
    return x.scaled_units(explicit_scalings(spark, sf_dir), spark.createDataFrame(_UNITS, "unit_id int, symbol string")).select("p_partkey", "ordinal", "unit_id", "status")


@query("composite_scalings", f"""WITH {SCALINGS_SQL}, g AS (SELECT p_partkey, lower(raw_unit) AS raw_unit, lower(unit) AS unit, count(*) AS points, min((CAST(raw_value AS DOUBLE), CAST(value AS DOUBLE))) AS lo, max((CAST(raw_value AS DOUBLE), CAST(value AS DOUBLE))) AS hi FROM s GROUP BY ALL),
  n AS (SELECT *, lo[1] AS x0, lo[2] AS y0, hi[1] AS x1, hi[2] AS y1 FROM g) SELECT p_partkey, raw_unit, unit, points, round((y1 - y0) / (x1 - x0), 9) AS factor, round(y0 - (y1 - y0) / (x1 - x0) * x0, 9) AS offset_ FROM n WHERE x0 < x1""")
def composite_scalings(spark, sf_dir):
    found = x.composite_scalings(explicit_scalings(spark, sf_dir), ["p_partkey"])
    return found.select("p_partkey", "raw_unit", "unit", "points", F.round("factor", 9).alias("factor"), F.round("offset", 9).alias("offset_"))


REFERENCES_SQL = f"""{FRAGMENTS_SQL}, r AS (SELECT p_partkey, p_brand, unnest(range(len(o))) AS ordinal, unnest(o) AS reference, unnest(k) AS k, unnest(n) AS number FROM (SELECT p_partkey, p_brand, regexp_extract_all(body, '{_R}', 0) AS o, regexp_extract_all(body, '{_R}', 1) AS k, regexp_extract_all(body, '{_R}', 2) AS n FROM f)),
  refs AS (SELECT p_partkey, p_brand, ordinal, reference, CASE WHEN lower(k) LIKE 'fig%' THEN 'figure' ELSE lower(k) END AS kind, number, row_number() OVER (PARTITION BY p_partkey, lower(reference) ORDER BY ordinal) - 1 AS occurrence FROM r)"""


@query("structural_references", f"WITH {REFERENCES_SQL} SELECT * EXCLUDE (p_brand) FROM refs")
def structural_references(spark, sf_dir):
    return x.references(fragments(spark, sf_dir), ["p_partkey"], "body")


@query("resolved_references", f"""WITH {REFERENCES_SQL}, t AS (SELECT p_brand, 'section' AS kind, regexp_extract(title, '^(\\d+(?:\\.\\d+)*)', 1) AS number, p_partkey AS target_id FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN p_size || ' ' || p_name WHEN p_size % 3 = 0 THEN p_size || 'x ' ELSE p_size || '.1: ' END AS title FROM part) WHERE regexp_matches(title, '^\\d+(?:\\.\\d+)*\\b')),
  g AS (SELECT p_brand, kind, number, max(target_id) AS target_id FROM t GROUP BY ALL) SELECT p_partkey, ordinal, refs.kind, refs.number, target_id FROM refs LEFT JOIN g USING (p_brand, kind, number)""")
def resolved_references(spark, sf_dir):
    size = F.col("p_size")
    title = F.when(size % 2 == 0, F.concat(size.cast("string"), F.lit(" "), "p_name")).when(size % 3 == 0, F.concat(size.cast("string"), F.lit("x "))).otherwise(F.concat(size.cast("string"), F.lit(".1: ")))
    sections = table(spark, sf_dir, "part").select("p_brand", "p_partkey", title.alias("title"))
    found = x.references(fragments(spark, sf_dir), ["p_partkey", "p_brand"], "body")
    return x.resolved_references(found, x.section_numbers(sections, "p_brand", "title", "p_partkey"), "p_brand").select("p_partkey", "ordinal", "kind", "number", "target_id")


@query("fragment_hashes", f"WITH {FRAGMENTS_SQL} SELECT p_partkey, sha256(p_brand || '|paragraph|' || p_partkey || '|' || lower(trim(regexp_replace(body, '\\s+', ' ', 'g'))) || '|' || p_size || '||||' || coalesce(CASE WHEN p_size % 2 = 0 THEN p_size || '' END, '')) AS hash FROM f")
def fragment_hashes(spark, sf_dir):
    size, none = F.col("p_size"), F.lit(None).cast("string")
    hash_ = x.fragment_hash(F.col("p_brand"), F.lit("paragraph"), F.col("p_partkey"), text.normal(F.col("body")), size, none, none, none, F.when(size % 2 == 0, size))
    return fragments(spark, sf_dir).select("p_partkey", hash_.alias("hash"))


@query("context_windows", f"WITH {FRAGMENTS_SQL}, p AS (SELECT p_partkey, body, strpos(lower(body), lower(' ' || p_size)) - 1 AS s, length(' ' || p_size) AS n FROM f) SELECT p_partkey, CASE WHEN s >= 0 THEN body[greatest(s - 40, 0) + 1:s] END AS before, CASE WHEN s >= 0 THEN body[s + 1:s + n] END AS match, CASE WHEN s >= 0 THEN body[s + n + 1:s + n + 40] END AS after FROM p")
def context_windows(spark, sf_dir):
    needle = F.concat(F.lit(" "), F.col("p_size").cast("string"))
    start = text.nth_start(F.col("body"), needle, F.lit(0))
    rows = fragments(spark, sf_dir).withColumn("s", start).withColumn("c", text.context(F.col("body"), F.col("s"), F.col("s") + F.length(needle)))
    return rows.select("p_partkey", "c.before", "c.match", "c.after")


@query("attribute_values", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type WHEN p_size % 3 = 1 THEN p_name END AS value FROM part")
def attribute_values(spark, sf_dir):
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    size = F.col("p_size") % 3
    pairs = F.array(pair(F.when(size < 2, "unit").otherwise("other"), F.col("p_name")), pair(F.when(size == 0, "unit").otherwise("x"), F.col("p_type")), pair(F.lit("brand"), F.col("p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", x.attribute_value(pairs, "unit").alias("value"))


@query("summaries", "SELECT p_partkey, concat_ws(' ', nullif(trim(CASE WHEN p_size % 2 = 0 THEN p_name ELSE ' ' END), ''), p_type, CASE WHEN p_size % 3 = 0 THEN p_brand END) AS summary, array_to_string(CASE WHEN p_size % 2 = 0 THEN [upper(p_name)] ELSE [upper(p_type), upper(p_brand)] END, ' ') AS half FROM part")
def summaries(spark, sf_dir):
    size = F.col("p_size")
    half = text.without_half(F.when(size % 2 == 0, F.concat_ws("  ", "p_name", "p_name")).otherwise(F.concat_ws(" ", "p_type", "p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", text.summary(F.when(size % 2 == 0, F.col("p_name")).otherwise(" "), F.col("p_type"), F.when(size % 3 == 0, F.col("p_brand"))).alias("summary"), half.alias("half"))
