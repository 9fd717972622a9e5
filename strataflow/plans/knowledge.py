"""Document, fact, graph and search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knowledge as k
from ..sources import html
from .adapters import table
from .registry import query


@query("canonical_urls", r"""WITH a AS (SELECT page_id AS id, regexp_replace(regexp_replace(trim(url), '[#?].*$', ''), '/+$', '') AS url, sha256(html) AS sha FROM pages)
  SELECT id, url, sha, CASE WHEN id > min(id) OVER (PARTITION BY sha) THEN 'duplicate_exact' WHEN id > min(id) OVER (PARTITION BY url) THEN 'duplicate_url' ELSE 'new' END AS decision FROM a""")
def canonical_urls(spark, sf_dir):
    return k.artifacts(table(spark, sf_dir, "pages"), "page_id", "url", F.col("html").cast("binary"))


@query("exact_duplicates", "SELECT sha256(text) AS sha, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf_dir):
    return k.duplicate_groups(table(spark, sf_dir, "documents"), "doc_id", F.col("text").cast("binary"))


@query("fragments", r"""WITH p AS (SELECT doc_id, unnest(range(len(parts))) AS place, trim(unnest(parts)) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
  SELECT doc_id, place, sha256(doc_id || '|paragraph|' || (place + 1) || '|' || lower(trim(regexp_replace(part, '\s+', ' ', 'g'))) || '|||||' || (place + 1)) AS hash FROM p WHERE part <> ''""")
def fragments(spark, sf_dir):
    return k.fragments(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "place", "hash")


@query("sections", r"""WITH p AS (SELECT doc_id, unnest(range(len(parts))) AS place, trim(unnest(parts)) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
  SELECT doc_id, place, last_value(CASE WHEN length(part) < 20 THEN place END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY place) AS section FROM p WHERE part <> ''""")
def sections(spark, sf_dir):
    parts = k.fragments(table(spark, sf_dir, "documents"), "doc_id", "text")
    return k.section_of(parts, "doc_id", "place", F.length("part") < 20).select("doc_id", "place", "section")


@query("tags_numbers_ranges", "SELECT doc_id, CAST(unnest(range(len(f))) AS BIGINT) AS place, unnest(f) AS token FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)?') AS f FROM documents)")
def tags_numbers_ranges(spark, sf_dir):
    return k.tokens(table(spark, sf_dir, "documents"), "doc_id", "text", "[0-9]+(?:[.,][0-9]+)?")


TERMS = {"the": "article", "and": "conjunction", "der": "article", "une": "article", "los": "article", "worthless": "insult"}


@query("lexicon_mentions", """WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-zà-ÿ0-9]+')) AS term FROM documents)
  SELECT doc_id, term, count(*) AS n, CASE term WHEN 'and' THEN 'conjunction' WHEN 'worthless' THEN 'insult' ELSE 'article' END AS kind FROM w WHERE term IN ('the','and','der','une','los','worthless') GROUP BY ALL""")
def lexicon_mentions(spark, sf_dir):
    return k.term_counts(table(spark, sf_dir, "documents"), "doc_id", "text", TERMS)


@query("line_cooccurrence", r"""WITH p AS (SELECT doc_id, unnest(range(len(parts))) AS place, trim(unnest(parts)) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
  f AS (SELECT doc_id, place, regexp_extract_all(part, '[0-9]+') AS a, regexp_extract_all(part, '[A-Z][a-z]{9,}') AS b FROM p WHERE part <> '')
  SELECT doc_id, place, a, unnest(b) AS b FROM (SELECT doc_id, place, unnest(a) AS a, b FROM f)""")
def line_cooccurrence(spark, sf_dir):
    lines = k.fragments(table(spark, sf_dir, "documents"), "doc_id", "text")
    find = lambda p: F.regexp_extract_all(F.col("part"), F.lit(p), F.lit(0))
    return k.line_pairs(lines, "doc_id", find("[0-9]+"), find("[A-Z][a-z]{9,}"))


@query("recurring_patterns", "SELECT source, lang, count(DISTINCT doc_id) AS subjects, count(*) AS n FROM documents GROUP BY source, lang HAVING count(DISTINCT doc_id) >= 2")
def recurring_patterns(spark, sf_dir):
    return k.recurring(table(spark, sf_dir, "documents"), ["source", "lang"], "doc_id")


@query("conflict_sets", """WITH v AS (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS m, count(DISTINCT l_linestatus) AS d, min(l_linestatus) AS lo, max(l_linestatus) AS hi FROM lineitem GROUP BY ALL)
  SELECT l_partkey, l_suppkey, CAST(sum(m) AS BIGINT) AS members, CASE WHEN max(d) = 1 THEN 'split' ELSE 'review' END AS decision FROM v GROUP BY ALL HAVING sum(m) > 1 AND min(lo) <> max(hi)""")
def conflict_sets(spark, sf_dir):
    return k.conflicts(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "l_linestatus", "l_returnflag")


@query("fact_versions", """WITH b AS (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders), c AS (SELECT * FROM b WHERE p IS NULL OR p <> o_orderstatus)
  SELECT o_custkey, o_orderstatus, row_number() OVER w AS version, CAST(o_orderdate AS VARCHAR) AS since, CAST(lead(o_orderdate) OVER w AS VARCHAR) AS until FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def fact_versions(spark, sf_dir):
    found = k.versions(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus")
    as_text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return found.select("o_custkey", "o_orderstatus", "version", as_text("since"), as_text("until"))


@query("assertion_validation", """SELECT doc_id, CASE WHEN toxic = 1 OR n_chars / 2000.0 < 0.5 THEN 'REJECTED' WHEN quality = 0 THEN 'CANDIDATE' ELSE 'SUPPORTED' END AS status FROM documents JOIN labels USING (doc_id)""")
def assertion_validation(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    reason = F.when(F.col("toxic") == 1, "Incompatible content")
    return rows.select("doc_id", k.assertion_status(F.col("n_chars") / 2000.0, reason, F.when(F.col("quality") == 0, 1).otherwise(0)).alias("status"))


def _graph(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = t("nation").select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst"), F.lit("in_region").alias("kind"))
    edges = edges.union(t("supplier").select(name("s", "s_suppkey"), name("n", "s_nationkey"), F.lit("in_nation")))
    return edges.union(t("customer").select(name("c", "c_custkey"), name("n", "c_nationkey"), F.lit("in_nation")))


EDGES_SQL = "edges AS (SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst, 'in_region' AS kind FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'in_nation' FROM supplier UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'in_nation' FROM customer)"


@query("graph_build_counts", f"WITH {EDGES_SQL} SELECT kind, count(*) AS edges, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets FROM edges GROUP BY kind")
def graph_build_counts(spark, sf_dir):
    return k.edge_counts(_graph(spark, sf_dir))


@query("graph_bfs", f"""WITH RECURSIVE {EDGES_SQL}, sides AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges), b AS (SELECT 'r0' AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM b JOIN sides ON src = node WHERE depth < 3)
  SELECT node, CAST(min(depth) AS BIGINT) AS depth FROM b GROUP BY node""")
def graph_bfs(spark, sf_dir):
    found = k.breadth_first(_graph(spark, sf_dir), spark.createDataFrame([("r0",)], "node string"), 3)
    return found.select("node", F.col("depth").cast("long").alias("depth"))


@query("graph_neighbors", f"WITH {EDGES_SQL} SELECT dst AS node, kind, count(*) AS neighbors FROM edges GROUP BY ALL")
def graph_neighbors(spark, sf_dir):
    return k.neighbour_counts(_graph(spark, sf_dir))


@query("search_like", "SELECT doc_id, source FROM documents WHERE lower(text) LIKE '%lic%se%' AND source <> '' ORDER BY doc_id LIMIT 20")
def search_like(spark, sf_dir):
    return k.search_like(table(spark, sf_dir, "documents"), "doc_id", "text", "lic%se", 20).select("doc_id", "source")


@query("search_ranked", """WITH s AS (SELECT p_partkey, CASE WHEN lower(p_name) = 'small' THEN 100 WHEN lower(p_brand) = 'small' THEN 90 WHEN lower(p_type) = 'small' THEN 80
  WHEN contains(lower(p_name || ' ' || p_brand), 'small') THEN 70 ELSE 0 END AS score FROM part)
  SELECT p_partkey, CAST(score AS BIGINT) AS score FROM s WHERE score > 0 ORDER BY score DESC, p_partkey LIMIT 25""")
def search_ranked(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    score = k.relevance(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.concat_ws(" ", "p_name", "p_brand"), "small")
    return part.select("p_partkey", score.cast("long").alias("score")).filter("score > 0").orderBy(F.desc("score"), "p_partkey").limit(25)


@query("reprocess_state", """WITH d AS (SELECT sha256(text) AS sha, min(CASE WHEN lang = 'en' THEN doc_id END) AS en, min(doc_id) AS any_id, count(*) AS n FROM documents GROUP BY 1)
  SELECT coalesce(en, any_id) AS doc_id, n, count(l.doc_id) AS labels, count(DISTINCT l.quality) AS grades FROM d LEFT JOIN labels l ON l.doc_id = coalesce(en, any_id) GROUP BY 1, 2""")
def reprocess_state(spark, sf_dir):
    return k.reprocess_state(table(spark, sf_dir, "documents"), "doc_id", F.col("text").cast("binary"), F.col("lang") == "en", table(spark, sf_dir, "labels"), "doc_id", "quality")


@query("run_counts", "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY GROUPING SETS ((source), (lang), ())")
def run_counts(spark, sf_dir):
    return k.counts_by(table(spark, sf_dir, "documents"), ["source", "lang"], "n_chars", "chars")


@query("lifecycle_violations", """WITH c AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'SUPPORTED' ELSE 'CANDIDATE' END AS before, CASE WHEN toxic = 1 THEN 'REJECTED' ELSE 'ACCEPTED' END AS after FROM labels)
  SELECT * FROM c WHERE before = 'CANDIDATE' AND after = 'ACCEPTED'""")
def lifecycle_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "SUPPORTED").otherwise("CANDIDATE").alias("before"), F.when(F.col("toxic") == 1, "REJECTED").otherwise("ACCEPTED").alias("after"))
    return k.invalid_transitions(rows, "before", "after")


@query("graph_trace", f"""WITH RECURSIVE {EDGES_SQL}, sides AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges), b AS (SELECT 'r0' AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM b JOIN sides ON src = node WHERE depth < 2)
  SELECT src, dst, kind FROM edges WHERE src IN (SELECT node FROM b) AND dst IN (SELECT node FROM b)""")
def graph_trace(spark, sf_dir):
    return k.trace(_graph(spark, sf_dir), spark.createDataFrame([("r0",)], "node string"), 2)[1]


def _projected(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    text = lambda c: F.col(c).cast("string")
    attributes = lambda *pairs: F.create_map(*(x for name, c in pairs for x in (F.lit(name), c)))
    nations = t("nation").select(F.lit("nation").alias("kind"), text("n_nationkey").alias("external_id"), attributes(("name", F.col("n_name"))).alias("attributes"))
    entities = nations.union(nations).union(t("customer").select(F.lit("customer"), text("c_custkey"), attributes(("segment", F.col("c_mktsegment")), ("name", F.col("c_name")))))
    relations = t("customer").select(F.lit("lives_in").alias("kind"), F.lit("customer").alias("source_kind"), text("c_custkey").alias("source_id"), F.lit("nation").alias("target_kind"), (F.col("c_nationkey") * 2).cast("string").alias("target_id"), attributes(("since", F.lit("1"))).alias("attributes"))
    return k.graph_projection(entities, relations)


@query("projected_nodes", """SELECT kind, external_id, sha256(json) AS signature FROM (SELECT 'nation' AS kind, n_nationkey || '' AS external_id, '{"name":"' || n_name || '"}' AS json FROM nation UNION ALL SELECT 'customer', c_custkey || '', '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' FROM customer)""")
def projected_nodes(spark, sf_dir):
    return _projected(spark, sf_dir)[0].select("kind", "external_id", "signature")


@query("projected_edges", "SELECT 'lives_in' AS kind, count(*) AS n, count(DISTINCT c_nationkey) AS targets FROM customer WHERE c_nationkey * 2 IN (SELECT n_nationkey FROM nation)")
def projected_edges(spark, sf_dir):
    return _projected(spark, sf_dir)[1].groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("dst").alias("targets"))


@query("search_documents", """SELECT 'variable' AS kind, p_partkey || '' AS source_id, 'variables-v1' AS index_name, concat_ws(' ', p_name, CASE WHEN p_size % 2 = 0 THEN p_brand END) AS index_text FROM part UNION ALL SELECT 'document', doc_id || '', 'documents-v1', coalesce(lang, '') || CASE WHEN lang IS NOT NULL AND source IS NOT NULL THEN ' ' ELSE '' END || coalesce(source, '') FROM documents""")
def search_documents(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.lit("variable").alias("kind"), F.col("p_partkey").cast("string").alias("source_id"), F.array("p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" ")).alias("parts"))
    docs = table(spark, sf_dir, "documents").select(F.lit("document"), F.col("doc_id").cast("string"), F.array(F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))))
    return k.search_documents(part.union(docs)).select("kind", "source_id", "index_name", "index_text")


@query("html_structure")
def html_structure(spark, sf_dir):
    return html.structure(table(spark, sf_dir, "pages"), "page_id", "html")


@query("html_elements", f"""SELECT p_partkey, CAST(unnest(range(7)) AS BIGINT) AS place, unnest(['title', 'heading2', 'paragraph', 'table_row', 'figure', 'link']) AS kind, unnest([p_name, p_type, p_size || '', '1|' || p_size, p_brand, 'l']) AS text FROM part""".replace("range(7)", "range(6)"))
def html_elements(spark, sf_dir):
    """Pages whose elements are known: text before a nested element isn't its own, and blank rows go."""
    join = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    size = F.col("p_size").cast("string")
    page = join("<title>", F.col("p_name"), "</title><h2>", F.col("p_type"), "</h2><p>a <b>x</b> ", size, "</p><table><caption>c</caption><tr><td>1</td><td>", size, "</td></tr><tr><td></td></tr></table><img alt='", F.col("p_brand"), "'><a href='/u'>l</a>")
    return html.structure(table(spark, sf_dir, "part").select("p_partkey", page.alias("page")), "p_partkey", "page").select("p_partkey", "place", "kind", "text")
