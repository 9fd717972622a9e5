"""Documents to fragments, mentions, assertions, conflicts, versioned facts, graphs and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import session, text, values
from . import extraction

#: Allowed changes of an assertion's state.
TRANSITIONS = [("CANDIDATE", "SUPPORTED"), ("CANDIDATE", "REJECTED"), ("SUPPORTED", "ACCEPTED"), ("SUPPORTED", "REJECTED"), ("SUPPORTED", "INVALIDATED"), ("SUPPORTED", "SUPERSEDED"), ("ACCEPTED", "INVALIDATED"), ("ACCEPTED", "SUPERSEDED")]


def artifacts(df: DataFrame, key: str, url: str, content: Column) -> DataFrame:
    """Each artifact's canonical address, hash, and whether an earlier one has its content or its address.

    The earliest key of each hash and address is an aggregate, joined back, so no group is sorted in one task.
    """
    rows = df.select(F.col(key).alias("id"), text.canonical_url(F.col(url)).alias("url"), F.sha2(content, 256).alias("sha"))
    by_sha = rows.groupBy("sha").agg(F.min("id").alias("first_sha"))
    by_url = rows.groupBy("url").agg(F.min("id").alias("first_url"))
    decision = F.when(F.col("id") > F.col("first_sha"), "duplicate_exact").when(F.col("id") > F.col("first_url"), "duplicate_url").otherwise("new")
    return rows.join(by_sha, "sha").join(by_url, "url").select("id", "url", "sha", decision.alias("decision"))


def duplicate_groups(df: DataFrame, key: str, content: Column) -> DataFrame:
    groups = df.groupBy(F.sha2(content, 256).alias("sha")).agg(F.min(key).alias("first"), F.count("*").alias("n"))
    return groups.filter("n > 1")


def fragments(df: DataFrame, key: str, body: str, separator: str = r"\n", kind: str = "paragraph") -> DataFrame:
    """Non-blank parts of each text, in order, with the hash of their version, kind, ordinal from 1, normalised text and trace."""
    parts = df.select(F.col(key), F.posexplode(F.split(F.col(body), separator)).alias("place", "part"))
    parts = parts.select(key, F.col("place").cast("long").alias("place"), F.trim("part").alias("part")).filter("part <> ''")
    none = F.lit(None).cast("string")
    return parts.withColumn("hash", extraction.fragment_hash(F.col(key), F.lit(kind), F.col("place") + 1, text.normal(F.col("part")), none, none, none, none, F.col("place") + 1))


def section_of(df: DataFrame, key: str, place: str, heading: Column) -> DataFrame:
    """The place of the nearest heading at or before each row."""
    w = Window.partitionBy(key).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("section", F.last(F.when(heading, F.col(place)), ignorenulls=True).over(w))


def tokens(df: DataFrame, key: str, body: str, pattern: str) -> DataFrame:
    """Matches of a pattern, with their order."""
    found = F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(0))
    return df.select(F.col(key), F.posexplode(found).alias("place", "token")).withColumn("place", F.col("place").cast("long"))


def term_counts(df: DataFrame, key: str, body: str, terms: dict[str, str]) -> DataFrame:
    """How often each document has each term of a lexicon as a whole word, whatever the case."""
    lexicon = F.create_map(*(F.lit(x) for pair in terms.items() for x in pair))
    words = df.select(F.col(key), F.explode(F.split(F.lower(body), "[^a-zà-ÿ0-9]+")).alias("term"))
    return words.filter(F.col("term").isin(list(terms))).groupBy(key, "term").agg(F.count("*").alias("n")).withColumn("kind", F.element_at(lexicon, F.col("term")))


def line_pairs(lines: DataFrame, key: str, first: Column, second: Column) -> DataFrame:
    """Lines that hold both a match of one list and one of the other: a row for each pair of them.

    Both lists come from the line itself, so no join is needed.
    """
    return lines.select(key, "place", F.explode(first).alias("a"), second.alias("_b")).select(key, "place", "a", F.explode("_b").alias("b"))


def recurring(df: DataFrame, group: list[str], subject: str, least: int = 2) -> DataFrame:
    return df.groupBy(*group).agg(F.countDistinct(subject).alias("subjects"), F.count("*").alias("n")).filter(F.col("subjects") >= least)


def conflicts(df: DataFrame, claim: list[str], value: str, version: str) -> DataFrame:
    """Claims with several members and values: split by version where each version has one value, else open."""
    per_version = df.groupBy(*claim, version).agg(F.count("*").alias("members"), F.countDistinct(value).alias("values"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    sets = per_version.groupBy(*claim).agg(F.sum("members").alias("members"), F.max("values").alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return sets.filter((F.col("members") > 1) & (F.col("lo") != F.col("hi"))).select(*claim, "members", F.when(F.col("most") == 1, "split").otherwise("review").alias("decision"))


def versions(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """A row for each change of a key's value: version, and the period in which it held."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(value).over(w)
    changed = df.withColumn("_before", before).filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col(value)))
    return changed.select(key, value, F.row_number().over(w).cast("long").alias("version"), F.col(order[0]).alias("since"), F.lead(order[0]).over(w).alias("until"))


def assertion_status(score: Column, reason: Column, issues: Column) -> Column:
    """Rejected before candidate before supported; words in the reason decide."""
    rejected = text.any_of(F.lower(F.coalesce(reason, F.lit(""))), ("reject", "incompatible", "error"))
    return F.when(rejected | (score < 0.5), "REJECTED").when(issues > 0, "CANDIDATE").otherwise("SUPPORTED")


def invalid_transitions(changes: DataFrame, before: str, after: str) -> DataFrame:
    allowed = changes.sparkSession.createDataFrame(TRANSITIONS, "_a string, _b string")
    return changes.join(F.broadcast(allowed), (F.col(before) == F.col("_a")) & (F.col(after) == F.col("_b")), "left_anti")  # TRANSITIONS has 8 rows


def breadth_first(edges: DataFrame, start: DataFrame, depth: int = 8) -> DataFrame:
    """node and its least distance from the start, up to ``depth``, along edges either way.

    Each level is an anti join with all nodes so far; a node is expanded once.
    """
    session.ensure_checkpoints(edges.sparkSession)
    both = edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct()
    reached = start.select("node", F.lit(0).alias("depth"))
    front = reached
    for level in range(1, depth + 1):
        front = front.join(both, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(reached.select("node"), "node", "left_anti").withColumn("depth", F.lit(level))
        front = front.checkpoint()
        if front.isEmpty():
            break
        reached = reached.union(front)
    return reached


def chained(df: DataFrame, chain: list[tuple[DataFrame, str, str]], columns: list[str], where: Column | None = None) -> DataFrame:
    """Distinct ``columns`` of rows followed from table to table: ``chain`` has each table with the column that leads to it and its own."""
    rows = df
    for table, here, there in chain:
        rows = rows.join(table, F.col(here) == F.col(there))
    return (rows if where is None else rows.filter(where)).select(*columns).distinct()


def edge_counts(edges: DataFrame) -> DataFrame:
    """Edges of each kind, and how many nodes they begin and end at."""
    return edges.groupBy("kind").agg(F.count("*").alias("edges"), F.countDistinct("src").alias("sources"), F.countDistinct("dst").alias("targets"))


def neighbour_counts(edges: DataFrame) -> DataFrame:
    """How many edges of each kind end at a node."""
    return edges.groupBy(F.col("dst").alias("node"), "kind").agg(F.count("*").alias("neighbors"))


def counts_by(df: DataFrame, groups: list[str], amount: str, name: str) -> DataFrame:
    """Rows and the sum of an amount by each column alone, and of all."""
    return df.groupingSets([*([g] for g in groups), []], *groups).agg(F.count("*").alias("n"), F.sum(amount).alias(name))


def reprocess_state(documents: DataFrame, key: str, content: Column, preferred: Column, marks: DataFrame, mark_key: str, mark: str) -> DataFrame:
    """Each distinct content with its preferred row, else its least key, how many rows have it, and that row's marks."""
    groups = documents.groupBy(F.sha2(content, 256).alias("_sha")).agg(F.coalesce(F.min(F.when(preferred, F.col(key))), F.min(key)).alias(key), F.count("*").alias("n"))
    found = marks.select(F.col(mark_key).alias("_mark_key"), F.col(mark).alias("_mark"))
    return groups.join(found, F.col(key) == F.col("_mark_key"), "left").groupBy(key, "n").agg(F.count("_mark_key").alias("labels"), F.countDistinct("_mark").alias("grades"))


def trace(edges: DataFrame, start: DataFrame, depth: int = 8) -> tuple[DataFrame, DataFrame]:
    """(nodes with their distance, the edges between them): what lies within ``depth`` steps, along edges either way."""
    nodes = breadth_first(edges, start, depth)
    both = nodes.select(F.col("node").alias("_a"))
    inner = edges.join(both, F.col("src") == F.col("_a"), "left_semi").join(both.withColumnRenamed("_a", "_b"), F.col("dst") == F.col("_b"), "left_semi")
    return nodes, inner


def graph_projection(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of entities (kind, external_id, attributes map) and relations (kind, source_kind, source_id, target_kind, target_id, attributes map).

    Ids come from what they stand for, so a projection that is run again gives the same graph; equal nodes and edges count once, and
    an edge whose ends aren't both there goes. The signature tells whether contents changed.
    """
    seed = lambda *parts: values.url_id(F.concat_ws(":", *parts))
    signature = lambda c: F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c)))).cast("binary"), 256)
    nodes = entities.select(seed(F.lit("node"), "kind", "external_id").alias("node_id"), "kind", "external_id", "attributes", signature(F.col("attributes")).alias("signature")).dropDuplicates(["node_id"])
    ends = relations.select("kind", seed(F.lit("node"), "source_kind", "source_id").alias("src"), seed(F.lit("node"), "target_kind", "target_id").alias("dst"), "attributes")
    ids = nodes.select("node_id")
    ends = ends.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    edges = ends.select(seed(F.lit("edge"), "kind", "src", "dst").alias("edge_id"), "kind", "src", "dst", "attributes", signature(F.col("attributes")).alias("signature")).dropDuplicates(["edge_id"])
    return nodes, edges


#: The search index of each kind of source, behind a prefix of the user's.
INDEXES = {"variable": "variables-v1", "document": "documents-v1", "fragment": "fragments-v1", "assertion": "assertions-v1", "fact": "facts-v1"}


def search_documents(sources: DataFrame, prefix: str = "") -> DataFrame:
    """A search document for each row (kind, source_id, parts array): its index, its text of the parts that aren't empty, and a stand-in embedding."""
    index = F.try_element_at(F.create_map(*(F.lit(x) for kind, name in INDEXES.items() for x in (kind, prefix + name))), F.col("kind"))
    body = F.array_join(F.filter(F.transform("parts", lambda p: F.trim(p)), lambda p: p != ""), " ")
    rows = sources.select(values.url_id(F.concat_ws(":", F.lit("search"), "kind", "source_id")).alias("document_id"), "kind", "source_id", index.alias("index_name"), body.alias("index_text"))
    return rows.withColumn("embedding", F.array(F.length("index_name").cast("float"), F.length("index_text").cast("float")))


def search_like(df: DataFrame, key: str, body: str, needle: str, most: int, source: tuple[str, str] | None = None) -> DataFrame:
    """The first rows whose text holds the needle in any case; its % and _ are wildcards. ``source`` is a column and its value."""
    found = df.filter(F.lower(body).like(f"%{needle.lower()}%"))
    if source is not None:
        found = found.filter(F.col(source[0]) == source[1])
    return found.orderBy(key).limit(most)


def relevance(name: Column, alias: Column, code: Column, body: Column, needle: str) -> Column:
    """100 for the name, 90 for an alias, 80 for the code, 70 where all words occur; else 0."""
    wanted = needle.lower()
    words = F.lit(True)
    for w in wanted.split():
        words = words & F.contains(F.lower(body), F.lit(w))
    return F.when(F.lower(name) == wanted, 100).when(F.lower(alias) == wanted, 90).when(F.lower(code) == wanted, 80).when(words, 70).otherwise(0)


def node_id(kind: str, key: Column) -> Column:
    return values.url_id(F.concat(F.lit(f"node:{kind}:"), key.cast("string")))
