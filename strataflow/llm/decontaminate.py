"""Benchmark decontamination with DataFrame operations only.

The benchmark's word windows form a small hash table, with the items that hold each. Each document's windows are
hashed, probed, and every hit is verified word by word; then hit spans or whole documents go.

The table is broadcast where it is measured to be small. A larger one meets the windows in a shuffle of their
hashes and places alone: the words come in again for the few documents with a hash hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._columns import fresh, lower_ascii
from ._scratch import Scratch

#: Words of a window; an item of fewer is one window of all its words.
WINDOW = 10
#: A word is a run of characters outside these classes, after A-Z are lower-cased and before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The window table is broadcast up to so many bytes; a larger one is joined by a shuffle.
BROADCAST_BYTES = 48 << 20
#: A window's hash is dealt to so many tasks in that shuffle, as a passage may occur in a third of all documents.
SALTS = 16
#: Documents with hits are broadcast by their keys up to so many; more are joined by a shuffle.
BROADCAST_KEYS = 1 << 20


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _windows(words_: Column, length: int) -> Column:
    """struct(place, length, hash) of all runs of ``length`` words."""
    n = F.size(words_)
    made = F.transform(
        F.sequence(F.lit(1), n - (length - 1)),
        lambda i: F.struct(i.alias("place"), F.lit(length).alias("length"), F.xxhash64(F.slice(words_, i, F.lit(length))).alias("hash")),
    )
    return F.when(n >= length, made).otherwise(F.array().cast("array<struct<place:int,length:int,hash:bigint>>"))


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """hash, length, run, items of each distinct window. Items without words have none; a null item isn't listed."""
    w = F.col("words")
    made = items.select(F.col(item).alias("item"), words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    made = made.withColumn("length", F.least(F.size("words"), F.lit(window)))
    made = made.withColumn("place", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
    run = F.slice(w, F.col("place"), F.col("length"))
    return made.select("length", run.alias("run"), "item").groupBy("length", "run").agg(F.collect_set("item").alias("items")).withColumn("hash", F.xxhash64("run"))


def _identity(key: str, text: str) -> list[Column]:
    """What makes a row: its key and its text's hashes. Rows alike in all three have the same result anyway."""
    return [F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("mark2")]


def find_hits(docs: DataFrame, items: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """key, mark, mark2, places (word numbers from 1 inside hits, ascending), items (distinct, not null) of each text with a hit.

    The benchmark's window table is written first and measured: its window lengths (``window`` at most) and its
    bytes, which are broadcast only up to ``broadcast_bytes``.
    """
    table = scratch.table(benchmark_windows(items, item, item_text, window), "windows")
    lengths = {}
    size = F.length(F.concat_ws(" ", "run")) * 2 + 64 + F.size("items") * 16
    for row in table.groupBy("length").agg(F.sum(size).alias("bytes")).collect():  # a row for each length
        lengths[row["length"]] = row["bytes"]
    texts = docs.select(*_identity(key, text), words(F.col(text)).alias("words"))
    w = F.col("words")
    arrays = [_windows(w, n) for n in sorted(lengths, reverse=True)] or [_windows(w, window)]
    # the outer form, as a filter inferred from the inner one would cut the words anew for each window
    probes = texts.withColumn("windows", F.concat(*arrays)).select("key", "mark", "mark2", "words", F.inline_outer("windows"))
    table = table.select(F.col("hash").alias("b_hash"), F.col("run").alias("b_run"), "items")
    run = F.slice(w, F.col("place"), F.col("length"))
    # two comparisons make the word by word check a condition on hash hits; an equality would become a join key of every window
    verified = (run >= F.col("b_run")) & (run <= F.col("b_run"))
    if sum(lengths.values()) <= broadcast_bytes:
        hits = probes.join(F.broadcast(table), (F.col("hash") == F.col("b_hash")) & verified).select("key", "mark", "mark2", "place", "length", "items")
    else:
        probes = probes.select("key", "mark", "mark2", "place", "length", "hash", F.pmod("mark", F.lit(SALTS)).alias("salt"))
        salted = table.withColumn("b_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).hint("merge")
        maybe = scratch.table(probes.join(salted, (F.col("hash") == F.col("b_hash")) & (F.col("salt") == F.col("b_salt"))).select("key", "mark", "mark2", "place", "length", "b_run", "items"), "maybe")
        keys = scratch.broadcast_if_small(scratch.table(maybe.select(F.col("key").alias("m_key"), F.col("mark").alias("m_mark"), F.col("mark2").alias("m_mark2")).distinct(), "keys"), BROADCAST_KEYS)
        own = F.col("key").eqNullSafe(F.col("m_key")) & F.col("mark").eqNullSafe(F.col("m_mark")) & (F.col("mark2") == F.col("m_mark2"))
        again = docs.select(*_identity(key, text), F.col(text).alias("text")).join(keys, own, "left_semi").dropDuplicates(["key", "mark", "mark2"])
        again = again.select(F.col("key").alias("m_key"), F.col("mark").alias("m_mark"), F.col("mark2").alias("m_mark2"), words(F.col("text")).alias("words"))
        hits = maybe.join(again, own).filter(verified).select("key", "mark", "mark2", "place", "length", "items")
    spans = F.transform(F.collect_set(F.struct("place", "length")), lambda x: F.sequence(x["place"], x["place"] + x["length"] - 1))
    found = hits.groupBy("key", "mark", "mark2").agg(F.array_sort(F.array_distinct(F.flatten(spans))).alias("places"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return scratch.table(found, "hits")


def contamination(docs: DataFrame, items: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated of each row of ``docs``.

    A null or empty text has no words and no hits; texts count whole, however long. Repeated documents each have
    their row; repeated items count once, and where several items share a window each counts; windows of an item
    without id hit, but no item is counted for them. Empty tables are fine on either side. Other columns aren't read.
    """
    hits = scratch.broadcast_if_small(find_hits(docs, items, scratch, key, text, **options), BROADCAST_KEYS)
    rows = docs.select(*_identity(key, text), F.size(words(F.col(text))).cast("long").alias("n_words"))
    ids = F.array_sort(F.transform(F.coalesce(F.col("h.items"), F.array().cast("array<string>")), lambda x: x.cast("string")))
    same = F.col("r.key").eqNullSafe(F.col("h.key")) & F.col("r.mark").eqNullSafe(F.col("h.mark")) & (F.col("r.mark2") == F.col("h.mark2"))
    n_hit = F.when(F.col("h.places").isNull(), F.lit(0)).otherwise(F.size("h.places")).cast("long")
    return rows.alias("r").join(hits.alias("h"), same, "left").select(
        F.col("r.key").alias(key),
        F.col("r.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents, or (remove="spans") with the hit words cut out of their texts.

    Columns and their order stay. A cut span leaves one blank; rows without hits keep their very text. The hits are
    found and counted first, so that documents stay where they are unless very many are hit; only the hits outlive
    ``scratch``.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is either 'documents' or 'spans'")
    names = {n: fresh(docs.columns, f"_{n}") for n in ("key", "mark", "mark2", "places")}
    hits = find_hits(docs, items, scratch, key, text, **options)
    kept = ("key", "mark", "mark2") if remove == "documents" else ("key", "mark", "mark2", "places")
    hits = scratch.broadcast_if_small(scratch.publish(hits.select(*(F.col(n).alias(names[n]) for n in kept))), BROADCAST_KEYS).alias("h")
    marks = [c.alias(names[n]) for c, n in zip(_identity(key, text), ("key", "mark", "mark2"), strict=True)]
    rows = docs.select("*", *marks[1:]).alias("r")
    same = F.col(f"r.`{key}`").eqNullSafe(F.col(f"h.{names['key']}")) & F.col(f"r.{names['mark']}").eqNullSafe(F.col(f"h.{names['mark']}")) & (F.col(f"r.{names['mark2']}") == F.col(f"h.{names['mark2']}"))
    if remove == "documents":
        return rows.join(hits, same, "left_anti").select(*(F.col(f"r.`{c}`") for c in docs.columns))
    joined = rows.join(hits, same, "left")
    parts = fresh([*docs.columns, *names.values()], "_parts")
    joined = joined.select(*(F.col(f"r.`{c}`") for c in docs.columns), F.col(f"h.{names['places']}").alias(names["places"]), F.when(F.col(f"h.{names['places']}").isNotNull(), word_parts(F.col(f"r.`{text}`"))).alias(parts))
    cut = without_places(F.col(parts), F.col(names["places"]))
    return joined.select(*(F.coalesce(cut, F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))


def word_parts(text: Column) -> Column:
    """Each word with the gap before it, and last the gap behind them all."""
    return F.zip_with(F.split(text, WORD_ANY_CASE, -1), F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0)), lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))


def without_places(parts: Column, places: Column) -> Column:
    """The text of ``word_parts`` without the words of these ascending numbers; each run of them becomes a blank.

    ``parts`` has to be a column, not an expression: it is read once for each run.
    """
    before = F.concat(F.array(F.lit(0)), places)
    behind = F.concat(places, F.array(F.size(parts)))
    kept = F.zip_with(before, behind, lambda a, b: F.array_join(F.slice(parts, a + 1, b - a - 1), ""))
    return F.concat(F.array_join(F.filter(kept, lambda x: x != ""), " "), F.element_at(parts, -1))


def documents_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "contamination") as scratch:
        return scratch.publish(contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p FROM b WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, n, p, array_to_string(words[p : p + n - 1], ' ') AS run
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM w CROSS JOIN (SELECT DISTINCT n FROM bw) AS lengths WHERE len(words) >= n)
), hit AS (
  SELECT doc_id, dw.n, p, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.run = bw.run
), hw AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hit)) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
