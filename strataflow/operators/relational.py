"""Selection, matching and synchronisation of tables."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, stamp: str) -> DataFrame:
    """Rows of the newest stamp; the maximum is a scalar subquery, so the filter reaches the scan."""
    return df.filter(F.col(stamp) == df.agg(F.max(stamp)).scalar())


def not_in_pairs(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose tuple isn't in the other table, with SQL's rule for nulls in NOT IN.

    A null may equal anything, so rows with nulls in some columns are compared in the rest: for each pattern of nulls
    that occurs on either side there is one hash anti join on the columns that neither has null, and where none is
    left the pair of patterns takes all rows. Which patterns occur is counted first, a row for each.
    """
    flags = [F.col(c).isNull().alias(f"_n{i}") for i, c in enumerate(columns)]
    patterns = lambda table: sorted(tuple(r) for r in table.select(*flags).distinct().collect())  # noqa: E731  2 ** len(columns) rows at most
    matching = lambda pattern: functools.reduce(operator.and_, (F.col(c).isNull() == F.lit(n) for c, n in zip(columns, pattern, strict=True)))
    other = other.select(*columns)
    theirs, out = patterns(other), df.filter(F.lit(False))
    for own in patterns(df):
        rows = df.filter(matching(own))
        for their in theirs:
            both = [c for c, a, b in zip(columns, own, their, strict=True) if not a and not b]
            if not both:
                rows = None
                break
            partners = other.filter(matching(their)).select(*(F.col(c).alias(f"_{c}") for c in both)).distinct()
            rows = rows.join(partners, [F.col(c) == F.col(f"_{c}") for c in both], "left_anti")
        if rows is not None:
            out = out.union(rows)
    return out


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order, which should be total."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def sync_changes(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """What a sync would do to each key: insert, update or delete; keys that are equal are left out."""
    shared = [c for c in target.columns if c in source.columns and c != key]
    s = source.select(key, F.struct(*shared).alias("s"))
    t = target.select(key, F.struct(*shared).alias("t"))
    action = F.when(F.col("t").isNull(), "insert").when(F.col("s").isNull(), "delete").when(~F.col("s").eqNullSafe(F.col("t")), "update")
    return s.join(t, key, "full").select(key, action.alias("action")).filter("action is not null")


def synced(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target after a sync: the source's keys and shared columns, and the target's own columns where it had them."""
    own = [c for c in target.columns if c not in source.columns]
    return source.select(*(c for c in target.columns if c in source.columns)).join(target.select(key, *own), key, "left").select(*target.columns)


def either_key_join(df: DataFrame, other: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Rows whose value equals either key of the other table, a row a pair: an OR join as one hash join.

    A value may meet many rows, so the left side is dealt to as many tasks as shuffles have, whatever its bytes or values.
    """
    side = other.withColumn("_key", F.explode(F.array_distinct(F.array(*keys))))
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.join(side, F.col(value) == F.col("_key")).drop("_key")


def nearest_in_band(df: DataFrame, events: DataFrame, key: str, event_key: str, when: str, event_when: str, days: int) -> DataFrame:
    """For each row the newest event of its key within ``days`` either way.

    Both sides are cut into buckets as wide as the band, and a row looks into its own and both neighbours, so
    the band join is a hash join on key and bucket.
    """
    bucket = lambda c: F.floor(F.unix_date(F.to_date(c)) / days).cast("long")
    left = df.withColumn("_bucket", F.explode(F.array(*(bucket(F.col(when)) + i for i in (-1, 0, 1)))))
    right = events.withColumn("_event_bucket", bucket(F.col(event_when)))
    pairs = left.join(right, (F.col(key) == F.col(event_key)) & (F.col("_bucket") == F.col("_event_bucket")))
    apart = F.abs(F.date_diff(F.to_date(F.col(when)), F.to_date(F.col(event_when))))
    return pairs.filter(apart <= days).drop("_bucket", "_event_bucket")


def state_shares(df: DataFrame, state: str) -> DataFrame:
    """Rows of each state and their share of all, in percent; the total is a sum over the few groups."""
    groups = df.groupBy(F.coalesce(F.col(state).cast("string"), F.lit("NULL")).alias("state")).agg(F.count("*").alias("n"))
    return groups.select("state", "n", F.round(F.col("n") * 100.0 / groups.agg(F.sum("n")).scalar(), 2).alias("pct"))


def missing_rows(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to insert: those whose keys aren't there yet."""
    return wanted.join(present.select(*keys), keys, "left_anti")


def not_in_column(df: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Rows whose value isn't in the other table's column, as an anti join decides: rows with a null stay."""
    return df.join(other.select(F.col(column).alias("_other")).distinct(), F.col(column) == F.col("_other"), "left_anti")


def with_ids_of(df: DataFrame, key: str, ids: DataFrame, other: str) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(ids.select(F.col(other).alias("_id")), F.col(key) == F.col("_id"), "left_semi")


def updated(df: DataFrame, source: DataFrame, on: list[Column], column: str, value: str) -> DataFrame:
    """``df`` with a column taken from the source where the condition meets it, and left as it is elsewhere."""
    joined = df.alias("t").join(source.alias("s"), on, "left")
    return joined.select(*(F.coalesce(F.col(f"s.{value}"), F.col(f"t.{c}")).alias(c) if c == column else F.col(f"t.{c}") for c in df.columns))


def found_in_list(df: DataFrame, keys: list[str], listed: DataFrame) -> DataFrame:
    """``df`` with ``found``: whether the keys, trimmed and in lower case, are in the list."""
    plain = lambda c: F.lower(F.trim(F.col(c)))
    there = listed.select(*(plain(k).alias(f"_{k}") for k in keys)).distinct().withColumn("_there", F.lit(True))
    joined = df.join(there, [plain(k) == F.col(f"_{k}") for k in keys], "left")
    return joined.select(*(F.col(c) for c in df.columns), F.col("_there").isNotNull().alias("found"))


def first_rows(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    return df.orderBy(*order).limit(most)


def after(df: DataFrame, column: str, last: str | None, most: int) -> DataFrame:
    """The next rows behind a checkpoint, in the column's order; from the start without one."""
    rows = df if last is None else df.filter(F.col(column) > last)
    return rows.orderBy(column).limit(most)


def pending(df: DataFrame, state: str, states: list[str], or_null: bool) -> DataFrame:
    """Rows in one of the states; null is no state of a list, and counts only with ``or_null``."""
    inside = F.col(state).isin(states)
    return df.filter(inside | F.col(state).isNull() if or_null else inside)


def own_or_global(df: DataFrame, tenant: str, value, active: str) -> DataFrame:
    """Active rows of a tenant, and those of none."""
    return df.filter(F.col(active) & ((F.col(tenant) == value) | F.col(tenant).isNull()))


def same_text(a: Column, b: Column) -> Column:
    """Equal whatever the case."""
    return F.upper(a) == F.upper(b)


def allowed_url(url: Column, domains: list[str]) -> Column:
    """A web address whose host is one of the domains or lies within one."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    inside = F.lit(False)
    for d in domains:
        inside = inside | (host == d.lower()) | F.endswith(host, F.lit("." + d.lower()))
    return F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")).isin("http", "https") & inside, F.lit(False))


def discovered(urls: DataFrame, url: str, domains: list[str], most: int) -> DataFrame:
    """Distinct allowed addresses in order, the first of them."""
    return urls.filter(allowed_url(F.col(url), domains)).select(url).distinct().orderBy(url).limit(most)


def largest_match(df: DataFrame, pattern: str, column: str, value: str) -> DataFrame:
    """One row: the largest value of rows that are like the pattern, whose % and _ are wildcards."""
    return df.filter(F.col(column).like(pattern)).agg(F.max(value).alias("value"))


def best_of(frames: list[DataFrame], key: str, score: str) -> DataFrame:
    """The rows of several tables with one a key: the highest score, of equal ones the earlier table's."""
    rows = None
    for i, f in enumerate(frames):
        part = f.withColumn("_turn", F.lit(i))
        rows = part if rows is None else rows.unionByName(part)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), "_turn"))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_turn", "_place")


def counted_since(df: DataFrame, when: str, since: Column, needed: str, by: str) -> DataFrame:
    """Rows of each group from a time on that have a value in ``needed``."""
    return df.filter((F.col(when) >= since) & F.col(needed).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))


def lineage_versions(df: DataFrame, lineage: str, order: list[str]) -> DataFrame:
    """Rows numbered within their lineage, from 1, as one version after the other was seen."""
    return df.withColumn("version", F.row_number().over(Window.partitionBy(lineage).orderBy(*order)).cast("long"))


def latest_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each of the keys as they are once trimmed and in upper case: the first in the order."""
    plain = {k: F.upper(F.trim(F.col(k))) for k in keys}
    return first_by(df.withColumns({f"_{k}": c for k, c in plain.items()}), [f"_{k}" for k in keys], order).withColumns({k: F.col(f"_{k}") for k in keys}).drop(*(f"_{k}" for k in keys))


def upserted(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target with the source's rows in place of those with their keys, and the new ones."""
    return target.join(source.select(key).distinct(), key, "left_anti").unionByName(source.select(*target.columns))


def inserted(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target and the source's rows whose keys it lacks."""
    return target.unionByName(source.select(*target.columns).join(target.select(key), key, "left_anti"))


def replaced(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source in the target's columns: what a table holds once it is emptied and filled anew."""
    return source.select(*(F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns))
