"""Cleaning of scraped lists, events, configurations, catalogue checks and run ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, session

#: Event type and letter by kind of rig.
RIG_EVENTS = {"PER": (1, "P"), "PUL": (8, "R"), "WO": (7, "W")}


def without_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have something in one of the columns."""
    blank = lambda x: F.coalesce(F.trim(x), F.lit("")) == ""
    return df.filter(~F.forall(F.array(*columns), blank))


def in_range_labels(first: Column, second: Column, since: Column, until: Column) -> dict[str, Column]:
    """Whether either and both of two dates lie in a range; unknown dates don't."""
    inside = lambda c: F.coalesce(c.between(since, until), F.lit(False))
    return {"either": inside(first) | inside(second), "both": inside(first) & inside(second)}


def record_time(cell: Column, as_of: Column) -> Column:
    """A cell with a time of the day of ``as_of``, or with a date; null of anything else."""
    plain, clock = F.trim(cell), r"^(\d{1,2}):(\d{1,2})$"
    part = lambda i: F.nullif(F.regexp_extract(plain, clock, i), F.lit("")).cast("int")
    today = F.try_make_timestamp(F.year(as_of), F.month(as_of), F.day(as_of), part(1), part(2), F.lit(0))
    return F.when(F.contains(plain, F.lit(":")) & (F.length(plain) <= 5), today).otherwise(dates.spelled(plain, "d-b-y"))


def name_variants(code: Column, number: Column, suffix: Column, field: Column) -> Column:
    """The ways in which a well of these parts may be written, sorted."""
    ends = F.when(suffix.isNull(), F.array(number)).otherwise(F.array(number, F.concat(number, suffix), F.concat(number, F.lit("("), suffix, F.lit(")")), F.concat(number, F.lit(" ("), suffix, F.lit(")"))))
    plain = F.flatten(F.transform(ends, lambda e: F.array(F.concat(code, F.lit("-"), e), F.concat(code, F.lit(" "), e))))
    with_suffix = F.when(suffix.isNotNull(), F.array(F.concat(code, F.lit("."), suffix, F.lit("-"), number)))
    in_field = F.when(field.isNotNull(), F.flatten(F.transform(ends, lambda e: F.array(F.concat(field, F.lit("."), code, F.lit("-"), e), F.concat(field, F.lit("."), F.lower(code), F.lit("-"), e)))))
    in_field = F.concat(in_field, F.array(F.concat(field, F.lit("."), code, F.lit(" "), number), F.concat(field, F.lit("."), F.lower(code), F.lit(" "), number)))
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(plain, F.coalesce(with_suffix, none), F.coalesce(in_field, none))))


def placeholder_event(kind: Column) -> tuple[Column, Column]:
    """Type and letter of the event that stands in where a rig has none."""
    type_, letter = F.lit(0), F.lit(None).cast("string")
    for name, (t, p) in RIG_EVENTS.items():
        type_, letter = F.when(kind == name, t).otherwise(type_), F.when(kind == name, p).otherwise(letter)
    return type_, letter


def event_cascade(files: DataFrame, active: DataFrame, reports: DataFrame, keys: list[str]) -> DataFrame:
    """The event of each file: the active one of its keys, else the reported one, else none; with where it is from."""
    newest = lambda df, name: df.groupBy(*keys).agg(F.max("event_id").alias(name))
    found = files.join(newest(active, "a"), keys, "left").join(newest(reports, "r"), keys, "left")
    return found.select(*files.columns, F.coalesce("a", "r").alias("event_id"), F.when(F.col("a").isNotNull(), "active").when(F.col("r").isNotNull(), "report").otherwise("placeholder").alias("origin"))


def configuration(df: DataFrame, rig: str, variable: str, first: str, second: str, order: list[str]) -> DataFrame:
    """One row for each rig, variable and distinct mnemonic of the first configuration of the pair."""
    place = F.row_number().over(Window.partitionBy(rig, variable).orderBy(*order))
    names = F.array_distinct(F.array_compact(F.array(first, second)))
    return df.withColumn("_place", place).filter("_place = 1").select(rig, variable, F.explode(names).alias("mnemonic"))


def ambiguous_aliases(df: DataFrame, alias: str, scope: str, identity: str) -> DataFrame:
    """Aliases that mean several things within a scope."""
    return df.groupBy(F.lower(F.trim(alias)).alias("alias"), scope).agg(F.countDistinct(identity).alias("meanings")).filter("meanings > 1")


def hierarchy_problems(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Keys whose parent is unknown, and keys that lie on a cycle of any length.

    Each round joins every key with the key twice as many steps above it; those that pass a root leave. A key that
    is still there after more steps than there are keys climbs towards a cycle, and what is reached by such climbs
    is on one. Keys are unique.
    """
    session.ensure_checkpoints(df.sparkSession)
    edges = df.select(F.col(key).alias("k"), F.col(parent).alias("p"))
    unknown = edges.filter("p is not null").join(edges.select(F.col("k").alias("p")), "p", "left_anti").select(F.col("k").alias("key"), F.lit("unknown_parent").alias("problem"))
    climb, steps, keys = edges.filter("p is not null").checkpoint(), 1, edges.count()
    while steps <= keys and not climb.isEmpty():
        climb = climb.join(climb.select(F.col("k").alias("p"), F.col("p").alias("further")), "p").select("k", F.col("further").alias("p")).checkpoint()
        steps *= 2
    return unknown.union(climb.select(F.col("p").alias("key"), F.lit("cycle").alias("problem")).distinct())


def last_checkpoint(runs: DataFrame, payload: str, path: str, finished: str, place: Column | None = None) -> DataFrame:
    """The newest known value in the runs' summaries; of equal times that with the least ``place``."""
    value = F.get_json_object(F.col(payload), path)
    rows = runs.select(value.alias("value"), F.col(finished).alias("at"), (F.lit(0) if place is None else -place).alias("_turn")).filter("value is not null")
    return rows.agg(F.max_by("value", F.when(F.col("at").isNotNull(), F.struct("at", "_turn"))).alias("value"), F.max("at").alias("at"))


def synonym_problems(df: DataFrame, key: str, terms: str) -> DataFrame:
    """Sets with fewer than two terms, and sets that repeat another's."""
    plain = df.select(F.col(key).alias("key"), F.array_sort(F.array_distinct(F.transform(F.col(terms), lambda x: F.lower(F.trim(x))))).alias("terms"))
    first = plain.groupBy("terms").agg(F.min("key").alias("first"))
    few = plain.filter(F.size("terms") < 2).select("key", F.lit("too_few").alias("problem"))
    return few.union(plain.join(first, "terms").filter(F.col("key") > F.col("first")).select("key", F.lit("repeated").alias("problem")))


def placeholder_id(name: Column) -> Column:
    """'PH_', up to 7 of the name's letters and digits, and 8 digits that the whole name gives; 20 characters at most."""
    letters = F.substring(F.regexp_replace(name, "[^a-zA-Z0-9_-]", ""), 1, 7)
    digits = F.lpad(F.pmod(F.xxhash64(name), F.lit(10**8)).cast("string"), 8, "0")
    return F.substring(F.concat_ws("_", F.lit("PH"), letters, digits), 1, 20)


def report_events(reports: DataFrame, events: DataFrame) -> DataFrame:
    """Events to make from production reports (report_id, event_key, event_code, start_date, well, rig) that no event has yet.

    The code gives the type and letter; the newest report of an event counts.
    """
    fresh = reports.join(events.select("event_key"), "event_key", "left_anti")
    newest = fresh.withColumn("_place", F.row_number().over(Window.partitionBy("event_key").orderBy(F.desc("start_date"), F.desc("report_id")))).filter("_place = 1").drop("_place")
    code = F.col("event_code")
    return newest.withColumns({"type_event": F.when(code.isin("1", "7", "8"), code.cast("int")).otherwise(F.lit(0)), "letter": F.when(code == "1", "P").when(code == "7", "W").when(code == "8", "R")})


def download_window(runs: DataFrame, key: str, last_data: str, file_time: str, as_of: Column) -> DataFrame:
    """The period to download next for each key: from the last data there are, else midnight, to the newest file's time, else midnight."""
    midnight = F.date_trunc("day", as_of)
    return runs.groupBy(key).agg(F.coalesce(F.max(last_data), midnight).alias("since"), F.coalesce(F.max(file_time), midnight).alias("until"))


def newest_file(files: DataFrame, by: str, path: str, modified: str) -> DataFrame:
    """The path of the file that was changed last in each group; of equal times the greater path."""
    return files.groupBy(by).agg(F.max_by(path, F.struct(modified, path)).alias("path"))


def plan_steps(steps: DataFrame, plan: str, order: str) -> DataFrame:
    """Each step of a plan with its number from 1 and the step it follows."""
    w = Window.partitionBy(plan).orderBy(order)
    return steps.withColumns({"sequence": F.row_number().over(w).cast("long"), "follows": F.lag(order).over(w)})


def queue_transition(batch: DataFrame, outcome: Column) -> DataFrame:
    """A batch of pending files after a run: OK, or ERROR_ and what went wrong; each file by itself."""
    return batch.withColumn("state", F.when(outcome.isNull(), "OK").otherwise(F.concat(F.lit("ERROR_"), F.upper(F.regexp_replace(outcome, r"[^A-Za-z0-9]+", "_")))))


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON with the keys in order: equal contents give equal texts."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def last_values(pairs: Column) -> Column:
    """A map of pairs (key, value), the last value of a key counting."""
    kept = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(kept)
