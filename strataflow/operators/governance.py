"""What keeps a knowledge base in order: consolidation of facts, integrity, review, registries, plans and explanations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conflict_decisions(assertions: DataFrame, claim: list[str], value: str, version: str, accepted: Column) -> DataFrame:
    """Claims with several members and values, and what settles them: versions that each have one value, a sole accepted member, or review.

    ``winner`` is the sole accepted member's value. Members are summed by version first, so no claim is listed whole.
    """
    per_version = assertions.groupBy(*claim, version).agg(F.count("*").alias("members"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_if(accepted).alias("accepted"), F.max(F.when(accepted, F.col(value))).alias("winner"))
    sets = per_version.groupBy(*claim).agg(F.sum("members").alias("members"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bool_and(F.col("lo") == F.col("hi")).alias("split"), F.sum("accepted").alias("accepted"), F.max("winner").alias("winner"))
    decision = F.when(F.col("split"), "split_by_version").when(F.col("accepted") == 1, "accepted_wins").otherwise("review")
    return sets.filter((F.col("members") > 1) & (F.col("lo") != F.col("hi"))).select(*claim, "members", decision.alias("decision"), F.when(~F.col("split") & (F.col("accepted") == 1), F.col("winner")).alias("winner"))


def fact_changes(accepted: DataFrame, active: DataFrame, blocked: DataFrame, claim: str, value: str) -> DataFrame:
    """claim, action, version, signature: what accepted assertions do to the active facts (claim, version, signature).

    Equal signatures reuse the active version, others supersede it by the next; a claim without one begins with 1,
    one with an open conflict is blocked, and an active fact without an accepted assertion is invalidated.
    """
    signature = F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), "|")
    now = accepted.groupBy(claim).agg(signature.alias("signature"))
    rows = now.join(active.select(claim, F.col("version").alias("_version"), F.col("signature").alias("_signature")), claim, "full").join(blocked.select(claim).distinct().withColumn("_blocked", F.lit(True)), claim, "left")
    action = F.when(F.col("_blocked"), "blocked").when(F.col("signature").isNull(), "invalidate").when(F.col("_version").isNull(), "create").when(F.col("signature") == F.col("_signature"), "reuse").otherwise("supersede")
    rows = rows.withColumn("action", action)
    version = F.when(F.col("action") == "create", 1).when(F.col("action") == "supersede", F.col("_version") + 1).otherwise(F.col("_version"))
    return rows.select(claim, "action", version.cast("long").alias("version"), F.coalesce("signature", "_signature").alias("signature"))


def integrity_problems(facts: DataFrame, supports: DataFrame, claim: str, fact: str) -> DataFrame:
    """claim or fact and problem: a version that occurs twice, several active versions of a claim, a fact without support."""
    name = lambda c, p: (F.col(c).cast("string").alias("subject"), F.lit(p).alias("problem"))
    twice = facts.groupBy(claim, "version").agg(F.count("*").alias("_n")).filter("_n > 1").select(claim).distinct().select(*name(claim, "duplicate_version"))
    several = facts.filter("active").groupBy(claim).agg(F.count("*").alias("_n")).filter("_n > 1").select(*name(claim, "multiple_active"))
    bare = facts.join(supports.select(fact), fact, "left_anti").select(*name(fact, "missing_support"))
    return twice.union(several).union(bare)


def review_items(targets: DataFrame, items: DataFrame, target: str) -> DataFrame:
    """Targets that need a review item: those that have no open one."""
    return targets.join(items.filter("state = 'open'").select(target), target, "left_anti")


def reviewed(items: DataFrame, decisions: DataFrame, item: str) -> DataFrame:
    """Items with their last decision (item, decision, at): approved or rejected ones are closed, a decision about a closed item doesn't count. Of equal times the least ``place`` decides, if there is such a column."""
    valid = decisions.filter(F.col("decision").isin("approve", "reject"))
    if "place" in decisions.columns:
        valid = valid.groupBy(item, "at").agg(F.min_by("decision", "place").alias("decision"))
    last = valid.groupBy(item).agg(F.max_by("decision", "at").alias("_decision"))
    state = F.when((F.col("state") == "open") & (F.col("_decision") == "approve"), "approved").when((F.col("state") == "open") & (F.col("_decision") == "reject"), "rejected").otherwise(F.col("state"))
    return items.join(last, item, "left").withColumn("state", state).drop("_decision")


def contradictions(relations: DataFrame, single: list[str]) -> DataFrame:
    """source, kind, targets of relations (source, kind, target, active) that may have one target only and have several."""
    own = relations.filter(F.col("active") & F.col("kind").isin(single))
    return own.groupBy("source", "kind").agg(F.countDistinct("target").alias("targets")).filter("targets > 1")


def registry_problems(entities: DataFrame, relations: DataFrame, shapes: DataFrame, required: DataFrame) -> DataFrame:
    """subject and problem of a registry of entities (id, kind, unit) and relations (source, kind, target).

    ``shapes`` has source_kind, kind, target_kind that may occur; ``required`` has entity kinds (entity_kind) and the relation kinds (kind) each must
    have as a source. Ends of a relation must be known, and of one with units on both ends the units the same.
    """
    ends = lambda side: entities.select(F.col("id").alias(side), F.col("kind").alias(f"{side}_kind"), F.col("unit").alias(f"{side}_unit"))
    rows = relations.join(ends("source"), "source", "left").join(ends("target"), "target", "left")
    rows = rows.join(shapes.distinct().withColumn("_known", F.lit(True)), ["source_kind", "kind", "target_kind"], "left")
    whole = F.col("source_kind").isNotNull() & F.col("target_kind").isNotNull()
    problem = F.when(~whole, "unknown_end").when(F.col("_known").isNull(), "shape_not_allowed").when(F.col("source_unit") != F.col("target_unit"), "unit_mismatch")
    subject = F.concat_ws(":", F.col("source").cast("string"), "kind", F.col("target").cast("string"))
    found = rows.select(subject.alias("subject"), problem.alias("problem")).filter("problem is not null")
    needed = entities.select("id", F.col("kind").alias("entity_kind")).join(required, "entity_kind")
    missing = needed.join(relations.select(F.col("source").alias("id"), "kind").distinct(), ["id", "kind"], "left_anti")
    return found.union(missing.select(F.concat_ws(":", F.col("id").cast("string"), "kind"), F.lit("missing_relation")))


def plan_of(questions: DataFrame, recipes: DataFrame) -> DataFrame:
    """question, sequence, stage, follows: the stages of each question's type (question_type, stages array), each after the one before."""
    rows = questions.join(recipes, "question_type").select("question", F.posexplode("stages").alias("_i", "stage"), "stages")
    return rows.select("question", (F.col("_i") + 1).cast("long").alias("sequence"), "stage", F.when(F.col("_i") > 0, F.get("stages", F.col("_i") - 1)).alias("follows"))


def explanation_problems(explanations: DataFrame, parts: DataFrame, facts: DataFrame) -> DataFrame:
    """subject and problem: an explanation (explanation, target) whose target is no fact, parts (explanation, code, fact) of none or of no fact, codes that occur
    twice in one, and explanations that don't cover their target."""
    known = facts.select("fact").distinct()
    name = lambda c, p: (F.col(c).cast("string").alias("subject"), F.lit(p).alias("problem"))
    absent = explanations.join(known, F.col("target") == F.col("fact"), "left_anti").select(*name("explanation", "target_missing"))
    orphans = parts.join(explanations.select("explanation"), "explanation", "left_anti").select(*name("code", "orphan_part"))
    loose = parts.join(known, "fact", "left_anti").select(*name("code", "unknown_fact"))
    twice = parts.groupBy("explanation", "code").agg(F.count("*").alias("_n")).filter("_n > 1").select(*name("code", "code_not_unique"))
    covered = parts.select("explanation", F.col("fact").alias("target")).distinct()
    uncovered = explanations.join(covered, ["explanation", "target"], "left_anti").select(*name("explanation", "target_not_covered"))
    return absent.union(orphans).union(loose).union(twice).union(uncovered)


def workflow_counts(steps: DataFrame, halt_before: int | None = None) -> DataFrame:
    """Steps (run, step, name, outputs) with what went in, the outputs of the step before, and their state.

    With ``halt_before``, a run that awaits review ends before that step: it and those behind it are pending.
    """
    w = Window.partitionBy("run").orderBy("step")
    state = F.lit("COMPLETED") if halt_before is None else F.when(F.col("step") < halt_before, "COMPLETED").when(F.col("step") == halt_before, "AWAITING_REVIEW").otherwise("PENDING")
    rows = steps.withColumns({"inputs": F.coalesce(F.lag("outputs").over(w), F.lit(0)).cast("long"), "state": state})
    done = F.col("state") == "COMPLETED"
    return rows.select("run", "step", "name", F.when(done, F.col("inputs")).otherwise(F.lit(0)).cast("long").alias("inputs"), F.when(done, F.col("outputs")).otherwise(F.lit(0)).cast("long").alias("outputs"), "state")


def stale_runs(runs: DataFrame, now: Column, hours: int) -> DataFrame:
    """Runs (run, state, started) with those that have been running for longer than so many hours marked as failed."""
    stale = (F.col("state") == "running") & (F.timestamp_diff("HOUR", F.col("started"), now) >= hours)
    return runs.withColumn("state", F.when(stale, "failed").otherwise(F.col("state")))


def unmatched(mentions: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Mentions without a candidate."""
    return mentions.join(candidates.select(key), key, "left_anti")


def sole_approved(decisions: DataFrame, mention: str, concept: str) -> DataFrame:
    """mention, concept, status: the one approved concept of each mention; none, or several of which none counts."""
    found = decisions.groupBy(mention).agg(F.count_if(F.col("state") == "approved").alias("_n"), F.max(F.when(F.col("state") == "approved", F.col(concept))).alias("_one"))
    return found.select(mention, F.when(F.col("_n") == 1, F.col("_one")).alias(concept), F.when(F.col("_n") == 0, "none").when(F.col("_n") == 1, "approved").otherwise("several").alias("status"))


def schema_rows(rows: DataFrame, key: str, table: str, row: str, cells: str) -> DataFrame:
    """key, table, kind, name, type, target of the body rows of schema tables in standards' documents.

    A table's first row tells what it is: with 'attribute' in its first cell its rows are attributes (name, type), with
    'relationship' relationships (name, target), with 'derived from' the types it derives from.
    """
    head = rows.filter(F.col(row) == 1).select(F.col(key), F.col(table), F.lower(F.trim(F.get(cells, 0))).alias("_head"))
    kind = F.when(F.contains("_head", F.lit("attribute")), "attribute").when(F.contains("_head", F.lit("relationship")), "relationship").when(F.contains("_head", F.lit("derived from")), "derived_from")
    body = rows.filter(F.col(row) > 1).join(head.select(key, table, kind.alias("kind")).filter("kind is not null"), [key, table])
    cell = lambda i: F.nullif(F.trim(F.get(cells, i)), F.lit(""))
    return body.select(key, table, "kind", cell(0).alias("name"), F.when(F.col("kind") == "attribute", cell(1)).alias("type"), F.when(F.col("kind") == "relationship", cell(1)).alias("target")).filter("name is not null")
