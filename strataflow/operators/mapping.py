"""Mapping of raw curve names to canonical variables, units and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, text, values

#: How a curve was mapped, and what becomes of it.
EXACT, ALIAS, FUZZY = "EXACTO_CONFIG_EQUIPO", "ALIAS_EXACTO_PAE_EN_RIG", "FUZZY_PAE_EN_RIG"
IMPORTED, ALIAS_SUGGESTED, FUZZY_IMPORTED, FUZZY_SUGGESTED, UNMAPPED = "MAPEADA_EXACTO_IMPORTAR", "SUGERENCIA_ALIAS_EXACTO_EN_RIG", "MAPEADA_FUZZY_AUTOIMPORTAR", "SUGERENCIA_FUZZY_EN_RIG_REVISAR", "NO_MAPEADA_REVISAR"
SUGGEST, IMPORT = 70, 80
#: States of a unit check that are fine, and those that need attention or are a problem.
VALID = ("VALIDA_MISMA_UNIDAD", "VALIDA_CONVERSION_OK")
ATTENTION = ("CONVERSION_NO_ENCONTRADA", "DIMENSION_INCOMPATIBLE", "ECUACION_NO_PARSABLE")
PROBLEM = ("ORIGEN_NO_EN_CATALOGO", "OBJETIVO_NO_CATALOGO", "OBJETIVO_NO_DEFINIDO")


def unit_frequency(df: DataFrame, unit: str, most: int = 15, by: tuple[str, ...] = ()) -> DataFrame:
    """The most frequent units, of all or (``by``) of each file; a blank one counts as none."""
    name = F.coalesce(F.nullif(F.trim(F.col(unit)), F.lit("")), F.lit("SIN_UNIDAD"))
    counts = df.groupBy(*by, name.alias("unit")).agg(F.count("*").alias("n"))
    if not by:
        return counts.orderBy(F.desc("n"), "unit").limit(most)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "unit"))
    return counts.withColumn("_place", place).filter(F.col("_place") <= most).drop("_place")


def variable_texts(variables: DataFrame) -> DataFrame:
    """rig_id, position, plain, variable_id, is_alias of each name and alias of each variable, in load order.

    ``variables`` has rig_id, position, variable_id, name and aliases (comma-separated).
    """
    listed = F.concat(F.array(F.struct(F.col("name").alias("text"), F.lit(False).alias("is_alias"))), F.transform(F.when(F.coalesce("aliases", F.lit("")) != "", F.split("aliases", ",")).otherwise(F.array().cast("array<string>")), lambda a: F.struct(a.alias("text"), F.lit(True).alias("is_alias"))))
    rows = variables.select("rig_id", "variable_id", "position", F.posexplode(listed).alias("place", "x"))
    return rows.select("rig_id", F.struct("position", "place").alias("position"), "variable_id", text.comparable(F.col("x.text")).alias("plain"), F.col("x.is_alias").alias("is_alias")).filter("plain is not null")


def map_curves(curves: DataFrame, rules: DataFrame, variables: DataFrame, suggest: int = SUGGEST) -> DataFrame:
    """curve_id, variable_id, rule_id, imports, method, score of each curve (curve_id, rig_id, mnemonic); nulls where none fits.

    First the rig's rules (rule_id, rig_id, mnemonic, variable_id, imports) by the raw name, the last rule counting;
    then aliases of the rig's variables by the normalised name, the first variable counting, with 100 as well; then the
    most similar of all names and aliases whose category is compatible, from ``suggest`` on. Of equal texts the last
    variable counts and of equal scores the first text; only then is the score cut by the categories' factor, and
    if that takes it under ``suggest`` the curve stays unmapped. Each distinct name of a rig is compared once.
    """
    last_rule = rules.groupBy("rig_id", "mnemonic").agg(F.max_by(F.struct("variable_id", "rule_id", "imports"), "rule_id").alias("rule"))
    names = curves.filter("mnemonic <> ''").select("rig_id", "mnemonic").distinct().withColumn("plain", text.comparable(F.col("mnemonic")))
    texts = variable_texts(variables)
    by_alias = texts.filter("is_alias").groupBy("rig_id", "plain").agg(F.min_by("variable_id", "position").alias("alias_variable"))
    options = texts.filter("plain <> ''").groupBy("rig_id", F.col("plain").alias("option")).agg(F.max_by("variable_id", "position").alias("option_variable"), F.min("position").alias("first"))
    options = options.withColumn("option_category", text.category(F.col("option")))
    wanted = names.filter("plain <> ''").select("rig_id", "plain").distinct().withColumn("category", text.category(F.col("plain")))
    pairs = similarity.similar_pairs(wanted, options, "plain", "option", float(suggest), ["rig_id"], text.compatible(F.col("category"), F.col("option_category")))
    best = pairs.groupBy("rig_id", "plain").agg(F.min_by(F.struct("option_variable", "ratio", "category", "option_category"), F.struct(-F.col("ratio"), F.col("first"))).alias("best"))
    cut = F.floor(F.col("best.ratio") * text.category_factor(F.col("best.category"), F.col("best.option_category"))).cast("int")
    best = best.select("rig_id", "plain", F.col("best.option_variable").alias("fuzzy_variable"), cut.alias("fuzzy_score")).filter(F.col("fuzzy_score") >= suggest)
    found = names.join(last_rule, ["rig_id", "mnemonic"], "left").join(by_alias.filter("plain <> ''"), ["rig_id", "plain"], "left").join(best, ["rig_id", "plain"], "left")
    is_rule, is_alias, is_fuzzy = F.col("rule").isNotNull(), F.col("alias_variable").isNotNull(), F.col("fuzzy_variable").isNotNull()
    found = found.select(
        "rig_id", "mnemonic",
        F.when(is_rule, F.col("rule.variable_id")).when(is_alias, F.col("alias_variable")).otherwise(F.col("fuzzy_variable")).alias("variable_id"),
        F.when(is_rule, F.col("rule.rule_id")).alias("rule_id"), F.when(is_rule, F.col("rule.imports")).otherwise(F.lit(False)).alias("imports"),
        F.when(is_rule, EXACT).when(is_alias, ALIAS).when(is_fuzzy, FUZZY).alias("method"), F.when(is_rule | is_alias, 100).otherwise(F.col("fuzzy_score")).alias("score"),
    )
    return curves.select("curve_id", "rig_id", "mnemonic").join(found, ["rig_id", "mnemonic"], "left").select("curve_id", "variable_id", "rule_id", F.coalesce("imports", F.lit(False)).alias("imports"), "method", "score")


def outcome(method: Column, score: Column, least: int = IMPORT) -> Column:
    return F.when(method == EXACT, IMPORTED).when(method == ALIAS, ALIAS_SUGGESTED).when((method == FUZZY) & (score >= least), FUZZY_IMPORTED).when(method == FUZZY, FUZZY_SUGGESTED).otherwise(UNMAPPED)


def outcome_counts(mapped: DataFrame) -> DataFrame:
    """One row: curves by outcome, and all of them."""
    state = outcome(F.col("method"), F.col("score"))
    return mapped.agg(*(F.count_if(state == x).alias(x.lower()) for x in (IMPORTED, ALIAS_SUGGESTED, FUZZY_IMPORTED, FUZZY_SUGGESTED, UNMAPPED)), F.count("*").alias("total"))


def unit_lookup(df: DataFrame, unit: str, units: DataFrame) -> DataFrame:
    """``df`` with unit_id and unit_kind: the catalogue's unit (unit_id, name, kind) as written, in lower or in upper case, in this order.

    Each distinct spelling is looked up once.
    """
    plain = F.trim(F.col(unit))
    spelled = df.select(plain.alias("_unit")).filter("_unit <> ''").distinct().select("_unit", F.posexplode(F.array("_unit", F.lower("_unit"), F.upper("_unit"))).alias("_place", "_name"))
    found = spelled.join(units.select(F.col("name").alias("_name"), "unit_id", "kind"), "_name").groupBy("_unit").agg(F.min_by(F.struct("unit_id", "kind"), F.struct("_place", "unit_id")).alias("_found"))
    joined = df.withColumn("_unit", plain).join(found, "_unit", "left")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), F.col("_found.unit_id").alias("unit_id"), F.col("_found.kind").alias("unit_kind"))


def validate_units(curves: DataFrame, units: DataFrame, conversions: DataFrame) -> DataFrame:
    """State, factor and offset of each curve (source_unit as text, target_id); checks of the target come first.

    ``conversions`` has orig_unit_id, dest_unit_id and equation.
    """
    rows = unit_lookup(curves, "source_unit", units).join(units.select(F.col("unit_id").alias("target_id"), F.col("kind").alias("target_kind")).filter("target_kind is not null"), "target_id", "left")
    rows = rows.join(conversions.select(F.col("orig_unit_id").alias("unit_id"), F.col("dest_unit_id").alias("target_id"), "equation"), ["unit_id", "target_id"], "left").withColumn("linear", values.unit_equation(F.col("equation")))
    state = (
        F.when(F.col("target_id").isNull(), "OBJETIVO_NO_DEFINIDO").when(F.col("target_kind").isNull(), "OBJETIVO_NO_EN_CATALOGO").when(F.col("unit_kind") != F.col("target_kind"), "DIMENSION_INCOMPATIBLE")
        .when(F.col("unit_id").isNull(), "ORIGEN_NO_EN_CATALOGO").when(F.col("unit_id") == F.col("target_id"), "VALIDA_MISMA_UNIDAD")
        .when(F.coalesce("equation", F.lit("")) == "", "CONVERSION_NO_ENCONTRADA").when(F.col("linear.factor").isNull(), "CONVERSION_ECUACION_NO_PARSABLE").otherwise("VALIDA_CONVERSION_OK")
    )
    rows = rows.withColumn("state", state)
    number = lambda same, c: F.when(F.col("state") == "VALIDA_MISMA_UNIDAD", F.lit(same)).when(F.col("state") == "VALIDA_CONVERSION_OK", F.col(c))
    return rows.select(*(F.col(f"`{c}`") for c in curves.columns), "unit_id", "state", number(1.0, "linear.factor").alias("factor"), number(0.0, "linear.offset").alias("offset"))


def unit_icon(state: Column) -> Column:
    """The report's class of a state. The lists are the report's own: two states are written otherwise in them and so count as none."""
    return F.when(state.isin(*VALID), "VÁLIDA").when(state.isin(*ATTENTION), "REQUIERE_ATENCION").when(state.isin(*PROBLEM), "PROBLEMA").otherwise("N/A")


def mapping_report(curves: DataFrame, variables: DataFrame, config: DataFrame, rig: int | None = None) -> DataFrame:
    """Each curve with its variable, whether the rig expects that, and the class of its unit's state.

    ``curves`` has curve_id, place, mnemonic, unit, rig_id, variable_id, method, score, state, factor, offset; ``variables``
    variable_id, name, description; ``config`` rig_id, variable_id. With ``rig``, a constant is part of the condition.
    """
    expected = config.select(F.col("rig_id").alias("_rig"), F.col("variable_id").alias("_variable")).distinct().withColumn("configured", F.lit(True))
    of_rig = F.col("_rig") == (F.col("rig_id") if rig is None else F.lit(rig))
    named = curves.join(variables.select("variable_id", F.col("name").alias("variable"), F.col("description").alias("variable_description")), "variable_id", "left")
    rows = named.join(expected, (F.col("variable_id") == F.col("_variable")) & of_rig, "left")
    is_mapped, configured = F.col("variable_id").isNotNull(), F.coalesce("configured", F.lit(False))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select(
        "curve_id", "place", "mnemonic", F.when(is_mapped & configured, "ESPERADA_ENCONTRADA").when(is_mapped, "INESPERADA_ENCONTRADA").otherwise("NO_MAPEADA").alias("category"),
        blank("variable_id").alias("variable_id"), blank("variable").alias("variable"), blank("variable_description").alias("variable_description"), F.coalesce("method", F.lit(UNMAPPED)).alias("method"),
        F.when(F.coalesce("score", F.lit(0)) != 0, F.concat(F.col("score").cast("string"), F.lit("%"))).otherwise("").alias("score"), blank("unit").alias("unit"),
        unit_icon(F.col("state")).alias("unit_class"), blank("state").alias("state"), F.when(configured, "SÍ").otherwise("NO").alias("configured"),
    )


def coverage(expected: DataFrame, found: DataFrame, group: str, item: str) -> DataFrame:
    """Expected, found, missing and unexpected items of each group, and the share found."""
    e, f = expected.select(group, item).distinct().withColumn("e", F.lit(True)), found.select(group, item).distinct().withColumn("f", F.lit(True))
    both = e.join(f, [group, item], "full")
    hit, is_e, is_f = F.col("e").isNotNull() & F.col("f").isNotNull(), F.col("e").isNotNull(), F.col("f").isNotNull()
    found = both.groupBy(group).agg(F.count_if(is_e).alias("expected"), F.count_if(hit).alias("found"), F.count_if(is_e & ~is_f).alias("missing"), F.count_if(is_f & ~is_e).alias("unexpected"))
    return found.withColumn("pct", F.when(F.col("expected") > 0, F.round(F.col("found") * 100.0 / F.col("expected"), 2)).otherwise(F.lit(0.0)))


def coverage_details(expected: DataFrame, mapped: DataFrame, group: str, item: str, details: list[str]) -> DataFrame:
    """Each expected or found item of each group with its class, and an array of what was mapped to it."""
    found = mapped.filter(F.col(item).isNotNull()).groupBy(group, item).agg(F.array_sort(F.collect_list(F.struct(*details))).alias("mappings"))
    both = expected.select(group, item).distinct().withColumn("_expected", F.lit(True)).join(found, [group, item], "full")
    kind = F.when(F.col("_expected").isNull(), "INESPERADA").when(F.col("mappings").isNull(), "FALTANTE").otherwise("ENCONTRADA")
    return both.select(group, item, kind.alias("class"), "mappings")


def undefined_targets(mapped: DataFrame, variables: DataFrame, config: DataFrame) -> DataFrame:
    """Curves whose target unit isn't defined, with their variable's name and its configurations: how many, and for which rigs."""
    per_variable = config.groupBy("variable_id").agg(F.count("*").alias("configurations"), F.array_join(F.transform(F.array_sort(F.collect_set("rig_id")), lambda x: x.cast("string")), ",").alias("rigs"))
    rows = mapped.filter(F.col("state") == "OBJETIVO_NO_DEFINIDO").join(variables.select("variable_id", F.col("name").alias("variable")), "variable_id", "left").join(per_variable, "variable_id", "left")
    return rows.select("curve_id", "variable_id", "variable", F.coalesce("configurations", F.lit(0)).alias("configurations"), F.coalesce("rigs", F.lit("")).alias("rigs"))


def pending_units(mapped: DataFrame, since: str, states: tuple[str, ...] = ("OBJETIVO_NO_DEFINIDO",)) -> DataFrame:
    """Mapped curves registered since a time whose unit check is to run again: ``validate_units`` takes them."""
    return mapped.filter((F.col("registered") >= F.lit(since).cast("timestamp")) & F.col("variable_id").isNotNull() & F.col("state").isin(*states))


def concept_curves(concepts: DataFrame, curves: DataFrame, known: DataFrame, high: float = 90.0, medium: float = 75.0) -> DataFrame:
    """concept, curve, score, level of the curves that may stand for a concept: known rules first, then by similarity of sets of words.

    ``concepts`` has concept, ``curves`` has curve, ``known`` both. Curves are compared by their stripped names; one
    curve may serve several concepts. Names meet by the words that they share, as without one the score stays low.
    """
    by_rule = known.join(curves, "curve").join(concepts, "concept").select("concept", "curve", F.lit(100.0).alias("score"), F.lit("regla").alias("level"))
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.translate(c, "_", " ")), r"\s+"), lambda w: w != ""))
    a = concepts.select("concept", F.array_join(words(F.col("concept")), " ").alias("a")).distinct()
    b = curves.select("curve", F.array_join(words(text.curve_name(F.col("curve"))), " ").alias("b")).distinct()
    meet = a.withColumn("w", F.explode(F.split("a", " "))).join(b.withColumn("w", F.explode(F.split("b", " "))), "w").select("concept", "curve", "a", "b").distinct()
    scored = meet.withColumn("score", similarity.set_similarity("a", "b")).filter(F.col("score") >= medium)
    by_words = scored.join(by_rule, ["concept", "curve"], "left_anti").select("concept", "curve", F.round("score", 4).alias("score"), F.when(F.col("score") >= high, "alta").otherwise("media").alias("level"))
    place = F.row_number().over(Window.partitionBy("concept").orderBy((F.col("level") != "regla").cast("int"), F.desc("score"), "curve"))
    return by_rule.union(by_words).withColumn("place", place.cast("long"))


def gaps(observations: DataFrame) -> DataFrame:
    """What a catalogue should learn of each mnemonic: always that it is unknown, and what is odd about it."""
    seen = observations.groupBy("mnemonic").agg(F.countDistinct("alias").alias("aliases"), F.countDistinct("unit").alias("units"), F.count("*").alias("n"))
    kinds = F.array_compact(F.array(F.lit("unknown_variable"), F.when(F.col("aliases") > 1, "potential_alias"), F.when(F.col("units") > 1, "ambiguous_mnemonic"), F.when(F.col("units") == 0, "unknown_unit_binding")))
    return seen.select("mnemonic", F.explode(kinds).alias("gap"), "n")
