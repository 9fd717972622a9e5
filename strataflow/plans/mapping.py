"""Text, unit and mapping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity, text, values
from ..operators import mapping
from .adapters import table
from .registry import query


@query("unit_frequency", "SELECT coalesce(nullif(trim(p_type), ''), 'SIN_UNIDAD') AS unit, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, unit LIMIT 15")
def unit_frequency(spark, sf_dir):
    return mapping.unit_frequency(table(spark, sf_dir, "part"), "p_type")


@query("unit_frequency_by_file", "SELECT * FROM (SELECT p_brand, coalesce(nullif(trim(p_name), ''), 'SIN_UNIDAD') AS unit, count(*) AS n FROM part GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, unit) <= 5")
def unit_frequency_by_file(spark, sf_dir):
    return mapping.unit_frequency(table(spark, sf_dir, "part"), "p_name", 5, ("p_brand",))


#: Equations of all forms, with numbers of the part, as text and as SQL makes them.
EQUATION_FORMS = ["x*A", "A*x", "x/A", "x*A+B", "x*A-B", "A*x+B", "A * X - B", "x/A+B", "x/A-B", "x+B", "x-B", "x", "(x-32)*5/9", "x*-A", "-A*x+-B", "x--B", "x/-A", "x/0", "", "x*A*B"]
_EQUATION_SQL = "CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN replace(replace('{f}', 'A', p_size || '.5'), 'B', CAST(floor(p_retailprice) AS INT) || '')" for i, f in enumerate(EQUATION_FORMS)) + " END"
_NUMBER = r"(-?\d+\.?\d*)"


def _equation_sql() -> str:
    """All patterns one after the other: first with a shift, then without."""
    n = _NUMBER
    tries = [(rf"x\*{n}\+{n}", "1", "2", 1), (rf"{n}\*x\+{n}", "1", "2", 1), (rf"x\*{n}-{n}", "1", "2", -1), (rf"{n}\*x-{n}", "1", "2", -1), (rf"x/{n}\+{n}", "/1", "2", 1), (rf"x/{n}-{n}", "/1", "2", -1),
        (rf"x\*{n}", "1", "", 1), (rf"{n}\*x", "1", "", 1), (rf"x/{n}", "/1", "", 1), (rf"x\+{n}", "", "1", 1), (rf"x-{n}", "", "1", -1), ("x", "", "", 1)]
    factor = offset = ""
    for pattern, f, o, sign in tries:
        number = lambda g, p=pattern: f"CAST(regexp_extract(t, '^{p}$', {g}) AS DOUBLE)"
        size = "1.0" if not f else f"1.0 / nullif({number(f[1:])}, 0)" if f[0] == "/" else number(f)
        factor += f" WHEN regexp_full_match(t, '{pattern}') THEN {size}"
        shift = f"{sign} * {number(o)}" if o else "0.0"
        offset += f" WHEN regexp_full_match(t, '{pattern}') THEN " + (f"CASE WHEN {number(f[1:])} <> 0 THEN {shift} END" if f.startswith("/") else shift)
    return f"CASE{factor} END AS factor, CASE{offset} END AS offset_"


@query("unit_equations", f"WITH e AS (SELECT p_partkey, {_EQUATION_SQL} AS equation FROM part), t AS (SELECT *, replace(lower(equation), ' ', '') AS t FROM e), f AS (SELECT p_partkey, equation, {_equation_sql()} FROM t) SELECT p_partkey, equation, round(factor, 10) AS factor, round(offset_, 10) AS offset_ FROM f")
def unit_equations(spark, sf_dir):
    form = F.element_at(F.array(*map(F.lit, EQUATION_FORMS)), (F.col("p_partkey") % 20 + 1).cast("int"))
    price = F.floor("p_retailprice").cast("string")
    equation = F.replace(F.replace(form, F.lit("A"), F.concat(F.col("p_size").cast("string"), F.lit(".5"))), F.lit("B"), price)
    rows = table(spark, sf_dir, "part").select("p_partkey", equation.alias("equation")).withColumn("linear", values.unit_equation(F.col("equation")))
    return rows.select("p_partkey", "equation", F.col("linear.factor").alias("factor"), F.col("linear.offset").alias("offset_"))


UNITS = [(1, "m", "length"), (2, "ft", "length"), (3, "PSI", "pressure"), (4, "kpa", "pressure"), (5, "degC", "temperature"), (6, "degc", "temperature")]
CONVERSIONS = [(2, 1, "x*0.3048"), (3, 4, "x*6.894757"), (4, 3, "(x-1)*2"), (6, 5, "")]
_UNITS_SQL = "u AS (SELECT * FROM (VALUES " + ", ".join(map(str, UNITS)) + ") t(unit_id, name, kind)), e AS (SELECT * FROM (VALUES " + ", ".join(map(str, CONVERSIONS)) + ") t(o, d, equation))"
_CURVES_SQL = """c AS (SELECT p_partkey, CASE p_size % 9 WHEN 0 THEN 'FT' WHEN 1 THEN ' M ' WHEN 2 THEN 'psi' WHEN 3 THEN 'kPa' WHEN 4 THEN 'furlong' WHEN 5 THEN 'degC' WHEN 6 THEN 'DEGC' WHEN 7 THEN '' END AS source_unit,
    CASE p_partkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 99 WHEN 4 THEN 5 WHEN 5 THEN 2 END AS target_id FROM part)"""
_LOOKUP_SQL = "l AS (SELECT c.*, coalesce((SELECT min(unit_id) FROM u WHERE name = trim(source_unit)), (SELECT min(unit_id) FROM u WHERE name = lower(trim(source_unit))), (SELECT min(unit_id) FROM u WHERE name = upper(trim(source_unit)))) AS unit_id FROM c)"


def _unit_curves(spark, sf_dir):
    size, key = F.col("p_size") % 9, F.col("p_partkey") % 8
    source, target = None, None
    for i, name in enumerate(("FT", " M ", "psi", "kPa", "furlong", "degC", "DEGC", "")):
        source = F.when(size == i, name) if source is None else source.when(size == i, name)
    for i, unit in enumerate((1, 4, 3, 99, 5, 2)):
        target = F.when(key == i, unit) if target is None else target.when(key == i, unit)
    return table(spark, sf_dir, "part").select("p_partkey", source.alias("source_unit"), target.alias("target_id"))


def _units(spark):
    return spark.createDataFrame(UNITS, "unit_id int, name string, kind string")


@query("unit_lookup", f"WITH {_CURVES_SQL}, {_UNITS_SQL}, {_LOOKUP_SQL} SELECT p_partkey, l.unit_id, u.kind AS unit_kind FROM l LEFT JOIN u USING (unit_id)")
def unit_lookup(spark, sf_dir):
    return mapping.unit_lookup(_unit_curves(spark, sf_dir), "source_unit", _units(spark)).select("p_partkey", "unit_id", "unit_kind")


STATE_SQL = f"""{_CURVES_SQL}, {_UNITS_SQL}, {_LOOKUP_SQL}, j AS (SELECT l.*, a.kind AS sk, b.kind AS tk, equation FROM l LEFT JOIN u a ON a.unit_id = l.unit_id LEFT JOIN u b ON b.unit_id = target_id LEFT JOIN e ON o = l.unit_id AND d = target_id),
  s AS (SELECT p_partkey, CASE WHEN target_id IS NULL THEN 'OBJETIVO_NO_DEFINIDO' WHEN tk IS NULL THEN 'OBJETIVO_NO_EN_CATALOGO' WHEN sk IS NOT NULL AND sk <> tk THEN 'DIMENSION_INCOMPATIBLE' WHEN unit_id IS NULL THEN 'ORIGEN_NO_EN_CATALOGO'
    WHEN unit_id = target_id THEN 'VALIDA_MISMA_UNIDAD' WHEN equation IS NULL OR equation = '' THEN 'CONVERSION_NO_ENCONTRADA' WHEN equation LIKE '(%' THEN 'CONVERSION_ECUACION_NO_PARSABLE' ELSE 'VALIDA_CONVERSION_OK' END AS state, equation FROM j)"""


@query("unit_validation", f"""WITH {STATE_SQL} SELECT p_partkey, state, CASE state WHEN 'VALIDA_MISMA_UNIDAD' THEN 1.0::DOUBLE WHEN 'VALIDA_CONVERSION_OK' THEN CAST(replace(equation, 'x*', '') AS DOUBLE) END AS factor,
  CASE WHEN state LIKE 'VALIDA%' THEN 0.0::DOUBLE END AS offset_ FROM s""")
def unit_validation(spark, sf_dir):
    found = mapping.validate_units(_unit_curves(spark, sf_dir), _units(spark), spark.createDataFrame(CONVERSIONS, "orig_unit_id int, dest_unit_id int, equation string"))
    return found.select("p_partkey", "state", "factor", F.col("offset").alias("offset_"))


@query("converted_values", f"WITH {STATE_SQL} SELECT p_partkey, state, round(CASE state WHEN 'VALIDA_MISMA_UNIDAD' THEN p_retailprice WHEN 'VALIDA_CONVERSION_OK' THEN p_retailprice * CAST(replace(equation, 'x*', '') AS DOUBLE) END, 6) AS y FROM s JOIN part USING (p_partkey)")
def converted_values(spark, sf_dir):
    found = unit_validation(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_partkey")
    return found.select("p_partkey", "state", F.round(values.converted(F.col("p_retailprice"), F.col("factor"), F.col("offset_")), 6).alias("y"))


def _sql_collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


NORMAL_SQL = rf"""SELECT p_partkey, {_sql_collapse(r"regexp_replace(regexp_replace(regexp_replace(lower(p_name), 'ñ', 'n', 'g'), '[_:(/\-.)]+', ' ', 'g'), '[\[\]()]', '', 'g')")} AS comparable,
  {_sql_collapse(r"replace(regexp_replace(replace(upper(p_type), 'Ñ', 'N'), '[^A-Z0-9_\s\-.()/]', '', 'g'), '/', '-')")} AS well, lower({_sql_collapse('p_name')}) AS normal,
  trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS tag, regexp_extract(p_brand, '(\d+)', 1) AS number FROM part"""


@query("text_normalize", NORMAL_SQL)
def text_normalize(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "part").select("p_partkey", text.comparable(c("p_name")).alias("comparable"), text.well_name(c("p_type")).alias("well"), text.normal(c("p_name")).alias("normal"), text.tag(c("p_brand")).alias("tag"), text.first_number(c("p_brand")).alias("number"))


@query("curve_names", r"""WITH c AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'DBA_' WHEN 1 THEN 'wc_' WHEN 2 THEN 'DIR-' WHEN 3 THEN '' ELSE 'X_' END || p_type || CASE p_size % 4 WHEN 0 THEN '_EST' WHEN 1 THEN '_final' ELSE ' (b)' END AS mnemonic FROM part)
  SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(upper(mnemonic)), '^(DBA_|WC_|KZ_|RAW_|WSGD_|DIR-|GEO-)', ''), '(_EST|_CALC|_RT|_CORR|_FINAL|_PROMEDIO|_REPROCESSED)$', ''), '[\s.\-/()]+', '_', 'g'), '[^A-Z0-9_]', '', 'g') AS name FROM c""")
def curve_names(spark, sf_dir):
    size = F.col("p_size")
    before = F.when(size % 5 == 0, "DBA_").when(size % 5 == 1, "wc_").when(size % 5 == 2, "DIR-").when(size % 5 == 3, "").otherwise("X_")
    behind = F.when(size % 4 == 0, "_EST").when(size % 4 == 1, "_final").otherwise(" (b)")
    return table(spark, sf_dir, "part").select("p_partkey", text.curve_name(F.concat(before, "p_type", behind)).alias("name"))


@query("well_components", r"""WITH w AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'PZ.xp-' || s_suppkey WHEN 1 THEN 'LMC-' || s_suppkey || '(H)' WHEN 2 THEN 'ABCD ' || s_suppkey || ' K' ELSE 'sin nombre' END AS name FROM supplier),
  d AS (SELECT *, regexp_matches(name, '([A-Z]+)\.([a-zA-Z]+)[\s\-]+(\d+)') AS dotted, replace(nullif(regexp_extract(name, '([A-Z.\-]+)[\s\-]+(\d+)', 1), ''), '-', '') AS code, nullif(regexp_extract(name, '([A-Z.\-]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?', 3), '') AS suffix FROM w)
  SELECT s_suppkey, CASE WHEN dotted THEN upper(regexp_extract(name, '\.([a-zA-Z]+)', 1)) WHEN length(code) = 4 AND suffix IS NOT NULL THEN code[1:3] ELSE code END AS code,
    nullif(CASE WHEN dotted THEN regexp_extract(name, '(\d+)', 1) ELSE regexp_extract(name, '([A-Z.\-]+)[\s\-]+(\d+)', 2) END, '') AS number, CASE WHEN NOT dotted THEN suffix END AS suffix, CASE WHEN dotted THEN regexp_extract(name, '([A-Z]+)\.', 1) END AS field FROM d""")
def well_components(spark, sf_dir):
    key = F.col("s_suppkey")
    name = F.when(key % 4 == 0, F.concat(F.lit("PZ.xp-"), key.cast("string"))).when(key % 4 == 1, F.concat(F.lit("LMC-"), key.cast("string"), F.lit("(H)"))).when(key % 4 == 2, F.concat(F.lit("ABCD "), key.cast("string"), F.lit(" K"))).otherwise("sin nombre")
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.name_parts(name).alias("p")).select("s_suppkey", "p.code", "p.number", "p.suffix", "p.field")


def _any_sql(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def category_sql(x: str) -> str:
    """The category of a normalised text, as the tests of the fixed table in order."""
    families = []
    for family, words, kinds in text.CATEGORIES:
        inner = " ".join(f"WHEN {_any_sql(x, hints)} THEN '{family}_{kind}'" for kind, hints in kinds)
        families.append(f"WHEN {_any_sql(x, words)} THEN CASE {inner} ELSE '{family}_GENERAL' END")
    return f"CASE {' '.join(families)} ELSE 'GENERAL' END"


def compatible_sql(a: str, b: str) -> str:
    return f"({a} = {b} OR (split_part({a}, '_', 1) = split_part({b}, '_', 1) AND ({a} LIKE '%\\_GENERAL' ESCAPE '\\' OR {b} LIKE '%\\_GENERAL' ESCAPE '\\')) OR {a} = 'GENERAL' OR {b} = 'GENERAL')"


def factor_sql(a: str, b: str) -> str:
    special = " ".join(f"WHEN ({a} = '{f}_GENERAL' AND {b} = '{f}_{k}') OR ({a} = '{f}_{k}' AND {b} = '{f}_GENERAL') THEN {x}" for (f, k), x in text.KIND_FACTORS.items())
    return f"CASE WHEN NOT {compatible_sql(a, b)} THEN {text.INCOMPATIBLE_FACTOR} {special} ELSE 1.0 END"


def comparable_sql(x: str) -> str:
    return _sql_collapse(rf"regexp_replace(regexp_replace(regexp_replace(lower({x}), 'ñ', 'n', 'g'), '[_:(/\-.)]+', ' ', 'g'), '[\[\]()]', '', 'g')")


#: Pairs' longest common subsequences, a character of ``a`` at a time; pairs are (a, b).
RATIOS_SQL = """lcs(a, b, i, row) AS (SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda j: 0) FROM pairs UNION ALL
    SELECT a, b, i + 1, list_transform(range(0, length(b) + 1), lambda j: greatest(row[j + 1], coalesce(list_max(list_transform(list_filter(range(1, j + 1), lambda k: b[k] = a[i + 1]), lambda k: row[k] + 1)), 0))) FROM lcs WHERE i < length(a)),
  ratios AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100.0 ELSE 200.0 * row[length(b) + 1] / (length(a) + length(b)) END AS ratio FROM lcs WHERE i = length(a))"""

_NAMED_SQL = "CASE p_size % 6 WHEN 0 THEN 'Casing Pressure ' WHEN 1 THEN 'Flow In ' WHEN 2 THEN 'Bit Status ' WHEN 3 THEN 'Torque Raw ' WHEN 4 THEN 'H2S Pileta ' ELSE '' END || p_name"


def _named():
    size = F.col("p_size") % 6
    before = F.when(size == 0, "Casing Pressure ").when(size == 1, "Flow In ").when(size == 2, "Bit Status ").when(size == 3, "Torque Raw ").when(size == 4, "H2S Pileta ").otherwise("")
    return F.concat(before, "p_name")


@query("curve_category", f"SELECT p_partkey, {category_sql(comparable_sql('(' + _NAMED_SQL + ')'))} AS category FROM part")
def curve_category(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.category(_named()).alias("category"))


CATEGORY_NAMES = ["GENERAL", *(f"{f}_{k}" for f, _, kinds in text.CATEGORIES for k in ["GENERAL", *(k for k, _ in kinds)])]
_INCOMPATIBLE = "(a, b) IN (('FLUJO_ENTRADA','FLUJO_SALIDA'),('PRESION_AIRE','PRESION_CASING'),('STATUS_BIT','STATUS_SLIP'),('TORQUE_RAW','TORQUE_ROTARY'))"


@query("category_matrix", f"""WITH c AS (SELECT DISTINCT {category_sql(comparable_sql('(' + _NAMED_SQL + ')'))} AS c FROM part), p AS (SELECT x.c AS a, y.c AS b FROM c x, c y) SELECT a, b, {compatible_sql('a', 'b')} AS compatible, CAST({factor_sql('a', 'b')} AS DOUBLE) AS factor FROM p""")
def category_matrix(spark, sf_dir):
    c = curve_category(spark, sf_dir).select("category").distinct()
    a, b = c.select(F.col("category").alias("a")), F.broadcast(c.select(F.col("category").alias("b")))  # as many rows as the table of categories has
    pairs = a.join(b, F.lit(True))
    return pairs.select("a", "b", text.compatible(F.col("a"), F.col("b")).alias("compatible"), text.category_factor(F.col("a"), F.col("b")).alias("factor"))


_MNEMONIC_SQL = f"CASE p_size % 7 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) || '_EST' WHEN 2 THEN p_type WHEN 3 THEN {_NAMED_SQL} WHEN 4 THEN p_brand WHEN 5 THEN replace(p_name, ' ', '.') WHEN 6 THEN '' END"
MAP_SQL = f"""WITH RECURSIVE curves AS (SELECT p_partkey AS curve_id, p_partkey % 3 AS rig_id, {_MNEMONIC_SQL} AS mnemonic FROM part), rules AS (SELECT p_partkey AS rule_id, p_partkey % 3 AS rig_id, p_brand AS mnemonic, p_size AS variable_id, p_size % 2 = 0 AS imports FROM part WHERE p_brand LIKE '%1'),
  texts AS (SELECT p_partkey AS variable_id, p_partkey % 3 AS rig_id, 0 AS place, {comparable_sql('(' + _NAMED_SQL + ')')} AS plain FROM part
    UNION ALL SELECT p_partkey, p_partkey % 3, 1, {comparable_sql('p_type')} FROM part WHERE p_size % 10 = 0 UNION ALL SELECT p_partkey, p_partkey % 3, 2, {comparable_sql("(' Brand-' || p_size)")} FROM part WHERE p_size % 10 = 0),
  names AS (SELECT DISTINCT rig_id, mnemonic, {comparable_sql('mnemonic')} AS plain FROM curves WHERE mnemonic <> ''),
  r AS (SELECT * FROM rules QUALIFY row_number() OVER (PARTITION BY rig_id, mnemonic ORDER BY rule_id DESC) = 1),
  al AS (SELECT rig_id, plain, variable_id FROM texts WHERE place > 0 QUALIFY row_number() OVER (PARTITION BY rig_id, plain ORDER BY variable_id, place) = 1),
  o AS (SELECT rig_id, plain AS option, max_by(variable_id, variable_id * 4 + place) AS variable_id, min(variable_id * 4 + place) AS first FROM texts WHERE plain <> '' GROUP BY ALL),
  near AS (SELECT n.rig_id, n.plain, option, o.variable_id, first, {category_sql('n.plain')} AS ca, {category_sql('option')} AS cb FROM (SELECT DISTINCT rig_id, plain FROM names WHERE plain <> '') n JOIN o ON n.rig_id = o.rig_id),
  fit AS (SELECT * FROM near WHERE {compatible_sql('ca', 'cb')}), pairs AS (SELECT DISTINCT plain AS a, option AS b FROM fit), {RATIOS_SQL},
  best AS (SELECT rig_id, plain, variable_id, CAST(floor(ratio * {factor_sql('ca', 'cb')}) AS INT) AS score FROM fit JOIN ratios ON plain = a AND option = b WHERE ratio >= 70 QUALIFY row_number() OVER (PARTITION BY rig_id, plain ORDER BY ratio DESC, first) = 1),
  m AS (SELECT c.curve_id, CASE WHEN r.rule_id IS NOT NULL THEN r.variable_id WHEN al.variable_id IS NOT NULL THEN al.variable_id WHEN best.score >= 70 THEN best.variable_id END AS variable_id, r.rule_id, coalesce(r.imports, false) AS imports,
    CASE WHEN r.rule_id IS NOT NULL THEN 'EXACTO_CONFIG_EQUIPO' WHEN al.variable_id IS NOT NULL THEN 'ALIAS_EXACTO_PAE_EN_RIG' WHEN best.score >= 70 THEN 'FUZZY_PAE_EN_RIG' END AS method,
    CASE WHEN r.rule_id IS NOT NULL OR al.variable_id IS NOT NULL THEN 100 WHEN best.score >= 70 THEN best.score END AS score
    FROM curves c LEFT JOIN names n ON n.rig_id = c.rig_id AND n.mnemonic = c.mnemonic LEFT JOIN r ON r.rig_id = n.rig_id AND r.mnemonic = n.mnemonic LEFT JOIN al ON al.rig_id = n.rig_id AND al.plain = n.plain AND n.plain <> ''
    LEFT JOIN best ON best.rig_id = n.rig_id AND best.plain = n.plain)"""


def _mapped(spark, sf_dir):
    part, c = table(spark, sf_dir, "part"), F.col
    size, rig = c("p_size") % 7, (c("p_partkey") % 3).alias("rig_id")
    mnemonic = F.when(size == 0, c("p_name")).when(size == 1, F.concat(F.upper("p_name"), F.lit("_EST"))).when(size == 2, c("p_type")).when(size == 3, _named()).when(size == 4, c("p_brand")).when(size == 5, F.replace("p_name", F.lit(" "), F.lit("."))).otherwise("")
    curves = part.select(c("p_partkey").alias("curve_id"), rig, mnemonic.alias("mnemonic"))
    rules = part.filter(c("p_brand").like("%1")).select(c("p_partkey").alias("rule_id"), rig, c("p_brand").alias("mnemonic"), c("p_size").cast("long").alias("variable_id"), (c("p_size") % 2 == 0).alias("imports"))
    aliases = F.when(c("p_size") % 10 == 0, F.concat("p_type", F.lit(", Brand-"), c("p_size").cast("string")))
    variables = part.select(c("p_partkey").alias("variable_id"), rig, c("p_partkey").alias("position"), _named().alias("name"), aliases.alias("aliases"))
    return mapping.map_curves(curves, rules, variables)


@query("fuzzy_match", f"{MAP_SQL} SELECT * FROM m")
def fuzzy_match(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query("mapping_outcomes", f"""{MAP_SQL}, x AS (SELECT CASE WHEN method LIKE 'EXACTO%' THEN 1 WHEN method LIKE 'ALIAS%' THEN 2 WHEN score >= 80 THEN 3 WHEN score IS NOT NULL THEN 4 ELSE 5 END AS k FROM m)
  SELECT count_if(k = 1) AS mapeada_exacto_importar, count_if(k = 2) AS sugerencia_alias_exacto_en_rig, count_if(k = 3) AS mapeada_fuzzy_autoimportar, count_if(k = 4) AS sugerencia_fuzzy_en_rig_revisar, count_if(k = 5) AS no_mapeada_revisar, count(*) AS total FROM x""")
def mapping_outcomes(spark, sf_dir):
    return mapping.outcome_counts(_mapped(spark, sf_dir))


_REPORT_CURVES_SQL = """w AS (SELECT p_partkey AS curve_id, p_size AS place, p_name AS mnemonic, p_type AS unit, p_partkey % 4 AS rig_id, CASE WHEN p_size % 3 > 0 THEN p_size END AS variable_id, CASE WHEN p_size % 3 > 0 THEN 'EXACTO_CONFIG_EQUIPO' END AS method, CASE WHEN p_size % 3 > 0 THEN p_size + 50 END AS score FROM part),
  v AS (SELECT n_nationkey AS variable_id, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'about ' || n_name END AS description FROM nation), g AS (SELECT DISTINCT s_nationkey % 4 AS rig_id, s_nationkey AS variable_id FROM supplier)"""


def _report_sides(spark, sf_dir):
    mapped, c = F.col("p_size") % 3 > 0, F.col
    curves = table(spark, sf_dir, "part").select(c("p_partkey").alias("curve_id"), c("p_size").alias("place"), c("p_name").alias("mnemonic"), c("p_type").alias("unit"), (c("p_partkey") % 4).alias("rig_id"), F.when(mapped, c("p_size")).alias("variable_id"), F.when(mapped, mapping.EXACT).alias("method"), F.when(mapped, c("p_size") + 50).alias("score"), "p_partkey")
    curves = curves.join(unit_validation(spark, sf_dir).select("p_partkey", "state"), "p_partkey").drop("p_partkey")
    variables = table(spark, sf_dir, "nation").select(c("n_nationkey").alias("variable_id"), c("n_name").alias("name"), F.when(c("n_nationkey") % 2 == 0, F.concat(F.lit("about "), "n_name")).alias("description"))
    config = table(spark, sf_dir, "supplier").select((c("s_nationkey") % 4).alias("rig_id"), c("s_nationkey").alias("variable_id")).distinct()
    return curves, variables, config


@query("mapping_report", f"""WITH {STATE_SQL}, {_REPORT_CURVES_SQL} SELECT curve_id, place, mnemonic, CASE WHEN w.variable_id IS NOT NULL AND g.rig_id IS NOT NULL THEN 'ESPERADA_ENCONTRADA' WHEN w.variable_id IS NOT NULL THEN 'INESPERADA_ENCONTRADA' ELSE 'NO_MAPEADA' END AS category,
  coalesce(CAST(w.variable_id AS VARCHAR), '') AS variable_id, coalesce(v.name, '') AS variable, coalesce(v.description, '') AS variable_description, coalesce(method, 'NO_MAPEADA_REVISAR') AS method, CASE WHEN score IS NOT NULL THEN score || '%' ELSE '' END AS score, unit,
  CASE WHEN state IN ('VALIDA_MISMA_UNIDAD', 'VALIDA_CONVERSION_OK') THEN 'VÁLIDA' WHEN state IN ('CONVERSION_NO_ENCONTRADA', 'DIMENSION_INCOMPATIBLE', 'ECUACION_NO_PARSABLE') THEN 'REQUIERE_ATENCION' WHEN state IN ('ORIGEN_NO_EN_CATALOGO', 'OBJETIVO_NO_CATALOGO', 'OBJETIVO_NO_DEFINIDO') THEN 'PROBLEMA' ELSE 'N/A' END AS unit_class,
  state, CASE WHEN g.rig_id IS NOT NULL THEN 'SÍ' ELSE 'NO' END AS configured FROM w JOIN s ON s.p_partkey = curve_id LEFT JOIN v ON v.variable_id = w.variable_id LEFT JOIN g ON g.variable_id = w.variable_id AND g.rig_id = 2""")
def mapping_report(spark, sf_dir):
    return mapping.mapping_report(*_report_sides(spark, sf_dir), rig=2)


@query("undefined_targets", f"""WITH {STATE_SQL}, {_REPORT_CURVES_SQL}, k AS (SELECT variable_id, count(*) AS configurations, string_agg(CAST(rig_id AS VARCHAR), ',' ORDER BY rig_id) AS rigs FROM g GROUP BY 1)
  SELECT curve_id, w.variable_id, v.name AS variable, coalesce(configurations, 0) AS configurations, coalesce(rigs, '') AS rigs FROM w JOIN s ON s.p_partkey = curve_id LEFT JOIN v ON v.variable_id = w.variable_id LEFT JOIN k ON k.variable_id = w.variable_id WHERE state = 'OBJETIVO_NO_DEFINIDO'""")
def undefined_targets(spark, sf_dir):
    return mapping.undefined_targets(*_report_sides(spark, sf_dir))


@query("coverage_details", """WITH e AS (SELECT DISTINCT p_brand AS brand, p_type FROM part WHERE p_size <= 30), f AS (SELECT p_brand AS brand, p_type, string_agg(p_partkey || ':' || p_size, ',' ORDER BY p_partkey) AS mappings FROM part WHERE p_size > 20 GROUP BY ALL)
  SELECT coalesce(e.brand, f.brand) AS brand, coalesce(e.p_type, f.p_type) AS p_type, CASE WHEN e.brand IS NULL THEN 'INESPERADA' WHEN f.brand IS NULL THEN 'FALTANTE' ELSE 'ENCONTRADA' END AS class, mappings FROM e FULL JOIN f ON e.brand = f.brand AND e.p_type = f.p_type""")
def coverage_details(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    found = mapping.coverage_details(part.filter("p_size <= 30"), part.filter("p_size > 20"), "brand", "p_type", ["p_partkey", "p_size"])
    listed = F.array_join(F.transform("mappings", lambda m: F.concat(m["p_partkey"].cast("string"), F.lit(":"), m["p_size"].cast("string"))), ",")
    return found.select("brand", "p_type", "class", listed.alias("mappings"))


@query("concept_curves")
def concept_curves(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    known = part.select(F.col("p_type").alias("concept"), F.col("p_name").alias("curve")).filter("concept = 'SMALL'").distinct()
    return mapping.concept_curves(part.select(F.concat_ws(" ", "p_type", "p_name").alias("concept")).union(part.select("p_type")).distinct(), part.select(F.col("p_name").alias("curve")).distinct(), known)


@query("coverage_report", """WITH e AS (SELECT DISTINCT p_brand AS g, p_type AS i FROM part WHERE p_size <= 30), f AS (SELECT DISTINCT p_brand AS g, p_type AS i FROM part WHERE p_size > 20)
  SELECT g AS brand, count(e.i) AS expected, count_if(e.i IS NOT NULL AND f.i IS NOT NULL) AS found, count_if(f.i IS NULL) AS missing, count_if(e.i IS NULL) AS unexpected,
  CASE WHEN count(e.i) > 0 THEN round(count_if(e.i IS NOT NULL AND f.i IS NOT NULL) * 100.0 / count(e.i), 2) ELSE 0.0 END AS pct FROM e FULL JOIN f USING (g, i) GROUP BY g""".replace("FULL JOIN f USING (g, i)", "FULL JOIN f ON e.g = f.g AND e.i = f.i").replace("SELECT g AS brand", "SELECT coalesce(e.g, f.g) AS brand").replace("GROUP BY g", "GROUP BY 1"))
def coverage_report(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    return mapping.coverage(part.filter("p_size <= 30"), part.filter("p_size > 20"), "brand", "p_type")


@query("las_gaps", """WITH o AS (SELECT p_type AS mnemonic, p_brand AS alias, CASE WHEN p_size > 25 THEN CAST(p_size % 3 AS VARCHAR) END AS unit FROM part),
  s AS (SELECT mnemonic, count(DISTINCT alias) AS aliases, count(DISTINCT unit) AS units, count(*) AS n FROM o GROUP BY 1)
  SELECT mnemonic, 'unknown_variable' AS gap, n FROM s UNION ALL SELECT mnemonic, 'potential_alias', n FROM s WHERE aliases > 1 UNION ALL SELECT mnemonic, 'ambiguous_mnemonic', n FROM s WHERE units > 1 UNION ALL SELECT mnemonic, 'unknown_unit_binding', n FROM s WHERE units = 0""")
def las_gaps(spark, sf_dir):
    unit = F.when(F.col("p_size") > 25, (F.col("p_size") % 3).cast("string"))
    return mapping.gaps(table(spark, sf_dir, "part").select(F.col("p_type").alias("mnemonic"), F.col("p_brand").alias("alias"), unit.alias("unit")))


@query("online_state", "SELECT event_id, CASE WHEN date_sub('hour', ts, (SELECT max(ts) FROM events)) < 6 THEN 'online' ELSE 'offline' END AS state FROM events")
def online_state(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hours = F.timestamp_diff("HOUR", F.col("ts"), events.agg(F.max("ts")).scalar())
    return events.select("event_id", F.when(hours < 6, "online").otherwise("offline").alias("state"))


@query("uuid5_ids", r"""WITH s AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('doc:' || doc_id)) AS h FROM documents)
  SELECT doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || CASE CAST('0x' || h[17] AS INT) % 4 WHEN 0 THEN '8' WHEN 1 THEN '9' WHEN 2 THEN 'a' ELSE 'b' END || h[18:20] || '-' || h[21:32] AS id FROM s""")
def uuid5_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.url_id(F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("id"))


@query("name_similarity", f"""WITH RECURSIVE pairs AS (SELECT DISTINCT x.t AS a, y.p_name AS b FROM (SELECT DISTINCT p_brand, p_type || ' ' || p_name AS t FROM part) x JOIN (SELECT DISTINCT p_brand, p_name FROM part) y USING (p_brand)), {RATIOS_SQL} SELECT a, b, round(ratio, 4) AS ratio FROM ratios WHERE ratio >= 60""")
def name_similarity(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    a, b = part.select("p_brand", F.concat_ws(" ", "p_type", "p_name").alias("a")).distinct(), part.select("p_brand", F.col("p_name").alias("b")).distinct()
    return similarity.similar_pairs(a, b, "a", "b", 60.0, ["p_brand"]).select("a", "b", F.round("ratio", 4).alias("ratio")).distinct()
