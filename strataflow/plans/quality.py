"""Quality-monitor queries over the adapter views.

The SQL follows the statements that the monitor's pages send to their database, with a rig's loop as one
statement for all rigs, and not the DataFrame code beside it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from .adapters import QUALITY_SQL, quality_hours, rigs, wells
from .registry import query

#: The day that reports end at: the data end in a year that has fewer facts.
AS_OF = "2001-06-15"
SINCE, UNTIL = "1997-01-01", "1998-12-31"
WITH = "WITH " + QUALITY_SQL
DAY = f"DATE '{AS_OF}'"


def _as_of():
    return F.lit(AS_OF).cast("date")


def _recent(spark, sf_dir, days=quality.MONITOR_DAYS):
    return quality.recent(quality_hours(spark, sf_dir), days, _as_of())


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


def _round(x: str, digits: int = 1) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _window(days: int) -> str:
    return f"date >= {DAY} - INTERVAL {days} DAY AND date <= {DAY}"


SUMMARY_SQL = f"""{WITH}, summary AS (
  SELECT r.id AS rig_id, r.name, r.rig_type, count(DISTINCT e.date) AS days, count(DISTINCT CAST(e.date AS VARCHAR) || '_' || e.well_id) AS day_wells, count(DISTINCT e.well_id) AS wells,
    count(DISTINCT e.variable_name) AS variables, {_sum('e.horas')} AS hours, {_sum('e.value_present')} AS hours_present, {_sum('e.value_null')} AS hours_null,
    {_round(_sum('e.value_present') + ' / nullif(' + _sum('e.horas') + ', 0) * 100')} AS pct_present, CAST(min(e.date) AS VARCHAR) AS first_date, CAST(max(e.date) AS VARCHAR) AS last_date,
    CAST({DAY} + 1 - max(e.date) AS BIGINT) AS idle_days, CASE WHEN {DAY} + 1 - max(e.date) <= 1 THEN 'ACTIVO' WHEN {DAY} + 1 - max(e.date) <= 3 THEN 'ALERTA' ELSE 'INACTIVO' END AS state
  FROM quality_hours e JOIN rigs r ON e.rig_id = r.id WHERE r.rig_type = 'PUL' AND {_window(14)} GROUP BY r.id, r.name, r.rig_type)"""


@query("rig_summary", f"{SUMMARY_SQL} SELECT * FROM summary")
def rig_summary(spark, sf_dir):
    return quality.rig_summary(_recent(spark, sf_dir), rigs(spark, sf_dir), _as_of()).orderBy(*quality.monitor_order())


ACTIVITY_SQL = f"""{WITH}, d AS (SELECT rig_id, date, count(DISTINCT well_id) AS wells, count(DISTINCT variable_name) AS variables, {_sum('horas')} AS hours, {_sum('value_present')} AS hours_present, {_sum('value_null')} AS hours_null
    FROM quality_hours WHERE {_window(14)} GROUP BY rig_id, date),
  a AS (SELECT rig_id, date, variable_name, {_sum('horas')} AS h, {_sum('value_present')} AS p, {_sum('value_range_in')} AS r FROM quality_hours WHERE {_window(14)} AND requerido = 'SI' GROUP BY rig_id, date, variable_name),
  i AS (SELECT rig_id, date, sum(CASE WHEN p <= 0 THEN 1 ELSE 0 END) AS missing, sum(CASE WHEN p > 0 AND p / nullif(h, 0) * 100 < 90 THEN 1 ELSE 0 END) AS incomplete,
    sum(CASE WHEN p > 0 AND r / nullif(h, 0) * 100 < 85 THEN 1 ELSE 0 END) AS out_of_range FROM a GROUP BY rig_id, date),
  activity AS (SELECT rig_id, CAST(date AS VARCHAR) AS date, wells, variables, hours, hours_present, hours_null, {_round('hours_present / nullif(hours, 0) * 100')} AS pct_present, CAST(coalesce(missing, 0) AS BIGINT) AS missing,
    CAST(coalesce(incomplete, 0) AS BIGINT) AS incomplete, CAST(coalesce(out_of_range, 0) AS BIGINT) AS out_of_range, CAST(coalesce(missing, 0) + coalesce(incomplete, 0) + coalesce(out_of_range, 0) AS BIGINT) AS issues FROM d LEFT JOIN i USING (rig_id, date))"""


@query("daily_activity", f"{ACTIVITY_SQL} SELECT * FROM activity")
def daily_activity(spark, sf_dir):
    return quality.daily_activity(_recent(spark, sf_dir))


@query("activity_map", f"{ACTIVITY_SQL} SELECT rig_id, count(*) AS days, CAST(max(CASE WHEN date = '{AS_OF}' THEN issues END) AS BIGINT) AS issues FROM activity GROUP BY rig_id")
def activity_map(spark, sf_dir):
    found = quality.activity_map(daily_activity(spark, sf_dir))
    return found.select("rig_id", F.size("by_date").cast("long").alias("days"), F.try_element_at("by_date", F.lit(AS_OF))["issues"].alias("issues"))


@query("top_wells", f"""{WITH}, w AS (SELECT e.rig_id, w.id, w.name AS well, max(e.date) AS last, count(DISTINCT e.variable_name) AS variables, {_sum('e.horas')} AS hours, {_round(_sum('e.value_present') + ' / nullif(' + _sum('e.horas') + ', 0) * 100')} AS pct_present
    FROM quality_hours e JOIN wells w ON e.well_id = w.id WHERE {_window(7)} GROUP BY e.rig_id, w.id, w.name)
  SELECT rig_id, well, CAST(last AS VARCHAR) AS last_date, variables, hours, pct_present, row_number() OVER (PARTITION BY rig_id ORDER BY last DESC, id) AS place FROM w QUALIFY place <= 10""")
def top_wells(spark, sf_dir):
    return quality.top_wells(_recent(spark, sf_dir, quality.LIST_DAYS), wells(spark, sf_dir))


@query("worst_variables", f"""{WITH}, l AS (SELECT rig_id, variable_name, {_sum('horas')} AS hours, {_sum('value_null')} AS hours_null, {_round(_sum('value_null') + ' / nullif(' + _sum('horas') + ', 0) * 100')} AS pct_null
    FROM quality_hours WHERE {_window(7)} AND requerido = 'SI' GROUP BY rig_id, variable_name HAVING pct_null > 0)
  SELECT *, row_number() OVER (PARTITION BY rig_id ORDER BY pct_null DESC, variable_name) AS place FROM l QUALIFY place <= 5""")
def worst_variables(spark, sf_dir):
    return quality.worst_variables(_recent(spark, sf_dir, quality.LIST_DAYS))


def _stats_sql(source: str) -> str:
    return f"""SELECT count(*) AS rigs, count_if(state = 'ACTIVO') AS active, count_if(state = 'ALERTA') AS alert, count_if(state = 'INACTIVO') AS inactive, CAST(coalesce(sum(wells), 0) AS BIGINT) AS wells,
  round(coalesce(CAST(sum(CAST(pct_present AS DECIMAL(18,4))) AS DOUBLE), 0) / greatest(count(*), 1), 1) AS mean_present FROM {source}"""


@query("global_stats", f"{SUMMARY_SQL} {_stats_sql('summary')}")
def global_stats(spark, sf_dir):
    return quality.global_stats(rig_summary(spark, sf_dir))


@query("filtered_stats", f"{SUMMARY_SQL} {_stats_sql('''(SELECT * FROM summary WHERE contains(lower(name), 'er#0') AND state = 'ALERTA' AND days >= 2)''')}")
def filtered_stats(spark, sf_dir):
    return quality.global_stats(quality.filtered(rig_summary(spark, sf_dir), "ER#0", "ALERTA", 2))


def _detail_sql(more: str) -> str:
    pct = lambda c, n: f"CASE WHEN h > 0 THEN {_round(c + ' / h * 100')} ELSE 0.0 END AS {n}"
    return f"""{WITH}, d AS (SELECT e.rig_id, e.date, e.variable_name, coalesce(nullif(e.unidad_pae, ''), nullif(e.unidad_nov, '')) AS unit, e.tipo_variable, {_sum('e.horas')} AS h, {_sum('e.value_present')} AS p, {_sum('e.value_range_in')} AS r,
    {_sum('e.value_null')} AS z, {_sum('e.value_under_min')} AS u, {_sum('e.value_above_out')} AS a, max(CASE WHEN e.requerido = 'SI' THEN 1 ELSE 0 END) AS needed, string_agg(DISTINCT w.name, ', ' ORDER BY w.name) AS wells
    FROM quality_hours e LEFT JOIN wells w ON w.id = e.well_id WHERE {_window(14)} {more} GROUP BY ALL),
  s AS (SELECT rig_id, CAST(date AS VARCHAR) AS date, variable_name, unit, tipo_variable, round(h, 1) AS hours, {pct('p', 'pct_present')}, {pct('r', 'pct_range')}, {pct('z', 'pct_null')}, {pct('u', 'pct_under')}, {pct('a', 'pct_above')},
    CASE WHEN needed = 1 THEN 'SI' ELSE 'NO' END AS required, wells, p FROM d)
  SELECT s.* EXCLUDE (p), CASE WHEN p <= 0 THEN 'NO REGISTRADA' WHEN pct_range < 85 THEN 'FUERA DE RANGO' WHEN pct_present < 90 THEN 'INCOMPLETA' ELSE 'OK' END AS alert,
    CAST(CASE WHEN p <= 0 THEN 3 WHEN pct_range < 85 THEN 2 WHEN pct_present < 90 THEN 1 ELSE 0 END AS BIGINT) AS severity FROM s"""


@query("day_detail", _detail_sql(""))
def day_detail(spark, sf_dir):
    return quality.day_detail(_recent(spark, sf_dir), wells(spark, sf_dir))


@query("day_detail_required", _detail_sql("AND e.requerido = 'SI'") + " ORDER BY severity DESC, pct_range, variable_name")
def day_detail_required(spark, sf_dir):
    return quality.day_detail(_recent(spark, sf_dir), wells(spark, sf_dir), required_only=True).orderBy(*quality.severity_order())


@query("report_summary", f"""{WITH} SELECT CAST(min(e.date) AS VARCHAR) AS first_date, CAST(max(e.date) AS VARCHAR) AS last_date, coalesce({_sum('e.horas')}, 0) AS hours, string_agg(DISTINCT w.name, ', ' ORDER BY w.name) AS wells
  FROM quality_hours e LEFT JOIN wells w ON e.well_id = w.id WHERE e.date BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}'""")
def report_summary(spark, sf_dir):
    return quality.report_summary(quality_hours(spark, sf_dir), wells(spark, sf_dir), SINCE, UNTIL)


REPORT_SQL = f"""{WITH}, v AS (SELECT rig_id, variable_name, tipo_variable, coalesce(nullif(unidad_pae, ''), nullif(unidad_nov, '')) AS unit, CAST(round(sum(horas), 2) AS DOUBLE) AS hours, CAST(round(sum(value_present), 2) AS DOUBLE) AS hours_present,
    CAST(round(sum(value_range_in), 2) AS DOUBLE) AS hours_in_range, CAST(round(sum(value_under_min + value_above_out), 2) AS DOUBLE) AS hours_out_of_range, CAST(sum(CASE WHEN requerido = 'SI' THEN 1 ELSE 0 END) AS BIGINT) AS required_rows
    FROM quality_hours WHERE date BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}' GROUP BY ALL),
  p AS (SELECT *, CASE WHEN hours > 0 THEN {_round('hours_present / hours * 100', 2)} ELSE 0.0 END AS pct_present, CASE WHEN hours > 0 THEN {_round('hours_in_range / hours * 100', 2)} ELSE 0.0 END AS pct_range FROM v),
  report AS (SELECT *, CASE WHEN hours <= 0 OR hours_present <= 0 THEN 'NO REGISTRADA' WHEN pct_range < 85 THEN 'FUERA DE RANGO' WHEN pct_present < 90 THEN 'INCOMPLETA' ELSE 'OK' END AS alert FROM p)"""


@query("report_variables", f"{REPORT_SQL} SELECT * FROM report")
def report_variables(spark, sf_dir):
    return quality.report_variables(quality_hours(spark, sf_dir), SINCE, UNTIL)


@query("report_lines", f"""{REPORT_SQL} SELECT coalesce(r.name, '') AS EQUIPO, variable_name || CASE WHEN unit IS NOT NULL THEN ' (' || unit || ')' ELSE '' END AS "VARIABLE/UNIDAD", tipo_variable AS "TIPO VARIABLE",
  printf('%.1f', round(hours, 1)) AS "REGISTRO (HS)", printf('%.1f', round(pct_present, 1)) AS "VALOR PRESENTE (%)", printf('%.1f', round(pct_range, 1)) AS "DENTRO RANGO (%)", alert AS ALERTA
  FROM report LEFT JOIN rigs r ON r.id = rig_id WHERE alert <> 'OK'""")
def report_lines(spark, sf_dir):
    return quality.report_lines(quality.report_variables(quality_hours(spark, sf_dir), SINCE, UNTIL, issues_only=True), rigs(spark, sf_dir))


@query("activity_calendar", f"""{ACTIVITY_SQL}, cells AS (SELECT id AS rig_id, CAST(CAST(unnest(generate_series({DAY} - INTERVAL 13 DAY, {DAY}, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS date FROM rigs WHERE rig_type = 'PUL')
  SELECT rig_id, date, CAST(coalesce(wells, 0) AS BIGINT) AS wells, CASE WHEN issues > 0 THEN 'partial' WHEN pct_present >= 80 THEN 'good' WHEN pct_present > 0 THEN 'partial' ELSE 'none' END AS cell FROM cells LEFT JOIN activity USING (rig_id, date)""")
def activity_calendar(spark, sf_dir):
    return quality.calendar(daily_activity(spark, sf_dir), rigs(spark, sf_dir).filter("rig_type = 'PUL'"), _as_of())
