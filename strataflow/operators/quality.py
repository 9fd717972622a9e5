"""Roll-ups of hourly data-quality facts: by rig, day, well and variable.

Facts have rig_id, well_id, date, variable_name, tipo_variable, unidad_pae, unidad_nov, requerido ('SI' or 'NO') and the
hours horas, value_present, value_null, value_range_in, value_under_min, value_above_out. Windows end at ``as_of``,
the day before the report, so that a rig with facts on it has been idle for one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values

#: Days before ``as_of`` that the monitor and its lists of wells and variables look back.
MONITOR_DAYS, LIST_DAYS = 14, 7
RANGE_MIN, PRESENT_MIN = 85.0, 90.0


def recent(facts: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Facts of ``as_of`` and so many days before it. A literal ``as_of`` reaches the scan as a filter."""
    return facts.filter((F.col("date") >= F.date_sub(as_of, days)) & (F.col("date") <= as_of))


def _total(name: str) -> Column:
    return F.sum(name).cast("double")


def _names(column: Column) -> Column:
    """The distinct names in order, comma-joined; null where there is none."""
    found = F.array_sort(F.collect_set(column))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def _unit() -> Column:
    return F.coalesce(F.nullif(F.col("unidad_pae"), F.lit("")), F.nullif(F.col("unidad_nov"), F.lit("")))


def _by_variable(facts: DataFrame) -> DataFrame:
    """A row for each rig, day, well and variable: what the roll-ups of one window share."""
    required = F.col("requerido") == "SI"
    return facts.groupBy("rig_id", "date", "well_id", "variable_name").agg(
        *(F.sum(c).alias(c) for c in ("horas", "value_present", "value_null")),
        *(F.sum(F.when(required, F.col(c))).alias(f"required_{c}") for c in ("horas", "value_present", "value_range_in")),
        F.max(F.when(required, True)).alias("required"),
    )


def rig_summary(facts: DataFrame, rigs: DataFrame, as_of: Column, rig_type: str | None = "PUL") -> DataFrame:
    """Activity, presence and state of each rig of a type that has facts. ``facts`` lie in the window already.

    Facts are summed once, by rig, day, well and variable; the distinct counts are sizes of sets over those
    rows, which a window bounds, so no row is expanded for them.
    """
    chosen = rigs if rig_type is None else rigs.filter(F.col("rig_type") == rig_type)
    day_well = F.concat(F.col("date").cast("string"), F.lit("_"), F.col("well_id").cast("string"))  # null if a part is
    count = lambda c: F.size(F.collect_set(c)).cast("long")
    found = _by_variable(facts.join(chosen.select(F.col("id").alias("rig_id")), "rig_id", "left_semi")).groupBy("rig_id").agg(
        count("date").alias("days"), count(day_well).alias("day_wells"), count("well_id").alias("wells"), count("variable_name").alias("variables"),
        _total("horas").alias("hours"), _total("value_present").alias("hours_present"), _total("value_null").alias("hours_null"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    idle = F.date_diff(F.date_add(as_of, 1), F.col("last_date"))
    return found.join(chosen, F.col("rig_id") == F.col("id")).select(
        "rig_id", "name", "rig_type", "days", "day_wells", "wells", "variables", "hours", "hours_present", "hours_null",
        values.percent(F.col("hours_present"), F.col("hours")).alias("pct_present"),
        F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"),
        idle.cast("long").alias("idle_days"), values.idle_state(idle).alias("state"),
    )


def monitor_order() -> list[Column]:
    return [F.desc("last_date"), F.desc("hours"), F.asc("rig_id")]


def daily_activity(facts: DataFrame, present_min: float = PRESENT_MIN, range_min: float = RANGE_MIN) -> DataFrame:
    """Each rig's day, for all rigs in one plan: hours, presence, and required variables that have an issue.

    A required variable that has hours may count as incomplete and as out of range; either share is one of all
    its hours. Hours and issues come from one aggregate, without a join.
    """
    by_variable = _by_variable(facts).groupBy("rig_id", "date", "variable_name").agg(
        F.collect_set("well_id").alias("wells"),
        *(F.sum(c).alias(c) for c in ("horas", "value_present", "value_null")),
        *(F.sum(f"required_{c}").cast("double").alias(n) for c, n in (("horas", "h"), ("value_present", "p"), ("value_range_in", "r"))),
        F.max("required").alias("required"),
    )
    needed, seen = F.col("required"), F.col("p") > 0
    short = lambda part, least: F.col(part) / F.nullif("h", F.lit(0.0)) * 100 < least
    found = by_variable.groupBy("rig_id", "date").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("wells")))).cast("long").alias("wells"), F.count("variable_name").alias("variables"),
        _total("horas").alias("hours"), _total("value_present").alias("hours_present"), _total("value_null").alias("hours_null"),
        F.count_if(needed & ~seen).alias("missing"), F.count_if(needed & seen & short("p", present_min)).alias("incomplete"), F.count_if(needed & seen & short("r", range_min)).alias("out_of_range"),
    )
    return found.select(
        "rig_id", F.col("date").cast("string").alias("date"), "wells", "variables", "hours", "hours_present", "hours_null",
        values.percent(F.col("hours_present"), F.col("hours")).alias("pct_present"), "missing", "incomplete", "out_of_range",
        (F.col("missing") + F.col("incomplete") + F.col("out_of_range")).alias("issues"),
    )


def top_wells(facts: DataFrame, wells: DataFrame, most: int = 10) -> DataFrame:
    """The wells of each rig that were seen last; facts of unknown wells don't count. Ranks a row a well, not facts."""
    found = facts.groupBy("rig_id", "well_id", "variable_name").agg(F.max("date").alias("last"), F.sum("horas").alias("horas"), F.sum("value_present").alias("value_present"))
    found = found.groupBy("rig_id", "well_id").agg(F.max("last").alias("last"), F.count("variable_name").alias("variables"), _total("horas").alias("hours"), _total("value_present").alias("present"))
    found = found.join(wells.select(F.col("id").alias("well_id"), F.col("name").alias("well")), "well_id")
    place = F.row_number().over(Window.partitionBy("rig_id").orderBy(F.desc("last"), "well_id"))
    return found.withColumn("place", place).filter(F.col("place") <= most).select("rig_id", "well", F.col("last").cast("string").alias("last_date"), "variables", "hours", values.percent(F.col("present"), F.col("hours")).alias("pct_present"), F.col("place").cast("long").alias("place"))


def worst_variables(facts: DataFrame, most: int = 5) -> DataFrame:
    """The required variables of each rig with the largest shares of hours without data, over 0 when rounded."""
    lost = facts.filter(F.col("requerido") == "SI").groupBy("rig_id", "variable_name").agg(_total("horas").alias("hours"), _total("value_null").alias("hours_null"))
    lost = lost.withColumn("pct_null", values.percent(F.col("hours_null"), F.col("hours"))).filter("pct_null > 0")
    place = F.row_number().over(Window.partitionBy("rig_id").orderBy(F.desc("pct_null"), "variable_name"))
    return lost.withColumn("place", place).filter(F.col("place") <= most).select("rig_id", "variable_name", "hours", "hours_null", "pct_null", F.col("place").cast("long").alias("place"))


def global_stats(summary: DataFrame) -> DataFrame:
    """One row: how many rigs there are in each state, their wells, and the mean of their rounded presence."""
    n = lambda state: F.count_if(F.col("state") == state)
    mean = F.round(F.coalesce(F.sum(F.col("pct_present").cast("decimal(18,4)")).cast("double"), F.lit(0.0)) / F.greatest(F.count("*"), F.lit(1)), 1)
    return summary.agg(F.count("*").alias("rigs"), n("ACTIVO").alias("active"), n("ALERTA").alias("alert"), n("INACTIVO").alias("inactive"), F.coalesce(F.sum("wells"), F.lit(0)).alias("wells"), mean.alias("mean_present"))


def filtered(summary: DataFrame, name: str = "", state: str = "", least_days: int = 0) -> DataFrame:
    """Rigs whose name holds ``name`` in any case, in a state (any if empty), with so many active days."""
    found = summary.filter(F.contains(F.lower("name"), F.lit(name.lower())) & (F.col("days") >= least_days))
    return found.filter(F.col("state") == state) if state else found


def activity_map(activity: DataFrame) -> DataFrame:
    """A row a rig: its days, each with its figures."""
    figures = F.struct(*(c for c in activity.columns if c not in ("rig_id", "date")))
    return activity.groupBy("rig_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("date", figures.alias("figures"))))).alias("by_date"))


def day_detail(facts: DataFrame, wells: DataFrame, required_only: bool = False, present_min: float = PRESENT_MIN, range_min: float = RANGE_MIN) -> DataFrame:
    """Each variable of each rig's day with its wells, shares of all hours, alert and severity."""
    if required_only:
        facts = facts.filter(F.col("requerido") == "SI")
    named = facts.join(wells.select(F.col("id").alias("well_id"), F.col("name").alias("well")), "well_id", "left")
    found = named.groupBy("rig_id", "date", "variable_name", "tipo_variable", _unit().alias("unit")).agg(
        *(_total(c).alias(n) for c, n in (("horas", "h"), ("value_present", "p"), ("value_range_in", "r"), ("value_null", "z"), ("value_under_min", "u"), ("value_above_out", "a"))),
        F.max(F.when(F.col("requerido") == "SI", 1).otherwise(0)).alias("needed"), _names(F.col("well")).alias("wells"),
    )
    found = found.withColumns({n: values.share(F.col(c), F.col("h"), 1) for c, n in (("p", "pct_present"), ("r", "pct_range"), ("z", "pct_null"), ("u", "pct_under"), ("a", "pct_above"))})
    alert = values.alert(F.col("p"), F.col("pct_range"), F.col("pct_present"), range_min, present_min)
    return found.select(
        "rig_id", F.col("date").cast("string").alias("date"), "variable_name", "unit", "tipo_variable", F.round("h", 1).alias("hours"),
        "pct_present", "pct_range", "pct_null", "pct_under", "pct_above", F.when(F.col("needed") == 1, "SI").otherwise("NO").alias("required"), "wells",
        alert.alias("alert"), values.severity(alert).cast("long").alias("severity"),
    )


def severity_order() -> list[Column]:
    """Most severe first, then the least share in range."""
    return [F.desc("severity"), F.asc("pct_range"), F.asc("variable_name")]


def report_summary(facts: DataFrame, wells: DataFrame, since: str, until: str) -> DataFrame:
    """One row, even of nothing: first and last date, hours and wells of a period."""
    period = _period(facts, since, until).join(wells.select(F.col("id").alias("well_id"), F.col("name").alias("well")), "well_id", "left")
    return period.agg(F.min("date").cast("string").alias("first_date"), F.max("date").cast("string").alias("last_date"), F.coalesce(_total("horas"), F.lit(0.0)).alias("hours"), _names(F.col("well")).alias("wells"))


def _period(facts: DataFrame, since: str, until: str) -> DataFrame:
    return facts.filter(F.col("date").between(F.lit(since).cast("date"), F.lit(until).cast("date")))


def report_variables(facts: DataFrame, since: str, until: str, issues_only: bool = False, present_min: float = PRESENT_MIN, range_min: float = RANGE_MIN) -> DataFrame:
    """Each rig's variables over a period; shares and alerts are made from the rounded hours."""
    hours = lambda c: F.round(F.sum(c), 2).cast("double")
    found = _period(facts, since, until).groupBy("rig_id", "variable_name", "tipo_variable", _unit().alias("unit")).agg(
        hours(F.col("horas")).alias("hours"), hours(F.col("value_present")).alias("hours_present"), hours(F.col("value_range_in")).alias("hours_in_range"),
        hours(F.col("value_under_min") + F.col("value_above_out")).alias("hours_out_of_range"), F.count_if(F.col("requerido") == "SI").alias("required_rows"),
    )
    found = found.withColumns({"pct_present": values.share(F.col("hours_present"), F.col("hours"), 2), "pct_range": values.share(F.col("hours_in_range"), F.col("hours"), 2)})
    present = F.when(F.col("hours") <= 0, F.lit(0.0)).otherwise(F.col("hours_present"))
    found = found.withColumn("alert", values.alert(present, F.col("pct_range"), F.col("pct_present"), range_min, present_min))
    return found.filter(F.col("alert") != "OK") if issues_only else found


def report_lines(report: DataFrame, rigs: DataFrame) -> DataFrame:
    """The report as it is exported: seven columns of text, numbers with one decimal."""
    number = lambda c: F.format_string("%.1f", F.round(F.col(c), 1))
    unit = F.when(F.coalesce("unit", F.lit("")) != "", F.concat(F.lit(" ("), "unit", F.lit(")"))).otherwise("")
    named = report.join(rigs.select(F.col("id").alias("rig_id"), F.col("name").alias("rig")), "rig_id", "left")
    return named.select(
        F.coalesce("rig", F.lit("")).alias("EQUIPO"), F.concat("variable_name", unit).alias("VARIABLE/UNIDAD"), F.col("tipo_variable").alias("TIPO VARIABLE"),
        number("hours").alias("REGISTRO (HS)"), number("pct_present").alias("VALOR PRESENTE (%)"), number("pct_range").alias("DENTRO RANGO (%)"), F.col("alert").alias("ALERTA"),
    )


def calendar(activity: DataFrame, rigs: DataFrame, as_of: Column, days: int = 14) -> DataFrame:
    """A cell for each rig and each of the last ``days``, days without facts included.

    ``activity`` has the rows of ``daily_activity``; a day with issues is partial whatever its presence.
    """
    cells = rigs.select(F.col("id").alias("rig_id")).distinct().select("rig_id", F.explode(F.sequence(F.date_sub(as_of, days - 1), as_of)).alias("date")).withColumn("date", F.col("date").cast("string"))
    cell = F.when(F.col("issues") > 0, "partial").when(F.col("pct_present") >= 80, "good").when(F.col("pct_present") > 0, "partial").otherwise("none")
    return cells.join(activity.select("rig_id", "date", "wells", "issues", "pct_present"), ["rig_id", "date"], "left").select("rig_id", "date", F.coalesce("wells", F.lit(0)).alias("wells"), cell.alias("cell"))
