"""Statistics, events, regimes and outliers of curves: (series, ts, row, value) tables.

Values keep their precision; queries that are compared as text round at their own edge. A series is never one window
partition: rows lie in buckets of time, are numbered and compared within them, and only a row a bucket is carried
from one to the next. Statistics aggregate first and are joined back by series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seconds of a bucket; with another kind of ``ts``, units of it.
BUCKET = 86_400.0
#: Words that tell a curve of casing pressure, and those that are preferred in order.
PRESSURE_HINTS = ("ZUNCH", "CSG", "CASING", "PRESION", "PRESS", "ANNULAR", "CIRCULACION", "HYDRAULIC", "TORQUE")
PRESSURE_PREFERRED = ("ZUNCH", "PRESION")


def _bucket(rows: DataFrame, width: float) -> Column:
    """Buckets of numbers, times, or times without a zone, in their order."""
    if isinstance(rows.schema["ts"].dataType, T.TimestampNTZType):
        return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")) / width)
    return F.floor(F.col("ts").cast("double") / width)


def present(curve: DataFrame) -> DataFrame:
    """Without nulls and NaN."""
    return curve.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def numbered(curve: DataFrame, width: float = BUCKET) -> DataFrame:
    """With the place ``i`` of each value in its series, from 0, and the number ``n`` of them; nulls and NaN go."""
    rows = present(curve)
    rows = rows.withColumn("_bucket", _bucket(rows, width))
    sizes = rows.groupBy("series", "_bucket").agg(F.count("*").alias("_rows"))
    order = Window.partitionBy("series").orderBy("_bucket")
    sizes = sizes.select("series", "_bucket", F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy("series")).alias("n"))
    place = F.row_number().over(Window.partitionBy("series", "_bucket").orderBy("ts", "row")) - 1
    return rows.withColumn("_place", place).join(sizes, ["series", "_bucket"]).withColumn("i", (F.col("_before") + F.col("_place")).cast("long")).drop("_bucket", "_before", "_place")


def with_neighbours(rows: DataFrame, column: str, width: float = BUCKET) -> DataFrame:
    """With the column's value in the row before and behind in the series, as ``before`` and ``behind``. It must not be null."""
    rows = rows.withColumn("_bucket", _bucket(rows, width))
    place = F.struct("ts", "row")
    edges = rows.groupBy("series", "_bucket").agg(F.min_by(column, place).alias("_first"), F.max_by(column, place).alias("_last"))
    order = Window.partitionBy("series").orderBy("_bucket")
    edges = edges.select("series", "_bucket", F.lag("_last").over(order).alias("_edge_before"), F.lead("_first").over(order).alias("_edge_behind"))
    inside = Window.partitionBy("series", "_bucket").orderBy("ts", "row")
    rows = rows.withColumns({"before": F.lag(column).over(inside), "behind": F.lead(column).over(inside)}).join(edges, ["series", "_bucket"])
    return rows.withColumns({"before": F.coalesce("before", "_edge_before"), "behind": F.coalesce("behind", "_edge_behind")}).drop("_bucket", "_edge_before", "_edge_behind")


def stats(curve: DataFrame) -> DataFrame:
    """A row a series: moments, exact percentiles by linear interpolation, and the active share."""
    v = F.col("value")
    shares = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    found = present(curve).groupBy("series").agg(
        F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.countDistinct(v).alias("distinct_values"),
        F.percentile(v, F.array(*map(F.lit, shares.values()))).alias("_shares"), (F.count_if(v > 0) / F.count("*") * 100).alias("active_pct"),
    )
    return found.withColumns({name: F.col("_shares")[i] for i, name in enumerate(shares)}).drop("_shares")


def _fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c rounded once, as a fused multiply-add does: the product's own rounding error is found and added."""
    halves = lambda x: ((high := F.lit(134217729.0) * x - (F.lit(134217729.0) * x - x)), x - high)
    (a1, a2), (b1, b2), product = halves(a), halves(b), a * b
    lost = a2 * b2 - (((product - a1 * b1) - a2 * b1) - a1 * b2)
    total = product + c
    rest = total - product
    return F.nanvl(total + ((product - (total - rest)) + (c - rest) + lost), total)


def percentile(rows: DataFrame, value: str, share: float, out: str) -> DataFrame:
    """A row a series: the exact percentile by linear interpolation, to the last bit as SQL's quantile_cont has it.

    ``lo * (1 - d) + hi * d`` with the first product unrounded: Spark's own aggregate rounds it and may be one unit in the
    last place off, which decides whether a value that equals the limit exceeds it. One task a series orders its distinct values.
    """
    counted = rows.groupBy("series", value).agg(F.count("*").alias("_rows"))
    order = Window.partitionBy("series").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumns({"_upto": F.sum("_rows").over(order), "_place": (F.sum("_rows").over(Window.partitionBy("series")) - 1) * F.lit(share)})
    at = lambda place: F.max(F.when((F.col("_upto") - F.col("_rows") <= place) & (place < F.col("_upto")), F.col(value)))
    found = placed.groupBy("series").agg(at(F.floor("_place")).alias("_lo"), at(F.ceil("_place")).alias("_hi"), F.max(F.col("_place") - F.floor("_place")).alias("_part"))
    part = F.col("_part")
    return found.select("series", F.when(part == 0, F.col("_lo")).otherwise(_fused(F.col("_lo"), 1 - part, F.col("_hi") * part)).alias(out))


def gradient(numbered_curve: DataFrame) -> DataFrame:
    """Central differences, one-sided at the ends."""
    before, behind, v = F.col("before"), F.col("behind"), F.col("value")
    slope = F.when(before.isNull(), behind - v).when(behind.isNull(), v - before).otherwise((behind - before) / 2)
    return with_neighbours(numbered_curve, "value").withColumn("gradient", slope).drop("before", "behind")


def peaks(numbered_curve: DataFrame, share: float = 0.95) -> DataFrame:
    """Places where the gradient's size exceeds its percentile and both neighbours."""
    sloped = gradient(numbered_curve).filter(F.col("gradient").isNotNull()).withColumn("size", F.abs("gradient"))
    limits = percentile(sloped, "size", share, "limit")
    marked = with_neighbours(sloped, "size").join(limits, "series")
    return marked.filter("size > limit and size > before and size > behind").select("series", "i", "gradient")


def spaced(peaks_: DataFrame, gap: int = 50) -> DataFrame:
    """Of each series' peaks those more than ``gap`` places behind the one kept before.

    A peak that lies further than that behind any other is kept whatever came before, so runs of close peaks are
    folded one by one.
    """
    rows = with_neighbours(peaks_.select("series", "i", F.col("i").alias("ts"), F.lit(0).alias("row")), "i", float(1 << 16))
    begins = rows.withColumn("_begin", F.when(F.col("before").isNull() | (F.col("i") - F.col("before") > gap), F.col("i")))
    run = F.last("_begin", ignorenulls=True).over(Window.partitionBy("series").orderBy("i"))
    runs = begins.withColumn("_run", run).groupBy("series", "_run").agg(F.array_sort(F.collect_list("i")).alias("places"))
    none = F.array().cast("array<bigint>")
    kept = F.aggregate("places", none, lambda kept, x: F.when((F.size(kept) == 0) | (x - F.try_element_at(kept, F.lit(-1)) > gap), F.concat(kept, F.array(x))).otherwise(kept))
    return runs.select("series", F.explode(kept).alias("i"))


def transitions(curve: DataFrame) -> DataFrame:
    """Places where a state differs from the one before."""
    return with_neighbours(curve.filter(F.col("state").isNotNull()), "state").filter(F.col("before") != F.col("state")).drop("behind")


def outliers(curve: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Each series' values beyond three deviations, and beyond the fences of 1.5 quartile ranges; ``of`` are its stats, rounded for instance."""
    s = (stats(curve) if of is None else of).select("series", "mean", "std", "p25", "p75")
    joined = present(curve).join(s, "series")
    z = F.try_divide(F.abs(F.col("value") - F.col("mean")), F.col("std"))
    spread = F.col("p75") - F.col("p25")
    fenced = (F.col("value") < F.col("p25") - 1.5 * spread) | (F.col("value") > F.col("p75") + 1.5 * spread)
    return joined.groupBy("series").agg(F.count_if(z > 3).alias("by_deviation"), F.count_if(fenced).alias("by_quartiles"))


def moving_variance(numbered_curve: DataFrame, width: int = 100, step: int = 50, constant: float = 1.0) -> DataFrame:
    """Population variance of windows that start every ``step`` values, strictly before n - width."""
    last = F.floor(F.col("i") / step)
    first = F.greatest(F.lit(0), F.ceil((F.col("i") - width + 1) / step))
    placed = numbered_curve.filter(first <= last).withColumn("window", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    placed = placed.filter(F.col("window") * step < F.col("n") - width)
    found = placed.groupBy("series", (F.col("window") * step).alias("start")).agg(F.var_pop("value").alias("variance"))
    return found.withColumn("is_constant", F.col("variance") < constant)


def correlation(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"), F.corr(x, y).alias("corr"))


def regimes(curve: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Variation class of each series (deviation by mean: under 0.1, over 0.5, between), and its values half a quartile range beyond the quartiles, and between; ``of`` are its stats, rounded for instance."""
    s = stats(curve) if of is None else of
    cv = F.try_divide(F.col("std"), F.col("mean"))
    s = s.withColumn("cv_class", F.when(cv < 0.1, "estable").when(cv > 0.5, "alta").otherwise("moderada"))
    half = 0.5 * (F.col("p75") - F.col("p25"))
    joined = present(curve).join(s.select("series", "p25", "p75", "cv_class"), "series")
    low, high = F.col("value") < F.col("p25") - half, F.col("value") > F.col("p75") + half
    return joined.groupBy("series", "cv_class").agg(F.count_if(low).alias("low"), F.count_if(high).alias("high"), F.count_if(~low & ~high).alias("middle"))


def behaviour(low: Column, n: Column, correlation_: Column, events: Column) -> Column:
    """What a signal looks like: mostly low, following depth, with enough events, or none of these."""
    return F.when(low > 0.7 * n, "TIPICO").when(correlation_ > 0.5, "CONFUSION").when(events > F.floor(n / 1000), "EVENTOS").otherwise("ATIPICO")


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal bins between the extremes, the last one closed."""
    lo, hi = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    place = F.least(F.lit(bins - 1), F.floor((F.col(value) - lo) / ((hi - lo) / bins)))
    return df.groupBy(place.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def boxplot(curve: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Quartiles of each series, its last values inside the fences, and how many lie outside; ``of`` are its stats, rounded for instance."""
    s = (stats(curve) if of is None else of).select("series", "p25", "median", "p75")
    spread = F.col("p75") - F.col("p25")
    lo, hi = F.col("p25") - 1.5 * spread, F.col("p75") + 1.5 * spread
    inside = F.col("value").between(lo, hi)
    v = F.when(inside, F.col("value"))
    return present(curve).join(s, "series").groupBy("series", "p25", "median", "p75").agg(F.min(v).alias("whisker_lo"), F.max(v).alias("whisker_hi"), F.count_if(~inside).alias("outside"))


def extremes(curve: DataFrame, most: int = 10) -> DataFrame:
    """The highest and the lowest values of each series, each with its rank; of equal ones the earlier row first."""
    ranked = lambda order, side: present(curve).withColumn("rank", F.row_number().over(Window.partitionBy("series").orderBy(order, "row"))).filter(F.col("rank") <= most).select("series", F.lit(side).alias("side"), F.col("rank").cast("long").alias("rank"), "row", "value")
    return ranked(F.desc("value"), "top").union(ranked(F.asc("value"), "bottom"))


def stopped(df: DataFrame, turning: str, advancing: str, value: str) -> DataFrame:
    """Rows while the string neither turns nor advances."""
    return df.filter((F.abs(turning) < 5) & (F.abs(advancing) < 1) & F.col(value).isNotNull())


def spectrum_top(numbered_curve: DataFrame, most: int = 5) -> DataFrame:
    """The strongest frequencies of each whole series, of both signs, by power to three decimals; of equal powers the lower place first.

    A fast transform finds them, then the power of each is summed term by term, in the order of places: the two differ in the
    last bits, which show where a power is half of a decimal. Equal input gives equal output.

    One task transforms one series, some 40 bytes a value in its worker: the transform needs all of it.
    """

    def strongest(part: pd.DataFrame) -> pd.DataFrame:
        values = part.sort_values("i")["value"].to_numpy()
        n = len(values)
        values = values - np.cumsum(values)[-1] / n
        best = np.argsort(-np.floor(np.abs(np.fft.fft(values)) ** 2 * 1000 + 0.5), kind="stable")[:most]
        return pd.DataFrame({"series": part["series"].iloc[0], "frequency": np.fft.fftfreq(n)[best], "power": [summed(values, int(k)) for k in best]})

    def summed(values: np.ndarray, k: int) -> float:
        angles = (2 * math.pi * (np.arange(len(values)) * k % len(values)) / len(values)).tolist()
        re, im = (float(np.cumsum(values * np.fromiter(map(f, angles), float, len(angles)))[-1]) for f in (math.cos, math.sin))
        return re * re + im * im

    return numbered_curve.select("series", "i", "value").groupBy("series").applyInPandas(strongest, "series long, frequency double, power double")


def plausible_unit(lo: Column, hi: Column, mean: Column, psi_most: float = 5000.0, torque_least: float = 10000.0) -> Column:
    return F.when((lo >= 0) & (hi <= psi_most), "psi").when((hi > torque_least) | (mean > psi_most), "torque").otherwise("desconocida")


def within_configured(stats_: DataFrame, config: DataFrame) -> DataFrame:
    """Each series with each range that is configured for it (series, lo_least, hi_most), and whether it lies inside."""
    inside = F.col("lo").between(F.col("lo_least"), F.col("hi_most")) & F.col("hi").between(F.col("lo_least"), F.col("hi_most"))
    return stats_.select("series", "lo", "hi").join(config, "series").select("series", "lo_least", "hi_most", inside.alias("inside"))


def pressure_curves(curves: DataFrame) -> DataFrame:
    """Of each file's curves (file_id, place, mnemonic, description) those that may be casing pressure, with the choice.

    A hint in either text makes a candidate; the preferred hints, in order, decide, else the first candidate.
    """
    has = lambda words: F.coalesce(F.upper("mnemonic").rlike("|".join(words)), F.lit(False)) | F.coalesce(F.upper("description").rlike("|".join(words)), F.lit(False))
    rank = F.lit(len(PRESSURE_PREFERRED))
    for i in range(len(PRESSURE_PREFERRED) - 1, -1, -1):
        rank = F.when(has(PRESSURE_PREFERRED[i : i + 1]), i).otherwise(rank)
    found = curves.filter(has(PRESSURE_HINTS)).withColumn("_rank", rank)
    place = F.row_number().over(Window.partitionBy("file_id").orderBy("_rank", "place"))
    return found.withColumn("chosen", place == 1).drop("_rank")
