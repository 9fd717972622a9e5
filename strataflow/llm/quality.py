"""Quality rules with risk-controlled cutoffs.

Each rule scores a text, higher being worse. A labelled holdout decides how low the rules' cutoffs may go in a
stratum, by split fixed-sequence testing: bad documents and the GUIDE share of the good ones order the steps
that lower one cutoff by a bin, and the other good documents, on which that order doesn't depend, test it. From
the first step on, an exact binomial test asks whether the rules together would reject at least RISK of the
good documents; the first step that isn't refuted ends the sequence, so no correction is needed along it.
Levels are divided by the number of strata (Bonferroni), so that with probability 1 - LEVEL no stratum loses
more than RISK of its good documents. A stratum needs ``least_labels`` good labels that test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._columns import fresh
from ._scratch import Scratch

#: Share of a stratum's good documents that all rules together may reject, and the chance of breaking that.
RISK, LEVEL = 0.02, 0.05
#: A cutoff must reject this many times the share of bad documents that it rejects of good ones.
GAIN = 50.0
#: One in this many good documents helps to order the steps; the others test them.
GUIDE = 5
#: Cutoffs of a rule lie on a fixed grid of its score.
BINS = 64
#: The characters that count as symbols, and the base rule's limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Strata up to this number have their cutoffs broadcast; more are joined by a shuffle.
BROADCAST_STRATA = 10_000

#: Rules: a score between 0 and 1 of the counts below.
RULES = {
    "symbols": lambda c: c("n_symbols") / F.greatest(c("word_chars"), F.lit(1)),
    "dup_lines": lambda c: c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
    "repeats": lambda c: c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
    "long_words": lambda c: c("word_chars") / F.greatest(c("n_words"), F.lit(1)) / 32,
    "short_words": lambda c: 1 - c("word_chars") / F.greatest(c("n_words"), F.lit(1)) / 8,
    "bare_symbols": lambda c: c("n_bare") / F.greatest(c("n_words"), F.lit(1)),
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bare")
COUNTS_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in COUNTS])

_IS_SYMBOL = np.zeros(256, np.uint8)
_IS_SYMBOL[list(SYMBOLS)] = 1
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
_IS_LETTER_OR_DIGIT = np.array([(48 <= b < 58) or (65 <= b < 91) or (97 <= b < 123) or b >= 128 for b in range(256)])


def _running(x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, np.int64)
    np.cumsum(x, out=total[1:])
    return total


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = ordered[1:] == ordered[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    out = np.empty(len(keys), bool)
    out[order] = same
    return out


def count_block(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of COUNTS for each text of a block."""
    n = len(offsets) - 1
    words = _text.Words(data, offsets)
    text_of = words.text_of()
    per_text = lambda flags: np.diff(_running(flags)[offsets])
    out = np.zeros((n, len(COUNTS)), np.int64)
    out[:, 0] = words.counts()
    out[:, 1] = per_text(words.inside & _STARTS_CHARACTER[data])
    out[:, 2] = per_text(_IS_SYMBOL[data])

    marks = _text.mix(np.arange(n, dtype=np.uint64), 5)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    line_text = np.searchsorted(offsets[1:], starts, "right")
    # a break at a text's end begins an empty line of that text; it holds no word, so its owner doesn't matter
    ends = np.minimum(np.concatenate((starts[1:], [len(data)])), len(data))
    is_break = np.zeros(len(data) + 1, bool)
    is_break[breaks] = True
    ends = np.maximum(ends - is_break[np.maximum(ends - 1, 0)], starts)
    inside = _running(words.inside)
    full = inside[ends] > inside[np.minimum(starts, len(data))]
    starts, ends, line_text = starts[full], ends[full], line_text[full]
    out[:, 5] = np.bincount(line_text, minlength=n)
    line_keys = _text.span_hashes(data, starts, ends) ^ marks[line_text]
    _, first = np.unique(line_keys, return_index=True)
    out[:, 3] = out[:, 5] - np.bincount(line_text[first], minlength=n)

    hashes = words.hashes()
    windows = np.flatnonzero(text_of[2:] == text_of[:-2]) if len(words) > 2 else np.empty(0, np.int64)
    factors = _text.mix(np.arange(1, 4, dtype=np.uint64), 9) | np.uint64(1)
    keys = _text.mix(hashes[windows] * factors[0] + hashes[windows + 1] * factors[1] + hashes[windows + 2] * factors[2]) ^ marks[text_of[windows]]
    hit = windows[_repeated(keys)]
    covered = np.zeros(len(words) + 1, np.int64)
    covered[hit] = covered[hit + 1] = covered[hit + 2] = 1
    out[:, 4] = np.diff(_running(covered[:-1])[words.first])

    plain = _running(_IS_LETTER_OR_DIGIT[data])
    bare = plain[words.ends] == plain[words.starts]
    out[:, 6] = np.diff(_running(bare)[words.first])
    return out


def with_counts(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct of COUNTS of each whole text (null: as empty)."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, COUNTS_TYPE)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [count_block(data, offsets) for _, data, offsets in _text.text_blocks(batch.column(text))]
            table = np.concatenate(found) if found else np.zeros((0, len(COUNTS)), np.int64)
            struct = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(COUNTS))], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [f.name for f in schema])

    return df.mapInArrow(_text.lean(count), schema)


def base_failed(c) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))


def _bin(score: Column) -> Column:
    return F.floor(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)) * BINS).cast("int")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws with chance p, summed exactly."""
    if k >= n:
        return 1.0
    i = np.arange(k)
    terms = n * math.log1p(-p) + np.concatenate(([0.0], np.cumsum(np.log((n - i) / (i + 1)) + math.log(p) - math.log1p(-p))))
    top = terms.max()
    return min(1.0, math.exp(top) * float(np.exp(terms - top).sum()))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, level: float, gain: float = GAIN) -> int | None:
    """The bin from which a rule rejects, given good and bad documents by bin; None: it rejects none.

    Only cutoffs that the tests allow are considered; of them, the one that rejects most bad documents for
    ``gain`` times the good ones, by share.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    best, best_value = None, 0.0
    lost = caught = 0
    for cut in range(len(good) - 1, 0, -1):
        lost, caught = lost + int(good[cut]), caught + int(bad[cut])
        if not n_good or lost > risk * n_good or binomial_tail(lost, n_good, risk) > level:
            break
        value = (caught / n_bad if n_bad else 0.0) - gain * lost / n_good
        if value > best_value:
            best, best_value = cut, value
    return best


def least_labels(strata: int, risk: float = RISK, level: float = LEVEL) -> int:
    """Good documents that must test a stratum before any rule may reject, even if none is lost."""
    return math.ceil(math.log(level / max(1, strata)) / math.log1p(-risk))


def order_steps(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The step, from 1, at which each bin of each rule is rejected first, given counts by rule and bin; 0: never.

    The rule and cutoff that catch most bad documents for the good ones lost come next, bin after bin.
    """
    steps = np.zeros(good.shape, np.int32)
    cuts = [good.shape[1]] * len(good)
    step = 0
    while True:
        best, move = (0.0, 0.0), None
        for rule, cut in enumerate(cuts):
            caught, lost = np.cumsum(bad[rule, 1:cut][::-1]), np.cumsum(good[rule, 1:cut][::-1])
            if not len(caught):
                continue
            gain = caught / (lost + 0.5)
            at = int(np.lexsort((caught, gain))[-1])
            at = int(np.flatnonzero(caught == caught[at])[0])  # not beyond the last bin that catches any
            if (gain[at], caught[at]) > best:
                best, move = (gain[at], caught[at]), (rule, cut - 1 - at)
        if move is None:
            return steps
        rule, to = move
        for cut in range(cuts[rule] - 1, to - 1, -1):
            step += 1
            steps[rule, cut] = step
        cuts[rule] = to


def learn_cutoffs(scored: DataFrame, labels: DataFrame, key: str, counts: str, stratum: Column, strata: int, scratch: Scratch, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """stratum and a cutoff bin for each rule (null: it rejects none).

    Labels other than 0 and 1, null keys, keys with both labels and rows that the base rule fails are left out; a
    label that is repeated counts once. Only histograms of BINS a rule, and of the steps, of each stratum leave the workers.
    """
    c = lambda n: F.col(f"{counts}.{n}")
    marks = labels.select(F.col("doc_id").alias("_label_key"), F.col("quality").alias("_label")).filter("_label in (0, 1) and _label_key is not null")
    marks = marks.groupBy("_label_key").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).filter("_label = _other").drop("_other")
    bins = scored.filter(~base_failed(c)).select(F.col(key).alias("_key"), stratum.alias("stratum"), F.array(*(_bin(rule(c)) for rule in RULES.values())).alias("bins"))
    guides = F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit(5)), F.lit(GUIDE)) == 0
    found = bins.join(marks, F.col("_key") == F.col("_label_key")).select("stratum", (F.col("_label") == 1).alias("good"), guides.alias("guides"), "bins")
    found = scratch.table(found, "labelled")
    n_bins = BINS + 1

    def order(rows: pd.DataFrame) -> pd.DataFrame:
        at = rows["rule"] * n_bins + rows["bin"]
        good, bad = (np.bincount(at, weights=rows[x], minlength=len(RULES) * n_bins).reshape(len(RULES), n_bins) for x in ("good", "bad"))
        return pd.DataFrame([{"stratum": rows["stratum"].iloc[0], "steps": order_steps(good, bad).ravel().tolist()}])

    is_good = F.col("good").cast("int")
    guide = found.filter("guides or not good").select("stratum", is_good.alias("good"), F.posexplode("bins").alias("rule", "bin"))
    guide = guide.groupBy("stratum", "rule", "bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    orders = scratch.table(guide.groupBy("stratum").applyInPandas(order, "stratum string, steps array<int>"), "orders")

    joined = found.filter("not (guides and good)").join(F.broadcast(orders) if strata <= BROADCAST_STRATA else orders, "stratum")
    reached = F.array(*(F.nullif(F.get("steps", i * n_bins + F.col("bins")[i]), F.lit(0)) for i in range(len(RULES))))
    tested = joined.select("stratum", is_good.alias("good"), F.coalesce(F.array_min(reached), F.lit(0)).alias("step"))
    tested = tested.groupBy("stratum", "step").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    schema = T.StructType([T.StructField("stratum", T.StringType()), *(T.StructField(n, T.IntegerType()) for n in RULES)])

    def choose(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(own):
            return pd.DataFrame(columns=schema.names)
        steps = np.array(own["steps"].iloc[0]).reshape(len(RULES), n_bins)
        most = int(steps.max())
        place = np.where(rows["step"] > 0, most + 1 - rows["step"], 0)  # the first step has the highest place
        good, bad = (np.bincount(place, weights=rows[x], minlength=most + 1) for x in ("good", "bad"))
        lowest = choose_cutoff(good, bad, risk, level / max(1, strata))
        out = {"stratum": rows["stratum"].iloc[0]}
        for name, own_steps in zip(RULES, steps, strict=True):
            hit = np.flatnonzero((own_steps > 0) & (own_steps <= most + 1 - lowest)) if lowest is not None else []
            out[name] = int(hit[0]) if len(hit) else None
        return pd.DataFrame([out]).astype({n: "Int32" for n in RULES})

    return tested.groupBy("stratum").cogroup(orders.groupBy("stratum")).applyInPandas(choose, schema)


def _stratum(df: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in df.columns else F.lit("")


def _judged(scored: DataFrame, cutoffs: DataFrame, strata: int, counts: str, stratum: Column, verdict: str) -> DataFrame:
    """``scored`` with the boolean column ``verdict``."""
    names = {n: fresh([*scored.columns, *RULES], f"_cut_{n}") for n in ("stratum", *RULES)}
    table = cutoffs.select(*(F.col(n).alias(names[n]) for n in ("stratum", *RULES)))
    if strata <= BROADCAST_STRATA:
        table = F.broadcast(table)
    c = lambda n: F.col(f"{counts}.{n}")
    kept = ~base_failed(c)
    for name, rule in RULES.items():
        kept = kept & F.coalesce(_bin(rule(c)) < F.col(names[name]), F.lit(True))
    return scored.join(table, stratum == F.col(names["stratum"]), "left").withColumn(verdict, kept).drop(*names.values())


def judge(docs: DataFrame, labels: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, COUNTS, base_failed, kept of each row of ``docs``.

    A null or empty text has no words and fails the base rule. Strata are the values of ``lang`` (null: one
    of its own; no such column: one for all). Without labels, or with too few for a guarantee, only the base
    rule rejects. Repeated rows have repeated results; other columns aren't read.
    """
    keep = [F.col(key).alias(key), F.col(text).alias("text"), _stratum(docs).alias("stratum")]
    scored = scratch.table(with_counts(docs.select(*keep), "text", "counts").drop("text"), "counts")
    stratum = F.col("stratum")
    strata = scored.select("stratum").distinct().count()
    cutoffs = scratch.table(learn_cutoffs(scored, labels, key, "counts", stratum, strata, scratch), "cutoffs")
    c = lambda n: F.col(f"counts.{n}")
    return _judged(scored, cutoffs, strata, "counts", stratum, "kept").select(key, *(c(n).alias(n) for n in COUNTS), base_failed(c).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns. Only the cutoffs outlive ``scratch``."""
    counts, verdict = fresh(docs.columns, "_counts"), fresh(docs.columns, "_kept")
    strata = docs.select(_stratum(docs).alias("s")).distinct().count()
    # all texts are counted twice rather than shuffled to meet their labels
    scored = with_counts(docs.select(key, F.col(text).alias("text"), _stratum(docs).alias("stratum")), "text", "counts").drop("text")
    cutoffs = scratch.publish(learn_cutoffs(scored, labels, key, "counts", F.col("stratum"), strata, scratch))
    judged = _judged(with_counts(docs, text, counts), cutoffs, strata, counts, _stratum(docs), verdict)
    return judged.filter(F.col(verdict)).select(*(F.col(f"`{c}`") for c in docs.columns))


def documents_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "quality") as scratch:
        return scratch.publish(judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), scratch))
