"""Language-model scoring with a hashed maximum-entropy model.

A word's probability is factored: that of its class times that of its group in the class, times its share of
the group's smoothed corpus counts. The class is a softmax over CLASSES; the group is told by a run of softmaxes
of two, each over the halves of what is left of the class, up to DEPTH of them. Scores are sums of a prior from
the corpus counts and of the weights of hashed features: the word before, the two words before, and the word
before that alone (a skip). Classes have equal shares of the corpus, so a frequent word is alone in its group,
and a class of many rare words has many groups: every word of the corpus has a place in the model, and the
number of groups and of weights follows the vocabulary, up to DEPTH splits and WEIGHT_BITS_MOST.

Counts come from all training documents. Weights are trained by rounds of distributed gradient updates: a
round has a share of the training documents, each task sums the gradients of its own at the weights of the round
before, with their expected counts or curvatures, and the sums of all tasks make one update. Which task has which
document doesn't matter, but for rounding.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._scratch import Scratch

#: Classes (the first is that of words whose counts aren't broadcast, and of unknown ones), and splits in one.
CLASSES, DEPTH = 16, 9
#: Hashed weights of splits: four for each distinct word, between these powers of two; classes have half as many.
WEIGHT_BITS_LEAST, WEIGHT_BITS_MOST = 16, 20
#: The prior of a class that no word has.
UNUSED = -30.0
#: Rounds of training, the size of an update, and what is added to the counts that a gradient is measured by.
ROUNDS, RATE, SMOOTHING = 2, 0.65, 5.0
#: Units of a gradient; a task's sum of one weight may reach 2**31 of them.
FIXED = 1 << 10
#: Tokens handled at a time.
STEP_TOKENS = 1 << 14
#: Tokens that a training task should have at least, as each sends sums for all weights, and bounds of the tasks.
TASK_TOKENS, LEAST_TASKS, MOST_TASKS = 4 << 20, 8, 4096
#: Words whose counts are broadcast, at most; the counts of the others are joined by a shuffle.
BROADCAST_WORDS = 1 << 18
#: Folds of documents: those with this remainder of their key's checksum are held out.
FOLDS, HELD_OUT = 7, 2
#: Parts in which weights are summed.
PARTS = 16

_U = np.uint64
_END = _text.mix(np.array([1], _U), 4242)[0]
_START = _text.mix(np.array([2], _U), 4242)[0]


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo FOLDS; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words, each text's followed by the end; where each text begins, and one more)."""
    words = _text.Words(_text.lower_ascii(data), offsets)
    counts = words.counts()
    first = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.full(first[-1], _END, _U)
    out[np.arange(len(words)) + words.text_of()] = words.hashes()
    return out, first


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (a hash), c of all tokens of ``docs``; summed within blocks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in _text.text_blocks(batch.column(0), 8 << 20):
                found = [tokens_of(d, o)[0] for _, d, o in _sub_blocks(data, offsets)]
                words, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "c"])

    return docs.select(text).mapInArrow(_text.lean(count), "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _sub_blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    row, n = 0, len(offsets) - 1
    while row < n:
        end = min(max(int(np.searchsorted(offsets, offsets[row] + _text.BLOCK_BYTES, "right")) - 1, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Vocabulary:
    """What all tasks know of the counts; BROADCAST_WORDS and DEPTH bound its size."""

    words: np.ndarray  # hashes of the most frequent words, ascending
    counts: np.ndarray
    classes: np.ndarray  # of each of them, 1 at least
    depths: np.ndarray  # splits of each class
    offsets: np.ndarray  # where a class begins in the next two
    groups: np.ndarray  # smoothed count of each group
    splits: np.ndarray  # prior score of the upper half at each split of a class: a heap, from place 1 on
    class_prior: np.ndarray
    tokens: int  # N
    distinct: int  # V

    @classmethod
    def of(cls, counts: DataFrame, most: int = BROADCAST_WORDS) -> Vocabulary:
        """From the whole table of counts; at most ``most`` words and 2**DEPTH sums of it come to the driver."""
        bucket = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
        rows = counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("words"), F.sum("c").alias("tokens"), F.min("c").alias("least")).collect()  # 16 a doubling of the count
        rows.sort(key=lambda r: -r["b"])
        taken, least = 0, None
        for r in rows:
            if taken + r["words"] > most:
                break
            taken, least = taken + r["words"], r["least"]
        frequent = counts.filter(F.col("c") >= least).toPandas() if least is not None else None
        words = frequent["word"].to_numpy(np.int64).view(_U) if frequent is not None else np.empty(0, _U)
        n = frequent["c"].to_numpy(np.int64) if frequent is not None else np.empty(0, np.int64)
        tokens, distinct = sum(r["tokens"] for r in rows), sum(r["words"] for r in rows)
        rare, depth = counts if least is None else counts.filter(F.col("c") < least), _depth(distinct - len(words))
        path = F.shiftrightunsigned(F.shiftrightunsigned("word", 1), 63 - depth)
        sums = np.ones(1 << depth)  # an unknown word has a place in each group
        for r in rare.groupBy(path.alias("path")).agg(F.sum(F.col("c") + 1).alias("sum")).toLocalIterator() if distinct > len(words) else ():
            sums[r["path"]] += r["sum"]
        return cls.build(words, n, sums, tokens, distinct)

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, others: np.ndarray, tokens: int, distinct: int) -> Vocabulary:
        """From the most frequent words and the sums of the groups of all others."""
        order = np.lexsort((words, -counts))
        before = np.cumsum(counts[order] + 1.0) - (counts[order] + 1.0)
        classes = np.empty(len(words), np.int64)
        classes[order] = 1 + np.minimum(before * ((CLASSES - 1) / max(1.0, float((counts + 1).sum()))), CLASSES - 2).astype(np.int64)
        depths = np.array([len(others).bit_length() - 1, *(_depth(n) for n in np.bincount(classes, minlength=CLASSES)[1:].tolist())])
        offsets = np.concatenate(([0], np.cumsum(1 << depths)))
        groups = np.bincount(offsets[classes] + _paths(words, depths[classes]), weights=counts + 1.0, minlength=offsets[-1])
        groups[: len(others)] = others
        splits, prior = np.zeros(offsets[-1], np.float32), np.full(CLASSES, UNUSED)
        for c, (lo, depth) in enumerate(zip(offsets.tolist(), depths.tolist(), strict=False)):
            sums = groups[lo : lo + (1 << depth)]
            if sums.sum() > 0:
                prior[c] = math.log(sums.sum())
            for level in range(depth - 1, -1, -1):
                halves = sums.reshape(-1, 2)
                ratio = (halves[:, 1] + 1e-6) / (halves[:, 0] + 1e-6)  # a half may be empty
                splits[lo + (1 << level) : lo + (2 << level)] = np.log(ratio)
                sums = halves.sum(axis=1)
        order = np.argsort(words)
        return cls(words[order], counts[order], classes[order], depths, offsets, groups, splits, np.where(prior > UNUSED, prior - prior.max(), UNUSED).astype(np.float32), int(tokens), int(distinct))

    @property
    def weight_bits(self) -> int:
        return min(WEIGHT_BITS_MOST, max(WEIGHT_BITS_LEAST, (self.distinct + 1).bit_length() + 2))

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, class, path in the class) of each word; the count is -1 of one that isn't among the most frequent."""
        if not len(self.words):
            counts, classes = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        else:
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            counts, classes = np.where(known, self.counts[at], -1), np.where(known, self.classes[at], 0)
        return counts, classes, _paths(words, self.depths[classes])


def _depth(words: int) -> int:
    return min(DEPTH, max(0, int(words) - 1).bit_length())


def _paths(words: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The first bits of each hash, as a number."""
    return ((words >> _U(1)) >> (63 - depths).astype(_U)).astype(np.int64)


class MaxEnt:
    """Weights of features for classes, (rows, CLASSES), and for the upper halves of splits, with the corpus' priors."""

    def __init__(self, vocabulary: Vocabulary, by_class: np.ndarray, by_split: np.ndarray):
        self.vocabulary, self.by_class, self.by_split = vocabulary, by_class, by_split
        self.log_groups = np.log(np.maximum(vocabulary.groups, 1e-9)).astype(np.float32)
        self.row_shift, self.split_shift = _U(64 - (len(by_class).bit_length() - 1)), _U(64 - (len(by_split).bit_length() - 1))

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> MaxEnt:
        """Without weights: the corpus' shares alone."""
        bits = vocabulary.weight_bits
        return cls(vocabulary, np.zeros(((1 << bits - 1) // CLASSES, CLASSES), np.float32), np.zeros(1 << bits, np.float32))

    @staticmethod
    def features(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Hashes of each token's features; they see the tokens before it in its text only."""
        place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        before = np.empty_like(words)
        before[1:], before[:1] = words[:-1], _START
        before[place < 1] = _START
        skipped = np.empty_like(words)
        skipped[2:], skipped[:2] = words[:-2], _START
        skipped[place < 2] = _START
        return [_text.mix(before, 11), _text.mix(before * _U(0x9E3779B97F4A7C15) + skipped, 12), _text.mix(skipped, 13)]

    def class_rows(self, features: list[np.ndarray]) -> list[np.ndarray]:
        return [(f >> self.row_shift).astype(np.int64) for f in features]

    def class_shares(self, rows: list[np.ndarray]) -> np.ndarray:
        """The probability of each class, (tokens, CLASSES)."""
        # an array of numpy's own type: what pickled weights are made into isn't, and ufunc.at is slow with it
        scores = np.zeros((len(rows[0]), CLASSES), np.float32)
        for r in rows:
            scores += np.take(self.by_class, r, axis=0)
        scores += self.vocabulary.class_prior
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def splits_of(self, features: list[np.ndarray], classes: np.ndarray, paths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """For each level: (tokens that are split there, whether each goes to the upper half, that half's score, places of its weights)."""
        depths = self.vocabulary.depths[classes]
        order = np.argsort(-depths.astype(np.int8), kind="stable")
        depths, paths, base = depths[order], paths[order], self.vocabulary.offsets[classes[order]]
        features = [f[order] for f in features]
        live = np.searchsorted(-depths, -np.arange(1, DEPTH + 1), "right")
        for level, n in enumerate(live[live > 0].tolist()):
            left, path = depths[:n] - level, paths[:n]
            split = base[:n] + ((path >> left) | (1 << level))
            salt = (split.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
            places = [((f[:n] ^ salt) * _U(0xC2B2AE3D27D4EB4F) >> self.split_shift).view(np.int64) for f in features]
            score = self.vocabulary.splits[split]
            for x in places:
                score += self.by_split[x]
            yield order[:n], (path >> (left - 1)) & 1, score, places

    def log_probabilities(self, words: np.ndarray, first: np.ndarray, classes: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each token's group, divided by the group's smoothed count."""
        out = np.empty(len(words))
        features = self.features(words, first)
        for lo in range(0, len(words), STEP_TOKENS):
            s = slice(lo, lo + STEP_TOKENS)
            part, own = [f[s] for f in features], classes[s]
            found = np.log(np.maximum(self.class_shares(self.class_rows(part))[np.arange(len(own)), own].astype(np.float64), 1e-30))
            for tokens, upper, score, _ in self.splits_of(part, own, paths[s]):
                against = np.minimum(np.where(upper == 1, -score, score), np.float32(60))
                found[tokens] -= np.log1p(np.exp(against))
            out[s] = found - self.log_groups[self.vocabulary.offsets[own] + paths[s]]
        return out


class Gradients:
    """Sums over the texts of one task, at fixed weights: each weight's gradient, and what it is measured by.

    Those of splits lie together in one number, the gradient in the lower and the curvature in the upper half, both
    in units of 1 / FIXED, so that a weight is fetched once.
    """

    def __init__(self, model: MaxEnt):
        self.model = model
        self.observed, self.expected = np.zeros(model.by_class.size, np.float32), np.zeros(model.by_class.size, np.float32)
        self.by_split = np.zeros(len(model.by_split), np.int64)
        self.tokens = 0

    def add(self, words: np.ndarray, first: np.ndarray, classes: np.ndarray, paths: np.ndarray) -> None:
        model, features, across = self.model, MaxEnt.features(words, first), np.arange(CLASSES)
        for lo in range(0, len(words), STEP_TOKENS):
            s = slice(lo, lo + STEP_TOKENS)
            part, own = [f[s] for f in features], classes[s]
            rows = model.class_rows(part)
            shares = model.class_shares(rows).ravel()
            for r in rows:
                np.add.at(self.expected, (r[:, None] * CLASSES + across).ravel(), shares)
                np.add.at(self.observed, r * CLASSES + own, np.float32(1))
            for _, upper, score, places in model.splits_of(part, own, paths[s]):
                share = 1 / (1 + np.exp(np.clip(-score, -30, 30)))
                both = np.rint((upper - share) * FIXED).astype(np.int64) + (np.rint(share * (1 - share) * FIXED).astype(np.int64) << 32)
                for x in places:
                    np.add.at(self.by_split, x, both)
        self.tokens += len(words)

    def sums(self) -> np.ndarray:
        """(2, weights): gradients, and the expected counts of classes and curvatures of splits."""
        gradient = self.by_split.astype(np.int32)  # the lower half, with its sign
        curvature = (self.by_split - gradient) >> 32
        as_float = lambda x: (x / FIXED).astype(np.float32)
        return np.stack((np.concatenate((self.observed - self.expected, as_float(gradient))), np.concatenate((self.expected, as_float(curvature)))))


def update(sums: np.ndarray) -> np.ndarray:
    """The change of each weight: its gradient by what that is measured by, with large ones damped."""
    return (RATE * np.arcsinh(sums[0] / (sums[1] + SMOOTHING))).astype(np.float32)


def _pack(x: np.ndarray) -> bytes:
    """The upper half of each number: sums of gradients need no more than 8 bits of precision."""
    whole = np.ascontiguousarray(x, np.float32).view(np.uint32)
    return zlib.compress(((whole + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    return (np.frombuffer(zlib.decompress(x), np.uint16).astype(np.uint32) << np.uint32(16)).view(np.float32)


def _sum_parts(batches: Iterator[pa.RecordBatch], pack) -> Iterator[pa.RecordBatch]:
    """One row a part: the sum of its rows; holds PARTS arrays at most."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = _unpack(packed.as_py())
            if part in totals:
                totals[part] += found
            else:
                totals[part] = found.astype(np.float64)
    yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([pack(x) for x in totals.values()], pa.binary())], ["part", "sums"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _sum_parts(batches, _pack)


def _updates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _sum_parts(batches, lambda x: zlib.compress(update(x.reshape(2, -1)).tobytes(), 1))


def train(docs: DataFrame, key: str, text: str, vocabulary: Vocabulary, scratch: Scratch, rounds: int = ROUNDS) -> MaxEnt:
    """A model trained on all of ``docs``: each round takes the documents that a hash of their key deals to it."""
    model = MaxEnt.start(vocabulary)
    context = docs.sparkSession.sparkContext
    tasks = min(MOST_TASKS, max(LEAST_TASKS, -(-vocabulary.tokens // TASK_TOKENS)))
    schema = "part int, sums binary"
    for turn in range(rounds):
        shared = context.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found: Gradients | None = None
            for batch in batches:
                for _, data, offsets in _text.text_blocks(batch.column(0)):
                    found = found or Gradients(shared.value)
                    words, first = tokens_of(data, offsets)
                    found.add(words, first, *shared.value.vocabulary.find(words)[1:])
            if found is not None:
                parts = np.array_split(found.sums(), PARTS, axis=1)
                for i, x in enumerate(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_pack(x)], pa.binary())], ["part", "sums"])

        dealt = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(rounds)) == turn
        table = scratch.table(docs.filter(dealt).select(text).coalesce(tasks).mapInArrow(_text.lean(learn), schema), "sums")
        sums = table.withColumn("salt", F.spark_partition_id() % 16).repartition(PARTS * 2, "part", "salt").select("part", "sums")
        sums = sums.mapInArrow(_text.lean(_add_up), schema).repartition(PARTS, "part").mapInArrow(_text.lean(_updates), schema)
        found = {r["part"]: np.frombuffer(zlib.decompress(bytes(r["sums"])), np.float32) for r in sums.toLocalIterator()}  # PARTS rows
        if found:
            change = np.concatenate([found[i] for i in range(PARTS)])
            cut = model.by_class.size
            model = MaxEnt(vocabulary, model.by_class + change[:cut].reshape(model.by_class.shape), model.by_split + change[cut:])
        scratch.drop(table)
        shared.unpersist()
    return model


def _scored(docs: DataFrame, known) -> DataFrame:
    """For each row: n_tokens, n_known, the sum of log10(c + 1) but of rare words, and the model's part without it.

    Each token whose count wasn't broadcast gives a row of its own, of mark and word alone.
    """
    names = ["doc_id", "held_out", "mark", "word", "n_tokens", "n_known", "logs", "model"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: MaxEnt = known.value
        for batch in batches:
            marks = batch.column(2).to_numpy(zero_copy_only=False)
            for row, data, offsets in _text.text_blocks(batch.column(3)):
                words, first = tokens_of(data, offsets)
                counts, classes, paths = model.vocabulary.find(words)
                logs, model_logs = np.log10(np.maximum(counts, 0) + 1.0), model.log_probabilities(words, first, classes, paths) / math.log(10)
                n = len(first) - 1
                per_text = [pa.array(np.add.reduceat(x, first[:-1])) for x in ((counts > 0).astype(np.int64), logs, model_logs)]  # each text has a token
                own = [batch.column(i).slice(row, n) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.nulls(n, pa.int64()), pa.array(np.diff(first)), *per_text], names)
                rare = np.flatnonzero(counts < 0)
                if len(rare):
                    nothing = [pa.nulls(len(rare), x.type) for x in (own[0], own[1], *per_text)]
                    owner = marks[row + np.searchsorted(first, rare, "right") - 1]
                    yield pa.RecordBatch.from_arrays([nothing[0], nothing[1], pa.array(owner), pa.array(words[rare].view(np.int64)), pa.nulls(len(rare), pa.int64()), *nothing[2:]], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "mark", "text").mapInArrow(_text.lean(score), f"doc_id {kind}, held_out boolean, mark long, word long, n_tokens long, n_known long, logs double, model double")


def score(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    Tokens are lower-cased (A-Z) words, then one end; a null text has the end alone. ``base_score`` is the
    add-one unigram log10 probability, ``score`` the model's. A row that repeats a key and a text is scored
    like the first and counts in training like any other. Without training documents all counts are 0 and
    the model is uniform over unknown words. An empty table gives an empty one; other columns aren't read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), (fold(F.col(key)) == HELD_OUT).alias("held_out"))
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text"))
    training = rows.filter(~F.col("held_out"))
    counts = scratch.table(word_counts(training), "counts")
    vocabulary = Vocabulary.of(counts, broadcast_words)
    model = train(training, "doc_id", "text", vocabulary, scratch, rounds)
    context = docs.sparkSession.sparkContext
    known = context.broadcast(model)
    both = scratch.table(_scored(rows, known), "scored")
    scored = both.filter("word is null").drop("word")
    found = both.filter("word is not null").select("mark", "word").join(counts, "word").groupBy("mark").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("rare_logs"), F.count("*").alias("rare_known"))
    copies = scored.groupBy("mark").agg(F.count("*").alias("copies"))
    rare = scratch.table(found.join(copies, "mark").select("mark", (F.col("rare_logs") / F.col("copies")).alias("rare_logs"), (F.col("rare_known") / F.col("copies")).cast("long").alias("rare_known")), "rare")
    joined = scored.join(rare, "mark", "left")
    extra = F.coalesce("rare_logs", F.lit(0.0))
    size = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    return joined.select(
        F.col("doc_id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + extra - F.col("n_tokens") * size).alias("base_score"),
        (F.col("model") + F.col("logs") + extra).alias("score"),
    )


def documents_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "lm") as scratch:
        return scratch.publish(score(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch))
