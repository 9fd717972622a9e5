"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read each window of a text's bytes, one from either end; every position is
labelled from both states, and a document's probabilities are the mean over its positions. The network is
trained on the driver in numpy, by backpropagation through time over a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._columns import fresh

#: Units a direction, and the bytes that a window has; states start anew at each window.
UNITS, WINDOW = 8, 64
#: The sample: so many texts a language at most, and so many characters of each. More languages than that are an error.
SAMPLE_TEXTS, SAMPLE_CHARS, MAX_LANGUAGES = 128, 4096, 4096
#: Training: windows in a step, steps, and the step size at the start.
BATCH, STEPS, RATE, SEED = 512, 260, 0.03, 20
#: Windows that are read at a time.
WINDOWS_AT_ONCE = 4096
#: Folds of documents: those with this remainder of their key's checksum are held out.
FOLDS, HELD_OUT = 3, 1
#: What a text without letters is labelled, and the pipeline's least score.
UNDETERMINED, LEAST_SCORE = "und", 0.3


class Direction:
    """One gated recurrent layer. Arrays hold a row a unit and a column a window."""

    def __init__(self, inputs: np.ndarray, recurrent: np.ndarray):
        self.inputs, self.recurrent = inputs, recurrent  # (3 units, 256) and (3 units, units): update, reset, new

    @classmethod
    def random(cls, units: int, rng: np.random.Generator) -> Direction:
        return cls(rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32), rng.normal(0, 0.5 / np.sqrt(units), (3 * units, units)).astype(np.float32))

    def step(self, bytes_: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """(new state, gates, candidate, recurrent part of the candidate)."""
        u = len(state)
        x = np.take(self.inputs, bytes_, axis=1)
        h = self.recurrent @ state
        gates = x[: 2 * u]
        gates += h[: 2 * u]
        gates *= np.float32(0.5)
        np.tanh(gates, out=gates)
        gates += np.float32(1)
        gates *= np.float32(0.5)
        new = gates[u:] * h[2 * u :]
        new += x[2 * u :]
        np.tanh(new, out=new)
        out = state - new
        out *= gates[:u]
        out += new
        return out, gates, new, h[2 * u :]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # (languages, 2 units)
    bias: np.ndarray  # (languages, 1)

    @classmethod
    def random(cls, languages: list[str], units: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        forward, backward = Direction.random(units, rng), Direction.random(units, rng)
        return cls(languages, forward, backward, rng.normal(0, 0.3, (len(languages), 2 * units)).astype(np.float32), np.zeros((len(languages), 1), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.recurrent, self.backward.inputs, self.backward.recurrent, self.output, self.bias]

    def label_windows(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the positions' probabilities, (languages, windows); each position's label, (places, windows)).

        ``windows`` is (places, windows); lengths descend, so the windows that have a place come first.
        """
        u, n = self.forward.recurrent.shape[1], windows.shape[1]
        live = np.searchsorted(-lengths, -np.arange(1, len(windows) + 1), "right")
        logits = []
        state = np.zeros((u, n), np.float32)
        for t in range(len(windows)):
            state = self.forward.step(windows[t, : live[t]], state[:, : live[t]])[0]
            logits.append(self.output[:, :u] @ state + self.bias)
        total = np.zeros((len(self.languages), n), np.float32)
        labels = np.zeros(windows.shape, np.uint16)
        state = np.zeros((u, 0), np.float32)
        for t in range(len(windows) - 1, -1, -1):
            if state.shape[1] < live[t]:
                state = np.concatenate((state, np.zeros((u, live[t] - state.shape[1]), np.float32)), axis=1)
            state = self.backward.step(windows[t, : live[t]], state)[0]
            scores = logits[t]
            scores += self.output[:, u:] @ state
            scores -= scores.max(axis=0)
            labels[t, : live[t]] = scores.argmax(axis=0) if len(scores) > 1 else 0
            np.exp(scores, out=scores)
            scores /= scores.sum(axis=0)
            total[:, : live[t]] += scores
        return total, labels

    def loss_and_gradients(self, windows: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of all positions of full windows, and its gradients, through time."""
        places, n = windows.shape
        u = self.forward.recurrent.shape[1]
        runs = []
        for layer, order in ((self.forward, range(places)), (self.backward, range(places - 1, -1, -1))):
            state, run = np.zeros((u, n), self.bias.dtype), {}
            for t in order:
                before = state
                state, gates, new, part = layer.step(windows[t], before)
                run[t] = (before, state, gates, new, part)
            runs.append(run)
        loss, d_output, d_bias = 0.0, np.zeros_like(self.output), np.zeros_like(self.bias)
        d_states = [np.empty((places, u, n), self.bias.dtype) for _ in runs]
        scale = 1 / (places * n)
        for t in range(places):
            both = np.concatenate((runs[0][t][1], runs[1][t][1]))
            scores = self.output @ both + self.bias
            scores -= scores.max(axis=0)
            np.exp(scores, out=scores)
            scores /= scores.sum(axis=0)
            loss -= float(np.log(np.maximum(scores[target, np.arange(n)], 1e-30)).sum()) * scale
            scores[target, np.arange(n)] -= 1
            scores *= scale
            d_output += scores @ both.T
            d_bias += scores.sum(axis=1, keepdims=True)
            d_both = self.output.T @ scores
            d_states[0][t], d_states[1][t] = d_both[:u], d_both[u:]
        gradients = []
        flat = windows.ravel()
        for layer, run, d_state, order in ((self.forward, runs[0], d_states[0], range(places - 1, -1, -1)), (self.backward, runs[1], d_states[1], range(places))):
            d_recurrent = np.zeros_like(layer.recurrent)
            d_x = np.empty((3 * u, places, n), self.bias.dtype)
            carried = np.zeros((u, n), self.bias.dtype)
            for t in order:
                before, _, gates, new, part = run[t]
                update, reset = gates[:u], gates[u:]
                d = d_state[t] + carried
                d_new = d * (1 - update) * (1 - new * new)
                d_x[:u, t] = d * (before - new) * update * (1 - update)
                d_x[u : 2 * u, t] = d_new * part * reset * (1 - reset)
                d_x[2 * u :, t] = d_new
                d_h = d_x[:, t].copy()
                d_h[2 * u :] *= reset
                d_recurrent += d_h @ before.T
                carried = d * update + layer.recurrent.T @ d_h
            rows = d_x.reshape(3 * u, -1)
            d_inputs = np.stack([np.bincount(flat, weights=row, minlength=256) for row in rows]).astype(self.bias.dtype)
            gradients += [d_inputs, d_recurrent]
        return loss, [*gradients, d_output, d_bias]


def train(texts: list[bytes], labels: list[str], units: int = UNITS, steps: int = STEPS, batch: int = BATCH, window: int = WINDOW, rate: float = RATE, seed: int = SEED) -> Network | None:
    """A network for the labels that occur; None without a text that has a byte. Each language is drawn alike."""
    pairs = [(x, y) for x, y in zip(texts, labels, strict=True) if x]
    if not pairs:
        return None
    languages = sorted({y for _, y in pairs})
    network, rng = Network.random(languages, units, seed), np.random.default_rng(seed)
    if len(languages) == 1:
        return network
    # texts of a language, one behind the other and around again, so that each has full windows
    tracks = []
    for language in languages:
        track = np.frombuffer(b"\n".join(x for x, y in pairs if y == language), np.uint8)
        tracks.append(np.resize(track, max(len(track), 2 * window) + window))
    parameters = network.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        target = (np.arange(batch) + (step - 1) * batch) % len(languages)
        starts = [int(rng.integers(0, len(tracks[y]) - window)) for y in target]
        windows = np.stack([tracks[y][s : s + window] for y, s in zip(target, starts, strict=True)], axis=1)
        _, gradients = network.loss_and_gradients(windows, target)
        size = rate * min(1.0, 2 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for p, g, a, b in zip(parameters, gradients, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= (size * a / (np.sqrt(b) + 1e-8)).astype(p.dtype)
    return network


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """(texts, languages): the mean of the positions' probabilities of each text of a block; 0 of an empty one."""
    sizes = np.diff(offsets)
    counts = -(-sizes // window)
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + place * window
    lengths = np.minimum(offsets[owner + 1] - starts, window)
    order = np.argsort(-lengths, kind="stable")
    padded = np.concatenate((data, np.zeros(window, np.uint8)))
    out = np.zeros((len(sizes), len(network.languages)))
    for at in range(0, len(order), WINDOWS_AT_ONCE):
        part = order[at : at + WINDOWS_AT_ONCE]
        windows = padded[starts[part][None, :] + np.arange(lengths[part[0]])[:, None]]
        total, _ = network.label_windows(windows, lengths[part])
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(owner[part], weights=total[k], minlength=len(sizes))
    return out / np.maximum(sizes, 1)[:, None]


def label_positions(network: Network, text: bytes, window: int = WINDOW) -> list[str]:
    """The label of every byte of a text."""
    data = np.frombuffer(text, np.uint8)
    found: list[str] = []
    for at in range(0, len(data), window):
        part = data[at : at + window]
        _, labels = network.label_windows(part[:, None], np.array([len(part)]))
        found += [network.languages[k] for k in labels[:, 0]]
    return found


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo FOLDS; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> list[tuple[str, str]]:
    """(text, label) of a bounded sample of the rows that aren't held out and have both.

    Rows of a language are dealt into SAMPLE_TEXTS buckets by a hash of their key, and a bucket gives the row
    of the least hash: all rows take part, a part of the aggregate is done before the shuffle, and no
    language is ever in one task.
    """
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull() & (fold(F.col(key)) != HELD_OUT))
    hash_ = F.xxhash64(F.col(key), F.lit(SEED))
    rows = rows.select(F.col(label).cast("string").alias("label"), hash_.alias("hash"), F.col(text).alias("text"))
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(SAMPLE_TEXTS)))
    buckets = rows.groupBy("label", "bucket").agg(F.min("hash").alias("least"), F.count("*").alias("rows")).persist()
    languages = buckets.select("label").distinct().count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages are more than one network is meant for ({MAX_LANGUAGES})")
    least = F.broadcast(buckets.select(F.col("label").alias("l"), F.col("least").alias("h")))  # SAMPLE_TEXTS * MAX_LANGUAGES rows at most
    start = F.greatest(F.lit(1), F.pmod(F.col("hash"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)) + 1).cast("int")
    found = rows.join(least, (F.col("label") == F.col("l")) & (F.col("hash") == F.col("h")))
    # rows of one key share a hash: one of them is enough
    found = found.select("label", "hash", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text")).groupBy("label", "hash").agg(F.min("text").alias("text"))
    sample = [(r["text"], r["label"]) for r in found.orderBy("label", "hash").collect()]
    buckets.unpersist()
    return sample


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Network | None:
    sample = training_sample(docs, key, text, label)
    return train([x.encode() for x, _ in sample], [y for _, y in sample])


def with_language(df: DataFrame, network: Network | None, text: str, label: str, score: str) -> DataFrame:
    """``df`` with the predicted language of each whole text and its pooled probability.

    A null text, a text without a letter, or any text where nothing could be learned is UNDETERMINED with
    the score 0. Ties go to the first language in alphabetical order. Only the text is looked at.
    """
    flag = fresh([*df.columns, label, score], "_letters")
    schema = T.StructType([*df.schema.fields, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(network)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network | None = shared.value
        for batch in batches:
            names, scores = [], []
            letters = batch.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            if net is None:
                names, scores = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows
            else:
                for row, data, offsets in _text.text_blocks(batch.column(text)):
                    found = pooled(net, data, offsets)
                    best = found.argmax(axis=1)
                    for i, k in enumerate(best.tolist()):
                        known = letters[row + i]
                        names.append(net.languages[k] if known else UNDETERMINED)
                        scores.append(min(1.0, max(0.0, float(found[i, k]))) if known else 0.0)
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != flag]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    has_letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return df.withColumn(flag, has_letter).mapInArrow(_text.lean(predict), schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """key, held_out, lang_pred, score of each row of ``docs``; learns from the rows that aren't held out.

    Rows without a label or a text aren't learned from; an empty table gives an empty table; repeated rows
    have repeated results; other columns aren't read.
    """
    network = fit(docs, key, text, label)
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text"), (fold(F.col(key)) == HELD_OUT).alias("held_out"))
    return with_language(rows, network, "text", "lang_pred", "score").select(key, "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is determined with ``least_score`` at least, with their own columns."""
    pred, score = fresh(docs.columns, "_lang_pred"), fresh(docs.columns, "_lang_score")
    found = with_language(docs, fit(docs, key, text, label), text, pred, score)
    return found.filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= least_score)).select(*(F.col(f"`{c}`") for c in docs.columns))


def documents_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
