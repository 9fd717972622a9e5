"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens; the pre-tokens that a batch brings anew lie one behind the other in flat numpy
arrays. In each round every pre-token applies the merge of lowest rank that it holds, all at once; a pre-token
without a merge leaves the arrays, and its surviving symbols are its tokens.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import _text
from ._columns import found_path

#: Fixed value: the pre-token pattern of byte-level tokenizer files with "use_regex".
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Counts of pre-tokens that a worker keeps; beyond it the cache starts anew. Results don't depend on it.
CACHE_ENTRIES = 800_000
#: Bytes of text that are cut at a time, and symbols that are merged at a time; longer single ones go alone.
BATCH_BYTES, BATCH_SYMBOLS = 4 << 20, 1 << 18
#: Documented limit of the report column over_limit.
TOKEN_LIMIT = 1024

_NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    symbols = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(plain))
    return [symbols[b] for b in range(256)]


class MergeTable:
    """The ranks and results of all merges, to be looked up for arrays of pairs."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.size = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[s] for s in byte_symbols()], np.int32)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.results = np.array([vocab[a + b] for a, b in merges], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that survive in each piece; pieces must not be empty."""
        counts = np.zeros(len(pieces), np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece = np.arange(len(pieces))
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        ranks = np.full(len(symbols), _NONE, np.int32)  # of the pair of a symbol and the next of its piece
        ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[firsts + lengths - 1] = _NONE
        while len(piece):
            best = np.minimum.reduceat(ranks, firsts)
            done = best == _NONE
            if done.any():
                counts[piece[done]] = lengths[done]
                live = np.repeat(~done, lengths)
                symbols, ranks = symbols[live], ranks[live]
                piece, lengths, best = piece[~done], lengths[~done], best[~done]
                firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
                if not len(piece):
                    break
            owner = np.repeat(np.arange(len(piece)), lengths)
            at = np.flatnonzero(ranks == best[owner])
            at = at[_every_other(at)]
            symbols[at] = self.results[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(owner[at], minlength=len(piece))
            # the merged symbol ends its piece if the symbol it took did
            ends = np.zeros(len(symbols), bool)
            ends[firsts[1:] - 1] = True
            ends[-1] = True
            ends[at] |= ends[at + 1]
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            symbols, ranks, ends, changed = symbols[keep], ranks[keep], ends[keep], changed[keep]
            firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            changed[:-1] |= changed[1:]  # the pair before a merged symbol changes too
            again = np.flatnonzero(changed & ~ends)
            ranks[ends] = _NONE
            ranks[again] = self.rank(symbols[again], symbols[again + 1])
        return counts


def _every_other(at: np.ndarray) -> np.ndarray:
    """Of runs of neighbouring positions the first, third and so on: pairs that overlap merge from the left."""
    if not len(at):
        return np.zeros(0, bool)
    new = np.ones(len(at), bool)
    new[1:] = np.diff(at) != 1
    start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    return (np.arange(len(at)) - start) % 2 == 0


class TokenCounter:
    """Counts tokens as the library does for a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} isn't a plain byte-level BPE file")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.table = MergeTable(model["vocab"], merges)
        self.pieces = regex.compile(BYTE_LEVEL_PATTERN)
        #: Strings that are one token wherever a text holds them.
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._cache: dict[str, int] = {}

    def _cut(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self.pieces.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.pieces.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = [self._cut(x) for x in texts]
        if len(self._cache) > CACHE_ENTRIES:
            self._cache.clear()
        new = list({p for pieces, _ in cut for p in pieces if p not in self._cache})
        at = 0
        while at < len(new):
            part, size = [], 0
            while at < len(new) and (not part or size + len(new[at]) <= BATCH_SYMBOLS):
                part.append(new[at].encode())
                size += len(part[-1])
                at += 1
            self._cache.update(zip(new[at - len(part) : at], self.table.count(part).tolist(), strict=True))
        found = self._cache.__getitem__
        return [sum(map(found, pieces)) + n for pieces, n in cut]


_loaded: dict[str, TokenCounter] = {}


def token_counts(df: DataFrame, path: str | Callable[[], str], key: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of each row of ``df``.

    A null text counts as empty (0 bytes, 0 tokens, not over the limit). Repeated rows give repeated results,
    an empty table an empty one; other columns aren't read. A whole text is counted, however long. ``path`` is
    that of the tokenizer's file on every worker, or a function that a worker calls for it.
    """
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = found_path(path)
        counter = _loaded.setdefault(file, None) or TokenCounter(file)
        _loaded[file] = counter
        for batch in batches:
            step = max(1, int(batch.num_rows * BATCH_BYTES / max(BATCH_BYTES, batch.column(text).nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = [x or "" for x in part.column(text).to_pylist()]
                tokens = np.array(counter.count(texts), np.int64)
                sizes = np.fromiter((len(x.encode()) for x in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], schema.names)

    return df.select(key, text).mapInArrow(_text.lean(count), schema)


def documents_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), functools.partial(public_tokenizers.path, "byte_bpe_50k.json"))
