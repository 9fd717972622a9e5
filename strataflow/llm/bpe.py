"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A list of tokens is what BPE makes of its bytes exactly if each pair of neighbours is what BPE makes of that
pair's bytes. So each prefix of a byte string has one valid last token: the token that ends there, and that
forms a valid pair with the last token of the prefix before it. Storing that token for every prefix gives
exact appends (earlier entries never change) and cheap edits (entries before the edit are kept, and entries
after it are kept once the new table has run level with the old one).
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import _text
from ._columns import found_path

#: Entries that a worker keeps of encoded pieces; beyond it the cache starts anew. Results don't depend on it.
CACHE_ENTRIES = 200_000
#: Rows of an Arrow batch that are encoded at a time.
BATCH_BYTES = 4 << 20

DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a line holds a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PrefixTable:
    """The last token's id of every non-empty prefix of ``data``."""

    __slots__ = ("data", "last")

    def __init__(self, data: bytes = b"", last: list[int] | None = None):
        self.data, self.last = data, last or []


class PrefixEncoder:
    """Encodes byte strings by the ranks of a vocabulary in which every single byte is a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        if len(self.bytes_of) != len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks must be distinct and hold each single byte")
        self.longest = max(map(len, ranks))
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}  # by left << 32 | right
        #: Finds all tokens that end at a byte, the longest first.
        self._ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self._ends.make_automaton()

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None of a single byte or a token that merges never reach."""
        if token not in self._halves:
            parts = self._merge(self.bytes_of[token], self.ranks[self.bytes_of[token]])
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Tokens after all merges of a rank under ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[x] for x in parts]

    def valid_pair(self, left: int, right: int) -> bool:
        """True if BPE leaves these two neighbours as they are.

        It goes back in time: the token that was formed later is taken apart, and at each step the two
        tokens that then met at the border must not have been due for a merge before one of them went
        into a larger token. Of merges of equal rank the left one comes first.
        """
        key = left << 32 | right
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) > 2 * CACHE_ENTRIES:
                self._pairs.clear()
            found = self._pairs[key] = self._survives(left, right)
        return found

    def _survives(self, left: int, right: int) -> bool:
        rank_of, bytes_of, halves, known = self.ranks.get, self.bytes_of, self.halves, self._halves
        left_end = right_end = 1 << 62
        while True:
            merged = rank_of(bytes_of[left] + bytes_of[right])
            if merged is not None and merged < left_end and merged <= right_end:
                return False
            right_parts = known[right] if right in known else halves(right)
            if right_parts is not None and right >= left:
                right_end, right = right, right_parts[0]
                continue
            left_parts = known[left] if left in known else halves(left)
            if left_parts is not None:
                left_end, left = left, left_parts[1]
            elif right_parts is not None:
                right_end, right = right, right_parts[0]
            else:
                return True

    def extend(self, table: PrefixTable, more: bytes) -> PrefixTable:
        """The table of table.data + more; no entry of ``table`` changes."""
        data, last = table.data + more, list(table.last)
        self._fill(data, last, len(table.data))
        return PrefixTable(data, last)

    def _fill(self, data: bytes, last: list[int], begin: int, stop: int | None = None) -> None:
        valid, fits_of, known, add = self.valid_pair, self._pairs.get, self._halves, last.append
        base = max(0, begin - self.longest)
        done = begin - base  # entries there are, counted from base
        for at, (token, length) in self._ends.iter(data[base:stop].decode("latin-1")):
            if at < done:
                continue
            before = at + base - length
            if before >= 0:
                fits = fits_of(last[before] << 32 | token)
                if not (valid(last[before], token) if fits is None else fits):
                    continue
            elif length > 1 and (known[token] if token in known else self.halves(token)) is None:
                continue
            add(token)
            done = at + 1

    def edit(self, table: PrefixTable, start: int, stop: int, new: bytes) -> PrefixTable:
        """The table of the data with data[start:stop] replaced.

        Entries before ``start`` stay. Behind the edit it recomputes until as many entries in a row as the
        longest token has bytes equal the old ones: the rest then depends on equal entries only and stays.
        """
        if not 0 <= start <= stop <= len(table.data):
            raise ValueError("the edit lies outside the data")
        data = table.data[:start] + new + table.data[stop:]
        last, shift = table.last[:start], len(new) - (stop - start)
        settled, end = 0, start
        while end < len(data):
            self._fill(data, last, end, end + 1)
            end += 1
            behind = end - start - len(new)  # bytes of the old tail that are done
            settled = settled + 1 if behind > 0 and table.last[end - 1 - shift] == last[end - 1] else 0
            if settled >= self.longest and behind >= 2 * self.longest:
                last.extend(table.last[end - shift :])
                break
        return PrefixTable(data, last)

    def tokens(self, table: PrefixTable) -> list[int]:
        found, end, last, sizes = [], len(table.data), table.last, self._sizes
        while end > 0:
            token = last[end - 1]
            found.append(token)
            end -= sizes[token]
        return found[::-1]

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:  # a piece that is a token is that token, whether or not merges reach it
            return [whole]
        last: list[int] = []
        self._fill(data, last, 0)
        return self.tokens(PrefixTable(data, last))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class TextEncoder:
    """Encodes texts piece by piece; equal pieces are encoded once while the cache holds them."""

    def __init__(self, encoder: PrefixEncoder, pattern: str):
        self.encoder, self.pieces = encoder, regex.compile(pattern)
        self._cache: dict[str, tuple[int, ...]] = {}  # tuples of numbers cost the garbage collector nothing

    def encode(self, text: str) -> list[int]:
        cache, ids = self._cache, []
        for piece in self.pieces.findall(text):
            found = cache.get(piece)
            if found is None:
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                found = cache[piece] = tuple(self.encoder.encode(piece.encode()))
            ids += found
        return ids


_loaded: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(path: str | Callable[[], str], pattern: str) -> TextEncoder:
    """One for each worker, vocabulary and pattern. ``path`` may be a function that the worker calls for it."""
    path = found_path(path)
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = TextEncoder(PrefixEncoder(read_ranks(path)), pattern)
    return _loaded[path, pattern]


def encode_texts(df: DataFrame, path: str | Callable[[], str], pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``df`` with the array column ``out``: the token ids of each text (null: empty).

    Every other column stays as it is, whatever its name; a column already called ``out`` is replaced. An
    empty table gives an empty table. The result depends on the text alone, so a repeated task repeats it.
    """
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(path, pattern)
        for batch in batches:
            for part in _slices(batch, text):
                ids = [coder.encode(x or "") for x in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*keep, out])

    return df.select(*keep).mapInArrow(_text.lean(encode), schema)


def decode_ids(df: DataFrame, path: str | Callable[[], str], pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the binary column ``out``: the bytes of each list of ids (null: empty). An unknown id is an error."""
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(path, pattern).encoder
        for batch in batches:
            found = [coder.decode(x or ()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*keep, out])

    return df.select(*keep).mapInArrow(_text.lean(decode), schema)


def token_digests(df: DataFrame, path: str | Callable[[], str], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of each row: encodes a whole text, then decodes its ids.

    A null text counts as empty: 0 tokens and the hash of no bytes. Repeated rows give repeated results, ties don't
    arise, a text of any length is encoded whole, an empty table gives an empty one, and other columns aren't read.
    """
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *DIGEST_SCHEMA.fields[1:]])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(path, pattern)
        name = _Names()
        for batch in batches:
            for part in _slices(batch, text):
                n, ids_hash, bytes_hash = [], [], []
                for x in part.column(text):
                    ids = coder.encode(x.as_py() or "")
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join(map(name.__getitem__, ids)).encode()).hexdigest())
                    bytes_hash.append(hashlib.sha256(coder.encoder.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())], schema.names)

    return df.select(key, text).mapInArrow(_text.lean(digest), schema)


class _Names(dict):
    """Decimal names of ids; at most as many as the vocabulary has."""

    def __missing__(self, token: int) -> str:
        self[token] = found = str(token)
        return found


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about BATCH_BYTES, one row at least."""
    step = max(1, int(batch.num_rows * BATCH_BYTES / max(BATCH_BYTES, batch.column(text).nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def documents_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(docs, functools.partial(public_tokenizers.path, "byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
