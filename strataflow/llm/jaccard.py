"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document's set is its distinct word shingles. Shingles have one global order, the rarer first, and only a
prefix of each set is indexed: two sets that are similar enough share a shingle of their prefixes. Documents
with the same prefix and size form a group, which is indexed once. Pairs are taken in three rounds, and
after each the verified pairs are contracted to components:

1. In each index entry, each group is paired with one hub, the group whose prefix has the fewest rarer
   shingles. An entry that may be large, by its shingle's frequency, is dealt to several tasks, and their hubs are
   paired in turn.
2. Groups of one entry are expanded to members. Of the pairs that still lie in different components and pass
   the size, position and bitmap filters, each block of an entry gives a spanning forest.
3. The pairs that still lie apart then, all of them.

So a large group of near copies costs a few pairs a member, not a pair a pair, and no link that could join
two components is lost: the last round leaves out only pairs that are in one component already. Sets are compared by 56-bit hashes of their shingles and documents of equal sets share a
64-bit id; two different shingles of one pair, or two different sets, are taken for equal with a chance of
about 1e-12 and 1e-19 a pair.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._columns import fresh
from ._scratch import Scratch

#: Words of a shingle, and the least similarity in percent.
SHINGLE, PERCENT = 4, 85
#: Buckets of the frequency sketch and the parts it is summed in. The order needs no exact counts.
SKETCH_BITS, SKETCH_PARTS = 22, 16
#: Rows of an index entry that are compared in one go; a larger entry is cut into blocks, and blocks are paired.
BLOCK_ROWS = 1024
#: Rows of an index entry that one task names hubs for, about; an entry that may have more is dealt to several.
SALT_ROWS = 1 << 16
#: Entries of up to so many rows are looked through pair by pair as they pass; of larger ones all rows stay.
SMALL_ENTRY = 64
#: Bits of the bitmaps that bound the difference of two sets: one for rows of entries, one for pairs.
BITMAP, WIDE_BITMAP = 256, 1024
#: Bits of the filter that picks documents whose sets must be fetched: so many a document, up to the limit.
FILTER_BITS_EACH, FILTER_BITS_MOST = 16, 1 << 27
#: Keys of documents that go are broadcast up to so many, 24 bytes each; with more of them, documents are shuffled.
BROADCAST_KEYS = 1 << 20

_U = np.uint64
_NO_TOKEN = np.int64(-1)  # no token has its top bit set, so this is none


def needed(size: np.ndarray | int, percent: int = PERCENT):
    """The least overlap of a set of this size with a similar one."""
    return (percent * size + 99) // 100


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lowered = _text.lower_ascii(data)
    words = _text.Words(lowered, offsets)
    hashes, first = _text.shingle_hashes(words.hashes(), words.first, k)
    for i in range(len(first) - 1):
        own = np.sort(hashes[first[i] : first[i + 1]])
        if len(own) > 1:
            fresh_ = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh_[1:])
            own = own[fresh_]
        yield own


def _identity(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _scan(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, set_id of each document, and from each task its part of the frequency sketch."""
    size = 1 << SKETCH_BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint32)
        for batch in batches:
            n, ids = [], []
            for _, data, offsets in _text.text_blocks(batch.column(1)):
                seen = []
                for own in sets_of(data, offsets, k):
                    n.append(len(own))
                    ids.append(_identity(own))
                    seen.append((own >> _U(64 - SKETCH_BITS)).astype(np.int64))
                np.add.at(counts, np.concatenate(seen), np.uint32(1))
            rows = len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], ["doc_id", "n", "set_id", "part", "counts"])
        parts = [zlib.compress(x.astype(np.uint64).tobytes(), 1) if x.any() else None for x in np.split(counts, SKETCH_PARTS)]
        found = [i for i, x in enumerate(parts) if x is not None]
        nothing = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, pa.array(found, pa.int32()), pa.array([parts[i] for i in found], pa.binary())], ["doc_id", "n", "set_id", "part", "counts"])

    return docs.mapInArrow(_text.lean(scan), "doc_id long, n long, set_id long, part int, counts binary")


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            counts = np.frombuffer(zlib.decompress(packed.as_py()), np.uint64)
            totals[part] = totals[part] + counts if part in totals else counts.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in totals.values()], pa.binary())], ["part", "counts"])


def frequency_classes(scanned: DataFrame) -> np.ndarray:
    """A rough logarithm of how many documents have a shingle, by sketch bucket; its size doesn't grow with the data."""
    parts = scanned.filter("part is not null").select("part", "counts", (F.spark_partition_id() % 16).alias("salt"))
    parts = parts.repartition(SKETCH_PARTS * 2, "part", "salt").mapInArrow(_text.lean(_sum_parts), "part int, counts binary")
    parts = parts.repartition(SKETCH_PARTS, "part").mapInArrow(_text.lean(_sum_parts), "part int, counts binary")
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    width = len(classes) // SKETCH_PARTS
    for row in parts.toLocalIterator():  # SKETCH_PARTS rows
        counts = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.uint64)
        classes[row["part"] * width : (row["part"] + 1) * width] = np.minimum(127, np.rint(3 * np.log2(counts + 1.0)))
    return classes


def _tokens(own: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The set in the global order: 7 bits of frequency class, then 56 of the shingle's hash."""
    ranks = classes[(own >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(_U)
    return np.sort((ranks << _U(56)) | (own >> _U(8))).astype(np.int64)


def _prefixes(docs: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """set_id, group_id, n, prefix and bitmaps of the sets that can be similar to a different one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            out: dict[int, tuple] = {}
            for _, data, offsets in _text.text_blocks(batch.column(0)):
                for own in sets_of(data, offsets, k):
                    n = len(own)
                    if n == 0 or 100 * n < percent * (n + 1):  # its neighbours in size are out of reach
                        continue
                    set_id = _identity(own)
                    if set_id in out:
                        continue
                    tokens = _tokens(own, classes)
                    prefix = tokens[: n - needed(n, percent) + 1].tobytes()
                    group = int.from_bytes(hashlib.blake2b(prefix, digest_size=8, salt=n.to_bytes(8, "little")).digest(), "little", signed=True)
                    wide = np.bincount(tokens & (WIDE_BITMAP - 1), minlength=WIDE_BITMAP) & 1
                    narrow = np.bitwise_xor.reduce(wide.reshape(-1, BITMAP), axis=0)
                    out[set_id] = (set_id, group, n, prefix, np.packbits(narrow).tobytes(), np.packbits(wide).tobytes())
            columns = list(zip(*out.values(), strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["set_id", "group_id", "n", "prefix", "bitmap", "wide"])

    return docs.select("text").mapInArrow(_text.lean(cut), "set_id long, group_id long, n long, prefix binary, bitmap binary, wide binary")


def _entries(groups: DataFrame) -> DataFrame:
    """A row for each token of each group's prefix, with the token before it."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                prefixes = [np.frombuffer(x.as_py(), np.int64) for x in part.column("prefix")]
                lengths = np.array([len(x) for x in prefixes])
                tokens = np.concatenate(prefixes)
                firsts = np.cumsum(lengths) - lengths
                before = np.empty_like(tokens)
                before[1:] = tokens[:-1]
                before[firsts] = _NO_TOKEN
                place = np.arange(len(tokens)) - np.repeat(firsts, lengths)
                column = lambda name: np.repeat(part.column(name).to_numpy(zero_copy_only=False), lengths)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(column("hub")), pa.array(column("n")), pa.array(place), pa.array(before), pa.array(column("several").astype(bool))], ["token", "set_id", "n", "place", "before", "several"])

    return groups.mapInArrow(_text.lean(spread), "token long, set_id long, n long, place long, before long, several boolean")


def _may_be_similar(n1, n2, place1, place2, percent: int):
    """The size filter, and the position filter as it holds for the first token that two prefixes share."""
    overlap = -(-percent * (n1 + n2) // (100 + percent))
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (np.minimum(n1 - place1, n2 - place2) >= overlap)


def _with_hubs(percent: int):
    """Streams entries in the order of token and place; drops rows that can pair with none and names each other's hub.

    A group that stands for several sets stays in any case. Held are an entry of up to SMALL_ENTRY rows or, of
    a larger one, its hubs, whose sizes are all out of reach of one another.
    """
    names = ["token", "set_id", "n", "place", "before", "hub"]

    def fits(size1: int, size2: int, at1: int, at2: int) -> bool:
        return 100 * min(size1, size2) >= percent * max(size1, size2) and min(size1 - at1, size2 - at2) >= -(-percent * (size1 + size2) // (100 + percent))

    def hub_for(row: tuple[int, int, int, int], hubs: list[tuple[int, int, int, int]]) -> int | None:
        set_id, size, at, prior = row
        for hub, hub_size, hub_at, hub_prior in hubs:
            if 100 * min(size, hub_size) >= percent * max(size, hub_size):
                return hub if (prior != hub_prior or prior == -1) and fits(size, hub_size, at, hub_at) and hub != set_id else None
        hubs.append(row)
        return None

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        large, large_hubs = None, []  # the key of a large entry that goes on, and its hubs

        def work(columns: list[np.ndarray], last: bool) -> pa.RecordBatch:
            nonlocal held, large, large_hubs
            if held is not None:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
                held = None
            token, several, salt = columns[0], columns[5], columns[6]
            starts = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])))) if len(token) else np.empty(0, np.int64)
            ends = np.append(starts[1:], len(token))
            is_large = lambda i: (token[i], salt[i]) == large or salt[i] >= 0  # noqa: E731  of a part of an entry all rows stay
            if len(starts) and not last and ends[-1] - starts[-1] <= SMALL_ENTRY and not is_large(starts[-1]):
                held = [c[starts[-1] :] for c in columns]
                starts, ends = starts[:-1], ends[:-1]
            at, hub_of = [], []
            busy = (ends - starts > 1) | several[starts] | (salt[starts] >= 0)
            if large is not None:
                busy |= (token[starts] == large[0]) & (salt[starts] == large[1])
            busy = np.flatnonzero(busy)
            for lo, hi in zip(starts[busy].tolist(), ends[busy].tolist(), strict=True):
                rows = list(zip(*(c[lo:hi].tolist() for c in columns[1:5]), strict=True))
                if is_large(lo) or hi - lo > SMALL_ENTRY:
                    if (token[lo], salt[lo]) != large:
                        large, large_hubs = (token[lo], salt[lo]), []
                    at += range(lo, hi)
                    hub_of += [hub_for(row, large_hubs) for row in rows]
                    continue
                keep = several[lo:hi].tolist()
                for i in range(1, len(rows)):
                    _, size, place, prior = rows[i]
                    for j in range(i):
                        other = rows[j]
                        if not (keep[i] and keep[j]) and (prior != other[3] or prior == -1) and fits(size, other[1], place, other[2]):
                            keep[i] = keep[j] = True
                hubs: list[tuple[int, int, int, int]] = []
                for i, row in enumerate(rows):
                    if keep[i]:
                        at.append(lo + i)
                        hub_of.append(hub_for(row, hubs))
            return pa.RecordBatch.from_arrays([*(pa.array(c[at]) if at else pa.array([], pa.int64()) for c in columns[:5]), pa.array(hub_of, pa.int64())], names)

        for batch in batches:
            if batch.num_rows:
                yield work([batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)], False)
        if held is not None:
            yield work([c[:0] for c in held], True)

    return pair


class _Forest:
    """Keeps, of pairs of components, those that join two trees."""

    def __init__(self, parts: np.ndarray):
        self.names = np.unique(parts)
        self.tree = np.arange(len(self.names))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.tree[np.searchsorted(self.names, a)] != self.tree[np.searchsorted(self.names, b)]

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The positions of pairs of a spanning forest; their trees are joined."""
        x, y = np.searchsorted(self.names, a), np.searchsorted(self.names, b)
        kept = []
        while True:
            hi, lo = np.maximum(self.tree[x], self.tree[y]), np.minimum(self.tree[x], self.tree[y])
            open_ = np.flatnonzero(hi != lo)
            if not len(open_):
                return np.concatenate(kept) if kept else open_
            trees, at = np.unique(hi[open_], return_index=True)
            kept.append(open_[at])
            to = np.arange(len(self.names))
            to[trees] = lo[open_[at]]  # always towards a lesser tree, so without a cycle
            while (to[to] != to).any():
                to = to[to]
            self.tree = to[self.tree]


def _apart(percent: int, forest: bool):
    """Pairs of one block of an entry that still lie in different components and pass all filters.

    With ``forest``, only as many of them as join the components of the block.
    """

    def pairs_of(block: list[np.ndarray], bitmaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, first_block, second_block, own, set_id, part, n, place, before = block
        if first_block[0] == second_block[0]:
            left = right = np.arange(len(set_id))
        else:
            left, right = np.flatnonzero(own == first_block[0]), np.flatnonzero(own == second_block[0])
        if not len(left) or not len(right):
            return set_id[:0], set_id[:0]
        trees = _Forest(part)
        out_a, out_b = [], []
        step = max(1, (1 << 18) // len(right))
        for at in range(0, len(left), step):
            i, j = left[at : at + step, None], right[None, :]
            good = (part[i] != part[j]) & ((before[i] != before[j]) | (before[i] == _NO_TOKEN)) & _may_be_similar(n[i], n[j], place[i], place[j], percent)
            x, y = np.nonzero(good)
            a, b = left[at + x], right[y]
            if forest:
                still = trees.apart(part[a], part[b])
                a, b = a[still], b[still]
            allowed = n[a] + n[b] - 2 * (-(-percent * (n[a] + n[b]) // (100 + percent)))
            for lo in range(0, len(a), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                near = np.flatnonzero(np.bitwise_count(bitmaps[a[s]] ^ bitmaps[b[s]]).sum(axis=1) <= allowed[s])
                if forest and len(near):
                    near = near[trees.join(part[a[s][near]], part[b[s][near]])]
                out_a.append(set_id[a[s]][near])
                out_b.append(set_id[b[s]][near])
        a, b = (np.concatenate(x) if x else set_id[:0] for x in (out_a, out_b))
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bits = None, None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(9)]
            bits = np.frombuffer(b"".join(x.as_py() for x in batch.column(9)), np.uint64).reshape(-1, BITMAP // 64)
            if held is not None:
                columns, bits = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)], np.concatenate((held_bits, bits))
            new = np.zeros(len(bits), bool)
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist()]
            out = [pairs_of([c[lo:hi] for c in columns], bits[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            held, held_bits = [c[cuts[-1] :] for c in columns], bits[cuts[-1] :]
            yield _pairs([x for x, _ in out], [y for _, y in out])
        if held is not None and len(held_bits):
            yield _pairs(*([x] for x in pairs_of(held, held_bits)))

    return find


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    none = np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], ["a", "b"])


def _sets(docs: DataFrame, k: int, classes, picked) -> DataFrame:
    """set_id and whole set of the documents that the filter picks, and of a few others."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = picked.value
        mask = len(words) * 64 - 1
        for batch in batches:
            slot = batch.column(0).to_numpy(zero_copy_only=False) & mask
            hit = (words[slot >> 6] >> (slot & 63).astype(_U)) & _U(1)
            texts = batch.column(1).filter(pa.array(hit.astype(bool)))
            ids, sets = [], []
            for _, data, offsets in _text.text_blocks(texts):
                for own in sets_of(data, offsets, k):
                    if len(own):
                        ids.append(_identity(own))
                        sets.append(_tokens(own, classes.value).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["set_id", "tokens"])

    return docs.select(F.xxhash64("doc_id").alias("slot"), "text").mapInArrow(_text.lean(fetch), "set_id long, tokens binary")


def _near(percent: int):
    """Leaves out pairs whose wide bitmaps differ in more places than similar sets can."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("wide", "wide2"))
            n = batch.column("n").to_numpy() + batch.column("n2").to_numpy()
            keep = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= n - 2 * (-(-percent * n // (100 + percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return check


def _similar(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = len(x) + len(y)
                merged = np.sort(np.concatenate((x, y)), kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= percent * (both - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


class GroupedPrefixJoin:
    def __init__(self, docs: DataFrame, scratch: Scratch, key: str, text: str, k: int, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("the least similarity lies over 50 and up to 100 percent")
        self.docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        self.scratch, self.k, self.percent = scratch, k, percent
        self.context = docs.sparkSession.sparkContext

    def verified(self, pairs: DataFrame, members: DataFrame, documents: DataFrame, classes) -> DataFrame:
        """The pairs whose sets are similar. Sets are made anew from the texts of one document a set."""
        one = members.select(F.col("set_id").alias("a"), "n", "wide")
        two = members.select(F.col("set_id").alias("b"), F.col("n").alias("n2"), F.col("wide").alias("wide2"))
        near = pairs.distinct().join(one, "a").join(two, "b").select("a", "b", "n", "n2", "wide", "wide2")
        pairs = self.scratch.table(near.mapInArrow(_text.lean(_near(self.percent)), "a long, b long"), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        chosen = documents.join(wanted, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
        chosen = self.scratch.table(chosen.select(F.xxhash64("doc_id").alias("slot")), "chosen")
        bits = 1 << 12
        while bits < min(FILTER_BITS_MOST, FILTER_BITS_EACH * chosen.count()):
            bits <<= 1
        words = np.zeros(bits // 64, _U)
        slot = F.col("slot").bitwiseAND(F.lit(bits - 1))
        filled = chosen.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((slot & {bits - 1}) & 63 as int))")).alias("bits"))
        for row in filled.toLocalIterator():  # FILTER_BITS_MOST / 64 rows at most
            words[row["word"]] = row["bits"] & 0xFFFFFFFFFFFFFFFF
        picked = self.context.broadcast(words)
        sets = _sets(self.docs, self.k, classes, picked).join(wanted, "set_id", "left_semi")
        sets = self.scratch.table(sets, "sets")
        left, right = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("y"))
        found = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        links = self.scratch.table(found.mapInArrow(_text.lean(_similar(self.percent)), "a long, b long").distinct(), "links")
        self.scratch.drop(sets, chosen, pairs)
        picked.unpersist()
        return links

    def run(self) -> tuple[DataFrame, DataFrame]:
        """(doc_id, n, set_id of each document; a, b: links of set ids that span all components)."""
        scanned = self.scratch.table(_scan(self.docs, self.k), "scan")
        documents = scanned.filter("part is null").select("doc_id", "n", "set_id")
        classes = self.context.broadcast(frequency_classes(scanned))
        prefixes = self.scratch.table(_prefixes(self.docs, self.k, self.percent, classes), "prefixes")
        groups = prefixes.groupBy("group_id").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("other"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        groups = self.scratch.table(groups.withColumn("several", F.col("hub") != F.col("other")), "groups")
        members = prefixes.select("set_id", "group_id", "n", "bitmap", "wide").join(groups.select("group_id", "hub"), "group_id").dropDuplicates(["set_id"])
        members = self.scratch.table(members.select("hub", "set_id", "n", "bitmap", "wide"), "members")
        self.scratch.drop(prefixes)

        may_be = F.ceil(F.pow(F.lit(2.0), F.shiftrightunsigned("token", 56) / 3) / SALT_ROWS)  # a shingle's frequency is at most what the sketch counted
        salt = F.when(may_be > 1, F.pmod(F.xxhash64("set_id"), may_be)).otherwise(F.lit(-1)).cast("long")
        entries = self.hubs(_entries(groups).withColumn("salt", salt))
        entries = self.scratch.table(entries.withColumn("salted", salt >= 0), "entries")
        self.scratch.drop(groups)
        apart = entries.filter("salted and hub is null").select("token", "set_id", "n", "place", "before", F.lit(False).alias("several"), F.lit(-1).cast("long").alias("salt"))
        pairs = entries.select("set_id", "hub").union(self.hubs(apart).select("set_id", "hub")).filter("hub is not null").select(F.least("set_id", "hub").alias("a"), F.greatest("set_id", "hub").alias("b"))
        entries = entries.drop("salted")
        inside = members.filter("set_id <> hub").select(F.least("set_id", "hub").alias("a"), F.greatest("set_id", "hub").alias("b"))
        links = self.verified(pairs.union(inside), members, documents, classes)

        rows = entries.select("token", F.col("set_id").alias("hub"), "n", "place", "before").join(members.select("hub", "set_id", "bitmap"), "hub").drop("hub")
        for forest in (True, False):
            rows = self.mixed(rows, components(links, self.scratch))
            more = self.verified(self.apart(rows, forest), members, documents, classes)
            links = links.union(more)
        classes.unpersist()
        return documents, links

    def hubs(self, entries: DataFrame) -> DataFrame:
        """Entries (with the column salt, -1 where an entry is whole) with the hub of each row."""
        dealt = entries.repartition("token", "salt").sortWithinPartitions("token", "salt", "place", "n", "set_id")
        return dealt.mapInArrow(_text.lean(_with_hubs(self.percent)), "token long, set_id long, n long, place long, before long, hub long")

    def mixed(self, rows: DataFrame, parts: DataFrame) -> DataFrame:
        """Entry rows with their component, of entries that have more than one; ``blocks`` tells how to cut them."""
        rows = rows.drop("part", "blocks").join(parts.select("set_id", F.col("least").alias("part")), "set_id", "left")
        rows = rows.withColumn("part", F.coalesce("part", "set_id")).select("token", "set_id", "part", "n", "place", "before", "bitmap")
        slim = self.scratch.table(rows, "rows")
        mixed = slim.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("rows")).filter("lo < hi")
        mixed = mixed.select("token", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
        found = self.scratch.table(slim.join(mixed, "token"), "mixed")
        self.scratch.drop(slim)
        return found

    def apart(self, rows: DataFrame, forest: bool) -> DataFrame:
        rows = rows.withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("token", F.least("own", "other").alias("first_block"), F.greatest("own", "other").alias("second_block"), "own", "set_id", "part", "n", "place", "before", "bitmap")
        order = ["token", "first_block", "second_block"]
        return rows.repartition(*(F.col(c) for c in order)).sortWithinPartitions(*order, "set_id").mapInArrow(_text.lean(_apart(self.percent, forest)), "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """set_id and the least id that links reach, of each id with a link.

    Alternates large and small stars (Kiveris et al., "Connected components in MapReduce and beyond") until
    every id points to its least; a node's links are aggregated before they meet, and each round is a table.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = scratch.table(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct()
        large = scratch.table(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", "least")).filter("u <> v").distinct()
        edges = scratch.table(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if now == before:
            return edges.select(F.col("u").alias("set_id"), F.col("v").alias("least")).union(edges.select(F.col("v").alias("set_id"), F.col("v").alias("least"))).distinct()
        before = now


def near_copies(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id of each row of ``docs``.

    Words are runs of characters but ASCII white space, A-Z lower-cased; a set has the distinct runs of ``k``
    words, or the whole sequence of fewer. Documents link when the intersection has ``percent`` of the union;
    component_id is the least key that links reach. A text without words, or null, has an empty set and its
    own key. Repeated rows are documents of equal sets; a null key is never the least unless no other is
    there. An empty table gives an empty one; other columns aren't read.
    """
    found = _classes(docs, scratch, key, text, k, percent)
    return found.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _classes(docs: DataFrame, scratch: Scratch, key: str, text: str, k: int, percent: int) -> DataFrame:
    """doc_id, n, set_id, component_id of each row of ``docs``."""
    documents, links = GroupedPrefixJoin(docs, scratch, key, text, k, percent).run()
    roots = components(links, scratch)
    least = documents.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    least = scratch.table(least.join(roots, "set_id", "left").select("set_id", "doc_id", F.coalesce("least", "set_id").alias("root")), "least")
    root = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = scratch.table(least.join(root, "root").select(F.col("set_id").alias("own"), "component_id"), "found")
    out = documents.join(found, (F.col("set_id") == F.col("own")) & (F.col("n") > 0), "left")
    return out.select("doc_id", "n", "set_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def _with_set_id(df: DataFrame, text: str, k: int, out: str) -> DataFrame:
    """``df`` with the id of each text's set."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_identity(own) for _, data, offsets in _text.text_blocks(batch.column(text)) for own in sets_of(data, offsets, k)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], schema.names)

    return df.mapInArrow(_text.lean(identify), schema)


def keep_one_of_each(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that with the least key.

    Rows with a null key all stay, and so do rows without words. Of rows that repeat a key and a text one
    stays. Rows of one key and different texts are judged each by its own text: one goes where its component
    has a lesser key, the others stay, as nothing tells which is meant. Only the keys of what goes outlive
    ``scratch``.
    """
    found = scratch.table(_classes(docs, scratch, key, text, k, percent), "classes")
    name, set_name = fresh(docs.columns, "_gone"), fresh(docs.columns, "_gone_set")
    gone = scratch.publish(found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(name), F.col("set_id").alias(set_name)).distinct())
    repeated = scratch.publish(found.groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias("rows")).filter(f"rows > 1 and `{name}` is not null").select(name))
    gone = scratch.broadcast_if_small(gone, BROADCAST_KEYS)
    same = F.col(f"`{key}`") == F.col(name)
    if repeated.isEmpty():
        return docs.join(gone, same, "left_anti")
    single = docs.join(repeated, same, "left_anti").join(gone, same, "left_anti")
    own = fresh([*docs.columns, name, set_name], "_own_set")
    several = _with_set_id(docs.join(repeated, same, "left_semi"), text, k, own).join(gone, same & (F.col(own) == F.col(set_name)), "left_anti")
    return single.union(several.drop(own).dropDuplicates([key, text]))


def documents_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "jaccard") as scratch:
        return scratch.publish(near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch))


#: Sets, links by counting shared shingles, and components as the closure of links.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')] ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' ')) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), sides AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS root, doc_id FROM documents UNION SELECT root, b FROM reach JOIN sides ON doc_id = a
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
