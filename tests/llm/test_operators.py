"""Each operator against a brute-force version, and on odd and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataflow.llm import _text, bpe, decontaminate, jaccard, langid, licences, lm, quality, queries, sharding, token_counts, warc
from strataflow.llm._scratch import Scratch
from tests import oracle
from tests.llm.fixtures import odd

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs():
    import duckdb

    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert oracle.compare(queries.queries()[name](spark, SF), oracle.connect(SF), queries.oracle_sql()[name]) == ""


def brute_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_counts(docs):
    rng = random.Random(1)
    texts = [t for _, t, _ in docs] + [None, "", "\n", "a\na"] + ["".join(rng.choice("ab é\n\n |\r\t") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    for size in (1 << 18, 300):
        got = np.concatenate([quality.count_block(d, o) for _, d, o in _text.text_blocks(pa.array(texts), size)])
        assert [tuple(r[:5]) for r in got.tolist()] == [brute_counts(t) for t in texts]


def test_binomial_tail_and_cutoff():
    for n, p in ((10, 0.3), (200, 0.02)):
        for k in range(0, 9):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert abs(quality.binomial_tail(k, n, p) - want) < 1e-12
    good, bad = np.zeros(65), np.zeros(65)
    good[:20], bad[40:] = 500, 30
    cut = quality.choose_cutoff(good, bad, 0.01, 0.001)
    assert 20 <= cut <= 40
    assert quality.choose_cutoff(good[:] / 500, bad, 0.01, 0.001) is None  # too few labels for a guarantee


def test_quality_keeps_its_promise(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 5 == 0
        words = ["w" + str(rng.randint(0, 9999)) + ("###" if bad and rng.random() < 0.6 else "") for _ in range(60)]
        rows.append((i, " ".join(words), "en" if i % 2 else None))
        labels.append((i, 0 if bad else 1))
    df, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    with Scratch(spark, "t") as scratch:
        got = {r["doc_id"]: r["kept"] for r in quality.judge(df, marks, scratch).collect()}
        kept = {r["doc_id"] for r in quality.keep_good(df, marks, scratch).collect()}
    assert kept == {i for i, k in got.items() if k}
    good = [i for i, q in labels if q]
    assert sum(not got[i] for i in good) <= quality.RISK * len(good)
    assert sum(got[i] for i, q in labels if not q) < 100


def test_quality_rejects_in_small_strata(spark):
    assert quality.least_labels(4) == 217
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(4 * 350):
        bad = i // 4 % 8 == 0
        words = ["w" + str(rng.randint(0, 9999)) + ("###" if bad else "") for _ in range(60)]
        rows.append((i, " ".join(words), ("de", "en", "es", "fr")[i % 4]))
        labels.append((i, 0 if bad else 1))
    rows += [(9000 + i, t, "xx") for i, t, _ in rows[:100]]  # too few labels for a guarantee
    labels += [(9000 + i, q) for i, q in labels[:100]]
    df, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    with Scratch(spark, "t") as scratch:
        got = {r["doc_id"]: r["kept"] for r in quality.judge(df, marks, scratch).collect()}
    assert [got[i] for i, _ in labels] == [i >= 9000 or q == 1 for i, q in labels]


def test_quality_rules_share_one_risk():
    good, bad = np.zeros((2, 65)), np.zeros((2, 65))
    good[:, :20], bad[0, 40], bad[1, 50], good[1, 45] = 10, 30, 20, 5
    steps = quality.order_steps(good, bad)
    assert steps[0, 64] == 1 and steps[0, 40] == 25 and steps[0, 39] == 0  # no bin below the last bad document
    assert steps[1, 64] == 26 and steps[1, 50] == 40 and not steps[1, :50].any()
    assert sorted(steps[steps > 0]) == list(range(1, 41))


def plain_kept(spark, rows, labels):
    """What ``judge`` keeps, rule by rule and document by document: rows have doc_id, stratum and COUNTS."""
    n_bins = quality.BINS + 1
    divided = lambda a, b: a / max(b, 1)

    def scores(r):
        c = dict(zip(quality.COUNTS, r[2:]))
        return (divided(c["n_symbols"], c["word_chars"]), divided(c["n_dup_lines"], c["n_lines"]), divided(c["n_repeat_words"], c["n_words"]), divided(c["word_chars"], c["n_words"]) / 32, 1 - divided(c["word_chars"], c["n_words"]) / 8, divided(c["n_bare"], c["n_words"]))

    bins = {r[0]: [math.floor(min(max(x, 0.0), 1.0) * quality.BINS) for x in scores(r)] for r in rows}
    failed = {r[0]: r[2] < 50 or 100 * r[6] > 50 * r[2] for r in rows}
    strata = {r[0]: r[1] for r in rows}
    hashed = spark.createDataFrame([(str(i),) for i in bins], "k string").select("k", (F.pmod(F.xxhash64("k", F.lit(5)), F.lit(quality.GUIDE)) == 0).alias("g")).collect()
    guides = {int(r["k"]) for r in hashed if r["g"]}
    level = quality.LEVEL / len(set(strata.values()))
    kept = {}
    for stratum in set(strata.values()):
        own = [i for i in bins if strata[i] == stratum]
        marked = [(i, q) for i, q in labels if i in bins and strata[i] == stratum and not failed[i]]
        guide = [(bins[i], q) for i, q in marked if i in guides or q == 0]
        tested = [(bins[i], q) for i, q in marked if not (i in guides and q == 1)]
        cuts, steps = [n_bins] * 6, []
        while True:
            best, move = (0.0, 0), None
            for rule in range(6):
                options = []
                for cut in range(cuts[rule] - 1, 0, -1):
                    caught = sum(b[rule] >= cut and b[rule] < cuts[rule] for b, q in guide if q == 0)
                    lost = sum(b[rule] >= cut and b[rule] < cuts[rule] for b, q in guide if q == 1)
                    options.append((caught / (lost + 0.5), caught, cut))
                if options:
                    top = max((g, c) for g, c, _ in options)
                    cut = max(cut for g, c, cut in options if c == top[1])
                    if top > best:
                        best, move = top, (rule, cut)
            if move is None:
                break
            for cut in range(cuts[move[0]] - 1, move[1] - 1, -1):
                steps.append((move[0], cut))
            cuts[move[0]] = move[1]
        good, bad = sum(q == 1 for _, q in tested), sum(q == 0 for _, q in tested)
        chosen, value, now = 0, 0.0, [n_bins] * 6
        for k, (rule, cut) in enumerate(steps, 1):
            now[rule] = cut
            gone = [q for b, q in tested if any(b[r] >= now[r] for r in range(6))]
            lost, caught = sum(q == 1 for q in gone), sum(q == 0 for q in gone)
            chance = sum(math.comb(good, i) * quality.RISK**i * (1 - quality.RISK) ** (good - i) for i in range(lost + 1))
            if not good or lost > quality.RISK * good or chance > level:
                break
            if caught / bad - quality.GAIN * lost / good > value:
                chosen, value = k, caught / bad - quality.GAIN * lost / good
        final = [min((cut for r, cut in steps[:chosen] if r == rule), default=n_bins) for rule in range(6)]
        for i in own:
            kept[i] = not failed[i] and all(bins[i][r] < final[r] for r in range(6))
    return kept


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_quality_query_equals_a_plain_version(spark, sf):
    langs = {r["doc_id"]: r["lang"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = sorted({(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()})
    found = queries.queries()["op1_quality"](spark, sf).collect()
    for r in found:
        assert tuple(r[n] for n in quality.COUNTS[:5]) == brute_counts(texts[r["doc_id"]])
    want = plain_kept(spark, [(r["doc_id"], langs[r["doc_id"]], *(r[n] for n in quality.COUNTS)) for r in found], labels)
    assert {r["doc_id"]: r["kept"] for r in found} == want


def test_quality_acts_by_its_method(spark):
    """Where each stratum has labels enough, the method rejects beyond the base rule, as the plain version does."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(2400):
        bad = i % 6 == 0
        words = ["w" + str(rng.randint(0, 9999)) + ("##" if rng.random() < (0.5 if bad else 0.004) else "") for _ in range(60)]
        rows.append((i, " ".join(words), ("de", "en", "es")[i % 3]))
        labels += [(i, 0 if bad else 1)] * (1 + i % 2)
    df, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    with Scratch(spark, "t") as scratch:
        found = quality.judge(df, marks, scratch).collect()
    want = plain_kept(spark, [(r["doc_id"], rows[r["doc_id"]][2], *(r[n] for n in quality.COUNTS)) for r in found], sorted(set(labels)))
    assert {r["doc_id"]: r["kept"] for r in found} == want
    assert sum(not r["kept"] and not r["base_failed"] for r in found) > 300


def plain_pooled(net, data):
    """The mean of the positions' probabilities, one unit and one byte after the other."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    total = [0.0] * len(net.languages)
    for at in range(0, len(data), langid.WINDOW):
        part, runs = data[at : at + langid.WINDOW], []
        for layer, order in ((net.forward, range(len(part))), (net.backward, range(len(part) - 1, -1, -1))):
            u = layer.recurrent.shape[1]
            w, r = layer.inputs.astype(float).tolist(), layer.recurrent.astype(float).tolist()
            state, run = [0.0] * u, [None] * len(part)
            for t in order:
                h = [sum(r[j][k] * state[k] for k in range(u)) for j in range(3 * u)]
                x = [w[j][part[t]] for j in range(3 * u)]
                update, reset = [sigmoid(x[j] + h[j]) for j in range(u)], [sigmoid(x[u + j] + h[u + j]) for j in range(u)]
                new = [math.tanh(x[2 * u + j] + reset[j] * h[2 * u + j]) for j in range(u)]
                state = [update[j] * state[j] + (1 - update[j]) * new[j] for j in range(u)]
                run[t] = state
            runs.append(run)
        for a, b in zip(*runs):
            scores = [sum(o * s for o, s in zip(row, a + b)) + bias[0] for row, bias in zip(net.output.astype(float).tolist(), net.bias.astype(float).tolist())]
            top = max(scores)
            parts = [math.exp(s - top) for s in scores]
            total = [x + p / sum(parts) for x, p in zip(total, parts)]
    return [x / len(data) for x in total]


def test_language_query_equals_a_plain_network(spark, docs):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.fit(df)
    got = {r["doc_id"]: r for r in queries.queries()["op2_language"](spark, SF).collect()}
    short = [(i, t) for i, t, _ in sorted(docs, key=lambda d: len(d[1] or "")) if t and len(t.encode()) < 1500][:40]
    assert len(short) >= 20
    for i, t in short:
        if not any(c.isalpha() for c in t):
            assert got[i]["lang_pred"] == "und"
            continue
        found = plain_pooled(net, t.encode())
        best = max(range(len(found)), key=found.__getitem__)
        assert got[i]["lang_pred"] == net.languages[best] and abs(got[i]["score"] - found[best]) < 1e-3


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="3 languages"):
        langid.fit(spark.createDataFrame([(0, "a", "x"), (2, "b", "y"), (3, "c", "z"), (5, "d", "x"), (6, "e", "y"), (8, "f", "z"), (9, "g", "x"), (11, "h", "y"), (12, "i", "z")], "doc_id long, text string, lang string"))


def test_sharding_query_equals_plain_jumps(spark, docs):
    rows = queries.queries()["op6_sharding"](spark, SF).collect()
    hashes = {r["doc_id"]: r["h"] for r in spark.createDataFrame([(i,) for i, _, _ in docs], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    texts = {i: (t or "").encode() for i, t, _ in docs}
    assert len(rows) == len(texts)
    for r in rows:
        key, data = hashes[r["doc_id"]] % 2**64, texts[r["doc_id"]]
        assert (r["shard"], r["grown_shard"], r["size"], r["text_crc32"], r["law"]) == (brute_jump(key, 40), brute_jump(key, 41), len(data) + 16, zlib.crc32(data), "key")
    for s in range(40):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))


def test_token_query_equals_the_library(spark, docs):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in queries.queries()["op7_token_counts"](spark, SF).collect()}
    for i, t, _ in docs:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len((t or "").encode()), n, n > 1024)
    assert any(r["over_limit"] for r in rows.values()) or max(r["n_tokens"] for r in rows.values()) <= 1024


def test_gradients_of_the_network():
    net = langid.Network.random(["a", "b", "c"], 3, 1)
    for layer in (net.forward, net.backward):
        layer.inputs, layer.recurrent = layer.inputs.astype(np.float64), layer.recurrent.astype(np.float64)
    net.output, net.bias = net.output.astype(np.float64), net.bias.astype(np.float64)
    windows, target = np.random.default_rng(0).integers(97, 100, (5, 4)).astype(np.uint8), np.array([0, 1, 2, 0])
    _, gradients = net.loss_and_gradients(windows, target)
    for p, g in zip(net.parameters(), gradients):
        for at in map(tuple, np.argwhere(np.abs(g) > 0)[:3]):
            old = p[at]
            p[at] = old + 1e-4
            up = net.loss_and_gradients(windows, target)[0]
            p[at] = old - 1e-4
            down = net.loss_and_gradients(windows, target)[0]
            p[at] = old
            assert abs((up - down) / 2e-4 - g[at]) < 1e-5


def test_language_of_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in queries.queries()["op2_language"](spark, SF).collect()}
    held = [(i, lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in docs)
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.9


def test_pooling_is_the_mean_of_positions():
    net = langid.Network.random(["a", "b"], 4, 3)
    texts = ["", "short", "q" * 64, "ab" * 100, "é" * 33]
    data = np.concatenate([np.frombuffer(t.encode(), np.uint8) for t in texts])
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    together = langid.pooled(net, data, offsets)
    for t, row in zip(texts, together):
        alone = langid.pooled(net, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert np.allclose(alone, row, atol=1e-5) and (not t or abs(row.sum() - 1) < 1e-4)
        assert len(langid.label_positions(net, t.encode())) == len(t.encode())


def brute_shingles(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute_components(rows):
    sets = [(i, brute_shingles(t)) for i, t in rows]
    tree = list(range(len(sets)))

    def root(x):
        while tree[x] != x:
            tree[x] = tree[tree[x]]
            x = tree[x]
        return x

    for x, (_, s) in enumerate(sets):
        for y in range(x):
            both = len(s & sets[y][1])
            if both and 100 * both >= 85 * (len(s) + len(sets[y][1]) - both):
                tree[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[root(x)] = min(least.get(root(x), i), i)
    return sorted((i, len(s), least[root(x)]) for x, (i, s) in enumerate(sets))


@pytest.mark.parametrize("block, salt", [(1024, 1 << 16), (8, 1 << 16), (1024, 1), (8, 4)])
def test_near_copies(spark, monkeypatch, block, salt):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard, "SALT_ROWS", salt)
    rng = random.Random(5)
    bases = [[rng.choice("abcdefghij") + str(rng.randint(0, 40)) for _ in range(n)] for n in (40, 60, 12, 9, 7, 100)]
    rows = [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, " \n")]
    for i in range(250):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = ["z" + str(rng.randint(0, 5))] * rng.randint(0, 1) or ["y"]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows)
    with Scratch(spark, "t") as scratch:
        assert sorted(map(tuple, jaccard.near_copies(df, scratch).collect())) == want
    if block > 8:
        with Scratch(spark, "t") as scratch:
            assert sorted(r["doc_id"] for r in jaccard.keep_one_of_each(df, scratch).collect()) == sorted({c for _, _, c in want})


def test_decontamination_forms(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    with Scratch(spark, "t") as scratch:
        want = sorted(map(tuple, decontaminate.contamination(docs, items, scratch).collect()))
        assert sorted(map(tuple, decontaminate.contamination(docs, items, scratch, broadcast_bytes=0).collect())) == want
        dirty = {r[0] for r in want if r[5]}
        assert dirty
        for options in ({}, {"broadcast_bytes": 0}):
            left = decontaminate.decontaminate(docs, items, scratch, **options)
            assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r[0] for r in want} - dirty
        cut = decontaminate.decontaminate(docs, items, scratch, remove="spans")
        assert cut.count() == docs.count() and decontaminate.contamination(cut, items, scratch).agg(F.sum("n_hit")).first()[0] == 0


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_short_items_and_cut_spans(spark, options):
    docs = spark.createDataFrame([(1, "See: Hello, World! Bye."), (2, "hello there world"), (3, None), (1, "again hello world"), (None, "hello world")], "doc_id long, text string")
    items = spark.createDataFrame([(10, "HELLO world"), (9, "?!"), (11, None), (10, "HELLO world"), (None, "bye"), (12, "hello, world")], "item_id long, text string")
    with Scratch(spark, "t") as scratch:
        got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(docs, items, scratch, **options).collect()}
        texts = {(r["doc_id"], r["text"]) for r in decontaminate.decontaminate(docs, items, scratch, remove="spans", **options).collect()}
        left = decontaminate.decontaminate(docs, items, scratch, **options).collect()
    assert got[1, 4]["n_hit"] == 3 and got[1, 4]["n_items"] == 2 and got[1, 4]["items_sha256"] == hashlib.sha256(b"10,12").hexdigest()
    assert got[1, 3]["n_hit"] == got[None, 2]["n_hit"] == 2
    assert not got[2, 3]["contaminated"] and got[3, 0]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (2, "hello there world") in texts and (3, None) in texts and not any("Hello" in (t or "") for _, t in texts) and any(t and t.startswith("See") for _, t in texts)
    assert sorted(str(r["doc_id"]) for r in left) == ["2", "3"]


def test_warc(spark):
    rows = [(None, None, "x" * 200), (1, "u\r\nv", None), (2, "u", ""), (2, "u", "é" * 300), (3, "w", "é" * 300), (3, "w2", "é" * 300), (4, "v", "y" * 99), (5, "v", "y" * 99)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    with Scratch(spark, "t") as scratch:
        got = [tuple(r) for r in warc.read_archives(warc.write_archives(df, scratch, scratch.path("f")), "page_id", "bigint").collect()]
        assert warc.read_archives(warc.write_archives(df.limit(0), scratch, scratch.path("g")), "page_id", "bigint").count() == 0
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(i, len((h or "").encode()), digest(h or ""), "revisit" if i == 3 else "response", 2 if i == 3 else None) for i, _, h in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_warc_with_repeats_and_text_keys(spark):
    rng = random.Random(9)
    pool = ["p" * 99, "p" * 100, "é" * 60, "<p>%20 x</p>" * 20, "long " * 100_000, ""]
    rows = [(rng.choice(["a b%", "ü/1", "k"]) + f" {i}", "http://x/ y", rng.choice(pool), "clash", "clash") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string, payload string, digest string").repartition(7)
    with Scratch(spark, "t") as scratch:
        got = sorted(tuple(r) for r in warc.read_archives(warc.write_archives(df, scratch, scratch.path("f")), "page_id", "string").collect())
    want = []
    for key, _, html, _, _ in rows:
        data, same = html.encode(), sorted(k for k, _, h, _, _ in rows if h == html)
        again = len(data) >= 100 and key != same[0]
        want.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", same[0] if again else None))
    assert got == sorted(want) and sum(w[3] == "revisit" for w in want) > 20


def test_a_shard_column_is_not_overwritten(spark):
    with pytest.raises(ValueError, match="shard"):
        sharding.with_shard(spark.createDataFrame([(1, 2)], "doc_id long, shard int"), "doc_id", 4)


def test_settings_are_the_callers_again(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    before = [spark.conf.get(n) for n in names]
    with Scratch(spark, "t") as scratch:
        scratch.table(spark.range(10).groupBy("id").count(), "x")
        assert [spark.conf.get(n) for n in names] == before


def test_rows_of_one_key_are_judged_by_their_own_text(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (5, " ".join(words[:-1])), (5, "quite another text of its own"), (5, "quite another text of its own"), (7, " ".join(words)), (None, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    with Scratch(spark, "t") as scratch:
        got = sorted((str(r["doc_id"]), r["text"]) for r in jaccard.keep_one_of_each(df, scratch).collect())
    assert got == sorted([("1", rows[0][1]), ("5", rows[2][1]), ("None", rows[5][1])])


def test_archive_round_trip():
    import io

    for records in ([b""], [b"a" * i for i in range(300)], [bytes([i % 251]) * 5000 for i in range(100)]):
        packed = b"".join(warc.write_archive("n", records))
        assert list(warc.read_archive(io.BytesIO(packed)))[1:] == records


def brute_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(spark):
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for n in (1, 2, 40, 41):
        assert sharding.jump_hash(keys, n).tolist() == [brute_jump(int(k), n) for k in keys]
    with Scratch(spark, "t") as scratch:
        df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 > 0, F.lit("é")).alias("text"))
        df = df.union(df.filter("doc_id = 5")).union(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
        rows = sharding.shard_rows(df, scratch, run_rows=10).collect()
    assert len(rows) == 2002 and {r["size"] for r in rows} == {16, 17, 18}
    assert all(r["grown_shard"] in (r["shard"], 40) for r in rows)
    for s in range(40):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert {(r["text_crc32"]) for r in rows} == {0, zlib.crc32("é".encode()), zlib.crc32(b"x")}


ODD_TEXTS = ["", "a" * 5000, " " * 3000, "ab" * 4000, "x<|endoftext|> y<|endoftext|>", "aaaaaaa", "it's we'll\x1c\x85 　٣½ǅ̀"]


def test_token_counts(docs):
    import tokenizers

    rng = random.Random(3)
    texts = [t for _, t, _ in docs] + ODD_TEXTS + ["".join(rng.choice("ab é中̀\U0001f600 \n\t\x1c\x85'sdthe ing") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    path = P.path("byte_bpe_50k.json")
    want = [len(e.ids) for e in tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert token_counts.TokenCounter(path).count(texts) == want


def test_bpe(docs):
    import tiktoken

    rng = random.Random(3)
    texts = [t for _, t, _ in docs] + ODD_TEXTS + ["".join(rng.choice("ab é中̀\U0001f600 \n\t\x1c\x85'sdthe ing") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.TextEncoder(bpe.PrefixEncoder(ranks), P.PATTERN)
    for t in texts:
        ids = coder.encode(t)
        assert ids == library.encode_ordinary(t) and coder.encoder.decode(ids) == t.encode()


def test_bpe_appends_and_edits():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    coder, rng = bpe.PrefixEncoder(ranks), random.Random(4)
    for _ in range(300):
        data = "".join(rng.choice("the ing of and éü123") for _ in range(rng.randint(0, 300))).encode()
        whole, cut = coder.extend(bpe.PrefixTable(), data), rng.randint(0, len(data))
        assert coder.extend(coder.extend(bpe.PrefixTable(), data[:cut]), data[cut:]).last == whole.last
        start = rng.randint(0, len(data))
        stop, new = rng.randint(start, len(data)), bytes(rng.choices(b"the in", k=rng.randint(0, 5)))
        edited = coder.edit(whole, start, stop, new)
        fresh = coder.extend(bpe.PrefixTable(), data[:start] + new + data[stop:])
        assert (edited.data, edited.last) == (fresh.data, fresh.last)


def test_lm_scores(spark, docs):
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t, _ in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for most in (1 << 18, 1500):
        with Scratch(spark, "t") as scratch:
            found.append({r["doc_id"]: r for r in lm.score(df, scratch, broadcast_words=most).collect()})
        for i, own in tokens.items():
            r = found[-1][i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(own), sum(counts[w] > 0 for w in own), n)
            want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
            assert abs(r["base_score"] - want) < 1e-6 * abs(want)
    # with fewer broadcast words all others share a class, whose words are told apart by their counts more than by features
    totals = [sum(r["score"] for r in scored.values()) for scored in found]
    assert abs(totals[0] - totals[1]) < 0.1 * abs(totals[0])
    for scored in found:
        out = [r for r in scored.values() if r["held_out"]]
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def some_vocabulary(rng, n=300):
    words = np.sort(_text.mix(np.arange(n, dtype=np.uint64), 3))
    counts = np.sort(rng.zipf(1.5, n) % 1000 + 1)
    return lm.Vocabulary.build(words, counts, np.array([5.0, 1.0, 9.0, 2.0]), int(counts.sum()) + 13, n + 9)


def test_lm_is_a_distribution():
    rng = np.random.default_rng(0)
    voc = some_vocabulary(rng)
    text = rng.choice(voc.words, 40)
    sums = lm.Gradients(lm.MaxEnt.start(voc))
    sums.add(text, np.array([0, 40]), *voc.find(text)[1:])
    change = lm.update(sums.sums())
    cut = sums.model.by_class.size
    model = lm.MaxEnt(voc, change[:cut].reshape(-1, lm.CLASSES), change[cut:])
    assert np.abs(change).max() > 0.1 and len(set(voc.classes.tolist())) > 5 and voc.depths.max() > 5
    others = np.arange(4, dtype=np.uint64) << np.uint64(62)  # an unknown word of each group of the others
    for i in range(3):
        total = 0.0
        for w in [*voc.words, *others]:
            seq = np.append(text[:i], w)
            counts, classes, paths = voc.find(seq)
            count = counts[i] + 1 if counts[i] >= 0 else voc.groups[paths[i]]  # all words of the group
            total += count * math.exp(model.log_probabilities(seq, np.array([0, i + 1]), classes, paths)[i])
        assert abs(total - 1) < 1e-3


def test_lm_without_weights_is_the_base_score():
    rng = np.random.default_rng(1)
    voc = some_vocabulary(rng)
    counts, classes, paths = voc.find(voc.words)
    got = lm.MaxEnt.start(voc).log_probabilities(voc.words, np.array([0, len(voc.words)]), classes, paths) + np.log(counts + 1.0)
    assert np.allclose(got, np.log((counts + 1) / (counts + 1).sum() * (counts + 1).sum() / ((counts + 1).sum() + 17)), atol=1e-3)


def test_lm_gradients():
    """Against plain sums over tokens, features and classes or splits; and, as numbers, against differences of the likelihood."""
    rng = np.random.default_rng(2)
    voc = some_vocabulary(rng, 80)
    text, first = rng.choice(voc.words, 60), np.array([0, 25, 60])
    start = lm.MaxEnt.start(voc)
    model = lm.MaxEnt(voc, rng.normal(0, 0.3, start.by_class.shape).astype(np.float32), rng.normal(0, 0.3, len(start.by_split)).astype(np.float32))
    _, classes, paths = voc.find(text)
    sums = lm.Gradients(model)
    sums.add(text, first, classes, paths)
    gradient = sums.sums()[0]
    likelihood = lambda m: m.log_probabilities(text, first, classes, paths).sum()
    for at in rng.choice(np.flatnonzero(np.abs(gradient) > 0.05), 25, replace=False):
        found = []
        for step in (0.02, -0.02):
            by_class, by_split = model.by_class.copy(), model.by_split.copy()
            if at < by_class.size:
                by_class.ravel()[at] += step
            else:
                by_split[at - by_class.size] += step
            found.append(likelihood(lm.MaxEnt(voc, by_class, by_split)))
        assert abs((found[0] - found[1]) / 0.04 - gradient[at]) < 2e-2


def test_lm_packing():
    x = np.random.default_rng(3).normal(0, 100, 1000).astype(np.float32)
    assert np.allclose(lm._unpack(lm._pack(x)), x, rtol=1 / 256)


def test_lm_scores_do_not_depend_on_the_layout(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for parts in (1, 7):
        with Scratch(spark, "t") as scratch:
            found.append({r["doc_id"]: r["score"] for r in lm.score(df.repartition(parts), scratch).collect()})
    assert all(abs(found[0][i] - found[1][i]) < 2e-3 * abs(found[0][i]) for i in found[0])


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal\n# in the Software without restriction, including without limitation the rights\n# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n# copies of the Software, and to permit persons to whom the Software is\n# furnished to do so, subject to the following conditions:\n#\n# The above copyright notice and this permission notice shall be included in all\n# copies or substantial portions of the Software."
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, "Licensed under CC BY-NC 4.0."), (3, "# " + mit), (4, "Not released under the MIT License today"), (5, None), (6, "All rights reserved. Licensed under the Apache License, Version 2.0"), (7, "")]
    got = {r["doc_id"]: (r["n_sentences"], r["licences"], r["n_unmatched"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, "MIT", 0), 2: (1, "CC-BY-NC-4.0", 0), 3: (2, "MIT", 0), 4: (0, "", 0), 5: (0, "", 0), 6: (2, "Apache-2.0", 1), 7: (0, "", 0)}


#: Known sentences as licences print them, where cuts at punctuation fall inside.
PRINTED = {
    "this program is free software you can": "This program is free software: you can",
    "merchantability or fitness": "MERCHANTABILITY or FITNESS",
    "without any warranty without even": "WITHOUT ANY WARRANTY; without even",
    "mozilla public license v 2.0": "Mozilla Public License, v. 2.0",
    "spdx-license-identifier ": "SPDX-License-Identifier: ",
    "at https www.eclipse.org legal epl-2.0": "at https://www.eclipse.org/legal/epl-2.0/",
    "at https mozilla.org mpl 2.0": "at https://mozilla.org/MPL/2.0/",
    "all rights reserved this program": "All rights reserved. This program",
}


def printed(sentence):
    for plain, own in PRINTED.items():
        sentence = sentence.replace(plain, own)
    return sentence


def test_every_licence_sentence_is_found_as_printed(spark):
    texts = [(f"x\n{printed(s)}.\ny", n) for s, n in licences.SENTENCES.items()]
    # in the midst of a paragraph, wrapped at each blank, and with the other mark that GPL headers have
    texts += [("Well. " + "\n * ".join(printed(s).split(" ")) + ". Well.", n) for s, n in licences.SENTENCES.items()]
    texts += [(t.replace("software: you", "software; you"), n) for t, n in texts if "software: you" in t]
    found = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").select("doc_id", licences.sentence_ids(F.col("text")).alias("ids"))
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == {i: [n] for i, (_, n) in enumerate(texts)}


def test_licence_headers_with_cuts_inside(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."
    rows = [(1, "// SPDX-License-Identifier: MIT\nint main;"), (2, gpl), (3, "SPDX-License-Identifier:\n\nMIT\n"), (4, "Not so: licensed under CC BY 4.0.")]
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("SPDX-MIT", "MIT"), 2: ("GPL3plus,GPLhope,GPLsee", "GPL-3.0-or-later"), 3: ("", ""), 4: ("CCBY4ref", "CC-BY-4.0")}


def plain_licences(text):
    """(identifiers, licences, sentences that no rule took), piece by piece and rule by rule."""
    def normal(x):
        x = re.sub(r"[^a-z0-9.+\-\x80-\U0010ffff]+", " ", x.lower())
        return " ".join(y for w in x.split(" ") if (y := w.strip(".+-")))

    paragraphs, at = [[]], 0
    for line in re.split("\r?\n", text or ""):
        line = re.sub(r"^[ \t]*(?:#+|//+|/?\*+/?|;+|--)[ \t]*", "", line)
        if line.strip(" ") == "":
            paragraphs.append([])
        elif normal(line) in licences.SENTENCES:
            paragraphs += [[line], []]
        else:
            paragraphs[-1].append(line)
    ids = []
    for lines in paragraphs:
        pieces = [p for x in re.split(r"(?<=[.!?:;])[ \t\r\x0b\f\n]+", " ".join(lines)) if (p := normal(x))]
        at = 0
        while at < len(pieces):
            for end in range(len(pieces), at, -1):
                if (found := licences.SENTENCES.get(" ".join(pieces[at:end]))) is not None:
                    ids.append(found)
                    break
            else:
                end = at + 1
            at = end
    rest, names = list(ids), set()
    for run, name in licences.RULES:
        i = 0
        while i + len(run) <= len(rest):
            if tuple(rest[i : i + len(run)]) == run:
                rest[i : i + len(run)] = [None]
                names.add(name)
            i += 1
    return ids, sorted(names), sum(x is not None for x in rest)


def test_licences_equal_a_plain_matcher(spark):
    rng = random.Random(6)
    known = [printed(s) for s in licences.SENTENCES]
    fillers = ["Some words.", "\n", "\n\n", " ", "// ", "Note: ", "licence;", "and so on", "\r\n", "# "]
    texts = ["".join(rng.choice(known if rng.random() < 0.5 else fillers) + rng.choice([".", ". ", "\n", "; ", ""]) for _ in range(rng.randint(1, 14))) for _ in range(800)]
    mit, apache = [printed(next(s for s, n in licences.SENTENCES.items() if n == x)) for x in ("MITgrant", "MITnotice")], [printed(next(s for s, n in licences.SENTENCES.items() if n == x)) for x in ("Apache2ref", "ApacheMayNot")]
    texts += [f"{apache[0]}.\n{mit[0]}.\n{mit[1]}.\n{apache[1]}.", None, "", "x" * 100_000 + "\nAll rights reserved."]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        ids, names, rest = plain_licences(t)
        r = got[i]
        assert (r["sentence_ids"], r["licences"], r["n_sentences"], r["n_unmatched"]) == (",".join(ids), ",".join(names), len(ids), rest), t


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_licence_query_equals_a_plain_matcher(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"], r["n_unmatched"]) for r in queries.queries()["op9_licences"](spark, sf).collect()}
    found = {i: plain_licences(t) for i, t in rows}
    assert got == {i: (",".join(x), ",".join(y), z) for i, (x, y, z) in found.items()} and sum(z[1] != [] for z in found.values()) > 0


def test_licence_hints_pass_every_sentence(spark):
    assert not any(" " in h for h in licences.HINTS) and all(any(h in s for h in licences.HINTS) for s in licences.SENTENCES)
    rows = [(1, "All\nrights reserved"), (2, "All  rights, reserved."), (3, "All\n# rights\n# reserved"), (4, "rights")]
    got = {r["doc_id"]: r["n_sentences"] for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0}


def test_licence_queries_find_planted_lines(spark, docs):
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    got = {r["doc_id"]: r["licences"] for r in queries.queries()["op9_licences"](spark, SF).collect()}
    assert got == {i: ",".join(sorted({lines[x] for x in t.split("\n") if x in lines})) for i, t, _ in docs}


OPERATORS = {
    "quality": lambda s, d, x: quality.judge(d, s.createDataFrame([(4, 1, 0), (None, None, 1)], "doc_id long, quality int, toxic int"), x),
    "language": lambda s, d, x: langid.identify(d),
    "decontamination": lambda s, d, x: decontaminate.contamination(d, s.createDataFrame([(1, "word"), (2, None), (None, "long long")], "item_id long, text string"), x),
    "near_copies": lambda s, d, x: jaccard.near_copies(d, x),
    "sharding": lambda s, d, x: sharding.shard_rows(d, x),
    "token_counts": lambda s, d, x: token_counts.token_counts(d, P.path("byte_bpe_50k.json")),
    "lm": lambda s, d, x: lm.score(d, x),
    "licences": lambda s, d, x: licences.scan(d),
    "bpe": lambda s, d, x: bpe.token_digests(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_empty_tables(spark, name):
    df = odd(spark)
    with Scratch(spark, "t") as scratch:
        found = OPERATORS[name](spark, df, scratch).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in df.collect())
        twice = [r.asDict() for r in found if r["doc_id"] == 5]
        for r in twice:
            r.pop("slot", None)
        assert twice[0] == twice[1]
        assert OPERATORS[name](spark, df.limit(0), scratch).count() == 0
