"""The pipeline on a small table, each stage against a brute-force version of its decision."""

import hashlib
import random
import re

import corpus_pipeline as p
import public_tokenizers as P
import pyarrow as pa
import tiktoken

from strataflow.llm import _text, bpe, langid, quality
from tests.llm.fixtures import odd
from tests.llm.test_operators import LOWER, brute_counts, brute_shingles, plain_kept

SF = "/root/testdata/sf0.001"


ITEM_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def brute_contaminated(text, items):
    words = ITEM_WORD.findall((text or "").translate(LOWER))
    runs = {}
    for item in items:
        w = ITEM_WORD.findall((item or "").translate(LOWER))
        n = min(10, len(w))
        if n:
            runs.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return any(tuple(words[i : i + n]) in found for n, found in runs.items() for i in range(len(words) - n + 1))


def brute_firsts(before):
    """The least id of each component by runs of five words and 80 percent; documents without words each."""
    sets = {i: brute_shingles(t, 5) for i, t in before.items()}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return {least[i] for i in sets}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in p.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"] for r in docs.collect()}
        seen[name] = (before, after)
        assert after <= set(before)
        if name != "byte_bpe":
            assert docs.columns == columns
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    before, after = seen["language_id"]
    scores = {r["doc_id"]: r for r in langid.identify(whole).collect()}
    assert after == {i for i, t in before.items() if any(c.isalpha() for c in t or "") and scores[i]["score"] >= langid.LEAST_SCORE}
    before, after = seen["quality_rules"]
    counts = {i: quality.count_block(*next((d, o) for _, d, o in _text.text_blocks(pa.array([t]))))[0].tolist() for i, t in before.items()}
    langs = {r["doc_id"]: r["lang"] or "" for r in whole.collect()}
    labels = sorted({(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()})
    kept = plain_kept(spark, [(i, langs[i], *c) for i, c in counts.items()], labels)
    assert after == {i for i, k in kept.items() if k} and all(tuple(counts[i][:5]) == brute_counts(before[i]) for i in before)
    before, after = seen["near_copies"]
    assert after == set(brute_firsts(before))
    before, after = seen["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert after == {i for i, t in before.items() if not brute_contaminated(t, items)} and len(after) < len(before)
    before, _ = seen["byte_bpe"]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in docs.collect():
        ids = library.encode_ordinary(before[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest()
    whole = {r["doc_id"] for r in p.run(spark, SF).collect()}
    assert whole == seen["byte_bpe"][1]


def test_stages_stand_odd_and_empty_tables(spark):
    for df in (odd(spark), odd(spark).limit(0)):
        for _, stage in p.STAGES:
            found = stage(spark, df, SF)
            assert found.count() <= df.count()


def test_near_copies_take_five_words_and_80_percent(spark):
    rng, rows = random.Random(4), []
    for i in range(20):
        words = [f"w{rng.randint(0, 99999)}" for _ in range(100)]
        rows.append((2 * i, " ".join(words)))
        for j in range(i % 4 + 1):
            words[20 * (j + 1)] = f"v{rng.randint(0, 99999)}"
        rows.append((2 * i + 1, " ".join(words)))
    want = set()
    for a, text in rows:
        one = brute_shingles(text, 5)
        if not any(100 * len(one & two) >= 80 * len(one | two) for two in (brute_shingles(t, 5) for b, t in rows if b < a)):
            want.add(a)
    got = {r["doc_id"] for r in p.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    assert got == want and len(want) == 30
