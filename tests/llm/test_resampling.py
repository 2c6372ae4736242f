import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from folioforge.llm import resampling
from folioforge.llm.common import table

SF = "/root/testdata/sf0.001"


def grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_force(documents, target, buckets=10_000, percent=5, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in documents:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    rows = []
    for i, text in documents:
        n, features = grams(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in features)
        rows.append((i, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranks = Counter()
    out = [(*able[k], k + 1) for k in range(drawn)] + [(*r, None) for r in able[drawn:]] + [(*r, None) for r in rows if r[1] < least]
    return sorted(out, key=str), ranks


def test_query_equals_brute_force(spark):
    documents = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").select("text").collect()]
    want = [(i, n, w, s, k) for i, _, n, w, s, k in brute_force(documents, target)[0]]
    got = resampling.digest(spark, SF)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(r[4] == 1 for r in want)


@pytest.mark.parametrize("block, slice_bytes", [(1, 1 << 20), (2000, 700), (1 << 20, 5000)])
def test_blocks_and_slices_change_nothing(spark, block, slice_bytes):
    """Blocks of one text, many small ones, and one block dealt out over many slices."""
    texts = ["the cat sat on the mat " * k + f"w{k} é{k % 3}x A{k}b" for k in range(60)]
    documents = list(enumerate(texts))
    df = spark.createDataFrame(documents, "doc_id long, text string")
    target = ["the mat sat w3", None, "a b c d"]
    got = resampling.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), block=block, slice_bytes=slice_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(documents, target)[0]


def test_dictionary_counts_every_string(spark):
    texts = ["B b  b-b\x00c", "ÀB c1 c1", None, "", "b b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = resampling.features(resampling.packed(df, 3, block=12))
    want = Counter(f for t in texts for f in grams(t)[1])
    assert {(r.feature, r.n, r.bucket) for r in got.collect()} == {(f, n, zlib.crc32(f.encode()) % 10_000) for f, n in want.items()}


def test_messy_and_empty(spark, messy, nothing):
    """Nulls, repeated rows and ids, very long texts, clashing columns; empty tables on either side."""
    target = spark.createDataFrame([("the cat sat",)], "text string")
    documents = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    for side in (target, target.limit(0)):
        theirs = [r.text for r in side.collect()]
        got = sorted(map(tuple, resampling.resampled(messy, side, percent=50).collect()), key=str)
        want = brute_force(documents, theirs, percent=50)[0]
        assert [r[:5] for r in got] == [r[:5] for r in want] and Counter(r[5] for r in got) == Counter(r[5] for r in want)
    assert resampling.resampled(nothing, target).count() == 0


def test_exchange_is_read_twice_not_made_twice(spark):
    """The gains' subquery and the weights share one exchange of packed features."""
    df = spark.createDataFrame([(i, f"a b c {i}") for i in range(20)], "doc_id long, text string")
    out = resampling.weights(df, df.select("text"))
    assert len(out.collect()) == 20
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_counted_by_their_triples_and_the_ends_of_texts():
    """A pair's postings aren't written: words and triples have theirs, and each text the pair that it ends with."""
    texts = [b"a b a b a", b"a b", b"c", b"", b"b a b c"]
    rows, _ = resampling.packed_block(texts, 3)
    entries, weighed = {}, [0] * len(texts)
    for row in rows:
        assert len(resampling._unpack(row["holders"])) == len(resampling.unpacked_features(row)) - len(resampling._unpack(row["thirds_of"]))
        some = resampling._Slice(7)
        some.add(row | {"block": 0})
        strings, _, feature = some.dictionary()
        entries |= dict(zip(strings.take(feature).to_pylist(), some.counts().tolist()))
        worth = [1000 ** len(x.split()) for x in strings.take(feature).to_pylist()]
        for _, held, each in some.worth(resampling.np.array(worth)):
            for t, x in zip(held.tolist(), each.tolist()):
                weighed[t] += x
    grams = [[tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)] for w in (t.split() for t in texts)]
    every = [b" ".join(g) for some in grams for g in some]
    assert entries == {g: every.count(g) for g in every}
    assert weighed == [sum(1000 ** len(g) for g in some) for some in grams]


def test_runs_take_their_hash_from_their_words(monkeypatch):
    """Only distinct words are gone through byte by byte, whatever their length, and every run has its string's CRC."""
    rnd = random.Random(23)
    vocabulary = ["a", "b7", "été", "x" * 63, "y" * 64, "z" * 131, "w" * 9000]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(60)).encode() for _ in range(20)]
    some = resampling._Slice(10_000)
    for block in range(2):
        for row in resampling.packed_block(texts[block * 10 :][:10], 1)[0]:
            some.add(row | {"block": block})
    hashed, plain = [], resampling._hashes
    monkeypatch.setattr(resampling, "_hashes", lambda strings: hashed.append(len(strings)) or plain(strings))
    strings, bucket, feature = some.dictionary()
    assert bucket.tolist() == [zlib.crc32(s.as_py()) % 10_000 for s in strings]
    assert (bucket[feature] == some.entry_buckets()).all() and max(hashed) == len(vocabulary) < len(strings)
