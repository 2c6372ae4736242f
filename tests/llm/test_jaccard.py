import random

import numpy as np
import pytest

from folioforge.llm import jaccard as J
from folioforge.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows, shingle=5, percent=80):
    """(doc_id, n_shingles, component_id) by comparing every pair."""

    def grams(text):
        words = (text or "").encode().lower().split()
        return {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()

    sets = [grams(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted([(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))], key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = J.digest(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    want = brute(rows)
    assert found(got) == want and any(r[0] != r[2] for r in want)


@pytest.mark.parametrize("percent", [80, 60])
def test_links_at_the_threshold(spark, percent):
    """Copies with words exchanged, cut and added, of many sizes, so that similarities lie on both sides of the threshold."""
    rnd = random.Random(percent)
    rows = []
    for k in range(90):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([1, 3, 5, 8, 9, 12, 20, 40, 70, 100, 200, 400]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rnd.randrange(4)):
            new = list(words)
            for _ in range(rnd.randrange(1 + len(words) // 25 + 1)):
                i = rnd.randrange(len(new))
                new[i : i + rnd.randrange(2)] = [f"x{rnd.randrange(50)}"] * rnd.randrange(2)
                new = new or ["w"]
            cut = rnd.randrange(1 + len(new) // 8)
            rows.append((len(rows), " ".join(new[cut:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, percent=percent)
    assert found(J.near_duplicates(df, percent=percent)) == want
    assert sum(r[0] != r[2] for r in want) > 20


def test_a_large_group_of_near_copies(spark):
    """Chains and stars of near copies that share most subsets, most not linked to the least one directly."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(150):
        at = rnd.randrange(300)
        words[at] = f"v{k}"
        rows.append((1000 - k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(J.near_duplicates(df)) == brute(rows)


def test_every_allocation_reaches_its_units():
    """By brute force over sets: a pair at the similarity always meets in a subset, probed by its larger set."""
    rnd = np.random.default_rng(1)
    for size in [4, 5, 6, 9, 10, 13, 20, 33, 64, 65, 90, 150, 700]:
        for _ in range(30):
            a = np.unique(rnd.integers(0, 1 << 63, size).astype(np.uint64))
            # As many differences as the similarity allows: some tokens less, some exchanged.
            less = rnd.integers(0, len(a) // 5 + 1)
            b = a[rnd.permutation(len(a))[less:]]
            while True:
                exchanged = np.concatenate([b[1:], rnd.integers(0, 1 << 63, 1).astype(np.uint64)])
                if not J.linked(np.sort(a), np.unique(exchanged), 80):
                    break
                b = exchanged
            b = np.unique(b)
            if len(b) > len(a):
                a, b = b, a
            ka, ra, spare = J.signatures(np.sort(a))
            kb, rb, _ = J.signatures(b)
            probes = {(k, r % 2) for k, r in zip(ka.tolist(), ra.tolist()) if r >= J.PROBES}
            index = set(zip(kb.tolist(), (rb % 2).tolist()))
            met = [k for k, r in probes if (k, 0) in index or (r == 0 and (k, 1) in index)]
            assert np.array_equal(a, b) or len(met) > spare, (size, len(a), len(b), len(met), spare)


def test_messy_and_empty(spark, messy, nothing):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns, an empty table."""
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    assert found(J.near_duplicates(messy)) == brute(rows)
    assert J.near_duplicates(nothing).count() == 0


def test_subsets_of_the_same_sets_are_compared_once(spark):
    rows = [(k, n, 9, r, n, s) for k in range(50) for n, r, s in ((1, 2, True), (2, 0, False), (2, 1, False))]
    rows += [(60, 1, 9, 2, 1, True), (60, 2, 9, 0, 2, False), (61, 1, 9, 2, 1, False), (61, 2, 9, 2, 2, True)]
    table = spark.createDataFrame(rows, "key long, node long, size int, role byte, root long, seeks boolean")
    assert {r["key"] for r in J._once(table).collect()} == {0, 60, 61}


def test_sketches_of_large_sets_tell_them_apart():
    """Sets that share two thirds of their tokens aren't near, whatever their sizes; those at the threshold are."""
    near = J._near(80)
    for n in (300, 2600, 12_000):
        tokens = J._mix(np.arange(2 * n, dtype=np.uint64), 3)
        a, apart, alike = tokens[:n], tokens[n // 3 : n + n // 3], tokens[n // 9 : n + n // 9 - 1]
        a, apart, alike = (J.pa.py_buffer(J.sketched(x).tobytes()) for x in (a, apart, alike))
        assert near(a, alike) and near(alike, a) and not near(a, apart)


def test_a_set_hashes_every_word_once(monkeypatch):
    """Shingles take their hash from their words', and are the same ones wherever they stand; order and number of words count."""
    rnd, read = random.Random(41), []
    plain = J.xxhash.xxh64_intdigest
    monkeypatch.setattr(J.xxhash, "xxh64_intdigest", lambda x, seed=0: (read.append(0 if seed else len(x)), plain(x, seed))[1])
    text = " ".join(rnd.choice("abcd") * rnd.randrange(1, 3) for _ in range(3000)).encode()
    words = text.split()
    grams = [b" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    tokens = J.token_set(text)
    assert sum(read) <= len(text) and len(tokens) == len(set(grams)) > 2000 and (np.diff(tokens.astype(object)) > 0).all()
    of = {g: int(J.token_set(g)[0]) for g in set(grams)}
    assert len(set(of.values())) == len(of) and set(of.values()) == set(tokens.tolist())
    assert J.token_set(b"\tA b\x0bC\n").tolist() == J.token_set(b"a B c").tolist() != J.token_set(b"a c b").tolist()
    assert [len(J.token_set(x)) for x in (b"", b" \n", b"a", b"a a a a a a a", b"a b a b a b a b")] == [0, 0, 1, 1, 2]
