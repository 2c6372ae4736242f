import random

import numpy as np

import corpus_pipeline
from folioforge.llm import similar


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute_force(docs):
    """Least ids of the groups that pairs of Jaccard similarity 0.8 or more join."""
    parent, of = {i: i for i, _ in docs}, {i: sets(t) for i, t in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in parent:
        for j in parent:
            if j < i and len(of[i] & of[j]) / len(of[i] | of[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {find(i) for i in parent}


def near_copies():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    docs = []
    for _ in range(40):
        base = [word() for _ in range(rnd.randint(50, 200))]
        for _ in range(rnd.randint(1, 5)):
            copy = list(base)
            for _ in range(rnd.randint(0, len(base) // 30)):
                copy[rnd.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
    docs += ["", None, "one two", "One  two", "one two three"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def test_stage_equals_brute_force(spark):
    docs = near_copies()
    want = brute_force(docs)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, rows, "").collect()} == want
    for options in ({"block": 2}, {"leaf": 20}, {"leaf": 4, "block": 3}):
        assert {r["doc_id"] for r in similar.one_of_each(rows, **options).collect()} == want, options


def test_trees_catch_pairs_at_the_similarity():
    """Pairs of sets at 0.8 differ in few enough bits and share a leaf, for small and large numbers of texts."""
    rnd = np.random.default_rng(8)
    pairs = []
    for _ in range(1_000):
        both = rnd.integers(0, 1 << 64, 200, np.uint64)
        a, b = (np.concatenate([both, rnd.integers(0, 1 << 64, 25, np.uint64)]) for _ in range(2))
        assert similar.alike(np.unique(a), np.unique(b), 0.8)
        pairs.append((similar.fingerprint(a), similar.fingerprint(b)))
    one, two = (np.array(x, np.uint64) for x in zip(*pairs))
    assert (np.bitwise_count(one ^ two).sum(axis=1) <= similar.MAX_BITS).mean() >= 0.99
    for n in (1_000, 200_000, 10_000_000):
        trees = similar.forest(n)
        found = (similar.leaves(one, trees) == similar.leaves(two, trees)).any(axis=1).mean()
        assert found >= 0.97, (n, len(trees), found)


def test_messy(messy, nothing):
    kept = similar.one_of_each(messy)
    assert kept.columns == messy.columns and kept.count() == 5
    assert similar.one_of_each(nothing).count() == 0
