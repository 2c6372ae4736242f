import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import simhash
from folioforge.llm.components import components


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@given(st.text(alphabet="ab cABÉé\n\x0b\x1c\u2003", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text.encode()) == fingerprint(text)


def test_components_equal_brute_force(spark):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(60)]
    fps = []
    for _ in range(500):
        f = rnd.choice(centres)
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 8])):
            f ^= 1 << rnd.randrange(64)
        fps.append(f)
    want = roots(fps)
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    for options in ({}, {"leaf": 1}, {"groups": 6, "leaf": 20}, {"groups": 7, "leaf": 20}, {"groups": 2, "leaf": 20}, {"groups": 1, "leaf": 30}, {"groups": 3, "leaf": 10, "leaf_most": 15}):
        nodes = simhash.rooted(rows, **options)
        got = {}
        for r in rows.join(nodes, "fp").select("doc_id", "root").collect():
            got.setdefault(r["root"], set()).add(r["doc_id"])
        groups = {}
        for i, r in enumerate(want):
            groups.setdefault(r, set()).add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_trees_grow_with_the_number_of_fingerprints():
    for n, trees, bits in ((10**5, 5, 12), (10**7, 15, 20), (10**10, 35, 27)):
        found, radius = simhash.forest(n)
        assert (len(found), radius) == (trees, 0) and min(map(len, found)) >= bits
    assert simhash.forest(10**5, groups=3) == ([[b for b in range(64) if b % 3 == i] for i in range(3)], 1)


def test_stars_join_what_links_join():
    rnd = random.Random(7)
    fps = sorted({rnd.getrandbits(10) << 3 for _ in range(120)})
    u, v = simhash.stars(np.array(fps, np.uint64).reshape(-1, 1), 1, rows=16)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(u.tolist(), v.tolist()):
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = roots(fps, 1)
    assert len({(find(i), want[i]) for i in range(len(fps))}) == len({find(i) for i in range(len(fps))}) == len(set(want))


def test_component_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(50, 50), (60, 61), (None, 3)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {60: 60, 61: 60}
    assert components(edges.limit(0)).count() == 0


def test_messy(messy, nothing):
    out = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(messy).collect()}
    assert simhash.near_duplicates(messy).count() == messy.count()
    assert {(1, 1), (2, 2), (3, 2), (4, 2), (None, 1), (None, 2), (5, 5), (6, 5)} <= out
    kept = simhash.one_of_each(messy)
    # Id 1 also names a text of its own, so there are five components under four ids.
    assert kept.columns == messy.columns and kept.count() == 5
    assert simhash.one_of_each(nothing).count() == 0
