"""SimHash near-dedup of texts by the similarity of their word shingles.

Every distinct text becomes the set of its word shingles, as hashes of 64 bits, and a SimHash of 128 bits of this set. Two
sets of Jaccard similarity s differ in any bit with probability arccos(2 s / (1 + s)) / pi: 0.151 at 0.8, so in 19 bits,
and with MAX_BITS = 36 four deviations are allowed for (two other texts differ in 64). That radius is too wide for trees
that find every pair: their triangle bounds would prune nothing. So a tree's levels measure one of `levels` bits each,
and there are as many trees of bits chosen at random as leave a pair at the similarity apart in all of them with
probability MISSED. A leaf holds about LEAF texts whatever their number; the trees grow with it, by a quarter of its
power. Of pairs at just 0.8 the trees catch 0.99 among 2 * 10^5 texts, and 0.98 among 10^7; more of those above.

Inside a leaf, stars of fingerprints within the radius are groups of candidates. There the sets themselves are compared,
so no pair below the similarity is linked; a search takes what it reaches out of the group's remaining sets, so a large
group of near copies costs one edge each. Groups with the same members are one. A group of more than BLOCK texts is
searched by pairs of its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own
from folioforge.llm.components import components
from folioforge.llm.simhash import leaf_stars

SHINGLE, SIMILAR = 5, 0.8
#: Bits of a fingerprint, and the most in which a candidate pair differs.
BITS, MAX_BITS = 128, 36
#: The probability with which the trees lose a pair at the similarity, and the texts that a leaf shall hold about.
MISSED, LEAF = 0.003, 500
#: Texts of a group that one search holds twice at most.
BLOCK = 500


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; a text of fewer words is one shingle, also one without words."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], np.uint64))


def fingerprint(some: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """SimHash of a set of hashes: two words of 64 bits, the second from the hashes mixed once more."""
    n, half = np.zeros(BITS, np.int64), len(some) / 2
    for i in range(0, len(some), block):
        h = some[i : i + block]
        again = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        both = np.stack([h, again ^ (again >> np.uint64(32))], axis=1)
        n += np.unpackbits(both.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(n > half, bitorder="little").view("<u8")


def forest(n: int, similar: float = SIMILAR, leaf: int = LEAF) -> list[list[int]]:
    """The bits of each tree for n texts."""
    levels = max(1, math.ceil(math.log2(max(2, n / leaf))))
    differ = math.acos(2 * similar / (1 + similar)) / math.pi
    agree = (1 - differ - math.sqrt(differ * (1 - differ) / BITS) / 2) ** levels  # half a deviation for pairs that differ in more
    trees = math.ceil(math.log(MISSED) / math.log(1 - agree)) if agree < 1 else 1
    rnd = np.random.default_rng(42)
    return [rnd.choice(BITS, levels, replace=False).tolist() for _ in range(trees)]


def _fingerprints(text: Column, shingle: int) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            fps = [fingerprint(shingles(t.as_py() or b"", shingle)) for t in texts.cast(pa.binary())]
            pair = np.array(fps, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.StructArray.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["f0", "f1"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "f0 long, f1 long")(text)


def leaves(fps: np.ndarray, trees: list[list[int]]) -> np.ndarray:
    """For fingerprints (n, 2): the code of the leaf in each tree, (n, trees)."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little").astype(np.int32)
    return np.stack([bits[:, some] @ (1 << np.arange(len(some), dtype=np.int32)) for some in trees], axis=1)


def _leaves(f0: Column, f1: Column, trees: list[list[int]]) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            codes = leaves(np.stack([a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)], axis=1), trees)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * len(trees), pa.int32()), pa.array(codes.astype(np.int32).ravel()))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<int>")(f0, f1)


def _set(text: Column, shingle: int) -> Column:
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shingles(t.as_py() or b"", shingle).tobytes() for t in texts.cast(pa.binary())], pa.binary())

    sets.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(sets, "binary")(text)


def alike(a: np.ndarray, b: np.ndarray, similar: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is `similar` or more."""
    if min(len(a), len(b)) / max(len(a), len(b)) < similar:
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both) >= similar


def edges_of(left: list[tuple[int, np.ndarray]], similar: float) -> list[tuple[int, int]]:
    """Edges that join the same sets as all links among these sets do."""
    edges = []
    while left:
        frontier, left = left[-1:], left[:-1]
        while frontier and left:
            node, some = frontier.pop()
            near = [alike(some, other, similar) for _, other in left]
            reached = [x for x, yes in zip(left, near) if yes]
            left = [x for x, yes in zip(left, near) if not yes]
            edges += [(node, other) for other, _ in reached]
            frontier += reached
    return edges


_EDGES = pa.list_(pa.struct([("u", pa.int64()), ("v", pa.int64())]))


def _searched(members: Column, similar: float) -> Column:
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for buckets in batches:
            out = []
            for bucket in buckets:
                found = edges_of([(x["node"].as_py(), np.frombuffer(x["set"].as_py(), np.uint64)) for x in bucket], similar)
                out.append([{"u": u, "v": v} for u, v in found])
            yield pa.array(out, _EDGES)

    search.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(search, "array<struct<u:long,v:long>>")(members)


def links(nodes: DataFrame, texts: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that join the same nodes as all links do. nodes: (node, h1, h2, f0, f1); texts: rows (h1, h2, text)."""
    trees = forest(nodes.count(), similar, leaf)
    members = nodes.select(F.col("node").alias("id"), "f0", "f1", F.posexplode(_leaves(F.col("f0"), F.col("f1"), trees)).alias("tree", "leaf"))
    found = leaf_stars(members, ["f0", "f1"], MAX_BITS)
    group = ["tree", "leaf", "a", "b", "u"]
    grouped = materialize(found.select(*group, F.explode(F.array("u", "v")).alias("node")).distinct(), "candidates")
    mark = [F.sum(F.pmod(F.xxhash64("node", F.lit(i)), F.lit(2147483647))).alias(f"m{i}") for i in range(2)]
    groups = grouped.groupBy(*group).agg(F.count("*").alias("n"), *mark)
    groups = groups.groupBy("n", "m0", "m1").agg(F.min(F.struct(*group)).alias("g")).select("g.*", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    held = materialize(grouped.join(groups, group), "groups")
    needed = nodes.join(held.select("node").distinct(), "node", "left_semi").select("node", "h1", "h2")
    sets = materialize(texts.join(needed, ["h1", "h2"]).dropDuplicates(["node"]).select("node", _set(F.col("text"), shingle).alias("set")), "sets")
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.select(*group, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node")
    searched = held.join(sets, "node").groupBy(*group, "x", "y").agg(F.collect_list(F.struct("node", "set")).alias("members"))
    return searched.select(F.explode(_searched(F.col("members"), similar)).alias("e")).select("e.u", "e.v").distinct()


def one_of_each(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, similar: float = SIMILAR, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """One document of each group that texts of this similarity or more link, with the columns of `documents`.

    It is the one with the least doc_id, null ids last; of rows that share this id the one with the least hash of its
    text, and of equal rows any one. Words are runs of bytes without white space, A-Z in lower case; texts without words,
    null ones included, are alike. An empty table gives no rows.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    row = documents.withColumns({own("h1"): F.xxhash64(t), own("h2"): F.xxhash64(F.lit(1), t), own("unknown"): F.col(doc_id).isNull()})
    texts = row.select(F.col(own("unknown")).alias("unknown"), F.col(doc_id).alias("doc_id"), F.col(own("h1")).alias("h1"), F.col(own("h2")).alias("h2"), t.alias("text"))
    prints = texts.select("unknown", "doc_id", "h1", "h2", _fingerprints(F.col("text"), shingle).alias("f"))
    best = prints.groupBy("h1", "h2").agg(F.min(F.struct("unknown", "doc_id", "h1", "h2")).alias("best"), F.first("f.f0").alias("f0"), F.first("f.f1").alias("f1"))
    # Numbers are unique, and fixed once they are written.
    nodes = materialize(best.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "best", "f0", "f1"), "nodes")
    found = components(links(nodes, texts.select("h1", "h2", "text"), shingle, similar, block, leaf)).withColumnRenamed("node", "of")
    rooted = nodes.join(found, nodes["node"] == found["of"], "left").select("best", F.coalesce("root", "node").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias(own("id")), F.col("best.h1").alias(own("k1")), F.col("best.h2").alias(own("k2")))
    out = row.join(kept, (F.col(own("h1")) == F.col(own("k1"))) & (F.col(own("h2")) == F.col(own("k2"))) & F.col(doc_id).eqNullSafe(F.col(own("id"))))
    return out.dropDuplicates([own("k1"), own("k2")]).select(*documents.columns)
