"""SimHash near-dedup: exact pairs of fingerprints within a Hamming radius, found with a forest of vantage-point trees.

The 64 bits are dealt into g groups. A pair within r bits agrees in all bits of g - r groups at least, so there is one
tree for every choice of so many groups, and g is the least for which the leaves of so many fingerprints stay small: 5
trees of 12 bits, 15 of 21 or 35 of 27 for r = 4. A tree has fixed vantage points in the Hamming distance over its own
bits, one for each level, and a child for either side of the middle distance. A fingerprint is stored in the leaf that its
distances lead to and searches every leaf that the triangle bound |d(x, p) - d(y, p)| <= d(x, y) leaves open: its own
where a pair must agree in the tree's bits, and with fewer groups than r + 1, where it may differ in r // g of them, both
children near a boundary. Leaves are the shards. Inside one the tree is carried on in the distance over all 64 bits:
fingerprints are sorted by their distance to a vantage point, and one is compared only with those within r of its own.

Equal fingerprints are one node. A leaf returns stars, not pairs: a search takes the fingerprints that it reaches out of
the leaf's remaining ones, so a large group of near copies costs one row each.

Near-dedup of texts by the similarity of their shingles is in `similar`, over leaves of the same kind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table
from folioforge.llm.components import components

MAX_BITS = 4
SHINGLE = 4
#: Fingerprints that a leaf shall hold about, and most; a fuller leaf is searched by pairs of its blocks.
LEAF, LEAF_MOST = 1_000, 8_000
SEED = 42


def fingerprint_of(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles, as an unsigned number; 0 without words. Ties give 0 bits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: len(words) - shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int32) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of a text as a signed long of the same bits; null counts as empty."""

    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.array([fingerprint_of(t.as_py() or b"", shingle) for t in texts.cast(pa.binary())], np.uint64).view(np.int64), pa.int64())

    digest.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(digest, "long")(text.cast("string"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(n: int, max_bits: int = MAX_BITS, groups: int | None = None, leaf: int = LEAF) -> tuple[list[list[int]], int]:
    """The bits of each tree for n fingerprints, and the radius of a search in a tree."""
    if groups is not None and groups <= max_bits:
        return [[b for b in range(64) if b % groups == i] for i in range(groups)], max_bits // groups
    g = groups or max_bits + 1
    while groups is None and g < max_bits + 3 and n > leaf << (64 * (g - max_bits) // g):
        g += 1
    return [[b for b in range(64) if b % g in some] for some in combinations(range(g), g - max_bits)], 0


def _leaves(fp: Column, tree: int, bits: list[int], levels: int, radius: int) -> Column:
    """The leaves of one tree that a search within radius visits, as an array of codes; the first is its own."""
    mask, middle = sum(1 << b for b in bits), (len(bits) - 1) // 2
    out = F.array(F.lit(0))
    for level in range(min(levels, len(bits))):
        point = int.from_bytes(xxhash.xxh64_digest(f"vantage {tree} {level}", 0), "big") & mask
        d = F.bit_count(fp.bitwiseXOR(F.lit(_signed(point))).bitwiseAND(F.lit(_signed(mask))))
        if not radius:
            code = F.when(d > middle, F.lit(1 << level)).otherwise(F.lit(0))
            out = code if not level else out + code
            continue
        own_side = F.when(d > middle, F.lit(1 << level)).otherwise(F.lit(0))
        other = F.when((d > middle) & (d - radius <= middle), F.lit(0)).when((d <= middle) & (d + radius > middle), F.lit(1 << level))
        sides = F.filter(F.array(own_side, other), lambda s: s.isNotNull())
        out = F.flatten(F.transform(sides, _added_to(out)))
    return out if radius or not levels else F.array(out)


def _added_to(codes: Column):
    return lambda side: F.transform(codes, lambda code: code + side)


def _in_tree(tree: int):
    return lambda leaf: F.struct(F.lit(tree).alias("tree"), leaf.alias("leaf"))


def links(fingerprints: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, groups: int | None = None, leaf: int = LEAF, leaf_most: int = LEAF_MOST) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that join the same pairs as all links at max_bits or fewer bits do.

    Every edge is a chain of links inside one leaf and every link lies in some leaf, so both have the same components.
    """
    nodes = fingerprints.select(F.col(fp).alias("fp"))
    n = nodes.count()
    trees, radius = forest(n, max_bits, groups, leaf)
    levels = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    codes = F.array(*[F.transform(_leaves(F.col("fp"), i, bits, levels, radius), _in_tree(i)) for i, bits in enumerate(trees)])
    members = nodes.select("fp", F.inline(F.flatten(codes))).select("tree", "leaf", F.col("fp").alias("id"), "fp")
    return leaf_stars(members, ["fp"], max_bits, leaf_most).select("u", "v").distinct()


def leaf_stars(members: DataFrame, words: list[str], max_bits: int, leaf_most: int = LEAF_MOST) -> DataFrame:
    """(tree, leaf, a, b, u, v): stars over the ids of rows (tree, leaf, id, *words) that links inside their leaf join.

    An overfull leaf is searched by pairs (a, b) of its blocks. There are as many leaves as fingerprints / LEAF in each
    tree, and fewer full ones than rows / leaf_most, so that adaptive execution chooses how these come back.
    """
    full = members.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > leaf_most).select("tree", "leaf", F.ceil(F.col("n") / leaf_most).cast("int").alias("blocks"))
    members = members.join(full, ["tree", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = members.withColumn("block", block).withColumn("other", other).select("tree", "leaf", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "id", *words)
    return members.groupBy("tree", "leaf", "a", "b").applyInPandas(_leaf_search(words, max_bits), "tree int, leaf int, a int, b int, u long, v long")


def _leaf_search(words: list[str], max_bits: int):
    def search(key: tuple, leaf: pd.DataFrame) -> pd.DataFrame:
        ids, first = np.unique(leaf["id"].to_numpy(), return_index=True)
        fps = np.stack([leaf[w].to_numpy().view(np.uint64)[first] for w in words], axis=1)
        u, v = stars(fps, max_bits)
        return pd.DataFrame({**dict(zip(("tree", "leaf", "a", "b"), key)), "u": ids[u], "v": ids[v]})

    return search


def _distance(fps: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps ^ x).sum(axis=-1, dtype=np.int32)


def stars(fps: np.ndarray, max_bits: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Edges from one fingerprint of each group that links join to all others of the group, as indices of fps (n, words)."""
    none = np.empty(0, np.int64)
    if len(fps) < 2:
        return none, none
    far = _distance(fps, fps[0])
    order = np.argsort(far, kind="stable")
    fps, far = fps[order], far[order]
    linked = np.zeros(len(fps), bool)
    for i in range(0, len(fps), rows):  # by the triangle bound nothing else can be within reach
        some = fps[i : i + rows]
        low, high = np.searchsorted(far, far[i] - max_bits), np.searchsorted(far, far[i + len(some) - 1] + max_bits, "right")
        near = sum(np.bitwise_count(some[:, None, w] ^ fps[None, low:high, w]).astype(np.int16) for w in range(fps.shape[1])) <= max_bits
        linked[i : i + rows] = near.sum(axis=1) > 1
    left, roots, reached = np.flatnonzero(linked), [none], [none]
    while len(left):
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = _distance(fps[left], fps[x]) <= max_bits
            if near.any():
                new, left = left[near], left[~near]
                roots.append(np.full(len(new), root))
                reached.append(new)
                frontier += new.tolist()
    return order[np.concatenate(roots)], order[np.concatenate(reached)]


def rooted(fingerprints: DataFrame, max_bits: int = MAX_BITS, groups: int | None = None, **leaves: int) -> DataFrame:
    """(fp, least, root) for every distinct fingerprint of rows (doc_id, fp): its least id, and one fingerprint that stands for its component."""
    distinct = fingerprints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(distinct, "fp", max_bits, groups, **leaves))
    return distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", F.col("fp")).alias("root"))


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS, shingle: int = SHINGLE, groups: int | None = None, **leaves: int) -> DataFrame:
    """(doc_id, fp, component_id), one row for each document.

    fp: the fingerprint as a signed long; component_id: the least doc_id that links reach, its own included. A null or
    empty text and one of white space have fingerprint 0 and link like any other. Null ids are never the least; a
    component of null ids only has a null component_id. Rows of one id are documents of their own. An empty table gives
    no rows; other columns are not returned.
    """
    rows = materialize(documents.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    nodes = rooted(rows, max_bits, groups, **leaves)
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = nodes.join(least, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS, shingle: int = SHINGLE, groups: int | None = None, **leaves: int) -> DataFrame:
    """One document of each component, with the columns of `documents`.

    It is the one with the least doc_id, null ids last; of rows that share this id the one with the least hash of its
    text, and of equal rows any one.
    """
    row = documents.withColumns({own("mark"): F.xxhash64(F.lit(1), text), own("unknown"): F.col(doc_id).isNull()})
    rows = materialize(row.select(F.col(own("unknown")).alias("unknown"), F.col(doc_id).alias("doc_id"), F.col(own("mark")).alias("mark"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    best = rows.groupBy("fp").agg(F.min(F.struct("unknown", "doc_id", "mark")).alias("best"))
    nodes = rooted(rows, max_bits, groups, **leaves)
    kept = nodes.join(best, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias(own("id")), F.col("best.mark").alias(own("kept")))
    found = row.join(kept, (F.col(own("mark")) == F.col(own("kept"))) & F.col(doc_id).eqNullSafe(F.col(own("id"))))
    return found.dropDuplicates([own("kept"), own("id")]).select(*documents.columns)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8_simhash: all of `documents`."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
