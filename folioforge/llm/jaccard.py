"""N-gram Jaccard join by universe partitions.

A document is the set of its distinct five-word shingles. Sets fall into size bands of ratio 1 / similarity, so that a pair's
larger set is in a band and the smaller one in the same or the one before. A band's scheme deals tokens by their hash into
segments. A pair at the similarity differs in at most H tokens, so if a set gives its segments a total of H + 1 units, one of
them differs in less than its units: a segment with one unit is then equal, one with two differs by one token at most and
is found by its one-deletion neighbourhood. The larger set of a pair allocates, the smaller one is indexed.

Allocation goes by cost. Small sets give two units to every segment, since few and full segments are the cheaper index for
them; larger ones give one. A segment's cost is the number of sets that share its subset: empty segments get no unit while
the others suffice, and a set takes away units from the segments with the most sharers, as long as H + 1 remain.

Sets that share subsets are first compared with a leader: every subset draws one of its sets, and a set meets the one that
it shares most with. What is linked becomes one component, and further rounds draw anew among the components. Then every
remaining pair across components is compared, on the whole sets. A link inside a component changes nothing, so large groups
of near copies cost a link each and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, table
from folioforge.llm.components import components

SHINGLE, PERCENT = 5, 80
#: Sets up to this size give every segment two units.
SMALL = 64
#: Most rounds of comparisons with leaders; one that adds less than this share of the links is the last.
ROUNDS, FEW = 5, 0.02
#: Least counters of a sketch, and the sets of a subset that a task compares with each other at once.
SKETCH, BLOCK = 256, 1000
#: Pairs that a task has given out; beyond this many it forgets them.
GIVEN = 500_000
FULL, DELETED, PROBES = 0, 1, 2


def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def most_apart(larger: int, smaller: int, percent: int) -> int:
    """The most tokens in which two sets of these sizes differ when 100 * intersection >= percent * union."""
    return (larger + smaller) * (100 - percent) // (100 + percent)


def bands(size: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(band, least size, largest size) of a size, and of the next band if a set of this size has partners there."""
    band, low = 0, 1
    while True:
        high = low * 100 // percent
        if size <= high:
            out = [(band, low, high)]
            if 100 * size >= percent * (high + 1):
                out.append((band + 1, high + 1, (high + 1) * 100 // percent))
            return out
        band, low = band + 1, high + 1


def segments(high: int, percent: int = PERCENT) -> tuple[int, int]:
    """(segments, units of each) of the scheme of sets up to a size."""
    needed = most_apart(high, high, percent) + 1
    if high <= SMALL:
        return (needed + 1) // 2 + (needed > 3), 2
    empty = needed * np.exp(-high / needed)
    return int(needed + np.ceil(empty + 4 * np.sqrt(empty)) + needed // 16 + 1), 1


def signatures(tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, roles, spare) of a set: subsets of its segments, by band; spare units that allocation may still take away."""
    keys, roles, spare = [], [], 0
    for place, (band, _, high) in enumerate(bands(len(tokens), percent)):
        if not most_apart(high, len(tokens), percent):
            continue
        m, units = segments(high, percent)
        mixed = _mix(tokens, 2 * band + 1)
        of = (mixed % np.uint64(m)).astype(np.int64)
        again = _mix(mixed, 2 * band + 2)
        order = np.argsort(of, kind="stable")
        sizes = np.bincount(of, minlength=m)
        ends = np.cumsum(sizes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(again[order], dtype=np.uint64)])
        sums = sums[ends] - sums[ends - sizes]
        named = _mix(np.arange(m, dtype=np.uint64), 1_000_003 + band)
        keys.append(_mix(sums + named, 7))
        role = np.full(m, FULL)
        if not place:
            filled = sizes > 0
            units_left = units * int(filled.sum()) - most_apart(len(tokens), len(tokens), percent) - 1
            role[filled] = FULL | PROBES
            # Where full segments don't suffice, empty ones must be looked up as well.
            role[np.flatnonzero(~filled)[: max(0, -units_left)]] = FULL | PROBES
            spare = max(0, units_left) if units == 1 else 0
        roles.append(role)
        if units == 2:
            keys.append(_mix((sums[of] - again) + named[of], 7))
            roles.append(np.full(len(tokens), DELETED | (PROBES if not place else 0)))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), 0
    return np.concatenate(keys), np.concatenate(roles), spare


def _odd(i: int) -> np.uint64:
    """The odd factor of a shingle's i-th word."""
    return np.uint64(xxhash.xxh64_intdigest(b"%d" % i, 3) | 1)


def token_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles, each put together from its words' hashes.

    Fewer words are hashed as one sequence, no words give no tokens.
    """
    words = text.lower().split()
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))][: len(words)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - shingle + 1
    sums = np.zeros(n, np.uint64)
    for i in range(shingle):
        sums += h[i : i + n] * _odd(i)
    sums = _mix(sums, 11)
    sums.sort()
    return sums[np.concatenate([[True], sums[1:] != sums[:-1]])]


def _digest(tokens: np.ndarray, seed: int) -> int:
    h = xxhash.xxh64_intdigest(tokens.tobytes(), seed)
    return h - (1 << 64) if h >> 63 else h


def _classes(text: Column, shingle: int) -> Column:
    """struct<n, node, check>: size and digests of a text's set."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets = [token_set(t.as_py() or b"", shingle) for t in texts.cast(pa.binary())]
            columns = [[len(s) for s in sets], [_digest(s, 1) for s in sets], [_digest(s, 2) for s in sets]]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n", "node", "check"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "n long, node long, check long")(text)


#: Sets whose signatures a task has written, by digest; beyond this many it forgets them.
REMEMBERED = 200_000


def _signed(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(key, node, size, role, spare): signatures of the texts' sets, once for each set of a task or a little more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        names = ["key", "node", "size", "role", "spare"]
        for batch in batches:
            parts: list = []
            held = 0
            for t in batch.column(0).cast(pa.binary()):
                tokens = token_set(t.as_py() or b"", shingle)
                node = _digest(tokens, 1)
                if not len(tokens) or node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                keys, roles, spare = signatures(tokens, percent)
                if len(keys):
                    k = len(keys)
                    parts.append((keys.view(np.int64), np.full(k, node), np.full(k, len(tokens)), roles, np.full(k, spare)))
                    held += k
                if held > 200_000:
                    yield _flat(parts, names)
                    parts, held = [], 0
            if parts:
                yield _flat(parts, names)

    return texts.mapInArrow(run, "key long, node long, size int, role byte, spare int")


def _flat(parts: list, names: list[str]) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int32, np.int8, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in parts]).astype(kind)) for i, kind in enumerate(kinds)], names)


def sketched(tokens: np.ndarray) -> np.ndarray:
    """How many of a set's tokens fall to each counter: half as many counters as tokens or more, a power of two."""
    n, mixed = SKETCH, _mix(tokens, 5)
    while 2 * n < len(tokens):
        n *= 2
    while True:
        counts = np.bincount((mixed % np.uint64(n)).astype(np.int64), minlength=n)
        if counts.max() <= 255:
            return counts.astype(np.uint8)
        n *= 2


def _folded(sketches: list) -> list[np.ndarray]:
    """Sketches, given as bytes, with as many counters as the least of them has."""
    least = min(map(len, sketches))
    return [np.frombuffer(b, np.uint8).reshape(-1, least).sum(axis=0, dtype=np.int32) for b in sketches]


def _sets(text: Column, shingle: int) -> Column:
    """struct<tokens: binary, sketch: binary>: a set, and how many of its tokens fall to each counter."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets = [token_set(t.as_py() or b"", shingle) for t in texts.cast(pa.binary())]
            sketches = [sketched(s).tobytes() for s in sets]
            yield pa.StructArray.from_arrays([pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(sketches, pa.binary())], ["tokens", "sketch"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "tokens binary, sketch binary")(text)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pairwise(judge, a: Column, b: Column) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([judge(x.as_buffer(), y.as_buffer()) for x, y in zip(left, right)], pa.bool_())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "boolean")(a, b)


def _near(percent: int):
    """A sketch can only lessen the difference of two sets, so what it sets apart is no link."""

    def judge(a: pa.Buffer, b: pa.Buffer) -> bool:
        x, y = _folded([a.to_pybytes(), b.to_pybytes()])
        return bool(np.abs(x - y).sum() <= most_apart(int(x.sum()), int(y.sum()), percent))

    return judge


def _alike(percent: int):
    return lambda a, b: linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of distinct pairs (u, v) that are links. Sketches are compared before whole sets move."""
    side = lambda c, *columns: sets.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in columns])
    near = pairs.join(side("u", "sketch"), "u").join(side("v", "sketch"), "v").where(_pairwise(_near(percent), F.col("sketch_u"), F.col("sketch_v"))).select("u", "v")
    near = materialize(near, "near")
    both = near.join(side("u", "tokens"), "u").join(side("v", "tokens"), "v")
    return materialize(both.where(_pairwise(_alike(percent), F.col("tokens_u"), F.col("tokens_v"))).select("u", "v"), "links")


def _fits(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _with_components(shared: DataFrame, found: DataFrame | None) -> DataFrame:
    """Rows of subsets that sets of several components share, with the component of each."""
    if found is None:
        return shared.withColumn("root", F.col("node"))
    found = found.withColumnRenamed("node", "_of")
    rows = shared.join(found, F.col("node") == F.col("_of"), "left").withColumn("root", F.coalesce("root", "node")).drop("_of")
    w = Window.partitionBy("key")
    return rows.withColumns({"_least": F.min("root").over(w), "_most": F.max("root").over(w)}).where("_least <> _most").drop("_least", "_most")


def _met(rows: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(u, v): sets of different components that share a subset, one of which seeks the other, and whose sketches are near.

    A subset that very many sets share is gone through by pairs of its blocks; only what passes leaves the task, and a pair
    that several of its subsets give, once.
    """
    given: set[tuple[int, int]] = set()  # each task has its own

    def run(group: pa.Table) -> pa.Table:
        node, size, root, deleted = (group.column(c).to_numpy() for c in ("node", "size", "root", "deleted"))
        seeks, own = (group.column(c).to_numpy(zero_copy_only=False) for c in ("seeks", "own"))
        cross = len(np.unique(own)) > 1  # two blocks; a block meets itself elsewhere
        sketch = np.array(_folded(group.column("sketch").to_pylist()), np.int16)
        out: set[tuple[int, int]] = set()
        for i in np.flatnonzero(seeks):
            fits = (root != root[i]) & (size <= size[i]) & (100 * size >= percent * size[i]) & ((size < size[i]) | (node != node[i])) & (deleted + deleted[i] < 2)
            other = np.flatnonzero(fits & (own != own[i]) if cross else fits)
            near = np.abs(sketch[other] - sketch[i]).sum(axis=1) <= (size[other] + size[i]) * (100 - percent) // (100 + percent)
            out.update((max(x, v), min(x, v)) for x in [int(node[i])] for v in node[other[near]].tolist())
        out -= given
        if len(given) > GIVEN:
            given.clear()
        given.update(out)
        pairs = np.array(list(out), np.int64).reshape(-1, 2)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    blocks = F.ceil(F.count("*").over(Window.partitionBy("key")) / block).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", F.col("size").cast("long").alias("size"), "root", (F.col("role") % 2).cast("long").alias("deleted"), "seeks", "sketch")
    return dealt.groupBy("key", "a", "b").applyInArrow(run, "u long, v long")


def _once(rows: DataFrame) -> DataFrame:
    """One subset of those that the same sets share in the same roles: they all give the same pairs.

    Rows of a subset are distinct, so that their hashes don't cancel out; members are told apart by 128 bits and their number.
    """
    member = ["node", "role", "seeks"]
    members = rows.groupBy("key").agg(F.bit_xor(F.xxhash64(*member)).alias("m1"), F.bit_xor(F.xxhash64(F.lit(1), *member)).alias("m2"), F.count("*").alias("n"))
    return rows.join(members.groupBy("m1", "m2", "n").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def links(texts: DataFrame, needed_texts, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Edges (u, v) that join the same sets as all links do. texts: one column; needed_texts: nodes -> (node, text)."""
    w = Window.partitionBy("key")
    most = {"_least": F.min("node").over(w), "_most": F.max("node").over(w), "_sought": F.max("role").over(w), "cost": F.count("*").over(w)}
    signed = _signed(texts, shingle, percent).withColumns(most).where((F.col("_least") != F.col("_most")) & (F.col("_sought") >= PROBES))
    shared = materialize(signed.select("key", "node", "size", "role", "spare", "cost").distinct(), "shared")
    # A set takes units away from the subsets that most others share; what nobody looks up any more needs no comparison.
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("cost"), "key"))
    probes = shared.where(F.col("role") >= PROBES).withColumn("rank", rank).where(F.col("rank") > F.col("spare")).select("key", F.col("node").alias("x")).distinct()
    kept = shared.join(probes.groupBy("key").agg(F.count("*").alias("n")), "key")
    seeks = shared.select("key", "node").join(probes, (shared["key"] == probes["key"]) & (shared["node"] == probes["x"]), "left_semi").withColumn("seeks", F.lit(True)).distinct()
    alive = materialize(kept.drop("n", "cost", "spare").join(seeks, ["key", "node"], "left").withColumn("seeks", F.coalesce("seeks", F.lit(False)) & (F.col("role") >= PROBES)), "alive")
    nodes = alive.select("node").distinct()
    sets = materialize(needed_texts(nodes).select("node", _sets(F.col("text"), shingle).alias("s")).select("node", "s.*"), "sets")
    found, linked_so_far = None, 0
    for turn in range(ROUNDS):
        rows = _with_components(alive, found)
        leader = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node", F.lit(turn)), "root", "node", "size")).alias("leader")).select("key", F.col("leader.root").alias("led"), F.col("leader.node").alias("leader"), F.col("leader.size").alias("of_size"))
        met = rows.join(leader, "key").where((F.col("root") != F.col("led")) & _fits("size", "of_size", percent))
        best = met.groupBy("node", "leader").agg(F.count("*").alias("n")).groupBy("node").agg(F.max(F.struct("n", "leader")).alias("best"))
        new = _verified(best.select(F.col("node").alias("u"), F.col("best.leader").alias("v")), sets, percent)
        if not (n := new.count()):
            break
        # Components so far are stars, to which new links are added.
        found = components(new if found is None else _stars(found).unionByName(new))
        linked_so_far += n
        if n < FEW * linked_so_far:
            break
    rows = materialize(_once(_with_components(alive, found)), "apart")
    pairs = _met(rows.join(sets.select("node", "sketch"), "node"), percent)
    pairs = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "pairs")
    last = _verified(pairs, sets, percent)
    return last if found is None else _stars(found).unionByName(last)


def _stars(found: DataFrame) -> DataFrame:
    return found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each document.

    component_id: the least doc_id that links reach, its own included. Texts of fewer words than a shingle are one shingle;
    null texts and those without words have none, and link with nothing. Equal sets are linked whatever their texts. Null ids
    are never the least; a component of null ids only has a null component_id; rows of one id are documents of their own.
    Texts are read whole whatever their length; an empty table gives no rows; other columns are not returned.

    Sets are told apart by 64 bits (among 10^9 sets two alike are expected with probability 0.03); where 128 bits show that
    two different sets fell together, it's an error and not a wrong link.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("t1"), _classes(t, shingle).alias("c")).select("doc_id", "t1", "c.*")
    rows = materialize(rows, "classes")
    classes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("check").alias("check"), F.max("check").alias("other"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t1")).alias("first"))
    classes = materialize(classes, "sets-by-digest")
    if not classes.where("check <> other").isEmpty():
        raise ValueError("two different sets have the same digest of 64 bits")

    def needed(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node").select("node", F.col("first.doc_id").alias("_id"), F.col("first.t1").alias("_t1"))
        given = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("t1"), t.alias("text"))
        return given.join(wanted, (F.col("t1") == F.col("_t1")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "text").dropDuplicates(["node"])

    found = components(links(documents.select(t.alias("text")), needed, shingle, percent)).withColumnRenamed("node", "_of")
    rooted = classes.join(found, F.col("node") == F.col("_of"), "left").select(F.col("node").alias("_node"), "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(least, "root").select("_node", "component_id")
    out = rows.join(of_class, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op12_jaccard: all of `documents`."""
    return near_duplicates(table(spark, sf_dir, "documents"))
