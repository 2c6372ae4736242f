"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The benchmark's texts are cut into windows of `window` consecutive words (a shorter item is one window). The windows of
one length form one search: a shift table over blocks of two words tells how far the search may jump, a window whose
last block is at hand is looked up in the bucket of that block, its first word thins the bucket out, and a direct
comparison of all words confirms the occurrence. In clean text nearly every probe jumps the longest way, so the cost is
about one table look-up for nine words.

Documents aren't shuffled: the windows travel to them. A benchmark of up to `block_bytes` of text is one block; a larger
one is searched by one pass over the documents for each block of items, so that a task holds the tables of one block only
and no more than one block is broadcast or at the driver at once, however large the benchmark is. The tables hold the
block's words once, with places of windows in them; a block of 8 MB takes about 300 MB in a Python worker.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table

WINDOW = 10
BLOCK_BYTES = 8 << 20

_SEPARATED = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, a-z and non-ASCII characters after A-Z are lower-cased."""
    return text.translate(_SEPARATED).split()


class _Length:
    """The tables for all windows of one length: places in a list of all the block's words.

    Blocks of words are keyed by a number; two that share one get the smaller shift and one bucket, which costs a
    comparison and loses nothing.
    """

    def __init__(self, m: int, words: list[bytes]):
        self.m, self.words, self.width = m, words, min(2, m)
        self.far = m - self.width + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, int | array] = {}

    def _key(self, words: list[bytes], end: int) -> int:
        return hash(words[end - 1]) if self.width == 1 else hash((words[end - 2], words[end - 1]))

    def add(self, start: int) -> None:
        for end in range(self.width, self.m + 1):
            key = self._key(self.words, start + end)
            if self.shift.get(key, self.far) > self.m - end:
                self.shift[key] = self.m - end
        known = self.bucket.get(key)  # the last block's
        if known is None:
            self.bucket[key] = start
        elif isinstance(known, int):
            self.bucket[key] = array("q", (known, start))
        else:
            known.append(start)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(place in `words`, place in the block's words) of every occurrence of a window."""
        m, far, jump, key = self.m, self.far, self.shift.get, self._key
        end, n = m, len(words)
        while end <= n:
            block = key(words, end)
            step = jump(block, far)
            if step:
                end += step
                continue
            first, window, places = words[end - m], None, self.bucket[block]
            for at in (places,) if isinstance(places, int) else places:
                if self.words[at] == first:
                    window = window or words[end - m : end]
                    if self.words[at : at + m] == window:
                        yield end - m, at
            end += 1


class WuManber:
    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.words: list[bytes] = []
        self.items: list[str] = []
        self.ends: list[int] = []
        by_length: dict[int, _Length] = {}
        same: dict[bytes, bytes] = {}
        for item, text in items:
            words = [same.setdefault(w, w) for w in words_of(text)]
            start, m = len(self.words), min(window, len(words))
            self.words += words
            self.items.append(item)
            self.ends.append(len(self.words))
            for i in range(len(words) - m + 1 if m else 0):
                by_length.setdefault(m, _Length(m, self.words)).add(start + i)
        self.lengths = list(by_length.values())

    def search(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words; disjoint hit intervals of words, end exclusive; items with occurring windows."""
        words, spans, found = words_of(text), [], set()
        for table in self.lengths:
            for start, at in table.search(words):
                spans.append((start, start + table.m))
                found.add(self.items[bisect_right(self.ends, at)])
        merged: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return len(words), merged, sorted(found)


_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
_HITS_SQL = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"

#: A Python worker keeps the tables of the last block that it has built: a pass uses one.
_BUILT: dict[str, WuManber] = {}


def _tables(key: str, items: list[tuple[str, bytes]], window: int) -> WuManber:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = WuManber(items, window)
    return _BUILT[key]


def _searcher(shared, window: int):
    key = uuid.uuid4().hex

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables(key, shared.value, window)
        for texts in batches:
            rows = []
            for text in texts.cast(pa.binary()):
                n, spans, items = tables.search(text.as_py() or b"")
                rows.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": items})
            yield pa.array(rows, _HITS)

    search.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(search, _HITS_SQL)


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`documents` with a column `contamination`: struct<n_words, n_hit, spans, items>.

    spans: the hit words as disjoint intervals (end exclusive); items: the ids, as strings and in order, of the items with
    an occurring window. A null or empty text has no words; an item without words has no window; a null item id counts
    as the id "null"; rows of one item id count as one item; an empty benchmark hits nothing. Repeated documents are
    judged one by one; very long texts are searched whole. The caller's columns stay, but for one named `contamination`.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    blocks = size // block_bytes + 1
    if blocks == 1:
        out = documents.withColumn(own("hits"), _searcher(_shared(items), window)(F.col(text).cast("string")))
        hits = F.col(own("hits"))
        return out.withColumn("contamination", _contamination(hits["n_words"], hits["spans"], hits["items"])).drop(own("hits"))
    rows = materialize(documents.withColumn(own("row"), F.monotonically_increasing_id()), "documents")
    passes = []
    for k in range(blocks):
        shared = _shared(items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k))
        hits = rows.select(own("row"), _searcher(shared, window)(F.col(text).cast("string")).alias("hits")).select(own("row"), "hits.*")
        passes.append(materialize(hits.where("size(items) > 0") if k else hits, "hits"))
        shared.unpersist()
    together = reduce(DataFrame.unionByName, passes).groupBy(own("row")).agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    spans, found = _merged(F.array_sort("spans")), F.array_sort(F.array_distinct("items"))
    judged = together.select(own("row"), "n_words", spans.alias("spans"), found.alias("items")).select(own("row"), _contamination(F.col("n_words"), F.col("spans"), F.col("items")).alias(own("judged")))
    return rows.join(judged, own("row")).withColumn("contamination", F.col(own("judged"))).drop(own("row"), own("judged"))


def _shared(items: DataFrame):
    """One block of items, at most block_bytes of text or one item, as a broadcast."""
    return items.sparkSession.sparkContext.broadcast([(r["item"], r["text"].encode()) for r in items.collect()])


def _contamination(n_words, spans, items):
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return F.struct(n_words.alias("n_words"), n_hit.alias("n_hit"), spans.alias("spans"), items.alias("items"))


def _merged(spans):
    """Overlapping or touching intervals of a sorted array made one."""

    def join(done, s):
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"), join)


def clean(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with their columns."""
    return decontaminate(documents, benchmark, **options).where("contamination.n_hit = 0").drop("contamination").select(*documents.columns)


def digest(spark, sf_dir: str) -> DataFrame:
    """Query op2_decontamination: all of `documents` against all of `benchmark`."""
    judged = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return judged.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )
