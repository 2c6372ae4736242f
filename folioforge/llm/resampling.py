"""Importance resampling toward a target text, by a distinct-feature dictionary.

A feature is a run of one to three consecutive words. Documents are gone through in blocks of some megabytes. A block is
packed as the distinct features that it holds, in order of their words, each with its postings: the block's documents that
hold it and how often. A pair of words goes on to a triple unless a document ends with it, and a pair's triples are in its
slice, so its postings are those of its triples and of these ends, and aren't written again. The packed features are dealt out over slices by their first two words, so that one slice meets all
blocks' entries of a feature, and a word that every document holds is one entry for each block, not one for each document.

A slice's dictionary is the union of its blocks' features with their counts over the corpus. A feature's hash is put together
from those of its words, as a CRC of two parts follows from theirs; so only a slice's distinct words are gone through byte by
byte. The buckets' sums give the gains: a table of `buckets` rows whatever the corpus. The same exchange is then read once
more: the gains are joined to the blocks' features, go back to the postings, and are summed for each document.
Neither the features of a document nor the dictionary are ever in one place: a task holds a block or a slice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, table

GRAMS, BUCKETS, SEED = 3, 10_000, 42
#: Documents of fewer words aren't drawn; of the others this many in a hundred are.
LEAST_WORDS, PERCENT = 20, 5
#: Bytes of text that a block holds (a longer text is a block of its own), and that a slice stands for.
BLOCK, SLICE = 4 << 20, 2 << 20
#: Weights that a task holds before it passes them on.
HELD = 4_000_000

#: For each byte its lower case, or 0 where no word goes on: ASCII letters and digits, and all bytes of other characters.
_WORD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
_CODEC = pa.Codec("zstd", 3)
_BLANK, _LINE_END, _NOTHING = (pa.scalar(x, pa.large_binary()) for x in (b" ", b"\n", b""))


def _pack(a: np.ndarray) -> bytes:
    """An array in the least width, its bytes apart by significance."""
    a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
    return bytes([a.itemsize]) + len(a).to_bytes(8, "little") + _CODEC.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes(), asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    width, n = packed[0], int.from_bytes(packed[1:9], "little")
    return np.ascontiguousarray(np.frombuffer(_CODEC.decompress(packed[9:], width * n, asbytes=True), np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64)


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(the distinct words in order, the number of each word of the texts, the text that it stands in)."""
    flat = _WORD[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = np.concatenate([[False], flat > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    every = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat[flat > 0])]).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return every.dictionary.take(pa.array(order)), rank[every.indices.to_numpy()], np.searchsorted(text_ends, starts, "right")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _counted(gram: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings in order of gram and text: (gram, text, how often)."""
    key, n = np.unique(gram * texts + text, return_counts=True)
    return (key // texts).astype(np.int32), (key % texts).astype(np.int32), n.astype(np.int32)


def _data(strings: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of large strings, and where each begins and ends."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return memoryview(strings.buffers()[2] or b""), offsets


def _hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = _data(strings)
    out = np.empty(len(strings), np.int64)
    for i in range(0, len(out), 1 << 16):
        at = offsets[i : i + (1 << 16) + 1].tolist()
        out[i : i + len(at) - 1] = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
    return out


def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """What each byte of a CRC becomes when bytes follow: by their number below 64, and 64 times each power of two."""
    units = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    one = np.array([[zlib.crc32(b"\0", x) ^ zlib.crc32(b"\0") for x in row] for row in units.tolist()], np.uint32)
    then = lambda x, table: table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
    few = [units]
    for _ in range(64):
        few.append(then(few[-1], one))
    many = [few.pop()]
    for _ in range(31):
        many.append(then(many[-1], many[-1]))
    return np.array(few), np.array(many)


_FEW, _MANY = _shifts()


def _joined(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRCs of strings in two parts from those of the parts; size: bytes of the second."""
    at = (size & 63) << 10
    out = _FEW.take(at + (a & 255))
    for k in (1, 2, 3):
        out ^= _FEW.take(at + ((a >> 8 * k & 255) | k << 8))
    for bit in range(int(size.max(initial=0) >> 6).bit_length()):
        more = np.flatnonzero(size >> 6 + bit & 1)
        x, table = out[more], _MANY[bit]
        out[more] = table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
    return out ^ b


def _pack_words(lines: pa.Array, at: np.ndarray) -> bytes:
    """Some of the words, which end with a line feed each."""
    if not len(at):
        return bytes(8)
    data, offsets = _data(lines.take(pa.array(at)))
    some = data[offsets[0] : offsets[-1] - 1]
    return len(some).to_bytes(8, "little") + _CODEC.compress(some, asbytes=True)


def _unpack_words(packed: bytes) -> pa.Array:
    size = int.from_bytes(packed[:8], "little")
    if not size:
        return pa.array([], pa.large_binary())
    letters = np.frombuffer(_CODEC.decompress(packed[8:], size, asbytes=True), np.uint8)
    ends = np.append(np.flatnonzero(letters == 10), size)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))])
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(letters[letters != 10])])


def packed_block(texts: list[bytes], slices: int) -> tuple[list[dict], np.ndarray]:
    """The features of one block by slice, and the number of words of each text.

    A slice's features are its single words, its pairs and their triples, in this order; each word and triple has as many
    postings as `holders` says. `ended` are the pairs that texts end with, `enders` these texts. Pairs are written as the distinct first words with the seconds of each, triples as the thirds of each
    pair, so a word is written about once for each feature that it ends.
    """
    words, word, text = words_of(texts)
    n_words = np.bincount(text, minlength=len(texts))
    if not len(word):
        return [], n_words
    hashed = _hashes(words).astype(np.uint64) + np.uint64(1)
    lines = pc.binary_join_element_wise(words, _LINE_END, _NOTHING)
    v = len(words)
    together = np.flatnonzero(text[1:] == text[:-1])
    pairs, pair = np.unique(word[together] * v + word[together + 1], return_inverse=True)
    place = np.full(len(word), -1)
    place[together] = pair
    long = together[np.isin(together + 1, together, assume_unique=True)]
    triples, triple = np.unique(place[long] * v + word[long + 2], return_inverse=True)
    slice_of_pair = (_mixed(_mixed(hashed[pairs // v]) + hashed[pairs % v]) % np.uint64(slices)).astype(np.int64)
    slice_of_word = (_mixed(_mixed(hashed)) % np.uint64(slices)).astype(np.int64)
    # Of each kind: its features in order of their slices, their postings, and where a slice's features and postings begin.
    sorted_kinds = []
    for where, gram, held in ((slice_of_word, word, text), (slice_of_pair[triples // v], triple, text[long])):
        gram, holder, count = _counted(gram, held, len(texts))
        order, holders = np.argsort(where.astype(np.min_scalar_type(slices)), kind="stable"), np.bincount(gram, minlength=len(where))
        begins, moved = np.cumsum(holders) - holders, holders[order]
        at = np.concatenate([[0], np.cumsum(moved)])
        posting = np.repeat(begins[order] - at[:-1], moved) + np.arange(len(gram))
        cut = np.searchsorted(where[order], np.arange(slices + 1))
        sorted_kinds.append((order, moved, holder[posting], count[posting], cut.tolist(), at[cut].tolist()))
    twos = np.argsort(slice_of_pair.astype(np.min_scalar_type(slices)), kind="stable")
    p_cut = np.searchsorted(slice_of_pair[twos], np.arange(slices + 1)).tolist()
    last = together[~np.isin(together + 1, together, assume_unique=True)]
    last = last[np.argsort(slice_of_pair[place[last]], kind="stable")]
    ended, enders = place[last], text[last]
    e_cut = np.searchsorted(slice_of_pair[ended], np.arange(slices + 1)).tolist()
    del word, text, pair, triple, place, together, long, last, gram, holder, count, posting
    (singles, *_, w_cut, _), (threes, *_, t_cut, _) = sorted_kinds
    rows = []
    for s in range(slices):
        single, two, three = singles[w_cut[s] : w_cut[s + 1]], twos[p_cut[s] : p_cut[s + 1]], threes[t_cut[s] : t_cut[s + 1]]
        if not len(single) and not len(two):
            continue
        firsts, seconds_of = np.unique(pairs[two] // v, return_counts=True)
        part = lambda i: np.concatenate([k[i][k[5][s] : k[5][s + 1]] for k in sorted_kinds])  # noqa: B023, E731
        rows.append({
            "slice": s,
            "singles": _pack_words(lines, single),
            "firsts": _pack_words(lines, firsts),
            "seconds": _pack_words(lines, pairs[two] % v),
            "thirds": _pack_words(lines, triples[three] % v),
            "seconds_of": _pack(seconds_of),
            "thirds_of": _pack(np.bincount(np.searchsorted(two, triples[three] // v), minlength=len(two))),
            "holders": _pack(np.concatenate([k[1][k[4][s] : k[4][s + 1]] for k in sorted_kinds])),
            "texts": _pack(part(2)),
            "counts": _pack(part(3)),
            "ended": _pack(np.searchsorted(two, ended[e_cut[s] : e_cut[s + 1]])),
            "enders": _pack(enders[e_cut[s] : e_cut[s + 1]]),
        })
    return rows, n_words


def _unpack_lists(row: dict) -> list[pa.Array]:
    """The single words, and the first, second and third words of pairs and triples."""
    return [_unpack_words(row[c]) for c in ("singles", "firsts", "seconds", "thirds")]


def _strings(lists: list[pa.Array], seconds_of: np.ndarray, thirds_of: np.ndarray) -> pa.Array:
    singles, firsts, seconds, thirds = lists
    pairs = pc.binary_join_element_wise(firsts.take(pa.array(np.repeat(np.arange(len(firsts)), seconds_of))), seconds, _BLANK) if len(seconds) else seconds
    triples = pc.binary_join_element_wise(pairs.take(pa.array(np.repeat(np.arange(len(pairs)), thirds_of))), thirds, _BLANK) if len(thirds) else thirds
    return pa.concat_arrays([singles, pairs, triples])


def unpacked_features(row: dict) -> pa.Array:
    return _strings(_unpack_lists(row), _unpack(row["seconds_of"]), _unpack(row["thirds_of"]))


_BINARY = ("singles", "firsts", "seconds", "thirds", "seconds_of", "thirds_of", "holders", "texts", "counts", "ended", "enders", "ids", "words")
_PACKED = "slice int, block long, " + ", ".join(f"{c} binary" for c in _BINARY)
_PACKED_ARROW = pa.schema([("slice", pa.int32()), ("block", pa.int64()), *[(c, pa.binary()) for c in _BINARY]])
#: Stands for a null id in the packed ids.
_NO_ID = np.iinfo(np.int64).min


def packed(documents: DataFrame, slices: int, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """The documents' features by slice and block, and one row for each block that lists its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            column = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            sizes = _data(column)[1] - _data(column)[1][0]
            begin = 0
            while begin < len(column):
                end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + block, "right")) - 1)
                rows, n_words = packed_block(column.slice(begin, end - begin).to_pylist(), slices)
                number += 1
                out = [row | {"block": number} for row in rows]
                out.append({"slice": number % slices, "block": number, "ids": ids[begin:end].tobytes(), "words": n_words.astype(np.int64).tobytes()})
                for i in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pylist(out[i : i + 64], _PACKED_ARROW)
                del rows, out
                begin = end
                pa.default_memory_pool().release_unused()

    return documents.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, _PACKED)


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("slice").sortWithinPartitions("slice")


class _Slice:
    """The blocks' entries of one slice, and their dictionary."""

    def __init__(self, buckets: int):
        self.buckets, self.lists, self.seconds_of, self.rows = buckets, [], [], []

    def add(self, row: dict) -> None:
        lists = _unpack_lists(row)
        self.lists.append(lists)
        self.seconds_of.append(_unpack(row["seconds_of"]))
        thirds_of, holders = _unpack(row["thirds_of"]), _unpack(row["holders"])
        n, singles = len(lists[0]) + len(lists[2]) + len(lists[3]), len(lists[0])
        self.rows.append((row["block"], n, singles, thirds_of, holders, *(_unpack(row[c]) for c in ("texts", "counts", "ended", "enders"))))

    def counts(self) -> np.ndarray:
        """How often each entry stands in its block; a pair as often as its triples and at the ends of texts."""
        out = []
        for _, _, singles, thirds_of, holders, _, counts, ended, _ in self.rows:
            n = np.add.reduceat(counts, np.cumsum(holders) - holders) if len(holders) else holders
            before = np.concatenate([[0], np.cumsum(n[singles:])])
            after = np.cumsum(thirds_of)
            out += [n[:singles], before[after] - before[after - thirds_of] + np.bincount(ended, minlength=len(thirds_of)), n[singles:]]
        return np.concatenate(out)

    def worth(self, worth: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, texts, what each adds) from the worth of every entry; a triple's posting adds its pair's worth too."""
        begin = 0
        for block, n, singles, thirds_of, holders, texts, counts, ended, enders in self.rows:
            each, begin = worth[begin : begin + n], begin + n
            pairs = each[singles : singles + len(thirds_of)]
            posted = np.concatenate([each[:singles], each[singles + len(thirds_of) :] + np.repeat(pairs, thirds_of)])
            yield block, np.concatenate([texts, enders]), np.concatenate([np.repeat(posted, holders) * counts, pairs[ended]])

    def _numbered(self) -> tuple[pa.Array, list[tuple[np.ndarray, ...]]]:
        """The distinct words, and of each block the numbers of its single, first, second and third words."""
        words = pa.concat_arrays([words for lists in self.lists for words in lists]).dictionary_encode()
        parts = np.split(words.indices.to_numpy(), np.cumsum([len(words) for lists in self.lists for words in lists])[:-1])
        return words.dictionary, list(zip(*[iter(parts)] * 4))

    def entry_buckets(self, numbered: tuple | None = None) -> np.ndarray:
        """The bucket of each entry. Only distinct words are gone through byte by byte; runs are put together from them."""
        words, blocks = numbered or self._numbered()
        plain = _hashes(words).astype(np.uint32)
        size = np.diff(_data(words)[1])
        spaced = _joined(np.full(len(plain), zlib.crc32(b" "), np.uint32), plain, size)
        out = []
        for (singles, firsts, seconds, thirds), seconds_of, row in zip(blocks, self.seconds_of, self.rows):
            pairs = _joined(np.repeat(plain[firsts], seconds_of), spaced[seconds], size[seconds] + 1)
            out += [plain[singles], pairs, _joined(np.repeat(pairs, row[3]), spaced[thirds], size[thirds] + 1)]
        return np.concatenate(out).astype(np.int64) % self.buckets

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(an entry of each distinct feature, the bucket of each, the feature of each entry), by the numbers of their words."""
        words, blocks = numbered = self._numbered()
        v = np.int64(max(1, len(words)))
        singles = np.concatenate([block[0] for block in blocks])
        pairs = np.concatenate([np.repeat(firsts, n).astype(np.int64) * v + seconds for (_, firsts, seconds, _), n in zip(blocks, self.seconds_of)])
        pairs = np.unique(pairs, return_inverse=True)[1]
        thirds_of, thirds = (np.concatenate(x) for x in ([row[3] for row in self.rows], [block[3] for block in blocks]))
        kind = np.repeat(np.tile(np.arange(3), len(blocks)), [len(x) for block in blocks for x in (block[0], block[2], block[3])])
        feature, so_far = np.empty(len(kind), np.int64), 0
        for k, keys in enumerate((singles, pairs, np.repeat(pairs, thirds_of) * v + thirds)):
            found = np.unique(keys, return_inverse=True)[1] if k != 1 else pairs
            feature[kind == k] = found + so_far
            so_far += int(found.max(initial=-1)) + 1
        bucket, entry = np.empty(so_far, np.int64), np.empty(so_far, np.int64)
        bucket[feature], entry[feature] = self.entry_buckets(numbered), np.arange(len(feature))
        return entry, bucket, feature

    def dictionary(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(the distinct features, the bucket of each, the feature of each entry)."""
        entry, bucket, feature = self.distinct()
        strings = [_strings(lists, seconds_of, row[3]) for lists, seconds_of, row in zip(self.lists, self.seconds_of, self.rows)]
        return pa.concat_arrays(strings).take(pa.array(entry)), bucket, feature


def _by_slice(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[_Slice | None, list[dict], np.ndarray | None]]:
    """(slice, its blocks' lists of documents, the gains where rows carry them) of rows that are sorted by slice."""
    now, some, lists, gains = None, _Slice(buckets), [], None
    for batch in batches:
        for i in range(batch.num_rows):
            at = batch.column("slice")[i].as_py()
            if at != now and now is not None:
                yield some, lists, gains
                some, lists = _Slice(buckets), []
                pa.default_memory_pool().release_unused()
            now = at
            if gains is None and "gains" in batch.schema.names:
                gains = np.array(batch.column("gains")[i].as_py(), np.int64)
            row = {c: batch.column(c)[i].as_py() for c in _PACKED_ARROW.names}
            if row["ids"] is None:
                some.add(row)
            else:
                lists.append(row)
    if now is not None:
        yield some, lists, gains


def features(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(feature, n, bucket): the dictionary, one row for each distinct feature of `packed` rows; words are UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, _ in _by_slice(batches, buckets):
            if some.rows:
                strings, bucket, feature = some.dictionary()
                n = np.bincount(feature, weights=some.counts(), minlength=len(strings))
                yield pa.RecordBatch.from_arrays([strings.cast(pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(bucket.astype(np.int32))], ["feature", "n", "bucket"])

    return dealt(rows).mapInArrow(run, "feature string, n long, bucket int")


def _bucket_sums(sliced: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): occurrences of the dictionary's features by bucket, summed in each slice before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, _ in _by_slice(batches, buckets):
            if some.rows:
                _, bucket, feature = some.distinct()
                sums = np.bincount(bucket[feature], weights=some.counts(), minlength=buckets).astype(np.int64)
                there = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(sums[there])], ["bucket", "n"])

    return sliced.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, `gains`: array<long> by bucket, from (bucket, n) of both sides. A bucket without features counts 0."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(c, F.lit(0)).cast("double") for c in ("s", "t"))
    listed = F.array_sort(F.collect_list(F.struct("bucket", s.alias("s"), t.alias("t"))))
    some = both.groupBy().agg(listed.alias("b"), (F.sum(s) + buckets).alias("all_s"), (F.sum(t) + buckets).alias("all_t"))
    gain = lambda x: F.floor(1000 * F.log((x["t"] + 1) * F.col("all_s") / ((x["s"] + 1) * F.col("all_t"))))
    return some.select(F.transform("b", gain).alias("gains"))


def _weighed(sliced: DataFrame, buckets: int) -> DataFrame:
    """(block, texts, sums, ids, words): each slice's share of the weights of a block's documents, and the lists of blocks."""
    schema = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("texts", "sums", "ids", "words")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # a block's weights, over the slices at hand
        for some, lists, gain in _by_slice(batches, buckets):
            out = [(row["block"], None, None, row["ids"], row["words"]) for row in lists]
            if some.rows:
                for block, texts, each in some.worth(gain[some.entry_buckets()]):
                    before = held.get(block, np.zeros(0, np.int64))
                    sums = np.bincount(texts, weights=each, minlength=len(before)).astype(np.int64)  # exact below 2^53
                    sums[: len(before)] += before
                    held[block] = sums
                if sum(map(len, held.values())) > HELD:
                    out += _sums(held)
                    held = {}
            yield from _batches(out, schema)
        yield from _batches(_sums(held), schema)

    return sliced.mapInArrow(run, "block long, texts binary, sums binary, ids binary, words binary")


def _sums(held: dict[int, np.ndarray]) -> list[tuple]:
    some = [(block, np.flatnonzero(w), w[w != 0]) for block, w in held.items()]
    return [(block, _pack(there), _pack((w << 1) ^ (w >> 63)), None, None) for block, there, w in some]


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 64]), schema)], schema=schema)


def _summed(parts: pa.Table) -> pa.Table:
    """One block's documents with their weights."""
    rows = parts.to_pylist()
    listed = next(r for r in rows if r["ids"] is not None)
    ids, words = np.frombuffer(listed["ids"], np.int64), np.frombuffer(listed["words"], np.int64)
    weight = np.zeros(len(ids), np.int64)
    for r in rows:
        if r["texts"] is not None:
            coded = _unpack(r["sums"])
            weight[_unpack(r["texts"])] += (coded >> 1) ^ -(coded & 1)
    grams = sum(np.maximum(words - k, 0) for k in range(GRAMS))
    place = np.arange(len(ids), dtype=np.int64) + (listed["block"] << 20)
    return pa.table({"place": place, "doc_id": pa.array(ids, mask=ids == _NO_ID), "n_words": words, "n_features": grams, "weight": weight})


def weights(documents: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, block: int = BLOCK, slice_bytes: int = SLICE) -> DataFrame:
    """(place, doc_id, n_words, n_features, weight), one row for each document; place is a number of the row.

    `documents` and `target` should be tables: a lost executor's blocks are read again from them. Nulls and texts without
    words have no features and the weight 0. Where the corpus or the target is empty its sums are 0, and the gains are
    still defined. Equal texts and repeated rows weigh alike, each in a row of its own.
    """
    size = lambda df: df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    of = lambda df: dealt(packed(df, max(1, -(-size(df) // slice_bytes)), text, doc_id, block))
    sliced = of(documents)
    theirs = _bucket_sums(of(target.withColumn(doc_id, F.lit(0))), buckets)
    gained = gains(_bucket_sums(sliced, buckets), theirs, buckets)
    with_gains = sliced.withColumn("gains", gained.scalar())
    return _weighed(with_gains, buckets).groupBy("block").applyInArrow(_summed, "place long, doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 g) of a Gumbel variable that the id decides; a null id counts as the empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(documents: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, **sizes: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row for each document.

    Of the N documents of least_words words or more, the floor(percent N / 100) of the highest scores are drawn: ranks from
    1, ties to the smaller id, null ids last; equal ids in any order. All others have no rank. An empty table gives no rows.
    The ranks come from a sort by range: rows are numbered inside a range and moved by the rows of the ranges before it.
    """
    scored = weights(documents, target, text, doc_id, **sizes).withColumn("score", F.col("weight") + gumbel(F.col("doc_id")))
    rows = materialize(scored.withColumn("small", F.col("n_words") < least_words), "weights")
    drawn = rows.where("not small").count() * percent // 100
    order = ["small", F.desc("score"), F.asc_nulls_last("doc_id"), "place"]
    ranged = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    # One row for each range, of which there are as many as shuffle partitions.
    before = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    starts, so_far = [], 0
    for part in sorted(before):
        starts.append((part, so_far))
        so_far += before[part]
    begins = documents.sparkSession.createDataFrame(starts or [(0, 0)], "part int, before long")
    ranked = ranged.withColumn("inside", inside).join(F.broadcast(begins), "part")
    rank = F.col("before") + F.col("inside")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", F.when(~F.col("small") & (rank <= drawn), rank).alias("rank"))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op11_resampling: all of `documents` toward all texts of `benchmark`."""
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
