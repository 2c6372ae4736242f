"""BPE encoding and decoding with a pair occurrence index.

The unit of work is a partition: the distinct pre-tokens of a batch that the worker has not met yet are laid out in
one flat array of symbols, every adjacent pair is entered with all its positions in an index, and the pairs that have a
rank are taken from a heap in ascending order. One step applies a rank at all its positions at once and updates the lists
of the pairs to the left and right. In these vocabularies a merge's parts are always made by earlier merges and no token
is made twice (`Vocabulary` checks both), so ascending order over the partition is ascending order in every word.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import own, table

#: Stretches of text that a Python worker remembers; beyond that it forgets the later half, so its memory stays bounded.
REMEMBERED = 300_000
#: Words that one pair occurrence index covers.
PARTITION = 16_384
#: A longer stretch is encoded but not remembered.
LONG = 64


_SPACE = regex.compile(r"\p{White_Space}+")
#: str.split() cuts at these four as well; the library doesn't.
_SPLIT_TOO = "\x1c\x1d\x1e\x1f"


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte: itself if it is a visible Latin-1 character, else the next code point from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """A tokenizer file of the word-end kind: NFC, white space folded, lower case, byte-level symbols, suffix at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.id_of: dict[str, int] = model["vocab"]
        self.token_of = {i: t for t, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of |= {i: t for t, i in self.special.items()}
        #: By rank: the pair's ids and the id of what it makes.
        self.merges: list[tuple[int, int, int]] = []
        self.rank_of: dict[int, int] = {}
        born: dict[int, int] = {}
        for r, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            left, right, made = self.id_of[a], self.id_of[b], self.id_of[a + b]
            if made in born or max(born.get(left, -1), born.get(right, -1)) >= r or max(left, right) >> 16:
                raise ValueError("ranks of this vocabulary can't be applied in ascending order over a partition")
            born[made] = r
            self.merges.append((left, right, made))
            self.rank_of[left << 16 | right] = r
        self._pairs = np.array(sorted(self.rank_of), np.int64)
        self._ranks = np.array([self.rank_of[p] for p in self._pairs.tolist()], np.int64)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # The library's \s is Unicode's White_Space.
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.inner = np.array([self.id_of[c] for c in alphabet], np.int64)
        self.final = np.array([self.id_of[c + self.end] for c in alphabet], np.int64)

    def normal(self, text: str) -> str:
        """Lower case goes character by character, so a final sigma is no special case."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def stretches(self, text: str) -> list[str]:
        """The normal form cut at white space, which no pre-token holds; strings of special tokens stand alone."""
        if self.specials is not None and "<" in text and self.specials.search(text):
            return [s for part in self.specials.split(text) for s in ([part] if part in self.special else self._cut(part))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        text = self.normal(text)
        out = [s for s in _SPACE.split(text) if s] if any(c in text for c in _SPLIT_TOO) else text.split()
        if self.special:  # what only looks like a special token after lower-casing is text
            out = [s if s not in self.special else s + " " for s in out] if any(t in out for t in self.special) else out
        return out

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The byte symbols of all words in one array, and where each word starts, with the end."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[flat]
        symbol[starts[1:] - 1] = self.final[flat[starts[1:] - 1]]
        return symbol, starts

    def ranks_at(self, symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each position, -1 for none."""
        pair = symbol << 16 | np.where(after >= 0, symbol[np.minimum(after, len(symbol) - 1)], 0)
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where((after >= 0) & (self._pairs[at] == pair), self._ranks[at], -1)


def encode_words(words: list[str], vocabulary: Vocabulary) -> list[list[int]]:
    """The ids of each word, by the pair occurrence index over all of them."""
    symbol, starts = vocabulary.symbols(words)
    n = len(symbol)
    if not n:
        return [[] for _ in words]
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    before[starts[:-1]] = -1
    after[starts[1:] - 1] = -1
    # The index: for every rank the positions of its pair, and a heap of the ranks that have any.
    ranks = vocabulary.ranks_at(symbol, after)
    at_all = np.flatnonzero(ranks >= 0)
    at_all = at_all[np.argsort(ranks[at_all], kind="stable")]
    distinct, first = np.unique(ranks[at_all], return_index=True)
    places = dict(zip(distinct.tolist(), (p.tolist() for p in np.split(at_all, first[1:]))))
    active = list(places)
    symbol, before, after = symbol.tolist(), before.tolist(), after.tolist()
    rank_of, merges = vocabulary.rank_of.get, vocabulary.merges
    while active:
        r = heapq.heappop(active)
        left, right, made = merges[r]
        at_all = places.pop(r)
        if left == right:
            at_all.sort()
        for at in at_all:
            nxt = after[at]
            # An entry is stale if an earlier merge took one of its symbols.
            if symbol[at] != left or nxt < 0 or symbol[nxt] != right:
                continue
            symbol[at], symbol[nxt] = made, -1
            follow = after[at] = after[nxt]
            if follow >= 0:
                before[follow] = at
                if (new := rank_of(made << 16 | symbol[follow])) is not None:
                    if new in places:
                        places[new].append(at)
                    else:
                        places[new] = [at]
                        heapq.heappush(active, new)
            prior = before[at]
            if prior >= 0 and (new := rank_of(symbol[prior] << 16 | made)) is not None:
                if new in places:
                    places[new].append(prior)
                else:
                    places[new] = [prior]
                    heapq.heappush(active, new)
    ends = starts.tolist()
    return [[s for s in symbol[a:b] if s >= 0] for a, b in zip(ends, ends[1:])]


class Codec:
    """Encodes whole batches; keeps the ids and the decoded form of the stretches between white space that it has met."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.packed: dict[str, bytes] = {}
        self.written: dict[str, str] = {}

    def _learn(self, stretches: list[str], packed: dict, written: dict) -> None:
        v = self.vocabulary
        found = [[s] if s in v.special else v.words.findall(s) for s in stretches]
        words = list({w: None for some in found for w in some if w not in v.special})
        ids_of = {t: [i] for t, i in v.special.items()}
        for i in range(0, len(words), PARTITION):
            some = words[i : i + PARTITION]
            ids_of.update(zip(some, encode_words(some, v)))
        token = v.token_of.__getitem__
        for s, some in zip(stretches, found):
            ids = ids_of[some[0]] if len(some) == 1 else [i for w in some for i in ids_of[w]]
            packed[s] = array("I", ids).tobytes()
            written[s] = " ".join(map(token, ids))

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        packed_out, written_out = [], []
        for packed, written in self.portions(texts):
            packed_out += packed
            written_out += written
        return packed_out, written_out

    def portions(self, texts: list[str]) -> Iterator[tuple[list[bytes], list[str]]]:
        """The packed ids and decoded forms of the texts in order, a few million characters at a time."""
        for some in _portions(texts):
            packed_out, written_out = [], []
            split = [self.vocabulary.stretches(t) for t in some]
            packed, written = self.packed, self.written
            new = set().union(*split) - packed.keys()
            self._learn([s for s in new if len(s) <= LONG], packed, written)
            if long := [s for s in new if len(s) > LONG]:
                self._learn(long, packed, written)
            for stretches in split:
                packed_out.append(b"".join(map(packed.__getitem__, stretches)))
                written_out.append(" ".join(map(written.__getitem__, stretches)))
            for s in long:
                del packed[s], written[s]
            if len(packed) > REMEMBERED:  # what came first is what is frequent
                for d in (packed, written):
                    for s in list(islice(d, REMEMBERED // 2, None)):
                        del d[s]
            yield packed_out, written_out


def _portions(texts: list[str], characters: int = 2_000_000) -> Iterator[list[str]]:
    """The texts in order, in lists of a few million characters."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size > characters:
            yield some
            some, size = [], 0
    if some:
        yield some


_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


_ENCODED = "ids binary, decoded string"


def encoder(path: str):
    """A column function: text -> struct<ids: binary (little-endian unsigned 32-bit), decoded: string>."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for texts in batches:
            for ids, decoded in codec.portions([t or "" for t in texts.to_pylist()]):
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["ids", "decoded"])

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, _ENCODED)


def decoder(path: str):
    """A column function: binary ids -> text, as the library decodes without a decoder: the tokens, joined by spaces."""

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token_of = _codec(path).vocabulary.token_of
        for packed in batches:
            yield pa.array([None if b is None else " ".join(token_of[i] for i in memoryview(b).cast("I")) for b in packed.to_pylist()], pa.string())

    decode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(decode, "string")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(documents: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """`documents` with `ids` (binary: packed little-endian unsigned 32-bit ids), `n_tokens` and `decoded`.

    path: the vocabulary file, at the same place on every executor. A null text counts as empty and has no ids; the text
    is encoded whole whatever its length; strings of special tokens in a text become those tokens, as the library does by
    default. Repeated rows are encoded one by one. The caller's columns stay, but for those three names.
    """
    out = documents.withColumn(own("encoded"), encoder(path or default_vocabulary())(F.col(text).cast("string")))
    e = F.col(own("encoded"))
    return out.withColumns({"ids": e["ids"], "n_tokens": (F.octet_length(e["ids"]) / 4).cast("long"), "decoded": e["decoded"]}).drop(own("encoded"))


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """`encoded` with the column `decoded` made from the packed ids; null ids give null."""
    return encoded.withColumn("decoded", decoder(path or default_vocabulary())(F.col(ids)))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7_bpe: every whole text of `documents`, encoded and decoded again."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
