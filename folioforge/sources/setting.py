"""Lines of text set as pages of glyphs or words, in the form that `glyphs.pages_of_glyphs` and `layout.pages_of_words` give."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

GLYPHS = "text array<string>, x0 array<double>, x1 array<double>, top array<double>, bottom array<double>, size array<double>"
WORDS = "array<struct<text: string, x0: double, x1: double, top: double, bottom: double, size: double>>"
BREAK = re.compile("[\x20\x09-\x0d]+")
#: A character's width, a line's height, where a space over a letter begins and ends, and pages set at once.
WIDTH, HEIGHT, FROM, TO, AT_ONCE = 5.0, 10.0, 2.0, 4.5, 50


def _texts(points: np.ndarray) -> pa.StringArray:
    """Code points as strings of one each."""
    size = 1 + (points >= 0x80) + (points >= 0x800).astype(int) + (points >= 0x10000)
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.py_buffer(points.tobytes().decode("utf-32-le").encode()))


def _set(lines: pa.ListArray, phantoms: bool) -> list[pa.ListArray]:
    flat = lines.flatten()
    text = pc.fill_null(flat.field("text"), "")
    top, size, spaced = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("top", "size", "spaced"))
    points = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), "<u4")
    n = pc.utf8_length(text).to_numpy()
    line = np.repeat(np.arange(len(n)), n)
    x = (np.arange(len(points)) - np.repeat(np.cumsum(n) - n, n)) * WIDTH
    stays = (points != 32) | spaced[line]
    points, line, x = points[stays], line[stays], x[stays]
    at = np.repeat(np.arange(len(points)), 1 + (phantoms & (points % 7 == 0) & (points != 32)))
    again = np.r_[False, at[1:] == at[:-1]][: len(at)]
    line, x = line[at], x[at]
    ends = np.r_[0, np.cumsum(np.bincount(line, minlength=len(n)))]
    sized = np.asarray(pc.fill_null(pc.list_value_length(lines), 0))
    offsets = pa.array(ends[np.r_[0, np.cumsum(sized)]], pa.int32())
    columns = [_texts(np.where(again, 32, points[at]).astype("<u4")), x + np.where(again, FROM, 0.0), x + np.where(again, TO, WIDTH), top[line], top[line] + HEIGHT, size[line]]
    return [pa.ListArray.from_arrays(offsets, c if isinstance(c, pa.Array) else pa.array(c)) for c in columns]


def glyphs_of(pages: DataFrame, phantoms: bool = False) -> DataFrame:
    """Pages with `lines`, an array of (text, top, size, spaced), with the columns of their glyphs instead.

    Spaces are glyphs where a line is spaced, else gaps. phantoms: some letters have a space over them.
    """
    schema = pages.drop("lines").schema
    for f in _parse_datatype_string(GLYPHS).fields:
        schema = schema.add(f)
    into = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), AT_ONCE):
                some = batch.slice(low, AT_ONCE)
                keys = [some[c] for c in some.schema.names if c != "lines"]
                found = [c.cast(f.type) for c, f in zip(_set(some["lines"], phantoms), list(into)[len(keys) :])]
                yield pa.RecordBatch.from_arrays([*keys, *found], schema=into)

    return pages.select(*schema.names[: len(schema) - 6], "lines").mapInArrow(run, schema)


def _placed(text: str) -> Iterator[tuple[str, float, float, float]]:
    """(word, x0, x1, top) of a text's words: a line is 14 points high, a character 5 points wide, and words wobble a little."""
    for i, line in enumerate(text.split("\n")):
        x = 0
        for k, word in enumerate(w for w in BREAK.split(line) if w):
            yield word, x * WIDTH, (x + len(word)) * WIDTH, i * 14.0 + k % 3 * 0.6
            x += len(word) + 1


def words_of(documents: DataFrame) -> DataFrame:
    """(book_id, page_seq, words) of documents (doc_id, text): a document is a page of placed words, as `layout.pages_of_words`
    gives them. One without words has none."""
    schema = _parse_datatype_string(f"book_id bigint, page_seq int, words {WORDS}")
    into = to_arrow_schema(schema)
    of = into.field("words").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), AT_ONCE):
                some = batch.slice(low, AT_ONCE)
                pages = [list(_placed(t)) if t else [] for t in some["text"].to_pylist()]
                text, x0, x1, top = map(list, zip(*chain.from_iterable(pages))) if any(pages) else ([], [], [], [])
                top = np.array(top, float)
                box = [pa.array(x0, pa.float64()), pa.array(x1, pa.float64()), pa.array(top), pa.array(top + HEIGHT), pa.array(np.full(len(top), HEIGHT))]
                words = pa.StructArray.from_arrays([pa.array(text, pa.string()), *box], ["text", "x0", "x1", "top", "bottom", "size"]).cast(of)
                ends = pa.array(np.r_[0, np.cumsum([len(p) for p in pages])], pa.int32())
                yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array([0] * len(some), pa.int32()), pa.ListArray.from_arrays(ends, words).cast(into.field("words").type)], schema=into)

    return documents.select("doc_id", "text").mapInArrow(run, schema)
