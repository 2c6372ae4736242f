"""State carried over a book's pages in Structured Streaming: notes read page by page, equal to the batch fold."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioforge.operators.carried import NOTE, Reader
from folioforge.operators.layout import PAGE


def carried_notes(pages: DataFrame, read: Reader, page: Sequence[str] = PAGE, lines: str = "lines") -> DataFrame:
    """`operators.carried.carried_notes` over a stream of pages, which may come in any order and more than once.

    Pages of a book count from 0 without gaps. A book's state is its last number, the page that is due, and pages that wait
    for it; a page that was read already is passed over, so a source that sends a batch again changes nothing. A page that
    never comes keeps the later ones of its book in the state. A null list of lines is an empty page.
    """
    *book, at = page
    fields = {f.name: f.dataType for f in pages.schema.fields}
    rows = T.StructType([T.StructField(c, fields[c]) for c in page] + T._parse_datatype_string(NOTE).fields)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, due, kept = state.get if state.exists else (0, 0, "{}")
        waiting = {int(n): some for n, some in json.loads(kept).items()}
        for batch in batches:
            for n, some in zip(batch[at], batch[lines]):
                if n >= due:
                    waiting.setdefault(int(n), [] if some is None else list(some))
        out = []
        while due in waiting:
            notes, last = read(waiting.pop(due), last)
            out += [(*key, due, *n.values()) for n in notes]
            due += 1
        state.update((last, due, json.dumps(waiting)))
        if out:
            frame = pd.DataFrame(out, columns=rows.names)
            yield frame.astype({"number": "Int32"})

    return pages.select(*page, lines).groupBy(*book).applyInPandasWithState(run, rows, "last int, due int, waiting string", "append", GroupStateTimeout.NoTimeout)
