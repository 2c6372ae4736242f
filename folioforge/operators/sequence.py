"""Ordered-sequence operators as window expressions: fills, as-of look-ups, breaks, islands, places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def _past(keys: Keys, order: Sequence, upto: int = 0):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)


def _future(keys: Keys, order: Sequence, upto: int = 0):
    """The rows from this one on, last row first. A frame with an unbounded end would be read anew for each row."""
    return Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o.desc() for o in order]).rowsBetween(Window.unboundedPreceding, -upto)


def carried_forward(value: Column, keys: Keys, order: Sequence) -> Column:
    """The last value that isn't null up to this row."""
    return F.last(value, ignorenulls=True).over(_past(keys, order))


def carried_back(value: Column, keys: Keys, order: Sequence) -> Column:
    """The next value that isn't null from this row on."""
    return F.last(value, ignorenulls=True).over(_future(keys, order))


def as_of(events: DataFrame, switches: DataFrame, keys: Keys, at: str, value: str) -> DataFrame:
    """`events` with the value of the last switch at or before them: one sort of both tables together, no range join."""
    both = switches.select(*keys, at, value, F.lit(0).alias("_side")).unionByName(events.withColumns({value: F.lit(None).cast(switches.schema[value].dataType), "_side": F.lit(1)}), allowMissingColumns=True)
    return both.withColumn(value, carried_forward(F.col(value), keys, [at, "_side"])).where("_side = 1").drop("_side")


def heading_stack(positions: DataFrame, keys: Keys, order: Sequence, level: str, title: str, levels: int) -> DataFrame:
    """`positions` with `hierarchy`: the titles of each level that no later heading of a smaller level has closed."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = positions.withColumn("_at", place)
    for n in range(levels):
        out = out.withColumn(f"_h{n}", carried_forward(F.when(F.col(level) == n, F.struct("_at", F.col(title).alias("title"))), keys, order))
    at = lambda n: F.coalesce(F.col(f"_h{n}")["_at"], F.lit(0))
    shown = [F.when(F.lit(True) if not n else at(n) >= F.greatest(at(n - 1), *[at(m) for m in range(n)]), F.col(f"_h{n}")["title"]) for n in range(levels)]
    return out.withColumn("hierarchy", F.array_compact(F.array(*shown))).drop("_at", *[f"_h{n}" for n in range(levels)])


def breaks(series: DataFrame, keys: Keys, order: Sequence, number: str) -> DataFrame:
    """Steps that aren't plus one, with what they are: restart, gap or duplicate."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.lag(number).over(w)
    kind = F.when(F.col(number) < prev, "restart").when(F.col(number) > prev + 1, "gap").when(F.col(number) == prev, "duplicate")
    return series.withColumns({"before": prev, "kind": kind, "at": F.row_number().over(w)}).where("kind is not null")


def islands(opens: Column, keys: Keys, order: Sequence) -> Column:
    """Running number of the segment that a row belongs to; `opens` marks the first rows."""
    return F.sum(F.when(opens, 1).otherwise(0)).over(_past(keys, order))


def offsets(length: Column, keys: Keys, order: Sequence) -> Column:
    """Where a line starts in its text: the lengths of the lines before it, a line break each."""
    return F.coalesce(F.sum(length + 1).over(_past(keys, order, -1)), F.lit(0))


def occurrence(keys: Keys, order: Sequence) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def mark_repeats(cards: DataFrame, address: str, order: Sequence) -> DataFrame:
    """The n-th occurrence of an address gets it with ` (n)`, and `repeat_of` names the plain one."""
    n = occurrence([address], order)
    marked = cards.withColumn("_n", n)
    return marked.withColumns({"repeat_of": F.when(F.col("_n") > 1, F.col(address)), address: F.when(F.col("_n") > 1, F.concat(address, F.lit(" ("), F.col("_n").cast("string"), F.lit(")"))).otherwise(F.col(address))}).drop("_n")


def keep_one(cards: DataFrame, keys: Keys, order: Sequence, last: bool = False) -> DataFrame:
    """The first or last row of each key in file order."""
    by = [F.desc(o) if last else F.asc(o) for o in order]
    return cards.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")


def repeated_pages(pages: DataFrame, head: Column, keys: Keys, at: str, ahead: int = 12, least: int = 40) -> DataFrame:
    """`pages` with `duplicate_scan`: an equal head stands on one of the next `ahead` pages, so the later one is kept."""
    w = Window.partitionBy(*keys, "_head").orderBy(at)
    marked = pages.withColumn("_head", head).withColumn("_next", F.lead(at).over(w))
    return marked.withColumn("duplicate_scan", (F.char_length("_head") >= least) & F.coalesce(F.col("_next") - F.col(at) <= ahead, F.lit(False))).drop("_head", "_next")


def filled_by_offset(pages: DataFrame, keys: Keys, page: str, folio: str, most_spread: int = 0, drop_outliers: bool = False) -> DataFrame:
    """Missing folios from the most frequent offset of folio and page; nothing is filled where offsets spread more.

    Of equally frequent offsets the least counts. With drop_outliers, folios of another offset are replaced as well.
    """
    offset = F.col(folio) - F.col(page)
    found = pages.where(F.col(folio).isNotNull()).groupBy(*keys).agg(F.mode(offset, deterministic=True).alias("_mode"), (F.max(offset) - F.min(offset)).alias("_spread"))
    out = pages.join(found, list(keys), "left")
    usable = F.col("_mode").isNotNull() & (F.lit(drop_outliers) | (F.col("_spread") <= most_spread))
    guess = F.col(page) + F.col("_mode")
    keep = F.col(folio).isNotNull() & (~F.lit(drop_outliers) | (offset == F.col("_mode")))
    return out.withColumns({f"{folio}_filled": usable & ~keep, folio: F.when(usable & ~keep, guess).otherwise(F.col(folio))}).drop("_mode", "_spread")


def filled_between(pages: DataFrame, keys: Keys, page: str, folio: str) -> DataFrame:
    """Missing folios from their neighbours: ends are extrapolated, a gap whose ends agree counts forward from the left,
    one whose ends don't counts back from the right and is marked approximate. A folio whose offset differs from both
    neighbouring ones' is cleared first."""
    order = [page]
    offset = F.col(folio) - F.col(page)
    left = F.last(offset, ignorenulls=True).over(_past(keys, order, -1))
    right = F.last(offset, ignorenulls=True).over(_future(keys, order, 1))
    lone = F.col(folio).isNotNull() & ~(left.isNull() & right.isNull()) & ~offset.eqNullSafe(left) & ~offset.eqNullSafe(right)
    read = pages.withColumn("_read", F.when(~lone, F.col(folio)))
    known = F.col("_read") - F.col(page)
    before = F.last(known, ignorenulls=True).over(_past(keys, order))
    behind = carried_back(known, keys, order)
    value = F.when(F.col("_read").isNotNull(), F.col("_read")).otherwise(F.col(page) + F.coalesce(F.when(before.eqNullSafe(behind), before), behind, before))
    approx = F.col("_read").isNull() & before.isNotNull() & behind.isNotNull() & ~before.eqNullSafe(behind)
    return read.withColumns({"_value": value, f"{folio}_approx": approx}).withColumn(folio, F.col("_value")).drop("_read", "_value")


def suffix_flag(small: Column, keys: Keys, order: Sequence) -> Column:
    """True for rows of the longest suffix in which every row is small."""
    return F.min(small).over(_future(keys, order))
