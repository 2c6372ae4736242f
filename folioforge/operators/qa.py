"""Quality figures of a corpus of numbered cards: continuity, coverage, lengths, duplicates, references, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Shares below which a book is stopped.
CONTINUITY, COVERAGE = 0.98, 0.90


def gaps(numbers: DataFrame, series: Sequence[str], number: str) -> DataFrame:
    """(series, from, to, missing) for consecutive numbers of a series that leave some out."""
    w = Window.partitionBy(*series).orderBy(number)
    pairs = numbers.select(*series, number).distinct().select(*series, F.col(number).alias("from"), F.lead(number).over(w).alias("to"))
    return pairs.withColumn("missing", F.col("to") - F.col("from") - 1).where("missing > 0")


def continuity(numbers: DataFrame, book: Sequence[str], series: Sequence[str], number: str) -> DataFrame:
    """(book, cards, missing, share): cards / (cards + missing), rounded to 4."""
    cards = numbers.groupBy(*book).agg(F.count("*").alias("cards"))
    lost = gaps(numbers, series, number).groupBy(*book).agg(F.sum("missing").alias("missing"))
    out = cards.join(lost, list(book), "left").withColumn("missing", F.coalesce("missing", F.lit(0)))
    return out.withColumn("share", F.round(F.col("cards") / (F.col("cards") + F.col("missing")), 4))


def duplicates(numbers: DataFrame, series: Sequence[str], number: str) -> DataFrame:
    return numbers.groupBy(*series, number).agg(F.count("*").alias("n")).where("n > 1")


def _merged(cards: DataFrame, book: Sequence[str], start: str, end: str) -> DataFrame:
    """Interval with the furthest end before it: what lies between is a hole, what lies behind is new."""
    w = Window.partitionBy(*book).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return cards.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_reach", F.coalesce(F.max(end).over(w), F.lit(0)))


def coverage(cards: DataFrame, lengths: DataFrame, book: Sequence[str], start: str = "char_start", end: str = "char_end") -> DataFrame:
    """(book, covered_chars, book_chars, share) from the union of the cards' intervals; lengths: (book, book_chars)."""
    fresh = F.greatest(F.col(end) - F.greatest(start, "_reach"), F.lit(0))
    covered = _merged(cards, book, start, end).groupBy(*book).agg(F.sum(fresh).alias("covered_chars"))
    out = lengths.join(covered, list(book), "left").withColumn("covered_chars", F.coalesce("covered_chars", F.lit(0)))
    return out.withColumn("share", F.round(F.col("covered_chars") / F.col("book_chars"), 4))


def holes(cards: DataFrame, lengths: DataFrame, book: Sequence[str], start: str = "char_start", end: str = "char_end") -> DataFrame:
    """(book, from, to, chars) of the maximal stretches in no card, the one at the end included."""
    inner = _merged(cards, book, start, end).where(F.col(start) > F.col("_reach")).select(*book, F.col("_reach").alias("from"), F.col(start).alias("to"))
    reach = cards.groupBy(*book).agg(F.max(end).alias("_reach"))
    tail = lengths.join(reach, list(book), "left").select(*book, F.coalesce("_reach", F.lit(0)).alias("from"), F.col("book_chars").alias("to")).where("from < to")
    return inner.unionByName(tail).withColumn("chars", F.col("to") - F.col("from"))


def lengths(cards: DataFrame, book: Sequence[str], text: str = "text", short: int = 20, long: int = 20_000) -> DataFrame:
    n = F.char_length(text)
    return cards.groupBy(*book).agg(F.median(n).alias("median"), F.min(n).alias("min"), F.max(n).alias("max"), F.sum(F.when(n < short, 1).otherwise(0)).alias("too_short"), F.sum(F.when(n > long, 1).otherwise(0)).alias("too_long"))


def depth_histogram(cards: DataFrame, book: Sequence[str], hierarchy: str = "hierarchy") -> DataFrame:
    return cards.groupBy(*book, F.size(hierarchy).alias("depth")).agg(F.count("*").alias("cards"))


def footnote_figures(cards: DataFrame, book: Sequence[str], notes: str = "footnotes") -> DataFrame:
    n = F.size(notes)
    return cards.groupBy(*book).agg(F.round(F.avg(F.when(n > 0, 1).otherwise(0)), 4).alias("share"), F.sum(n).alias("total"), F.median(n).alias("per_card"))


def equal_pages(pages: DataFrame, book: Sequence[str], text: str, page: str) -> DataFrame:
    """Groups of pages with the same text, by its digest: (book, first, copies)."""
    return pages.where(F.trim(text) != "").groupBy(*book, F.sha2(text, 256).alias("_digest")).agg(F.min(page).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("_digest")


def dead_pages(pages: DataFrame, cards: DataFrame, book: Sequence[str], page: str, start: str = "page_start", end: str = "page_end") -> DataFrame:
    """Pages in no card: the cards' page spans are spread out to single pages, so that the join is an equality."""
    used = cards.where(F.col(start) <= F.col(end)).select(*book, F.explode(F.sequence(start, end)).alias(page)).distinct()
    return pages.join(used, [*book, page], "left_anti")


def unresolved(refs: DataFrame, units: DataFrame, keys: Sequence[str]) -> DataFrame:
    return refs.join(units.select(*keys).distinct(), list(keys), "left_anti")


def resolved_share(refs: DataFrame, units: DataFrame, book: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(book, refs_total, unresolved, resolved_share): the share is null without references."""
    known = units.select(*keys).distinct().withColumn("_known", F.lit(1))
    joined = refs.join(known, list(keys), "left").groupBy(*book).agg(F.count("*").alias("refs_total"), F.sum(F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("unresolved"))
    return joined.withColumn("resolved_share", F.round(1 - F.col("unresolved") / F.nullif("refs_total", F.lit(0)), 4))


def stops(shares: DataFrame) -> DataFrame:
    """Books with their reasons to stop, from (continuity, coverage)."""
    why = F.array_compact(F.array(F.when(F.col("continuity") < CONTINUITY, "continuity"), F.when(F.col("coverage") < COVERAGE, "coverage")))
    return shares.withColumn("stops", F.array_join(why, ",")).where("stops <> ''")


def difference(old: DataFrame, new: DataFrame, key: str, structure: Sequence[str], text: str = "text") -> DataFrame:
    """(key, change): lost, new, moved (structure differs) or text, for cards that aren't the same in both."""
    digest = lambda df, tag: df.select(key, F.xxhash64(*structure).alias(f"_s{tag}"), F.sha2(text, 256).alias(f"_t{tag}"), F.lit(True).alias(f"_in{tag}"))
    both = digest(old, 0).join(digest(new, 1), key, "full")
    change = F.when(F.col("_in1").isNull(), "lost").when(F.col("_in0").isNull(), "new").when(~F.col("_s0").eqNullSafe(F.col("_s1")), "moved").when(~F.col("_t0").eqNullSafe(F.col("_t1")), "text")
    return both.select(key, change.alias("change")).where("change is not null")


def crosscheck(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """(place, n): ids in both, only in the first, only in the second."""
    both = first.select(key).distinct().withColumn("_a", F.lit(1)).join(second.select(key).distinct().withColumn("_b", F.lit(1)), key, "full")
    return both.groupBy(F.when(F.col("_b").isNull(), "only_first").when(F.col("_a").isNull(), "only_second").otherwise("both").alias("place")).agg(F.count("*").alias("n"))


def merge_missing(primary: DataFrame, secondary: DataFrame, key: str, name: str) -> DataFrame:
    """`primary` with the secondary's cards that it lacks; their offsets are null and merged_from names the run."""
    lacking = secondary.join(primary.select(key), key, "left_anti")
    blank = {c: F.lit(None).cast(primary.schema[c].dataType) for c in ("char_start", "char_end") if c in primary.columns}
    return primary.withColumn("merged_from", F.lit(None).cast("string")).unionByName(lacking.withColumns(blank).withColumn("merged_from", F.lit(name)))


def seeded_sample(cards: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The same n cards every time: the least hashes of key and seed."""
    return cards.orderBy(F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))), 256), key).limit(n)


def tallies(rows: DataFrame, book: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(book, column, value, n): how often each value of each column occurs, nulls too, all columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(*book, F.explode(pairs).alias("_p")).groupBy(*book, F.col("_p.column").alias("column"), F.col("_p.value").alias("value")).agg(F.count("*").alias("n"))


def voted(rows: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """(keys, value, votes): the most frequent value that isn't null; of equally frequent ones the first by `order`, a number."""
    of = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"), F.min(order).alias("_first"))
    return of.groupBy(*keys).agg(F.max(F.struct("votes", (-F.col("_first")).alias("_f"), value)).alias("_b")).select(*keys, f"_b.{value}", "_b.votes")


def look_first(cards: DataFrame, book: Sequence[str], ident: str = "external_id", text: str = "text", notes: str = "note_numbers") -> DataFrame:
    """(book, control_characters, id_collisions, unnumbered_notes): what to look at before anything else.

    Characters below a space but tab and line ends; cards beyond the first of an id; entries of `notes` that are null.
    """
    control = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""))
    bare = F.size(F.filter(notes, lambda n: n.isNull()))
    by_id = cards.groupBy(*book, ident).agg(F.count(ident).alias("_n"), F.sum(control).alias("_c"), F.sum(F.when(F.col(notes).isNotNull(), bare)).alias("_u"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return by_id.groupBy(*book).agg(total("_c").alias("control_characters"), total(F.greatest(F.col("_n") - 1, F.lit(0))).alias("id_collisions"), total("_u").alias("unnumbered_notes"))


def against_expected(cards: DataFrame, expected: DataFrame, book: Sequence[str], family: str) -> DataFrame:
    """(book, family, cards, expected, fits), a row also where only one side knows the family; expected: (book, family, expected)."""
    have = cards.groupBy(*book, family).agg(F.count("*").alias("cards"))
    both = have.join(expected, [*book, family], "full").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("cards", "expected")})
    return both.withColumn("fits", F.col("cards") == F.col("expected"))


def rising_share(rows: DataFrame, series: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """(series, steps, share): how many of the steps between neighbours rise, rounded to 4; null where there is no step."""
    before = F.lag(number).over(Window.partitionBy(*series).orderBy(*order))
    steps = rows.where(F.col(number).isNotNull()).withColumn("_b", before)
    share = F.round(F.avg(F.when(F.col("_b").isNotNull(), (F.col(number) > F.col("_b")).cast("int"))), 4)
    return steps.groupBy(*series).agg(F.count("_b").alias("steps"), share.alias("share"))
