"""The corpus service's relations: statistics, listings, upsert, patch and cascading deletes as DataFrame rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Rejected(ValueError):
    """A batch that breaks a rule of the schema."""


def by_jurisdiction(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """Sources and chunks of each jurisdiction; sources without chunks count. Chunks are counted before the join."""
    counted = chunks.groupBy("source_id").agg(F.count("*").alias("n"))
    return sources.join(counted, sources["id"] == counted["source_id"], "left").groupBy("jurisdiction").agg(F.countDistinct("id").alias("n_sources"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_chunks"))


def by_source(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    counted = chunks.groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("n"))
    return sources.join(counted, "id", "left").select("jurisdiction", "source_type", "title", "id", F.coalesce("n", F.lit(0)).alias("n_chunks"))


def statistics(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks by jurisdiction, layer and source with all subtotals; level 0 is the single source, 3 the total."""
    return by_source(sources, chunks).rollup("jurisdiction", "source_type", "id").agg(F.sum("n_chunks").alias("n_chunks"), F.grouping_id().alias("grouping")).withColumn("level", F.bit_count("grouping")).drop("grouping")


def without_sources(sources: DataFrame, universe: Sequence[str]) -> DataFrame:
    """Codes of the universe that no source has, with their place in it."""
    spark = sources.sparkSession
    codes = spark.createDataFrame(list(enumerate(universe)), "place int, jurisdiction string")
    return codes.join(sources.select("jurisdiction").distinct(), "jurisdiction", "left_anti")


def listing(chunks: DataFrame, source_id: str, limit: int, offset: int = 0) -> DataFrame:
    """A source's chunks by page, null pages last, then by creation."""
    return chunks.where(F.col("source_id") == source_id).orderBy(F.asc_nulls_last("page_start"), "created_at", "id").offset(offset).limit(limit)


def duplicate_keys(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = items.where(F.col(keys[-1]).isNotNull() & (F.col(keys[-1]) != ""))
    return named.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def upsert(existing: DataFrame, items: DataFrame, keys: Sequence[str] = ("source_id", "external_id"), kept: Sequence[str] = ("id", "created_at"), checked: bool = True) -> DataFrame:
    """`existing` after the items: a match overwrites every field but `kept`, what matches nothing is added.

    Items without an external id (null or empty) are always added. Two items of one key reject the batch.
    """
    if checked and not duplicate_keys(items, keys).isEmpty():
        raise Rejected("two items of a batch have the same external id")
    named = items.where(F.col(keys[-1]).isNotNull() & (F.col(keys[-1]) != ""))
    old = existing.where(F.col(keys[-1]) != "").select(*keys, *[F.col(c).alias(f"_{c}") for c in kept])
    fresh = items.join(old, list(keys), "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in kept else F.col(c) for c in existing.columns])
    return existing.join(named.select(*keys), list(keys), "left_anti").unionByName(fresh)


def patched(existing: DataFrame, patches: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, outcome, fields): updated, unchanged or missing for every patch row.

    patches: `key`, and `present`, a map from field to new value as string; a field that is not in the map is left alone, one
    with a null value is cleared.
    """
    unknown = patches.where(F.exists(F.map_keys("present"), lambda k: ~k.isin(*fields)))
    if not unknown.isEmpty():
        raise Rejected("a patch names a field that can't be patched")
    if patches.groupBy(key).count().where("count > 1").isEmpty() is False:
        raise Rejected("a key stands twice in one batch")
    joined = patches.join(existing.withColumn("_there", F.lit(True)), key, "left")
    new = {f: F.when(F.map_contains_key("present", f), F.try_element_at("present", F.lit(f)).cast(existing.schema[f].dataType)).otherwise(F.col(f)) for f in fields}
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~new[f].eqNullSafe(F.col(f))
    outcome = F.when(F.col("_there").isNull(), "missing").when(changed, "updated").otherwise("unchanged")
    return joined.select(key, outcome.alias("outcome"), *[c.alias(f) for f, c in new.items()])


def apply_patches(existing: DataFrame, patches: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """`existing` with the updated rows' fields; the others stay as they are."""
    done = patched(existing, patches, key, fields).where("outcome = 'updated'").select(key, F.lit(True).alias("_hit"), *[F.col(f).alias(f"_{f}") for f in fields])
    return existing.join(done, key, "left").select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in existing.columns])


def delete_sources(sources: DataFrame, chunks: DataFrame, footnotes: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three relations without the sources in `gone` (column id), their chunks and these chunks' footnotes."""
    left = chunks.join(gone.select(F.col("id").alias("source_id")), "source_id", "left_anti")
    lost = chunks.join(gone.select(F.col("id").alias("source_id")), "source_id", "left_semi").select(F.col("id").alias("chunk_id"))
    return sources.join(gone, "id", "left_anti"), left, footnotes.join(lost, "chunk_id", "left_anti")


def source_violations(sources: DataFrame, kinds: Sequence[str] = ("commentary", "textbook")) -> DataFrame:
    """(id, rule) for every rule that a source breaks."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rules = {"title": blank(F.col("title")), "jurisdiction": blank(F.col("jurisdiction")), "source_type": ~F.coalesce(F.col("source_type").isin(*kinds), F.lit(False))}
    return sources.select("id", F.explode(F.array_compact(F.array(*[F.when(broken, rule) for rule, broken in rules.items()]))).alias("rule"))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Rows whose foreign key has no parent."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def resolve(items: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(item, source_id): catalogue entries found by normalised title and authors, else by title, if there is exactly one."""
    normal = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    full = catalogue.groupBy(normal(F.col("title")).alias("t"), normal(F.array_join("authors", "")).alias("a")).agg(F.min("id").alias("by_both"), F.count("*").alias("n")).where("n = 1").drop("n")
    short = catalogue.groupBy(normal(F.col("title")).alias("t")).agg(F.min("id").alias("by_title"), F.count("*").alias("n")).where("n = 1").drop("n")
    keyed = items.select("item", normal(F.col("title")).alias("t"), normal(F.array_join("authors", "")).alias("a"))
    return keyed.join(full, ["t", "a"], "left").join(short, "t", "left").select("item", F.coalesce("by_both", "by_title").alias("source_id"))


def card_place(page: Column, top: Column) -> Column:
    """Where a card stands: by page, then by its upper edge; without a page it comes last, without an edge first on its page."""
    return F.struct(F.coalesce(page.cast("bigint"), F.lit(10**6)).alias("page"), F.coalesce(top.cast("double"), F.lit(0.0)).alias("top"))


def vector_of(text: Column, dims: int) -> Column:
    """A JSON list of numbers as array<float>; null unless it is a list of `dims` numbers."""
    parsed = F.from_json(text, "array<float>", {"mode": "PERMISSIVE"})
    return F.when((F.size(parsed) == dims) & F.forall(parsed, lambda x: x.isNotNull()), parsed)


def printed_page_batches(cards: DataFrame, book: Sequence[str], key: str, size: int = 500) -> DataFrame:
    """(book, key, printed_page_start, printed_page_end, batch): patches of the cards with a printed page, `size` a batch."""
    some = cards.where(F.col("printed_page_start").isNotNull()).select(*book, key, "printed_page_start", "printed_page_end")
    return some.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*book).orderBy(key)) - 1) / size))
