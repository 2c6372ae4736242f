"""Hybrid retrieval: lexical and vector rankings fused by reciprocal ranks, with late materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The fusion constant, candidates of each branch, characters of a snippet.
RRF_K, CANDIDATES, SNIPPET = 60, 100, 220
WORD_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; no stemming, no stop words."""
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def query_terms(query: str) -> list[str]:
    import regex

    return sorted({t for t in regex.split(WORD_BREAK, query.lower()) if t})


def _ranked(df: DataFrame, name: str) -> DataFrame:
    """Ranks 1, 2, ... over the at most CANDIDATES rows that a branch has kept."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.desc("score"), "id"))).drop("score")


def lexical_topk(chunks: DataFrame, query: str, k: int = CANDIDATES) -> DataFrame:
    """(id, score): chunks that hold every term, by the sum of tf / (1 + tf), ties by id.

    A term is counted in the text where no letter or digit stands beside it, so as often as it's a token. Only texts that
    hold every term somewhere, if inside other words, are counted.
    """
    terms = query_terms(query)
    low = F.lower(F.col("text"))
    counts = [F.regexp_count(low, F.lit(rf"(?<![\p{{L}}\p{{N}}]){t}(?![\p{{L}}\p{{N}}])")) for t in terms]
    found = chunks.where(F.lit(bool(terms)))
    for t in terms:
        found = found.where(F.contains(low, F.lit(t)))
    for c in counts:
        found = found.where(c > 0)
    score = sum((c.cast("double") / (1 + c) for c in counts), F.lit(0.0))
    return found.select("id", F.round(score, 8).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_topk(embeddings: DataFrame, query: Sequence[float], k: int = CANDIDATES) -> DataFrame:
    """(id, distance): the k least cosine distances; rows without an embedding stay candidates at the end. Exact."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return embeddings.select("id", F.round(cosine_distance(F.col("embedding"), q), 8).alias("distance")).orderBy(F.asc_nulls_last("distance"), "id").limit(k)


def fuse(lexical: DataFrame, vector: DataFrame, k: int = RRF_K) -> DataFrame:
    """(id, score, lexical_rank, vector_rank): sums of 1 / (k + rank) over ranked (id, lexical_rank) and (id, vector_rank)."""
    both = lexical.join(vector, "id", "full")
    part = lambda c: F.coalesce(1 / (k + F.col(c)), F.lit(0.0))
    return both.select("id", F.round(part("lexical_rank") + part("vector_rank"), 8).alias("score"), "lexical_rank", "vector_rank")


def page_of(fused: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """A page in fused order: score, then lexical hits by rank, then the rest by vector rank."""
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit must lie in 1..100 and offset must not be negative")
    return fused.orderBy(F.desc("score"), F.asc_nulls_last("lexical_rank"), F.asc_nulls_last("vector_rank"), "id").offset(offset).limit(limit)


def hybrid(chunks: DataFrame, embeddings: DataFrame, query: str | None = None, vector: Sequence[float] | None = None, jurisdiction: str | None = None, sources: DataFrame | None = None, source_type: str | None = None) -> DataFrame:
    """The candidate union with fused scores. Filters apply before either ranking; an empty filter is none.

    A blank query and no vector is an error. Only ids and ranks are joined; `details` fetches the texts of one page.
    """
    if not (query or "").strip() and not vector:
        raise ValueError("a query or a vector is needed")
    base = chunks
    if jurisdiction:
        base = base.where(F.col("jurisdiction") == jurisdiction)
    if source_type:
        base = base.join(sources.where(F.col("source_type") == source_type).select(F.col("id").alias("source_id")), "source_id", "left_semi")
    empty = base.select("id").limit(0)
    lexical = _ranked(lexical_topk(base, query), "lexical_rank") if (query or "").strip() else empty.withColumn("lexical_rank", F.lit(None).cast("int"))
    if vector:
        mine = embeddings if base is chunks else embeddings.join(base.select("id"), "id", "left_semi")
        near = vector_topk(mine, vector).withColumn("vector_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("distance"), "id"))).drop("distance")
    else:
        near = empty.withColumn("vector_rank", F.lit(None).cast("int"))
    return fuse(lexical, near)


def details(page: DataFrame, chunks: DataFrame, sources: DataFrame, footnotes: DataFrame) -> DataFrame:
    """The page's chunks with source title and footnotes; ids that no longer exist are skipped. The page is at most 100 rows."""
    hits = F.broadcast(page)
    mine = footnotes.join(F.broadcast(page.select(F.col("id").alias("chunk_id"))), "chunk_id", "left_semi")
    kept = chunks.join(hits, "id")
    titled = sources.select(F.col("id").alias("source_id"), "title").join(F.broadcast(kept), "source_id")
    found = titled.select("source_id", *[c for c in kept.columns if c != "source_id"], "title")
    return found.join(nested_footnotes(mine), found["id"] == F.col("chunk_id"), "left").drop("chunk_id").withColumn("footnotes", F.coalesce("footnotes", F.array().cast("array<struct<number:bigint,text:string>>")))


def nested_footnotes(footnotes: DataFrame) -> DataFrame:
    """(chunk_id, footnotes): an array ordered by number."""
    return footnotes.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("number", "text"))).alias("footnotes"))


def snippet(text: Column, limit: int = SNIPPET) -> Column:
    """White space collapsed; cut at the limit, back to the last space, with an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    head = F.substring(flat, 1, limit)
    return F.when(F.char_length(flat) <= limit, flat).otherwise(F.concat(F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head), F.lit("…")))


def neighbours(chunks: DataFrame) -> DataFrame:
    """(id, prev_id, next_id) inside each source by the strict order of (page, created_at); a null page counts as -1.

    Chunks of an equal key are no neighbours of each other; among the ties of the winning key the least id wins. The keys
    of a source are ordered once, so each chunk costs one look to either side.
    """
    keyed = chunks.select("id", "source_id", F.struct(F.coalesce("page_start", F.lit(-1)).alias("page"), "created_at").alias("key"))
    keys = keyed.groupBy("source_id", "key").agg(F.min("id").alias("least"))
    order = Window.partitionBy("source_id").orderBy("key")
    sides = keys.select("source_id", "key", F.lag("least").over(order).alias("prev_id"), F.lead("least").over(order).alias("next_id"))
    return keyed.join(sides, ["source_id", "key"]).select("id", "prev_id", "next_id")


def clamped(limit: int) -> int:
    return max(1, min(100, limit))


def rendered(hits: DataFrame) -> DataFrame:
    """Search results as text lines."""
    return hits.withColumn("rendered", F.concat_ws("\n", F.concat(F.lit("["), "citation", F.lit("]")), snippet(F.col("text"))))
