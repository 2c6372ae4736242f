"""Queries of the corpus service over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import relational as R
from folioforge.operators import search as S
from folioforge.sources.tables import CHUNKS, FOOTNOTES, SOURCES, chunks, embeddings, footnotes, read, sources

QUERY = "the of and"
UNIVERSE = ("at", "ch", "de", "en", "es", "fr", "it", "nl", "pl", "pt", "se", "uk")


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The embedding of vec_id 0: one row."""
    row = embeddings(spark, sf_dir).where("id = 0").select("embedding").first()
    return list(row["embedding"]) if row else []


def search_hybrid(spark, sf_dir) -> DataFrame:
    return S.hybrid(chunks(spark, sf_dir), embeddings(spark, sf_dir), QUERY, query_vector(spark, sf_dir))


def search_filtered(spark, sf_dir) -> DataFrame:
    return S.hybrid(chunks(spark, sf_dir), embeddings(spark, sf_dir), "der die", query_vector(spark, sf_dir), "de", sources(spark, sf_dir), "commentary")


def search_page(spark, sf_dir) -> DataFrame:
    page = S.page_of(search_hybrid(spark, sf_dir), 20, 5)
    found = S.details(page, chunks(spark, sf_dir), sources(spark, sf_dir), footnotes(spark, sf_dir))
    return found.select("id", "title", "score", "citation", F.size("footnotes").alias("n_footnotes"), S.snippet(F.col("text")).alias("snippet"))


def search_lexical_topk(spark, sf_dir) -> DataFrame:
    return S.lexical_topk(chunks(spark, sf_dir), QUERY)


def search_vector_topk(spark, sf_dir) -> DataFrame:
    return S.vector_topk(embeddings(spark, sf_dir), query_vector(spark, sf_dir))


def chunk_snippet(spark, sf_dir) -> DataFrame:
    return chunks(spark, sf_dir).select("id", S.snippet(F.col("text")).alias("snippet"))


def chunk_with_footnotes(spark, sf_dir) -> DataFrame:
    nested = S.nested_footnotes(footnotes(spark, sf_dir))
    return chunks(spark, sf_dir).join(nested, F.col("id") == F.col("chunk_id"), "left").select("id", F.coalesce(F.array_join(F.transform("footnotes", lambda n: F.concat_ws(":", n["number"].cast("string"), n["text"])), "|"), F.lit("")).alias("footnotes"))


def recent_sources(spark, sf_dir) -> DataFrame:
    return sources(spark, sf_dir).orderBy(F.desc("created_at"), "id").limit(8).select("id", "title", "created_at")


def source_list_filtered(spark, sf_dir) -> DataFrame:
    return sources(spark, sf_dir).where("source_type = 'commentary'").select("id", "jurisdiction", "title")


def chunk_list_nulls_last(spark, sf_dir) -> DataFrame:
    return R.listing(chunks(spark, sf_dir), "src3", 50, 3).select("id", "page_start", "created_at")


def _items(spark, sf_dir) -> DataFrame:
    """Labelled documents as an upsert batch: new texts for known ids, and one new chunk for each label of quality 0."""
    c = chunks(spark, sf_dir)
    labels = read(spark, sf_dir, "labels")
    known = c.join(labels.select(F.col("doc_id").alias("id"), "quality"), "id")
    again = known.where("external_id is not null").withColumn("text", F.concat(F.lit("new "), F.col("citation"))).drop("quality")
    added = known.where("quality = 0").withColumns({"external_id": F.concat(F.lit("n"), F.col("id")), "id": -F.col("id") - 1}).drop("quality")
    return again.unionByName(added)


def upsert_chunks(spark, sf_dir) -> DataFrame:
    return R.upsert(chunks(spark, sf_dir), _items(spark, sf_dir)).select("id", "source_id", "external_id", F.char_length("text").alias("n"))


def _patches(spark, sf_dir) -> DataFrame:
    """A patch for every labelled document and as many unknown ones: a page for quality 1, null for quality 0."""
    labels = read(spark, sf_dir, "labels")
    page = F.when(F.col("quality") == 1, F.lit("7"))
    known = labels.select(F.concat(F.lit("x"), F.col("doc_id")).alias("external_id"), F.create_map(F.lit("page_start"), page).alias("present"))
    return known.unionByName(labels.select(F.concat(F.lit("z"), F.col("doc_id")).alias("external_id"), F.create_map(F.lit("citation"), F.lit("c")).alias("present")))


def patch_chunks_result(spark, sf_dir) -> DataFrame:
    return R.patched(chunks(spark, sf_dir), _patches(spark, sf_dir), "external_id", ("page_start", "citation")).select("external_id", "outcome", "page_start")


def patch_chunks_applied(spark, sf_dir) -> DataFrame:
    return R.apply_patches(chunks(spark, sf_dir), _patches(spark, sf_dir), "external_id", ("page_start", "citation")).select("id", "external_id", "page_start", "citation")


def delete_cascade(spark, sf_dir) -> DataFrame:
    gone = sources(spark, sf_dir).where("source_type = 'textbook'").select("id")
    s, c, n = R.delete_sources(sources(spark, sf_dir), chunks(spark, sf_dir), footnotes(spark, sf_dir), gone)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
    return count(s, "sources").unionByName(count(c, "chunks")).unionByName(count(n, "footnotes"))


QUERIES = {
    "search_hybrid": search_hybrid,
    "search_filtered": search_filtered,
    "search_page": search_page,
    "search_lexical_topk": search_lexical_topk,
    "search_vector_topk": search_vector_topk,
    "chunk_snippet": chunk_snippet,
    "chunk_neighbors": lambda s, d: S.neighbours(chunks(s, d)),
    "chunk_with_footnotes": chunk_with_footnotes,
    "chunk_list_nulls_last": chunk_list_nulls_last,
    "stats_by_jurisdiction": lambda s, d: R.by_jurisdiction(sources(s, d), chunks(s, d)),
    "corpus_stats_by_source": lambda s, d: R.by_source(sources(s, d), chunks(s, d)),
    "corpus_stats_rollup": lambda s, d: R.statistics(sources(s, d), chunks(s, d)),
    "empty_jurisdictions": lambda s, d: R.without_sources(sources(s, d), UNIVERSE),
    "distinct_jurisdictions": lambda s, d: sources(s, d).select("jurisdiction").distinct(),
    "recent_sources": recent_sources,
    "source_list_filtered": source_list_filtered,
    "source_violations": lambda s, d: R.source_violations(sources(s, d), ("commentary",)),
    "orphan_footnotes": lambda s, d: R.orphans(footnotes(s, d), chunks(s, d).where("id % 3 = 0"), "chunk_id").select("chunk_id", "number"),
    "upsert_chunks": upsert_chunks,
    "patch_chunks_result": patch_chunks_result,
    "patch_chunks_applied": patch_chunks_applied,
    "delete_cascade": delete_cascade,
}


def _lexical(terms: list[str], base: str = "chunks") -> str:
    tf = [f"len(list_filter(tokens, lambda t: t = '{t}'))::DOUBLE" for t in terms]
    score = " + ".join(f"({x} / (1 + {x}))" for x in tf)
    held = " AND ".join(f"list_contains(tokens, '{t}')" for t in terms)
    return rf"""(SELECT id, round({score}, 8) AS score FROM (
      SELECT id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS tokens FROM {base})
      WHERE {held} ORDER BY score DESC, id LIMIT 100)"""


def _vector(where: str = "") -> str:
    return f"""(SELECT vec_id AS id, round(1 - list_dot_product(embedding::DOUBLE[], q) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(q, q))), 8) AS distance
      FROM embeddings, (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0) {where} ORDER BY distance NULLS LAST, id LIMIT 100)"""


def _fused(lexical: str, vector: str) -> str:
    return f"""SELECT coalesce(l.id, v.id) AS id, round(coalesce(1.0::DOUBLE / (60 + lexical_rank), 0) + coalesce(1.0::DOUBLE / (60 + vector_rank), 0), 8) AS score, lexical_rank::INT AS lexical_rank, vector_rank::INT AS vector_rank
    FROM (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS lexical_rank FROM {lexical}) l
    FULL JOIN (SELECT id, row_number() OVER (ORDER BY distance NULLS LAST, id) AS vector_rank FROM {vector}) v ON l.id = v.id"""


_SNIPPET = r"""CASE WHEN length(flat) <= 220 THEN flat ELSE CASE WHEN instr(flat[1:220], ' ') > 0 THEN regexp_replace(flat[1:220], ' [^ ]*$', '') ELSE flat[1:220] END || '…' END"""
_FLAT = r"trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat"
_ITEMS = """known AS (SELECT c.*, quality FROM chunks c JOIN labels l ON c.id = l.doc_id),
items AS (SELECT id, source_id, external_id, 'new ' || citation AS text FROM known WHERE external_id IS NOT NULL
          UNION ALL SELECT -id - 1, source_id, 'n' || id, text FROM known WHERE quality = 0)"""
_PATCHES = """patches AS (SELECT 'x' || doc_id AS external_id, 'p' AS field, CASE WHEN quality = 1 THEN 7 END AS page FROM labels
            UNION ALL SELECT 'z' || doc_id, 'c', NULL FROM labels)"""

ORACLES = {
    "search_hybrid": f"WITH {CHUNKS} {_fused(_lexical(['and', 'of', 'the']), _vector())}",
    "search_filtered": f"WITH {CHUNKS}, {SOURCES}, base AS (SELECT c.* FROM chunks c JOIN sources s ON c.source_id = s.id WHERE c.jurisdiction = 'de' AND s.source_type = 'commentary') "
    + _fused(_lexical(["der", "die"], "base"), _vector("WHERE vec_id IN (SELECT id FROM base)")),
    "search_page": f"""WITH {CHUNKS}, {SOURCES}, {FOOTNOTES}, f AS ({_fused(_lexical(['and', 'of', 'the']), _vector())}),
p AS (SELECT * FROM f ORDER BY score DESC, lexical_rank NULLS LAST, vector_rank NULLS LAST, id LIMIT 20 OFFSET 5)
SELECT id, title, score, citation, n_footnotes, {_SNIPPET} AS snippet FROM (
  SELECT p.id, s.title, p.score, c.citation, (SELECT count(*) FROM footnotes n WHERE n.chunk_id = p.id)::INT AS n_footnotes, {_FLAT}
  FROM p JOIN chunks c ON c.id = p.id JOIN sources s ON s.id = c.source_id)""",
    "search_lexical_topk": f"WITH {CHUNKS} SELECT * FROM {_lexical(['and', 'of', 'the'])}",
    "search_vector_topk": f"SELECT * FROM {_vector()}",
    "chunk_snippet": f"SELECT doc_id AS id, {_SNIPPET} AS snippet FROM (SELECT doc_id, {_FLAT} FROM documents)",
    "chunk_neighbors": f"""WITH {CHUNKS}, k AS (SELECT id, source_id, coalesce(page_start, -1) AS p, created_at AS c FROM chunks),
g AS (SELECT source_id, p, c, min(id) AS least FROM k GROUP BY ALL),
o AS (SELECT *, lag(least) OVER w AS prev_id, lead(least) OVER w AS next_id FROM g WINDOW w AS (PARTITION BY source_id ORDER BY p, c))
SELECT k.id, prev_id, next_id FROM k JOIN o USING (source_id, p, c)""",
    "chunk_with_footnotes": f"""WITH {CHUNKS}, {FOOTNOTES}, n AS (SELECT chunk_id, string_agg(number || ':' || text, '|' ORDER BY number, text) AS footnotes FROM footnotes GROUP BY chunk_id)
SELECT id, coalesce(footnotes, '') AS footnotes FROM chunks LEFT JOIN n ON id = chunk_id""",
    "chunk_list_nulls_last": f"WITH {CHUNKS} SELECT id, page_start, created_at FROM chunks WHERE source_id = 'src3' ORDER BY page_start NULLS LAST, created_at, id LIMIT 50 OFFSET 3",
    "stats_by_jurisdiction": f"WITH {CHUNKS}, {SOURCES} SELECT s.jurisdiction, count(DISTINCT s.id) AS n_sources, count(c.id) AS n_chunks FROM sources s LEFT JOIN chunks c ON c.source_id = s.id GROUP BY 1",
    "corpus_stats_by_source": f"WITH {CHUNKS}, {SOURCES} SELECT s.jurisdiction, source_type, title, s.id, count(c.id) AS n_chunks FROM sources s LEFT JOIN chunks c ON c.source_id = s.id GROUP BY ALL",
    "corpus_stats_rollup": f"""WITH {CHUNKS}, {SOURCES} SELECT s.jurisdiction, source_type, s.id, count(c.id) AS n_chunks, bit_count(grouping_id(s.jurisdiction, source_type, s.id))::INT AS level
FROM sources s LEFT JOIN chunks c ON c.source_id = s.id GROUP BY ROLLUP (s.jurisdiction, source_type, s.id)""",
    "empty_jurisdictions": f"WITH {SOURCES} SELECT place::INT AS place, jurisdiction FROM (SELECT unnest({list(UNIVERSE)}) AS jurisdiction, unnest(range({len(UNIVERSE)})) AS place) WHERE jurisdiction NOT IN (SELECT jurisdiction FROM sources)",
    "distinct_jurisdictions": f"WITH {SOURCES} SELECT DISTINCT jurisdiction FROM sources",
    "recent_sources": f"WITH {SOURCES} SELECT id, title, created_at FROM sources ORDER BY created_at DESC, id LIMIT 8",
    "source_list_filtered": f"WITH {SOURCES} SELECT id, jurisdiction, title FROM sources WHERE source_type = 'commentary'",
    "source_violations": f"WITH {SOURCES} SELECT id, 'source_type' AS rule FROM sources WHERE source_type <> 'commentary'",
    "orphan_footnotes": "SELECT conv_id AS chunk_id, turn AS number FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 = 0)",
    "upsert_chunks": f"""WITH {CHUNKS}, {_ITEMS}
SELECT coalesce(c.id, i.id) AS id, coalesce(c.source_id, i.source_id) AS source_id, coalesce(c.external_id, i.external_id) AS external_id, length(coalesce(i.text, c.text))::INT AS n
FROM chunks c FULL JOIN items i ON c.source_id = i.source_id AND c.external_id = i.external_id""",
    "patch_chunks_result": f"""WITH {CHUNKS}, {_PATCHES}
SELECT p.external_id, CASE WHEN c.id IS NULL THEN 'missing' WHEN field = 'p' AND c.page_start IS DISTINCT FROM p.page THEN 'updated' ELSE 'unchanged' END AS outcome,
       CASE WHEN field = 'p' THEN p.page::BIGINT ELSE c.page_start END AS page_start
FROM patches p LEFT JOIN chunks c USING (external_id)""",
    "patch_chunks_applied": f"""WITH {CHUNKS}, {_PATCHES}
SELECT c.id, c.external_id, CASE WHEN p.field = 'p' THEN p.page::BIGINT ELSE c.page_start END AS page_start, c.citation FROM chunks c LEFT JOIN patches p USING (external_id)""",
    "delete_cascade": f"""WITH {CHUNKS}, {SOURCES}, {FOOTNOTES}, gone AS (SELECT id FROM sources WHERE source_type = 'textbook'), lost AS (SELECT id FROM chunks WHERE source_id IN (SELECT id FROM gone))
SELECT 'sources' AS relation, count(*) AS n FROM sources WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'chunks', count(*) FROM chunks WHERE id NOT IN (SELECT id FROM lost)
UNION ALL SELECT 'footnotes', count(*) FROM footnotes WHERE chunk_id NOT IN (SELECT id FROM lost)""",
}
