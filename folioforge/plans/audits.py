"""Queries on cards' sections and quality figures, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import qa, relational, sections
from folioforge.plans.settings import NTH, book_lines
from folioforge.sources.tables import CHUNKS, chunks, read


def chapter_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as cards; ten in a row are of one chapter, every fourth ten of none, and numbers go from 1 to 5 again and again."""
    n = F.col("n")
    name = F.get(F.array(*map(F.lit, ("Chapter one", "Chapter IV", "Chapter seven", "Preface"))), F.floor(n / 10).cast("int") % 4)
    return book_lines(spark, sf_dir).select("book_id", n.alias("at"), F.array(name).alias("hierarchy"), F.lit("Rn.").alias("unit"), (n % 5 + 1).cast("int").alias("number"), F.concat_ws(":", "book_id", F.lit("rn"), n.cast("string")).alias("external_id"))


def sections_renumbered(spark, sf_dir) -> DataFrame:
    return sections.sectioned(chapter_cards(spark, sf_dir), r"^Chapter (\w+)$", words=True, renumber=True).select("book_id", "at", "number", "section", "address", "external_id")


def sections_split(spark, sf_dir) -> DataFrame:
    return sections.sectioned(chapter_cards(spark, sf_dir), r"^Chapter (\w+)$", split_restarts=True).select("book_id", "at", "number", "section", "address", "external_id")


def cards_retyped(spark, sf_dir) -> DataFrame:
    number = (F.col("n") % 4).cast("int")
    cards = book_lines(spark, sf_dir).select("book_id", "n", F.lit("Rn.").alias("unit"), F.lit("Rn.").alias("unit_type"), number.alias("number"), number.cast("string").alias("unit_number"), F.when(F.col("n") % 3 != 0, "5").alias("section"), F.lit("a").alias("address"))
    return sections.retyped(cards, sectionless="Vorwort")


def tails_transferred(spark, sf_dir) -> DataFrame:
    """Four lines are a card and a page; on every third page a section begins, and of two such pages one shows its heading on
    the third line."""
    n, j = F.col("n"), F.expr("cast(n div 4 as int)")
    line = F.when((j % 6 == 2) & (n % 4 == 2), F.concat(F.lit("§ "), (F.expr("n div 12") + 2).cast("string"), F.lit(". "), "line")).otherwise(F.col("line"))
    of = book_lines(spark, sf_dir).select("book_id", j.alias("id"), "n", line.alias("line")).groupBy("book_id", "id").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("_l"))
    cards = of.select("book_id", "id", F.col("id").alias("page_start"), F.col("id").alias("page_end"), F.lit(0.05).alias("top"), F.array_join("_l.line", "\n").alias("text"))
    switches = cards.where("id % 3 = 2").select("book_id", F.col("id").alias("page"), F.when(F.col("id") % 12 == 2, 0.1).otherwise(0.5).alias("top"), (F.expr("id div 3") + 2).cast("string").alias("section"))
    return sections.transferred(cards, switches, r"§ {section}\.").select("book_id", "id", "page_start", "page_end", "text", "given")


def chunk_notes(spark, sf_dir) -> DataFrame:
    """Thirty lines are a chunk of three pages: its header, text with one number, in every other chunk a list's number too, and notes."""
    n = F.col("n")
    k = n % 30
    number = F.when((k >= 20) & (k % 2 == 0), F.expr("(n % 30 - 20) div 2 + 1")).when(k == 5, 7).when((k == 10) & (F.expr("n div 30") % 2 == 1), 2)
    text = F.when(k == 0, "Export 1").otherwise(F.coalesce(F.concat(number.cast("string"), F.lit(". "), "line"), F.concat(F.lit("x "), "line")))
    lines = book_lines(spark, sf_dir).select("book_id", F.expr("cast(n div 10 as int)").alias("page_seq"), n.alias("line_no"), text.alias("text"))
    return sections.chunk_notes(lines, r"^Export \d").select("book_id", "line_no", "chunk", "is_note")


def notes_to_body(spark, sf_dir) -> DataFrame:
    n = F.col("n")
    lines = book_lines(spark, sf_dir).select("book_id", "n", (n % 10 >= 7).alias("is_note"), F.when(n % 10 == 8, "12.").otherwise(F.col("line")).alias("text"), F.when(n % 3 == 0, 5.0).when(n % 3 == 1, 4.5).alias("size"))
    return sections.notes_to_body(lines, 4.8).select("book_id", "n", "is_note", "moved")


def tallies(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("bucket", F.nullif(F.col("n_chars") % 4, F.lit(3)))
    return qa.tallies(docs, ["lang"], ["source", "bucket"])


def look_first(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumns({"external_id": F.concat_ws(":", "source", (F.col("n_chars") % 40).cast("string")), "text": F.translate("text", "\n", "\x02"), "note_numbers": F.when(F.col("doc_id") % 5 != 0, F.array(F.nullif(F.col("doc_id") % 3, F.lit(0)), F.lit(1)))})
    return qa.look_first(docs, ["lang"])


def against_expected(spark, sf_dir) -> DataFrame:
    """What `labels` says of the documents against how many there are, by source and language; one language is unknown."""
    docs = read(spark, sf_dir, "documents")
    known = docs.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").withColumn("lang", F.when(F.col("lang") == "de", "xx").otherwise(F.col("lang")))
    return qa.against_expected(docs, known.groupBy("source", "lang").agg(F.count("*").alias("expected")), ["source"], "lang")


def card_places(spark, sf_dir) -> DataFrame:
    c = chunks(spark, sf_dir).withColumn("top", F.when(F.col("id") % 5 != 0, F.col("id") % 7 / 10.0))
    place = Window.partitionBy("source_id").orderBy(relational.card_place(F.col("page_start"), F.col("top")), "id")
    return c.select("id", F.row_number().over(place).alias("place"))


def vectors_parsed(spark, sf_dir) -> DataFrame:
    """Of seven vectors one is cut off, one is short, one has a word in it."""
    text, k = F.to_json("embedding"), F.col("vec_id") % 7
    sent = F.when(k == 0, F.substring(text, 1, 9)).when(k == 1, "[0.5]").when(k == 2, F.regexp_replace(text, r"^\[[^,]*", '["x"')).otherwise(text)
    dims = read(spark, sf_dir, "embeddings").select(F.max(F.size("embedding"))).first()[0] or 0
    v = read(spark, sf_dir, "embeddings").select("vec_id", relational.vector_of(sent, dims).alias("v"))
    return v.select("vec_id", F.when(F.col("v").isNotNull(), F.size("v")).alias("dims"))


def printed_page_batches(spark, sf_dir) -> DataFrame:
    cards = chunks(spark, sf_dir).withColumns({"printed_page_start": F.col("page_start"), "printed_page_end": F.col("page_start") + 1})
    return relational.printed_page_batches(cards, ["source_id"], "id", 20)


QUERIES = {
    "sections_renumbered": sections_renumbered,
    "sections_split": sections_split,
    "cards_retyped": cards_retyped,
    "tails_transferred": tails_transferred,
    "chunk_notes": chunk_notes,
    "notes_to_body": notes_to_body,
    "tallies": tallies,
    "voted": lambda s, d: qa.voted(read(s, d, "documents"), ["source"], "lang", "doc_id"),
    "look_first": look_first,
    "against_expected": against_expected,
    "rising_share": lambda s, d: qa.rising_share(read(s, d, "events"), ["user_id"], ["ts", "event_id"], "value"),
    "card_places": card_places,
    "vectors_parsed": vectors_parsed,
    "printed_page_batches": printed_page_batches,
}

CHAPTERS = f"""{NTH}, c AS (SELECT book_id, n, n % 5 + 1 AS number, (n // 10) % 4 AS ch FROM nth), k AS (SELECT *, row_number() OVER (PARTITION BY book_id, ch ORDER BY n) AS k FROM c)"""
_NAMED = """CASE WHEN ch < 3 THEN 'Rn ' || section || '-' || number END AS address, book_id || ':rn:' || CASE WHEN ch < 3 THEN section || '/' || number ELSE n::VARCHAR END AS external_id"""

ORACLES = {
    "sections_renumbered": f"""WITH {CHAPTERS}, s AS (SELECT book_id, n, ch, CASE WHEN ch < 3 THEN k ELSE number END::INT AS number, CASE ch WHEN 0 THEN '1' WHEN 1 THEN '4' WHEN 2 THEN '7' END AS section FROM k)
SELECT book_id, n::INT AS "at", number, section, {_NAMED} FROM s""",
    "sections_split": f"""WITH {CHAPTERS}, s AS (SELECT book_id, n, ch, number::INT AS number, CASE ch WHEN 0 THEN 'one' WHEN 1 THEN 'IV' WHEN 2 THEN 'seven' END || CASE WHEN k > 5 THEN '.' || ((k - 1) // 5 + 1) ELSE '' END AS section FROM k)
SELECT book_id, n::INT AS "at", number, section, {_NAMED} FROM s""",
    "cards_retyped": f"""WITH {NTH}, s AS (SELECT *, CASE WHEN n % 3 = 0 THEN 'Vorwort' WHEN n % 4 = 0 THEN 'Vorspann' ELSE 'Rn.' END AS unit, n % 3 = 0 AS loose FROM nth)
SELECT book_id, n::INT AS n, unit, unit AS unit_type, CASE WHEN NOT loose THEN (n % 4)::INT END AS number, CASE WHEN loose THEN '' ELSE (n % 4)::VARCHAR END AS unit_number, CASE WHEN NOT loose THEN '5' END AS section, CASE WHEN loose THEN 'Vorwort' ELSE 'a' END AS address FROM s""",
    "tails_transferred": f"""WITH {NTH}, l AS (SELECT book_id, n, (n // 4)::INT AS id, CASE WHEN (n // 4) % 6 = 2 AND n % 4 = 2 THEN '§ ' || (n // 12 + 2) || '. ' || line ELSE line END AS line FROM nth),
c AS (SELECT book_id, id, string_agg(line, chr(10) ORDER BY n) FILTER (n % 4 < 2) AS head, string_agg(line, chr(10) ORDER BY n) FILTER (n % 4 >= 2) AS rest, string_agg(line, chr(10) ORDER BY n) AS text FROM l GROUP BY ALL),
k AS (SELECT *, coalesce(id % 6 = 2 AND rest IS NOT NULL AND length(head) + 1 >= 20 AND lead(id) OVER (PARTITION BY book_id ORDER BY id) IS NOT NULL, false) AS cut FROM c),
g AS (SELECT *, lag(CASE WHEN cut THEN rest END) OVER w AS got, lag(CASE WHEN cut THEN id END) OVER w AS of_ FROM k WINDOW w AS (PARTITION BY book_id ORDER BY id))
SELECT book_id, id, least(id, of_)::INT AS page_start, CASE WHEN cut AND id % 12 = 2 THEN id - 1 ELSE id END::INT AS page_end, CASE WHEN got IS NULL THEN '' ELSE got || chr(10) END || CASE WHEN cut THEN head ELSE text END AS text, CASE WHEN cut THEN length(rest) END::INT AS given FROM g""",
    "chunk_notes": f"""WITH {NTH}, c AS (SELECT book_id, n, n % 30 AS k, n // 30 AS chunk, CASE WHEN n % 30 >= 20 AND n % 2 = 0 THEN (n % 30 - 20) // 2 + 1 WHEN n % 30 = 5 THEN 7 WHEN n % 30 = 10 AND (n // 30) % 2 = 1 THEN 2 END AS num FROM nth),
s AS (SELECT a.book_id, a.chunk, min(a.n) AS start FROM c a JOIN c b ON a.book_id = b.book_id AND a.chunk = b.chunk AND b.num = a.num + 1 AND b.n > a.n GROUP BY ALL)
SELECT c.book_id, n::INT AS line_no, chunk + 1 AS chunk, coalesce(n >= start, false) AS is_note FROM c LEFT JOIN s USING (book_id, chunk) WHERE k > 0""",
    "notes_to_body": f"""WITH {NTH}, s AS (SELECT book_id, n, n % 10 >= 7 AS note, n % 10 >= 7 AND n % 3 = 1 AND n % 10 <> 8 AND NOT regexp_matches(line, '^[0-9\\s.)]+$') AS moved FROM nth)
SELECT book_id, n::INT AS n, note AND NOT moved AS is_note, moved FROM s""",
    "tallies": """SELECT lang, 'source' AS "column", source AS value, count(*) AS n FROM documents GROUP BY lang, source UNION ALL SELECT lang, 'bucket', nullif(n_chars % 4, 3)::VARCHAR, count(*) FROM documents GROUP BY lang, n_chars % 4""",
    "voted": "SELECT source, lang, votes FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY votes DESC, first) AS k FROM (SELECT source, lang, count(*) AS votes, min(doc_id) AS first FROM documents WHERE lang IS NOT NULL GROUP BY ALL)) WHERE k = 1",
    "look_first": r"""WITH i AS (SELECT lang, count(source || ':' || (n_chars % 40)) AS k, sum(length(regexp_replace(text, '[^\x00-\x08\x0A-\x0C\x0E-\x1F]', '', 'g'))) AS c, sum(CASE WHEN doc_id % 5 <> 0 AND doc_id % 3 = 0 THEN 1 ELSE 0 END) AS u FROM documents GROUP BY lang, source || ':' || (n_chars % 40))
SELECT lang, coalesce(sum(c), 0)::BIGINT AS control_characters, sum(greatest(k - 1, 0))::BIGINT AS id_collisions, sum(u)::BIGINT AS unnumbered_notes FROM i GROUP BY lang""",
    "against_expected": """WITH k AS (SELECT source, CASE WHEN lang = 'de' THEN 'xx' ELSE lang END AS lang, count(*) AS expected FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY ALL),
h AS (SELECT source, lang, count(*) AS cards FROM documents GROUP BY ALL)
SELECT source, lang, coalesce(cards, 0) AS cards, coalesce(expected, 0) AS expected, coalesce(cards, 0) = coalesce(expected, 0) AS fits FROM h FULL JOIN k USING (source, lang)""",
    "rising_share": """SELECT user_id, count(b) AS steps, round(avg(CASE WHEN b IS NOT NULL THEN (value > b)::INT END), 4) AS share FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events WHERE value IS NOT NULL) GROUP BY user_id""",
    "card_places": f"WITH {CHUNKS} SELECT id, (row_number() OVER (PARTITION BY source_id ORDER BY coalesce(page_start, 1000000), CASE WHEN id % 5 <> 0 THEN id % 7 / 10.0 ELSE 0 END, id))::INT AS place FROM chunks",
    "vectors_parsed": "SELECT vec_id, CASE WHEN vec_id % 7 > 2 THEN len(embedding)::INT END AS dims FROM embeddings",
    "printed_page_batches": f"WITH {CHUNKS} SELECT source_id, id, page_start AS printed_page_start, page_start + 1 AS printed_page_end, (row_number() OVER (PARTITION BY source_id ORDER BY id) - 1) // 20 AS batch FROM chunks WHERE page_start IS NOT NULL",
}
