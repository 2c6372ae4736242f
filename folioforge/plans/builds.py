"""Queries of the composed build: documents printed as books, from their glyphs to cards and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import contents, probe
from folioforge.plans import build as B
from folioforge.sources import setting
from folioforge.sources.tables import read

PROFILE = B.Profile.of({
    "id": "printed",
    "language": "en",
    "units": [{"type": "Rn.", "id_prefix": "rn", "pattern": r"# (\d+) "}],
    "address": {"section": {"mode": "pattern", "pattern": r"Chapter (\d+): "}, "template": "{section_prefix}{unit_type} {number}"},
    "citation": {"template": "{title} ({year}), {address}"},
})


def printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, n, page_seq, line): a document is a book, its lines with words are printed ten to a page.

    The last two lines of a page are small and are notes 1 and 2. Of the others every third opens a numbered unit, and of
    every twelve the second opens a chapter. In every tenth book the last unit has the number of the one before it.
    """
    line = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    line = line.withColumn("line", F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " "))).where("line <> ''")
    line = line.withColumn("n", F.row_number().over(Window.partitionBy("book_id").orderBy("i")) - 1)
    unit, note = F.expr("n % 10 < 8 and n % 3 = 0"), F.expr("n % 10 >= 8")
    count = F.sum(F.when(unit, 1).otherwise(0))
    k, last = count.over(Window.partitionBy("book_id").orderBy("n")), count.over(Window.partitionBy("book_id"))
    number = k - F.when((F.col("book_id") % 10 == 7) & (k == last) & (k > 1), 1).otherwise(0)
    text = F.when(note, F.concat((F.col("n") % 10 - 7).cast("string"), F.lit(". "), "line")).when(unit, F.concat(F.lit("# "), number.cast("string"), F.lit(" "), "line"))
    text = text.when(F.expr("n % 12 = 1"), F.concat(F.lit("Chapter "), F.expr("n div 12 + 1").cast("string"), F.lit(": "), "line")).otherwise(F.col("line"))
    return line.select("book_id", "n", F.expr("cast(n div 10 as int)").alias("page_seq"), text.alias("line"))


def glyphs_of(book: DataFrame) -> DataFrame:
    """The books' pages of glyphs, with a folio at the foot of each. Spaces are gaps."""
    line = lambda text, top, size: F.struct(text.alias("text"), top.alias("top"), size.alias("size"), F.lit(False).alias("spaced"))
    lines = F.array_sort(F.collect_list(F.struct(F.col("n"), "line")))
    body = F.transform("_l", lambda x: line(x["line"], 60.0 + (x["n"] % 10) * 56.0, F.when(x["n"] % 10 >= 8, 7.0).otherwise(10.0)))
    folio = F.array(line((F.col("page_seq") + 1).cast("string"), F.lit(680.0), F.lit(10.0)))
    pages = book.groupBy("book_id", "page_seq").agg(lines.alias("_l"))
    return setting.glyphs_of(pages.select("book_id", "page_seq", F.concat(body, folio).alias("lines")))


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(glyphs, pages, meta) of the printed documents."""
    book = printed(spark, sf_dir)
    pages = book.select("book_id", "page_seq").distinct().withColumns({"width": F.lit(5e5), "height": F.lit(700.0)})
    meta = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.col("source").alias("title"), F.col("lang").alias("year"))
    return glyphs_of(book), pages, meta


def build_cards(spark, sf_dir) -> DataFrame:
    cards = B.build(*inputs(spark, sf_dir), PROFILE).cards
    notes = F.array_join(F.transform("footnotes", lambda n: F.concat(n["page"].cast("string"), F.lit(":"), n["number"].cast("string"))), ",")
    where = ["page_start", "page_end", "printed_page_start", "printed_page_end", "char_start", "char_end"]
    return cards.select("book_id", "external_id", "number", "section", "address", "citation", "text", notes.alias("notes"), *where)


def build_report(spark, sf_dir) -> DataFrame:
    glyphs, pages, meta = inputs(spark, sf_dir)
    figures = B.report(B.build(glyphs, pages, meta, PROFILE), meta)
    return figures.select("book_id", "cards", "footnotes", "duplicates", "missing", "continuity", "book_chars", "coverage", "unreadable", "cards_without_offsets", "absorbed_units", F.array_join("stops", ",").alias("stops"))


def build_released(spark, sf_dir) -> DataFrame:
    """The standard pipeline: books with an address twice are held back."""
    cards, _ = B.standard(*inputs(spark, sf_dir), PROFILE, strict=False)
    return cards.select("book_id", "external_id", "text_reflowed")


def typeset(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(lines, numbers): the printed books' lines, a page's first one apart at its top and a folio apart at its foot; every
    fourth line has a number left of it, every seventh one right."""
    book = printed(spark, sf_dir)
    at = F.col("n") % 10
    line = book.select("book_id", "page_seq", at.cast("int").alias("line_no"), F.col("line").alias("text"), F.lit(100.0).alias("x0"), (100 + 5.0 * F.char_length("line")).alias("x1"), F.when(at == 0, 10.0).otherwise(60 + 40.0 * at).alias("top"), F.when(at >= 8, 7.0).otherwise(10.0).alias("size"))
    folio = book.select("book_id", "page_seq").distinct().select("*", F.lit(10).alias("line_no"), (F.col("page_seq") + 1).cast("string").alias("text"), F.lit(300.0).alias("x0"), F.lit(310.0).alias("x1"), F.lit(680.0).alias("top"), F.lit(10.0).alias("size"))
    left = book.where("n % 4 = 0").select("book_id", "page_seq", F.lit("7").alias("text"), F.lit(40.0).alias("x0"), F.lit(50.0).alias("x1"))
    right = book.where("n % 7 = 0").select("book_id", "page_seq", F.lit("8").alias("text"), F.lit(1e6).alias("x0"), F.lit(1e6).alias("x1"))
    return line.unionByName(folio).withColumns({"bottom": F.col("top") + 10.0, "height": F.lit(700.0)}), left.unionByName(right)


def layout_probe(spark, sf_dir) -> DataFrame:
    return probe.probed(*typeset(spark, sf_dir)).select("book_id", "pages", "body_size", "folios", "margin_left", "margin_right", "header_band", "bottom_band", "note_size_max", "folio_band")


def contents_entries(spark, sf_dir) -> DataFrame:
    """The documents' lines as two-column contents: the numbers stand a point lower, and every third line has none."""
    book = printed(spark, sf_dir).withColumn("line", F.regexp_replace("line", "[.]", "")).where("line <> ''")
    top = (F.col("n") % 10) * 20.0
    left = book.select("book_id", "page_seq", F.concat(F.lit("§ "), F.col("n").cast("string"), F.lit(". x"), F.col("line")).alias("text"), F.lit(100.0).alias("x0"), top.alias("top"))
    right = book.where("n % 3 <> 2").select("book_id", "page_seq", (F.col("n") + 1).cast("string").alias("text"), F.lit(500.0).alias("x0"), (top + 4.0).alias("top"))
    found = contents.entries(left.unionByName(right), 400.0, [(r"§\s*(\d+)\.\s*", "paragraph", 1)])
    return found.select("book_id", "page_seq", "depth", "marker", "number", F.char_length("title").alias("n_title"), "printed_page", "inherited")


QUERIES = {"contents_entries": contents_entries, "layout_probe": layout_probe, "build_cards": build_cards, "build_report": build_report, "build_released": build_released}

PRINTED = r"""raw AS (SELECT doc_id AS book_id, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS line, i
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)),
nth AS (SELECT book_id, line, row_number() OVER (PARTITION BY book_id ORDER BY i) - 1 AS n FROM raw WHERE line <> ''),
kinds AS (SELECT *, n % 10 >= 8 AS note, n % 10 < 8 AND n % 3 = 0 AS opens, n // 10 AS page FROM nth),
counted AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY book_id ORDER BY n) AS unit, count(*) FILTER (opens) OVER (PARTITION BY book_id) AS units FROM kinds),
typed AS (SELECT *, unit - CASE WHEN book_id % 10 = 7 AND unit = units AND unit > 1 THEN 1 ELSE 0 END AS number, NOT note AND NOT opens AND n % 12 = 1 AS heads FROM counted),
body AS (SELECT *, CASE WHEN opens THEN '# ' || number || ' ' || line WHEN heads THEN 'Chapter ' || (n // 12 + 1) || ': ' || line ELSE line END AS text FROM typed WHERE NOT note),
placed AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY book_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
  last_value(CASE WHEN heads THEN (n // 12 + 1)::VARCHAR END IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM body),
cards AS (SELECT book_id, unit, any_value(number) FILTER (opens) AS number, any_value(section) FILTER (opens) AS section, string_agg(CASE WHEN opens THEN line ELSE text END, chr(10) ORDER BY n) AS text,
  min(page)::INT AS page_start, max(page)::INT AS page_end, min(start) + length('# ' || any_value(number) FILTER (opens) || ' ') AS char_start, max(start + length(text)) AS char_end
  FROM placed WHERE unit > 0 GROUP BY book_id, unit),
shown AS (SELECT book_id, unit, page, max(start + length(text)) - min(start) AS chars FROM placed WHERE unit > 0 GROUP BY ALL),
notes AS (SELECT book_id, page, n % 10 - 7 AS number FROM typed WHERE note),
claims AS (SELECT n.book_id, n.page, n.number, c.unit, s.chars, count(*) OVER (PARTITION BY n.book_id, n.page, n.number) > 1 AND regexp_matches(c.text, '(^|[^0-9])' || n.number || '($|[^0-9])') AS marked
  FROM notes n JOIN shown s ON n.book_id = s.book_id AND n.page = s.page JOIN cards c ON c.book_id = s.book_id AND c.unit = s.unit),
given AS (SELECT *, row_number() OVER (PARTITION BY book_id, page, number ORDER BY marked DESC, CASE WHEN NOT marked THEN chars END DESC, unit) AS k FROM claims),
own AS (SELECT book_id, unit, string_agg(page || ':' || number, ',' ORDER BY page, number) AS notes, count(*) AS footnotes FROM given WHERE k = 1 GROUP BY ALL),
ids AS (SELECT c.*, c.book_id || ':rn:' || CASE WHEN section IS NULL THEN '' ELSE section || '/' END || number AS external_id,
  CASE WHEN section IS NULL THEN '' ELSE '§ ' || section || ' ' END || 'Rn. ' || number AS address, coalesce(notes, '') AS notes, coalesce(footnotes, 0) AS footnotes FROM cards c LEFT JOIN own USING (book_id, unit)),
twice AS (SELECT book_id, count(*) AS duplicates FROM (SELECT book_id, external_id FROM ids GROUP BY ALL HAVING count(*) > 1) GROUP BY book_id)"""

ORACLES = {
    "contents_entries": f"""WITH {PRINTED}, set_ AS (SELECT book_id, page, n, replace(CASE WHEN note THEN (n % 10 - 7) || '. ' || line WHEN opens THEN '# ' || number || ' ' || line WHEN heads THEN 'Chapter ' || (n // 12 + 1) || ': ' || line ELSE line END, '.', '') AS text FROM typed),
tail AS (SELECT *, CASE WHEN n % 3 = 2 THEN nullif(regexp_extract(rtrim(text), '\\s([0-9]{{1,4}})$', 1), '') END AS last FROM set_ WHERE text <> ''),
e AS (SELECT * REPLACE (CASE WHEN last IS NULL THEN text ELSE regexp_replace(rtrim(text), '\\s[0-9]{{1,4}}$', '') END AS text), CASE WHEN n % 3 <> 2 THEN n + 1 ELSE last::INT END AS own FROM tail)
SELECT book_id, page::INT AS page_seq, 1 AS depth, 'paragraph' AS marker, n::VARCHAR AS number, length(trim('x' || text))::INT AS n_title,
first_value(own IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::INT AS printed_page, own IS NULL AS inherited FROM e""",
    "layout_probe": f"""WITH {PRINTED}, set_ AS (SELECT book_id, page, n, CASE WHEN note THEN (n % 10 - 7) || '. ' || line WHEN opens THEN '# ' || number || ' ' || line WHEN heads THEN 'Chapter ' || (n // 12 + 1) || ': ' || line ELSE line END AS text FROM typed),
l AS (SELECT book_id, page, n % 10 AS k, text, 100 + 5.0::DOUBLE * length(text) AS x1, CASE WHEN n % 10 = 0 THEN 10 ELSE 60 + 40 * (n % 10) END AS top, CASE WHEN n % 10 >= 8 THEN 7.0 ELSE 10.0 END AS size FROM set_
  UNION ALL SELECT DISTINCT book_id, page, 10, (page + 1)::VARCHAR, 310.0, 680, 10.0 FROM set_),
many AS (SELECT *, count(*) OVER (PARTITION BY book_id, page) AS lines FROM l), used AS (SELECT * FROM many WHERE lines >= 5),
mode AS (SELECT book_id, arg_max(size, (chars, -size)) AS body_size FROM (SELECT book_id, size, sum(length(text)) AS chars FROM used GROUP BY ALL) GROUP BY book_id),
edge AS (SELECT book_id, page, median(x1) AS r, max(lines) AS lines FROM used JOIN mode USING (book_id) WHERE abs(size - body_size) < 0.4 AND length(text) > 40 GROUP BY ALL),
gap AS (SELECT u.*, lead(top) OVER w - top - 10 AS after, top - lag(top) OVER w - 10 AS before FROM used u WINDOW w AS (PARTITION BY book_id, page ORDER BY top)),
cut AS (SELECT book_id, page, greatest(0, median(after)) + 4 AS cut FROM gap GROUP BY ALL),
flags AS (SELECT g.*, body_size, bool_and(coalesce(after > cut, false)) OVER (PARTITION BY book_id, page ORDER BY top) AS head, bool_and(coalesce(before > cut, false)) OVER (PARTITION BY book_id, page ORDER BY top DESC) AS foot
  FROM gap g JOIN cut USING (book_id, page) JOIN edge USING (book_id, page) JOIN mode USING (book_id)),
ends AS (SELECT *, max(CASE WHEN head OR NOT foot THEN top + 10 END) OVER (PARTITION BY book_id, page) AS b, min(CASE WHEN NOT head THEN top END) OVER (PARTITION BY book_id, page) AS t FROM flags),
p AS (SELECT book_id, page, any_value(body_size) AS body_size, max(top / 700.0) FILTER (head) AS head, min(t / 700.0) AS body, min((top + 8) / 700.0) FILTER (foot AND NOT head) AS foot,
  min(top / 700.0) FILTER (top > b - 0.25 * CASE WHEN b > t THEN b - t ELSE 700 END AND size < body_size - 0.6 AND length(text) > 25) AS note,
  median(size) FILTER (top > b - 0.25 * CASE WHEN b > t THEN b - t ELSE 700 END AND size < body_size - 0.6 AND length(text) > 25) AS note_size,
  count(*) FILTER (foot AND NOT head AND regexp_matches(trim(text), '^[0-9]{{1,4}}$')) AS folios FROM ends GROUP BY ALL),
m AS (SELECT s.book_id, count(*) FILTER (n % 4 = 0) AS margin_left, count(*) FILTER (n % 7 = 0) AS margin_right FROM set_ s JOIN p USING (book_id, page) GROUP BY ALL)
SELECT book_id, count(*) AS pages, any_value(body_size)::DOUBLE AS body_size, sum(folios)::BIGINT AS folios, any_value(margin_left) AS margin_left, any_value(margin_right) AS margin_right,
round(coalesce((max(head) + min(body)) / 2, 0.06), 3)::DOUBLE AS header_band, round(coalesce(min(note) - 0.03, 0.7), 2)::DOUBLE AS bottom_band, round(median(note_size) + 0.2, 1)::DOUBLE AS note_size_max, round(coalesce(1 - min(foot), 0.1), 2)::DOUBLE AS folio_band
FROM p JOIN m USING (book_id) GROUP BY book_id""",
    "build_cards": f"""WITH {PRINTED} SELECT i.book_id, external_id, number::INT AS number, section, address, source || ' (' || lang || '), ' || address AS citation, i.text, notes,
page_start, page_end, page_start + 1 AS printed_page_start, page_end + 1 AS printed_page_end, char_start, char_end FROM ids i JOIN documents ON doc_id = book_id""",
    "build_report": f"""WITH {PRINTED}, size AS (SELECT book_id, max(start + length(text)) AS book_chars FROM placed GROUP BY book_id),
steps AS (SELECT book_id, number, lead(number) OVER (PARTITION BY book_id, section ORDER BY number) AS after FROM (SELECT DISTINCT book_id, section, number FROM ids)),
lost AS (SELECT book_id, coalesce(sum(after - number - 1), 0)::BIGINT AS missing FROM steps GROUP BY book_id),
sums AS (SELECT book_id, count(*) AS cards, sum(footnotes)::BIGINT AS footnotes, sum(char_end - char_start) AS covered FROM ids GROUP BY book_id),
f AS (SELECT doc_id AS book_id, coalesce(cards, 0) AS cards, coalesce(footnotes, 0) AS footnotes, coalesce(duplicates, 0) AS duplicates, coalesce(missing, 0) AS missing,
  round(cards / (cards + missing), 4) AS continuity, book_chars, round(covered / book_chars, 4) AS coverage FROM documents d
  LEFT JOIN sums ON sums.book_id = doc_id LEFT JOIN twice ON twice.book_id = doc_id LEFT JOIN lost ON lost.book_id = doc_id LEFT JOIN size ON size.book_id = doc_id)
SELECT *, 0 AS unreadable, 0 AS cards_without_offsets, 0 AS absorbed_units, concat_ws(',', CASE WHEN cards = 0 THEN 'no_cards' END, CASE WHEN continuity < 0.98 THEN 'continuity' END,
  CASE WHEN coverage < 0.9 THEN 'coverage' END, CASE WHEN duplicates > 0 THEN 'duplicates' END) AS stops FROM f""",
    "build_released": f"WITH {PRINTED} SELECT book_id, external_id, true AS text_reflowed FROM ids WHERE book_id NOT IN (SELECT book_id FROM twice)",
}
