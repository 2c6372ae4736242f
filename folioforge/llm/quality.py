"""Quality rules with distribution divergence; native DataFrame operations only.

Base rules count words, symbols, repeated lines and repeated three-word windows. On top of them a document's histograms
(character classes, and the most common words of its language) are compared with those of all documents of the language
by the Jensen-Shannon distance (base 2, so between 0 and 1). Short texts differ by chance, so nothing below a minimum
length is judged, and the limit for words falls with the square root of the length.

Everything about a document is computed inside its row, so texts are never shuffled; the references are sums of a few
counters for each listed language. Three-word windows are sorted by a hash of 63 bits less those that their position needs,
53 for a text of a thousand words, and neighbours of one hash are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table

#: The most common words of each language.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf".split(),
    "en": "the of and to in a is that it for was with".split(),
    "es": "de la que el en y los se las del un por".split(),
    "fr": "de la le et les des en un du une que pour".split(),
}
#: Words that a text must have to be judged by either histogram.
LEAST_WORDS = 50
#: Distances from which on a text is rejected: for classes; for words, with LENGTH_SHARE / sqrt(n_words) added.
MOST_CLASSES, MOST_WORDS, LENGTH_SHARE = 0.30, 0.10, 1.5
SPACE = r"[\x20\x09-\x0D]+"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "other")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _rest(text: Column, pattern: str) -> Column:
    """Characters that the pattern takes out of a text."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _mask(words: Column) -> Column:
    """All bits but the low ones that a position in the text needs."""
    return F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.length(F.bin(F.size(words).cast("bigint"))).cast("int"))


def sorted_windows(words: Column, mask: Column) -> Column:
    """Every three-word window as one number, its hash above its position, in order: equal windows are neighbours."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.sort_array(F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(mask).bitwiseOR(i.cast("bigint"))))


def repeated_words(windows: Column, mask: Column, words: Column) -> Column:
    """Words inside the three-word windows that occur twice or more, from sorted_windows.

    Neighbours of one hash are compared word by word. Where they differ the next but one is compared too, so that a
    window of the same hash between two equal ones hides nothing.
    """
    place = lambda x: x.bitwiseAND(F.bitwise_not(mask)).cast("int")

    def same(x: Column, y: Column) -> Column:
        equal = F.lit(True)
        for k in range(3):
            equal = equal & (F.get(words, place(x) + k) == F.get(words, place(y) + k))
        return (x.bitwiseXOR(y).bitwiseAND(mask) == 0) & equal

    def both(x: Column, j: Column) -> Column:
        after, next_one = F.get(windows, j + 1), F.get(windows, j + 2)
        near = x.bitwiseXOR(after).bitwiseAND(mask) == 0
        return F.when(near, F.when(same(x, after), F.array(place(x), place(after))).when(same(x, next_one), F.array(place(x), place(next_one))))

    at = F.array_sort(F.array_distinct(F.flatten(F.array_compact(F.transform(windows, both)))))
    none = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(at, none, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])


def _class_counts(text: Column) -> Column:
    lower, upper, digit, space, symbol = (_rest(text, p) for p in (r"\p{Ll}+", r"\p{Lu}+", r"[0-9]+", SPACE, r"[#*$%&|<>]+"))
    return F.array(*[c.cast("double") for c in (lower, upper, digit, space, symbol, F.char_length(text) - lower - upper - digit - space - symbol)])


def _common_of(lang: Column) -> Column:
    out = F.when(F.lit(False), F.array(F.lit("")))
    for name, words in COMMON.items():
        out = out.when(lang == name, F.array(*map(F.lit, words)))
    return out


def _word_counts(text: Column, common: Column) -> Column:
    """How often each common word of the language occurs, and how many other words there are."""
    tokens = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D.,]+"), "")
    pair = F.array(F.struct(F.size(tokens).alias("all"), F.filter(tokens, lambda w: F.array_contains(common, w)).alias("held")))

    def counts(x: Column) -> Column:
        each = F.transform(common, lambda w: (F.size(x["held"]) - F.size(F.array_remove(x["held"], w))).cast("double"))
        return F.concat(each, F.array((x["all"] - F.size(x["held"])).cast("double")))

    return F.get(F.transform(pair, counts), F.lit(0))


def measures(documents: DataFrame, text: str = "text", lang: str = "lang", base: bool = True) -> DataFrame:
    """`documents` with the base counts and own columns for the class and word counts; word counts are null for languages not listed."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = documents.withColumns({own("classes"): _class_counts(t), own("common"): _common_of(F.col(lang))}).withColumn(own("tokens"), F.when(F.col(own("common")).isNotNull(), _word_counts(t, F.col(own("common")))))
    if not base:
        return out.drop(own("common"))
    words, mask = F.col(own("words")), F.col(own("mask"))
    out = out.withColumns({own("words"): words_of(t), own("lines"): F.filter(F.split(t, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))})
    out = out.withColumn(own("mask"), _mask(words)).withColumn(own("windows"), sorted_windows(words, mask))
    return out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size(own("lines")) - F.size(F.array_distinct(own("lines")))).cast("long"),
            "n_repeat_words": F.when(F.size(own("windows")) > 1, repeated_words(F.col(own("windows")), mask, words)).otherwise(F.lit(0).cast("long")),
        }
    ).drop(*[own(c) for c in ("common", "words", "lines", "mask", "windows")])


def references(measured: DataFrame, lang: str = "lang") -> dict[str, tuple[list[float], list[float]]]:
    """For each listed language that occurs, the class and word counts of all its documents: a row of 19 sums each."""
    classes, tokens = own("classes"), own("tokens")
    sums = [F.sum(F.col(classes)[i]).alias(f"c{i}") for i in range(len(CLASSES))] + [F.sum(F.col(tokens)[i]).alias(f"t{i}") for i in range(13)]
    rows = measured.where(F.col(lang).isin(*COMMON)).groupBy(lang).agg(*sums).collect()
    return {r[lang]: ([r[f"c{i}"] for i in range(len(CLASSES))], [r[f"t{i}"] for i in range(13)]) for r in rows}


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of one length; null if either has no counts."""

    def shares(a: Column) -> Column:
        return F.transform(a, lambda x: x / F.aggregate(a, F.lit(0.0), lambda s, y: s + y))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    some = lambda a: F.exists(a, lambda x: x > 0)
    terms = F.zip_with(shares(counts), shares(reference), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.when(some(counts) & some(reference), F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0))))


def _literal(of_lang: dict[str, list[float]], lang: Column) -> Column:
    out = F.when(F.lit(False), F.array(F.lit(0.0)))
    for name, counts in of_lang.items():
        out = out.when(lang == name, F.array(*[F.lit(float(c)) for c in counts]))
    return out


def verdicts(measured: DataFrame, known: dict[str, tuple[list[float], list[float]]], lang: str = "lang") -> DataFrame:
    """class_distance, word_distance, base_failed and kept from the measures and the references."""
    code, n = F.col(lang), F.col("n_words")
    out = measured.withColumns(
        {
            "class_distance": divergence(F.col(own("classes")), _literal({k: v[0] for k, v in known.items()}, code)),
            "word_distance": divergence(F.col(own("tokens")), _literal({k: v[1] for k, v in known.items()}, code)),
        }
    )
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    strange = (n >= LEAST_WORDS) & ((F.col("class_distance") > MOST_CLASSES) | (F.col("word_distance") > MOST_WORDS + LENGTH_SHARE / F.sqrt(n)))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))).drop(own("classes"), own("tokens"))


def judge(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`documents` without the text, and with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance, base_failed and kept.

    A null text is empty: it has no words and fails the base rules. A text of a language that isn't listed (or null) has
    no reference, so both distances are null and the base rules alone decide; so they do for texts under LEAST_WORDS
    words, which the base rules reject. Repeated rows are judged one by one, and count in the references as often. An
    empty table gives no rows. The caller's columns stay, but for those nine names. The measures are written to the
    shared folder once, and both the references and the verdicts come from there.
    """
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")
    measured = materialize(measures(documents.drop(*[c for c in named if c not in (text, lang)]), text, lang).drop(text), "measures")
    return verdicts(measured, references(measured, lang), lang)


def clean(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their columns.

    Documents and measures are written to the shared folder together, so that each text is measured once; the references
    read only the counts back, and the filter runs over finished measures.
    """
    row = documents.select(F.struct(*documents.columns).alias(own("row")), F.col(text).alias("text"), F.col(lang).alias("lang"))
    measured = materialize(measures(row).drop("text"), "measured")
    return verdicts(measured, references(measured)).where("kept").select(f"{own('row')}.*")


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3_quality: all of `documents`."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _duck_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
g AS (SELECT doc_id, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS gram FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, range(3) AS t(k) GROUP BY doc_id),
k(lang, common) AS (VALUES {", ".join(f"('{name}', {_duck_list(words)})" for name, words in COMMON.items())}),
h AS (
  SELECT doc_id, lang, text, [length(regexp_replace(text, x, '', 'g')) for x in ['\p{{Ll}}+', '\p{{Lu}}+', '[0-9]+', '[\x20\x09-\x0D]+', '[#*$%&|<>]+']] AS rest,
         list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D.,]+'), lambda x: x <> '') AS tokens, common FROM d LEFT JOIN k USING (lang)),
v AS (
  SELECT doc_id, lang, [length(text) - x for x in rest] || [list_sum(rest) - 4 * length(text)] AS classes,
         [len(list_filter(tokens, lambda y: y = x)) for x in common] || [len(list_filter(tokens, lambda y: NOT list_contains(common, y)))] AS tokens FROM h WHERE common IS NOT NULL),
f AS (SELECT lang, {", ".join(f"sum(classes[{i + 1}])::DOUBLE AS c{i}" for i in range(6))}, {", ".join(f"sum(tokens[{i + 1}])::DOUBLE AS t{i}" for i in range(13))} FROM v GROUP BY lang),
s AS (
  SELECT doc_id,
    [x / list_sum(classes) for x in classes] AS p1, [x / list_sum(r1) for x in r1] AS q1, list_sum(classes) > 0 AND list_sum(r1) > 0 AS ok1,
    [x / list_sum(tokens) for x in tokens] AS p2, [x / list_sum(r2) for x in r2] AS q2, list_sum(tokens) > 0 AND list_sum(r2) > 0 AS ok2
  FROM v JOIN (SELECT lang, [{", ".join(f"c{i}" for i in range(6))}] AS r1, [{", ".join(f"t{i}" for i in range(13))}] AS r2 FROM f) USING (lang)),
j AS (
  SELECT doc_id,
    CASE WHEN ok1 THEN sqrt(greatest(0, list_sum([(CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END) + (CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END) for x in list_zip(p1, q1)]) / 2)) END AS class_distance,
    CASE WHEN ok2 THEN sqrt(greatest(0, list_sum([(CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END) + (CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END) for x in list_zip(p2, q2)]) / 2)) END AS word_distance
  FROM s),
b AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT coalesce(class_distance > {MOST_CLASSES} OR word_distance > {MOST_WORDS} + {LENGTH_SHARE} / sqrt(n_words), false) AS kept
FROM b LEFT JOIN j USING (doc_id)
"""
