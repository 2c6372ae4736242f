"""Line dedup by a deletion-neighbourhood join; native DataFrame operations only.

A line repeats an earlier one if their words are equal, or if one word added, left out or exchanged makes them so (for
lines of FUZZY words or more). The lines are first reduced to distinct ones, each with its earliest place. A distinct
line then emits its variants with one word deleted as hashed keys. Lines with equal keys are candidates, and each key is
reduced to its earliest line, so a key that very many lines share makes one candidate for each of them. The distance of
the candidates is verified on their words.

Two lines at distance one agree in the words before their middle or in those after it. So only lines that share such a
half with another one emit variants, and only those of the other half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table

#: Words from which on a line is compared at all, and from which on with one edit.
LEAST, FUZZY = 1, 8
#: Words from which on `dedup` takes a line out: headings and answers of a word or two recur without being copies.
OUT_LEAST = 3
#: Hashes of lines that are sent to all tasks at most, 8 bytes and two flags each.
SENT = 1_000_000
SPACE = r"[\x20\x09-\x0D]+"


def _two(*c: Column) -> list[Column]:
    """128 bits of hash."""
    return [F.xxhash64(*c).alias("h1"), F.xxhash64(F.lit(1), *c).alias("h2")]


def _key_of_row(doc_id: str, text: str) -> list[Column]:
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit(1), text, doc_id).alias("k2")]


def _normal(line: Column) -> Column:
    """Words with single spaces between; the pattern runs only over lines that hold other white space."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, SPACE, " ")).otherwise(line))


def _lines(documents: DataFrame, text: str, doc_id: str, least: int) -> DataFrame:
    """(k1, k2, place: struct<doc_id, line_no>, norm, n, h1, h2) of every line of `least` words or more."""
    lines = documents.select(F.col(doc_id).alias("doc_id"), *_key_of_row(doc_id, text), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    rows = lines.select("k1", "k2", F.struct("doc_id", "line_no").alias("place"), _normal(F.col("line")).alias("norm"))
    n = F.when(F.col("norm") == "", 0).otherwise(1 + F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "), F.lit(""))))
    return rows.withColumn("n", n).where(F.col("n") >= least).select("*", *_two(F.col("norm")))


def _halves(norm: Column, n: Column) -> Column:
    """Keys of the first and the last half, as the shorter (or equal) line of a pair and as the longer one."""

    def pair(length: Column) -> list[Column]:
        a = F.floor(length / 2).cast("int")
        first, last = F.call_function("substring_index", norm, F.lit(" "), a), F.call_function("substring_index", norm, F.lit(" "), a - length)
        return [F.xxhash64(length, F.lit(side), half) for side, half in ((0, first), (1, last))]

    return F.array(*pair(n), *pair(n - 1))


def places(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, fuzzy: int = FUZZY) -> DataFrame:
    """Every line of `least` words or more without its text: whose it is, its place, its hash and its halves' keys."""
    rows = _lines(documents, text, doc_id, least)
    return rows.select("k1", "k2", "place", "h1", "h2", F.when(F.col("n") >= fuzzy, _halves(F.col("norm"), F.col("n"))).alias("halves"))


def _variants(norm: Column, n: Column, first: Column, last: Column) -> Column:
    """Keys of the line itself and of what is left without one word; by class: 0 exchanged, 1 whole, 2 longer by a word.

    first: the line shares its first half, so that the edit is in the last one; last: the other way round.
    """
    middle = F.floor((n - 1) / 2).cast("int")
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda p: (first & (p >= middle)) | (last & (p <= middle + 1)))
    words = lambda count: F.call_function("substring_index", norm, F.lit(" "), count)

    def keys(p: Column) -> Column:
        left = F.array(F.trim(F.concat(words(p), F.lit(" "), words(p + 1 - n))))
        return F.get(F.transform(left, lambda v: F.array(F.struct(F.lit(0).alias("class"), F.xxhash64(n, p, v).alias("key")), F.struct(F.lit(2).alias("class"), F.xxhash64(n - 1, F.lit(-1), v).alias("key")))), F.lit(0))

    whole = F.struct(F.lit(1).alias("class"), F.xxhash64(n, F.lit(-1), norm).alias("key"))
    return F.concat(F.flatten(F.transform(at, keys)), F.array(whole))


def _at_most_one_edit(a: Column, b: Column) -> Column:
    """For word arrays: equal lengths differ in one place at most, or the longer without one word is the shorter."""
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda x: x))
    long, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    cut = F.array_position(F.zip_with(long, short, lambda x, y: ~x.eqNullSafe(y)), F.lit(True)).cast("int")  # the longer one's end differs at least
    left = F.concat(F.slice(long, F.lit(1), cut - 1), F.slice(long, cut + 1, F.size(long)))
    return F.when(F.size(a) == F.size(b), differ <= 1).when(F.size(long) == F.size(short) + 1, left == short).otherwise(F.lit(False))


def near_lines(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """(h1, h2, near): for distinct lines the place of the earliest other line at distance one, where there is one.

    lines: every line with its text, as a plan; placed: the same without, as a table. Few lines share a half with another
    one; only these are read again with their text. Up to SENT of them go to the tasks, more are joined by a shuffle.
    """
    halves = placed.where("halves is not null").select("h1", F.posexplode("halves").alias("side", "key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("key")
    side = F.col("side") % 2
    sides = halves.join(shared, "key", "left_semi").groupBy("h1").agg(F.max(side == 0).alias("first_half"), F.max(side == 1).alias("last_half"))
    sides = materialize(sides, "halves")
    sent = F.broadcast(sides) if sides.count() <= SENT else sides
    found = lines.select("h1", "h2", "place", "n", "norm").join(sent, "h1")
    some = found.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("norm").alias("norm"), F.first("n").alias("n"), F.first("first_half").alias("first_half"), F.first("last_half").alias("last_half"))
    some = materialize(some, "lines")
    keys = materialize(some.select("h1", "h2", "first", F.inline(_variants(F.col("norm"), F.col("n"), F.col("first_half"), F.col("last_half")))), "variants")
    who = F.struct("first", "h1", "h2")
    least = keys.groupBy("key").agg(*[F.min(F.when(F.col("class") == c, who)).alias(f"least{c}") for c in range(3)], F.count("*").alias("lines")).where("lines > 1").drop("lines")
    other = F.when(F.col("class") == 0, F.col("least0")).when(F.col("class") == 1, F.col("least2")).otherwise(F.col("least1"))
    pairs = keys.join(least, "key").select("h1", "h2", other.alias("other")).where("other is not null and not (h1 = other.h1 and h2 = other.h2)").select("h1", "h2", F.col("other.h1").alias("o1"), F.col("other.h2").alias("o2"), F.col("other.first").alias("near")).distinct()
    of = some.select("h1", "h2", "norm")
    there = some.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("norm").alias("others"))
    joined = pairs.join(of, ["h1", "h2"]).join(there, ["o1", "o2"])
    return joined.where(_at_most_one_edit(F.split("norm", " "), F.split("others", " "))).groupBy("h1", "h2").agg(F.min("near").alias("near"))


def repeats(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, fuzzy: int = FUZZY) -> DataFrame:
    """(k1, k2, doc_id, line_no, reason, earlier: struct<doc_id, line_no>), one row for every line that repeats an earlier one.

    Lines are in the order of (doc_id, line_no), null ids first; white space at the ends and the amount of it between words
    don't count, letters' case does. A line is judged against all lines, also those that are themselves repeats. reason:
    `equal` before `near`; earlier: the earliest such line. Lines of one place (rows that share an id) are never earlier
    than each other, so repeated rows keep their lines. A null text has no lines; an empty table gives no rows.
    """
    placed = materialize(places(documents, text, doc_id, least, fuzzy), "places")
    near = near_lines(_lines(documents, text, doc_id, fuzzy), placed)
    distinct = placed.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    marked = distinct.join(near, ["h1", "h2"], "left").where("first < last or near < last").drop("last")
    found = placed.select("k1", "k2", "place", "h1", "h2").join(marked, ["h1", "h2"])
    equal, close = F.col("first") < F.col("place"), F.coalesce(F.col("near") < F.col("place"), F.lit(False))
    return found.where(equal | close).select("k1", "k2", "place.doc_id", "place.line_no", F.when(equal, "equal").otherwise("near").alias("reason"), F.when(equal, F.col("first")).otherwise(F.col("near")).alias("earlier"))


def dedup(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = OUT_LEAST, fuzzy: int = FUZZY) -> DataFrame:
    """`documents` with the repeated lines of `least` words or more taken out of the text, with their columns.

    A document that loses every line with a word goes; one that had none stays. A column `n_chars` is counted anew.
    """
    gone = repeats(documents, text, doc_id, least, fuzzy).groupBy("k1", "k2").agg(F.collect_set("line_no").alias(own("gone")))
    keyed = documents.withColumns({own(k): c for k, c in zip(("k1", "k2"), _key_of_row(doc_id, text))})
    joined = keyed.join(gone, (F.col(own("k1")) == gone["k1"]) & (F.col(own("k2")) == gone["k2"]), "left")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(own("gone")))
    # Lines are picked from an array of one array, which is split once.
    left = F.get(F.transform(F.array(lines), lambda all_lines: F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")), F.lit(0))
    out = joined.withColumn(text, F.when(F.col(own("gone")).isNotNull(), left).otherwise(F.col(text)))
    out = out.where(F.col(own("gone")).isNull() | F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.char_length(text).cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op10_lines: every line of `documents` with a word that repeats an earlier one."""
    found = repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_no", "reason", F.col("earlier.doc_id").alias("earlier_doc_id"), F.col("earlier.line_no").alias("earlier_line_no"))


SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
w AS (SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM l),
p AS (SELECT doc_id, line_no, words, len(words) AS n, array_to_string(words, ' ') AS norm, (doc_id, line_no) AS place FROM w WHERE len(words) >= {LEAST}),
d AS (SELECT norm, any_value(words) AS words, any_value(n) AS n, min(place) AS first FROM p GROUP BY norm),
v AS (SELECT norm, first, n, i, array_to_string(words[1:i] || words[i + 2:], ' ') AS variant
      FROM (SELECT *, unnest(range(n)) AS i FROM d WHERE n >= {FUZZY})),
e AS (
  SELECT a.norm, b.first AS near FROM v a JOIN v b ON a.n = b.n AND a.i = b.i AND a.variant = b.variant AND a.norm <> b.norm
  UNION ALL SELECT v.norm, d.first FROM v JOIN d ON d.norm = v.variant AND d.n >= {FUZZY}
  UNION ALL SELECT d.norm, v.first FROM v JOIN d ON d.norm = v.variant AND d.n >= {FUZZY}),
m AS (SELECT norm, min(near) AS near FROM e GROUP BY norm),
r AS (SELECT doc_id, line_no, place, first, near FROM p JOIN d USING (norm) LEFT JOIN m USING (norm) WHERE first < place OR near < place),
x AS (SELECT doc_id, line_no, first < place AS equal, CASE WHEN first < place THEN first ELSE near END AS earlier FROM r)
SELECT doc_id, line_no::INTEGER AS line_no, CASE WHEN equal THEN 'equal' ELSE 'near' END AS reason, earlier[1] AS earlier_doc_id, earlier[2]::INTEGER AS earlier_line_no FROM x
"""
