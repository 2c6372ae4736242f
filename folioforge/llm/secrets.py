"""Secret scans with an incremental blob ledger; native DataFrame operations only.

Every version of a file is addressed by the SHA-256 of its content. A ledger says which blobs have been scanned under
which rule versions; only pairs that it lacks are scanned, each blob once however many paths hold it, and the findings
(those of the ledger and the new ones) are joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table


@dataclass(frozen=True)
class Rule:
    """kind: order and name in listings; least: characters that group `group` of a match must have."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed values. A hexadecimal run or an access key that is too short fails whatever follows, so those bounds stand in the pattern.
RULES = (
    Rule("assign", 1, r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
#: The kinds that the base spans hold.
BASE = ("assign", "access", "hex")

FINDINGS = "array<struct<rule:string,start:bigint,end:bigint>>"


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as {kind})")


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once for the row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, chunk: int = 128) -> Column:
    """Inclusive running sums of an array of bigint, in chunks, so that no long array is copied for every element."""
    none = _none("array<bigint>")
    last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("bigint"))
    add = lambda sums, x: F.concat(sums, F.array(last(sums) + x))

    def chunked(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / chunk).cast("int"), F.lit(0)))
        return F.transform(starts, lambda c: F.aggregate(F.slice(v, c * chunk + 1, F.lit(chunk)), none, add))

    def shifted(sums: Column) -> Column:
        moved = lambda totals: F.transform(sums, lambda some, i: F.transform(some, lambda x: x + F.coalesce(F.get(totals, i - 1), F.lit(0))))
        return F.flatten(_once(F.aggregate(F.transform(sums, last), none, add), moved))

    return _once(_once(values, chunked), shifted)


def _spans(text: Column, rule: Rule) -> Column:
    """All leftmost, non-overlapping matches that pass, with code-point offsets, end exclusive.

    The pieces between matches and the matches themselves alternate, so their lengths add up to the ends; the cost grows
    with the number of matches.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    length = lambda x: F.char_length(x).cast("bigint")
    # Split leaves one piece more than there are matches, the text's end.
    steps = F.zip_with(F.transform(F.split(text, rule.pattern, -1), length), F.transform(whole, length), lambda piece, own_length: F.coalesce(piece, F.lit(0)) + F.coalesce(own_length, F.lit(0)))
    ends = F.struct(running(steps).alias("ends"), F.transform(whole, length).alias("own"), F.transform(part, length).alias("part"))

    def spans(x: Column) -> Column:
        each = F.transform(x["own"], lambda n, i: F.struct(F.lit(rule.key).alias("rule"), (F.get(x["ends"], i) - n).alias("start"), F.get(x["ends"], i).alias("end"), F.get(x["part"], i).alias("part")))
        return F.transform(F.filter(each, lambda s: s["part"] >= rule.least), lambda s: F.struct(s["rule"].alias("rule"), s["start"].alias("start"), s["end"].alias("end")))

    return F.when(F.regexp_like(text, F.lit(rule.pattern)), _once(ends, spans)).otherwise(_none(FINDINGS))


def _in_order(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """By start, then by rule as listed; each span once."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(keys, s["rule"]).alias("at"), s["end"].alias("end"), s["rule"].alias("rule")))
    once = lambda sorted_spans: F.filter(sorted_spans, lambda s, i: (i == 0) | (s != F.get(sorted_spans, i - 1)))
    ordered = _once(F.array_sort(keyed), once)
    return F.transform(ordered, lambda s: F.struct(s["rule"].alias("rule"), s["start"].alias("start"), s["end"].alias("end")))


def address(text: Column) -> Column:
    """A blob's address: the SHA-256 of the content; null content is the empty blob."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger's rows for the blobs of `versions`: (blob, scanned, findings), one for each distinct blob.

    ledger: earlier rows of this function, kept as a table by the caller; a blob is scanned only under the rule versions
    that its rows lack, and findings of rules that are no longer listed in that version are left out. A ledger may name a
    blob in several rows, as runs that only append leave it. Null texts are the empty blob, without findings; very long
    texts are scanned whole; an empty table gives no rows.

    With a ledger the addresses are compared first, and only texts that lack a pair go on to be grouped and scanned: where
    the unseen blobs are few, adaptive execution sends their addresses to the texts, which then don't move at all.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    held = versions.select(address(F.col(text)).alias("blob"), content.alias("text"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    of_rules = F.filter("earlier", lambda s: F.array_contains(keys, s["rule"]))
    if ledger is None:
        blobs = held.groupBy("blob").agg(F.first("text").alias("text")).withColumns({"known": _none("array<string>"), "earlier": _none(FINDINGS)})
    else:
        past = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("known"), F.flatten(F.collect_list("findings")).alias("earlier"))
        here = materialize(held.select("blob").distinct().join(past, "blob", "left").withColumns({"known": F.coalesce("known", _none("array<string>")), "earlier": F.coalesce("earlier", _none(FINDINGS))}), "blobs")
        lacking = F.size(F.array_except(keys, F.col("known"))) > 0
        texts = held.join(here.where(lacking).select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text"))
        blobs = texts.join(here.where(lacking), "blob")
        seen = here.where(~lacking).select("blob", keys.alias("scanned"), _in_order(of_rules, rules).alias("findings"))
    fresh = [F.when(F.array_contains("known", r.key), _none(FINDINGS)).otherwise(_spans(F.col("text"), r)) for r in rules]
    scanned = blobs.select("blob", keys.alias("scanned"), _in_order(F.concat(of_rules, *fresh), rules).alias("findings"))
    return scanned if ledger is None else scanned.unionByName(seen)


def by_path(versions: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """`versions` with `blob` and `findings` (an empty array where there are none) in place of the text column.

    Only blobs with findings go into the join; a blob that very many paths hold is one row on the ledger's side, and the
    adaptive skew join splits its paths.
    """
    found = ledger.where(F.size("findings") > 0).select(F.col("blob").alias(own("blob")), F.col("findings").alias(own("findings")))
    paths = versions.withColumn("blob", address(F.col(text))).drop(text)
    joined = paths.drop("findings").join(found, F.col("blob") == F.col(own("blob")), "left")
    return joined.withColumn("findings", F.coalesce(own("findings"), _none(FINDINGS))).drop(own("blob"), own("findings"))


def kind_of(rule: Column) -> Column:
    return F.split_part(rule, F.lit("@"), F.lit(1))


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_of(s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op1_secrets: all of `documents`, each a path with one version, against an empty ledger."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("findings")
    base = F.filter(spans, lambda s: kind_of(s["rule"]).isin(*BASE))
    counts = {f"n_{kind}": F.size(F.filter(spans, _of(kind))).cast("long") for kind in BASE}
    return by_path(documents, scan(documents)).select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(listing(base), 256).alias("base_sha256"), listing(spans).alias("spans"))


def _of(kind: str):
    return lambda s: kind_of(s["rule"]) == kind


#: The same rows by plain scanning of every document, for DuckDB; match positions come from the pieces between matches.
def _duck_spans(rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT doc_id, '{rule.kind}' AS kind, {RULES.index(rule)} AS listed, start, start + length(whole) AS stop FROM (
      SELECT doc_id, whole, part, piece_sum + whole_sum - length(whole) AS start FROM (
        SELECT doc_id, whole, part,
               sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS piece_sum,
               sum(length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS whole_sum
        FROM (SELECT doc_id, unnest(whole) AS whole, unnest(part) AS part, unnest(pieces[1:len(whole)]) AS piece, unnest(range(len(whole))) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS whole, regexp_extract_all(text, '{pattern}', {rule.group}) AS part,
                           string_split_regex(text, '{pattern}') AS pieces FROM d))))
    WHERE length(part) >= {rule.least}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_duck_spans(r) for r in RULES)}),
g AS (SELECT doc_id,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, listed) FILTER (listed < {len(BASE)}) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, listed) AS spans
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
