"""Scalar text functions as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
#: Digits that recognition confuses with letters.
CONFUSED = {"O": "0", "o": "0", "l": "1", "I": "1", "S": "5", "B": "8"}
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
ODD_SPACE = r"[\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000]"


def expand_ligatures(text: Column) -> Column:
    for one, many in LIGATURES.items():
        text = F.replace(text, F.lit(one), F.lit(many))
    return text


#: Letters of ligatures behind which a text layer leaves a space.
TORN = ("Th", "ffi", "ffl", "fi", "fl")
#: Letters of a word before such a ligature that are looked at.
WORD_MOST = 80


def rejoin_ligatures(text: Column, torn: tuple[str, ...] = TORN) -> Column:
    """A space after a ligature's letters inside a word goes: `fi nal` -> `final`."""
    behind = "|".join(rf"(?<=\b[A-Za-z]{{0,{WORD_MOST}}}{letters})" for letters in torn)
    return F.regexp_replace(text, rf"(?:{behind}) (?=[a-z])", "")


def detab(text: Column) -> Column:
    """Tabs and odd spaces become single spaces."""
    return F.trim(F.regexp_replace(text, r"[\t\u00A0\u202F ]+", " "))


def clean_characters(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, CONTROL, ""), ODD_SPACE, " ")


def scrubbed(text: Column) -> Column:
    """struct<text, removed>: without control characters, and how many there were."""
    out = F.regexp_replace(text, CONTROL, "")
    return F.struct(out.alias("text"), (F.char_length(text) - F.char_length(out)).alias("removed"))


def normal_key(text: Column) -> Column:
    """Letters and digits in lower case, nothing else."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")


def spaced_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def pad_number(address: Column, width: int) -> Column:
    """The last number of an address filled up with zeros."""
    head, number, tail = (F.regexp_extract(address, r"(?s)^(.*?)(\d+)(\D*)$", g) for g in (1, 2, 3))
    return F.when(number == "", address).otherwise(F.concat(head, F.lpad(number, F.greatest(F.length(number), F.lit(width)), F.lit("0")), tail))


def tidy_article(address: Column) -> Column:
    """No space before a dash that starts a sub-address: `X. –1:101` -> `X.–1:101`."""
    return F.regexp_replace(address, r"\. ([–-])(?=\d)", ".$1")


def repair_article_number(text: Column) -> Column:
    """Confused letters become digits, if exactly three digits result."""
    fixed = F.translate(text, "".join(CONFUSED), "".join(CONFUSED.values()))
    return F.when(F.regexp_like(fixed, F.lit(r"^\d{3}$")), fixed).otherwise(text)


def number_list(text: Column) -> Column:
    """`9-12, 1` -> [9, 10, 11, 12, 1]."""

    def one(part: Column) -> Column:
        low = F.regexp_extract(part, r"^(\d+)", 1).try_cast("int")
        high = F.coalesce(F.regexp_extract(part, r"[-–](\d+)$", 1).try_cast("int"), low)
        return F.when(low.isNull() | (high < low), F.array().cast("array<int>")).otherwise(F.sequence(low, F.greatest(low, high)))

    return F.flatten(F.transform(F.split(F.regexp_replace(text, r"\s+", ""), ","), one))


def roman(text: Column) -> Column:
    """The number of a Roman numeral; null if it has other letters."""
    value = F.create_map(*[F.lit(x) for pair in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in pair])
    digits = F.transform(F.split(F.upper(text), ""), lambda c: F.try_element_at(value, c))
    total = F.aggregate(F.reverse(digits), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda s, d: F.struct(F.when(d < s["last"], s["sum"] - d).otherwise(s["sum"] + d).alias("sum"), d.alias("last")), lambda s: s["sum"])
    return F.when(F.regexp_like(F.upper(text), F.lit("^[IVXLCDM]+$")), total)


def authors(raw: Column) -> Column:
    return F.filter(F.transform(F.split(raw, ";"), lambda a: F.trim(a)), lambda a: a != "")


def human_size(n: Column) -> Column:
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024**power, F.concat(F.format_number(n / 1024**power, 1), F.lit(f" {unit}"))).otherwise(out)
    return out


def without_page_number(head: Column) -> Column:
    """A running head without the folio at either end."""
    return F.trim(F.regexp_replace(head, r"^\s*\d{1,4}\s+|\s+\d{1,4}\s*$", ""))


def strip_lines(text: Column, line_pattern: str, cut_pattern: str | None = None) -> Column:
    """Lines that match go; inside the others the cut pattern goes."""
    kept = F.filter(F.split(text, "\n"), lambda line: ~F.regexp_like(line, F.lit(line_pattern)))
    return F.array_join(F.transform(kept, lambda line: F.regexp_replace(line, cut_pattern, "")) if cut_pattern else kept, "\n")


def trim_after(text: Column, pattern: str, least: int = 40) -> Column:
    """What stands before the first match, if that is `least` characters or more."""
    head = F.split(text, pattern, 2)
    cut = F.rtrim(F.get(head, F.lit(0)))
    return F.when((F.size(head) > 1) & (F.char_length(F.get(head, F.lit(0))) >= least), cut).otherwise(text)


def find_all(text: Column, patterns: list[str]) -> Column:
    """Matches of all patterns in pattern order, each once, whatever its case; the first spelling is kept."""
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(f"(?i){p}"), F.lit(0)) for p in patterns]))
    placed = F.array_sort(F.transform(found, lambda m, i: F.struct(F.lower(m).alias("lower"), i.alias("i"), m.alias("found"))))
    # The sorted array is made once, and passed on as an array of one.
    return F.get(F.transform(F.array(placed), _first_spellings), F.lit(0))


def _first_spellings(found: Column) -> Column:
    """Of neighbours that are equal but for their case the first stays; what stays goes back to its place."""
    firsts = F.filter(found, lambda m, i: (i == 0) | (F.get(found, i - 1)["lower"] != m["lower"]))
    return F.transform(F.array_sort(F.transform(firsts, lambda m: F.struct(m["i"].alias("i"), m["found"].alias("found")))), lambda m: m["found"])


def median_of(values: Column) -> Column:
    """The median of an array's numbers, nulls left out; null without any."""
    some = F.array_sort(F.array_compact(values))
    n = F.size(some)
    return F.when(n > 0, (F.get(some, F.floor((n - 1) / 2).cast("int")) + F.get(some, F.floor(n / 2).cast("int"))) / 2)
