import hashlib
import re
import zlib
from functools import cache
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from folioforge.llm import conversations as C
from folioforge.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def brute(rows):
    """The answer for the rows of one conversation in order, by trying every edit at every place."""
    seen, turns = set(), []
    for _, _, role, text in rows:
        marks = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        turns.append((role, text, fault))

    @cache
    def best(i, so_far):
        """(cost, edits, lines) from turn i on, where so_far is what the initials have come to: '', s, u or a."""
        options = []
        if i == len(turns) and so_far in ("", "a"):
            options.append((0, "", ()))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, edits, lines = best(i + 1, so_far)
            options.append((cost + 3, "D" + edits, lines))
            if fault not in ("blank", "duplicate"):
                for letter, price, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if new and so_far + new[:1] in ("s", "u", "su", "ua", "au"):
                        cost, edits, lines = best(i + 1, new[:1])
                        options.append((cost + price + (fault == "truncated"), letter + edits, (f"{new}:{text}", *lines)))
        return relaxed(i, so_far, options)

    def relaxed(i, so_far, options):
        for chain in (("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
            initials = so_far + "".join(c[0] for c in chain)
            if all(initials[k : k + 2] in ("u", "ua", "au", "su") for k in range(len(initials) - 1)) and (so_far or initials[0] == "u"):
                cost, edits, lines = plain(i, initials[-1])
                options.append((cost + 2 * len(chain), "I" * len(chain) + edits, (*[f"{c}:" for c in chain], *lines)))
        return min(options, default=(10**9, "", ()))

    @cache
    def plain(i, so_far):
        """As best, but nothing is inserted here."""
        options = [(10**9, "", ())]
        if i == len(turns) and so_far in ("", "a"):
            options.append((0, "", ()))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, edits, lines = best(i + 1, so_far)
            options.append((cost + 3, "D" + edits, lines))
            if fault not in ("blank", "duplicate"):
                for letter, price, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if new and so_far + new[:1] in ("s", "u", "su", "ua", "au"):
                        cost, edits, lines = best(i + 1, new[:1])
                        options.append((cost + price + (fault == "truncated"), letter + edits, (f"{new}:{text}", *lines)))
        return min(options)

    for i in range(len(turns), 0, -1):
        for q in ("", "s", "u", "a"):
            best(i, q)
    cost, edits, lines = best(0, "")
    numbers = {t for _, t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    count = [sum(f == k for *_, f in turns) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, *count, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(spark, rows):
    """Brute force over rows as they come; ties of a turn are in the order that the operator states."""
    ids = {r[0] for r in rows}
    after = harmed(rows)
    texts = sorted({r[3] for r in after})
    hashed = spark.createDataFrame([(t,) for t in texts] or [("",)], "text string").select("text", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).collect()
    h = {r[0]: (r[1], r[2]) for r in hashed}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], h[r[3]])
    out = {conv: brute(list(some)) for conv, some in groupby(sorted(after, key=key), key=lambda r: r[0])}
    return sorted([(conv, *out.get(conv, brute([]))) for conv in ids], key=str)


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = C.digest(spark, SF)
    assert got.dtypes == [("conv_id", "bigint"), *[(c, "bigint") for c in COLUMNS[1:7]], ("audit", "string"), ("repaired_sha256", "string")]
    assert rows_of(got) == expected(spark, rows)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_pieces_change_nothing(spark, monkeypatch, bits):
    """Conversations cut into pieces of two rows, of eight, and not at all; one holds a third of all rows."""
    import random

    monkeypatch.setattr(C, "CHUNK_BITS", bits)
    rnd = random.Random(5)
    rows = []
    for conv in [*range(30), *[99] * 60]:
        for turn in range(rnd.randrange(9)):
            rows.append((conv, rnd.choice([turn, turn + 3, None]), rnd.choice(["user", "assistant", "system", "tool", "", None, "unit"]), rnd.choice(["Yes.", "No", " ", None, "Why?", f"t{turn}!", "a\nb."])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(C.repaired(df)) == expected(spark, rows)


def test_costs_of_known_conversations():
    def solve(turns):
        costs = C.cost_to_go(turns, C.DONE)
        return costs[0][C.START], C.walk(turns, costs, C.START, True)[0]

    ok = C.SOUND
    assert solve([]) == (0, "")
    assert solve([("s", ok), ("u", ok), ("a", ok)]) == (0, "KKK")
    assert solve([("u", ok)]) == (2, "KI")
    assert solve([("a", ok)]) == (2, "IK")
    assert solve([("s", ok)]) == (3, "D")
    assert solve([("u", ok), ("u", ok)]) == (2, "KR")
    assert solve([("u", C.DUPLICATE), ("a", C.SHORT)]) == (6, "DD")
    assert solve([("u", C.SHORT), ("a", C.BLANK), ("a", ok)]) == (4, "KDK")


def test_messy_and_empty(spark):
    """Null ids, turns, roles and texts, repeated rows, long texts, extra columns with clashing names, an empty table."""
    long = "word " * 50_000 + "end."
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", long), (2, 5, "", ""), (3, None, "system", "x."), (3, 7, "user", "é😀.")]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "conv_id long, turn long, role string, text string, place string, fault string, audit string")
    assert rows_of(C.repaired(df)) == expected(spark, rows)
    assert C.repaired(df.limit(0)).count() == 0
