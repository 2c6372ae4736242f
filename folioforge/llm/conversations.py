"""Conversation structure repair: the cheapest edits that make a conversation's turns follow the grammar `(s?(ua)+)?`.

Backward, cost-to-go over turns and the grammar's four states; forward, a greedy walk that takes the ASCII-least edit among
those whose cost is tight. Both work by pieces: rows are sorted by range, so a conversation of any length is spread over
ranges, and each CHUNK rows are one group. A conversation inside a group is solved there. Of the others each piece is
reduced to its costs from state to state, these are chained over the conversation, and with the cost-to-go at its end every
piece is walked from each state; the chain of exits then picks one walk of each piece. Texts move once, at the end: a
conversation's edits come before its rows, which are hashed as they pass by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, table

#: Rows of a group: a power of two.
CHUNK_BITS = 12
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after the system's turn, after the user's, after the assistant's. What an inserted or reroled turn leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
#: The state that a kept turn leads to, by its role's initial, from each state where it may stand.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, SHORT, SOUND = "b", "d", "t", "-"
#: Costs after the last turn: what must still be inserted.
DONE = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
SPACE = r"\x20\x09-\x0D"


def cost_to_go(turns: list[tuple[str, str]], end: tuple) -> list[tuple]:
    """For each turn (initial, fault) and the end, the least cost from each state."""
    out = [end]
    for initial, fault in reversed(turns):
        c = [DELETE + x for x in end]
        if fault not in (BLANK, DUPLICATE):
            more, stands = TRUNCATED * (fault == SHORT), KEPT.get(initial, {})
            for q in range(4):
                c[q] = min(c[q], REROLE + more + end[AFTER[q]], KEEP + more + end[stands[q]] if q in stands else FAR)
        user, assistant = min(c[USER], INSERT + c[ASSISTANT]), min(c[ASSISTANT], INSERT + c[USER])
        end = (min(c[START], INSERT + user), min(c[SYSTEM], INSERT + user), user, assistant)
        out.append(end)
    return out[::-1]


def walk(turns: list[tuple[str, str]], costs: list[tuple], q: int, last: bool) -> tuple[str, int]:
    """(edits, the state they end in) from state q: at each place the first of D, I, K, R whose cost is tight."""
    out, i = [], 0
    while i < len(turns) or (last and costs[i][q]):
        now = costs[i][q]
        if i < len(turns):
            (initial, fault), then = turns[i], costs[i + 1]
            if now == DELETE + then[q]:
                out.append("D")
                i += 1
                continue
        if now == INSERT + costs[i][AFTER[q]]:
            out.append("I")
            q = AFTER[q]
            continue
        more, to = TRUNCATED * (fault == SHORT), KEPT.get(initial, {}).get(q)
        kept = to is not None and now == KEEP + more + then[to]
        out.append("K" if kept else "R")
        q, i = to if kept else AFTER[q], i + 1
    return "".join(out), q


def piece_of(turns: list[tuple[str, str]], numbers: list[int | None]) -> dict:
    """What a run of a conversation's rows tells about it: counts, and its first and last turn."""
    known = [n for n in numbers if n is not None]
    return {
        "blank": sum(f == BLANK for _, f in turns),
        "duplicate": sum(f == DUPLICATE for _, f in turns),
        "truncated": sum(f == SHORT for _, f in turns),
        "illegal": sum(a + b not in LEGAL for (a, _), (b, _) in zip(turns, turns[1:])),
        "turns": len(set(known)),
        "least": min(known, default=None),
        "most": max(known, default=None),
        "first": turns[0][0],
        "last": turns[-1][0],
    }


def joined(pieces: list[dict]) -> dict:
    """The counts of a whole conversation from its pieces in order."""
    out = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(pieces, pieces[1:]))
    known = [p for p in pieces if p["least"] is not None]
    out["turns"] -= sum(a["most"] == b["least"] for a, b in zip(known, known[1:]))  # rows are in order of their turns
    out["gaps"] = known[-1]["most"] - known[0]["least"] + 1 - out["turns"] if known else 0
    return out


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PIECE = ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 takes
    `.!?` out, 3 repeats it, 4 makes it the user's. Null roles and texts, and nulls in the checked string, are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20).alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("harm <> 0").select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _order() -> list[Column]:
    """Rows of a conversation in order; what is equal in all of these is one and the same row, but for collisions of 128 bits."""
    return [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "h1", "h2")]


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, place, initial, fault): rows without their texts, numbered in order."""
    last = F.substring(F.regexp_replace("text", f"[{SPACE}]+$", ""), -1, 1)
    light = _hashed(rows).select("conv_id", "turn", "role", "h1", "h2", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("short"))
    # A hot conversation is several ranges, also where all its rows are alike.
    ranged = light.withColumn("any", F.rand(42)).repartitionByRange(*_order(), "any").sortWithinPartitions(*_order())
    placed = materialize(ranged.drop("any").withColumn("place", F.monotonically_increasing_id()), "turns")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2").orderBy("place")) > 1
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("short"), SHORT).otherwise(SOUND)
    return placed.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _solved(faults: DataFrame) -> DataFrame:
    """Runs of conversations by groups of rows: with their audit where the group holds the whole conversation."""
    kind = faults.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, piece long, " + ", ".join(f"{c} long" for c in _PIECE) + ", first string, last string, gaps long, cost long, audit string, codes string, matrix array<long>"

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        ids, numbers, initials, fault, piece = (group.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "chunk"))
        cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            turns = list(zip(initials[a:b], fault[a:b]))
            row = {"conv_id": ids[a], "piece": piece[a], **piece_of(turns, numbers[a:b])}
            if a and b < len(ids):
                costs = cost_to_go(turns, DONE)
                row |= joined([row]) | {"cost": costs[0][START], "audit": walk(turns, costs, START, True)[0]}
            else:  # it may go on in another group
                from_each = [cost_to_go(turns, tuple(0 if q == to else FAR for q in range(4)))[0] for to in range(4)]
                row |= {"codes": "".join((i if i in KEPT else "x") + f for i, f in turns), "matrix": [from_each[to][q] for q in range(4) for to in range(4)]}
            out.append(row)
        return pa.Table.from_pylist(out, _schema(kind))

    return faults.withColumn("chunk", F.shiftright("place", CHUNK_BITS)).groupBy("chunk").applyInArrow(run, schema)


def _schema(kind: str) -> pa.Schema:
    ids = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    return pa.schema([("conv_id", ids), ("piece", pa.int64()), *[(c, pa.int64()) for c in _PIECE], ("first", pa.string()), ("last", pa.string()), ("gaps", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("codes", pa.string()), ("matrix", pa.list_(pa.int64()))])


def _ends(pieces: pa.Table) -> pa.Table:
    """For each piece of a conversation the cost-to-go at its end; it's the last where `last_piece`."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["piece"])
    end, out = DONE, []
    for i, r in enumerate(reversed(rows)):
        out.append({"conv_id": r["conv_id"], "piece": r["piece"], "end": list(end), "last_piece": i == 0})
        m = r["matrix"]
        end = tuple(min(m[4 * q + to] + end[to] for to in range(4)) for q in range(4))
    ids = pieces.schema.field("conv_id").type
    return pa.Table.from_pylist(out, pa.schema([("conv_id", ids), ("piece", pa.int64()), ("end", pa.list_(pa.int64())), ("last_piece", pa.bool_())]))


def _walks(codes: Column, end: Column, last: Column) -> Column:
    """For each entry state: the edits and the state that they end in, and the cost."""
    kind = pa.list_(pa.struct([("edits", pa.string()), ("state", pa.int64()), ("cost", pa.int64())]))

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for coded, ends, lasts in batches:
            out = []
            for c, e, is_last in zip(coded.to_pylist(), ends.to_pylist(), lasts.to_pylist()):
                turns = list(zip(c[::2], c[1::2]))
                costs = cost_to_go(turns, tuple(e))
                walks = [walk(turns, costs, q, is_last) if costs[0][q] < FAR else ("", q) for q in range(4)]
                out.append([{"edits": w, "state": to, "cost": costs[0][q]} for q, (w, to) in enumerate(walks)])
            yield pa.array(out, kind)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<struct<edits:string,state:long,cost:long>>")(codes, end, last)


def _chained(pieces: pa.Table) -> pa.Table:
    """One conversation from its pieces: the walk of each that begins where the one before it ended."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["piece"])
    state, edits = START, []
    for r in rows:
        w = r["walks"][state]
        edits.append(w["edits"])
        state = w["state"]
    out = {"conv_id": rows[0]["conv_id"], **joined(rows), "cost": rows[0]["walks"][START]["cost"], "audit": "".join(edits)}
    ids = pieces.schema.field("conv_id").type
    return pa.Table.from_pylist([out], pa.schema([("conv_id", ids), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())]))


def _audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation that has rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    pieces = materialize(_solved(_faults(rows)), "pieces")
    opened = pieces.where("audit is null")
    ends = opened.select("conv_id", "piece", "matrix").groupBy("conv_id").applyInArrow(_ends, f"conv_id {kind}, piece long, end array<long>, last_piece boolean")
    ends = ends.withColumnRenamed("conv_id", "_conv").withColumnRenamed("piece", "_piece")
    walked = opened.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece")))
    walked = walked.select("conv_id", "piece", *_PIECE, "first", "last", _walks(F.col("codes"), F.col("end"), F.col("last_piece")).alias("walks"))
    chained = walked.groupBy("conv_id").applyInArrow(_chained, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string")
    return pieces.where("audit is not null").select("conv_id", *_COUNTS, "audit").unionByName(chained)


class _Rebuilt:
    """A conversation's repaired turns, hashed as they come: only the digest is kept."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.begun = audit, 0, START, hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * self.begun}{role}:{text}".encode())
        self.begun = True

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, AFTER[self.state]
            self.say(ROLES[self.state], "")

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self.state = KEPT[role[:1]][self.state] if edit == "K" else AFTER[self.state]
            self.say(role if edit == "K" else ROLES[self.state], text)

    def end(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256). The hash of one conversation is one pass over its rows in order, which no two tasks can
    share; only the row at hand is in memory."""
    kind = rows.schema["conv_id"].dataType
    heads = audits.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    both = heads.unionByName(_hashed(rows).withColumn("head", F.lit(False)))
    order = [F.asc_nulls_first("conv_id"), F.desc("head"), *_order()[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        for batch in batches:
            done = []
            for conv, head, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "head", "role", "text"))):
                if head:
                    if now:
                        done.append((now[0], now[1].end()))
                    now = conv, _Rebuilt(text)
                else:
                    now[1].turn(role, text)
            yield _digest_batch(done, batch.schema.field("conv_id").type)
        if now:
            yield _digest_batch([(now[0], now[1].end())], batch.schema.field("conv_id").type)

    sorted_rows = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "head", "role", "text")
    return sorted_rows.mapInArrow(run, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def _digest_batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])


def repaired(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row for each conv_id.

    rows: (conv_id, turn, role, text) to repair, without nulls in role and text; by default `damaged(conversations)`. Rows
    stand in order of their turn, nulls first; rows of one turn by role and then by a hash of the text, so that the result
    doesn't depend on the input's order. A null conv_id is a conversation like any other; an empty role
    fits nowhere, so its turn is reroled or deleted. A conversation without rows has
    zeros, an empty audit and the hash of the empty string. Texts are hashed whole; other columns are ignored; an empty table
    gives no rows.
    """
    rows = damaged(conversations) if rows is None else rows
    audits = materialize(_audits(rows), "audits")
    digests = _digests(rows, audits).withColumnRenamed("conv_id", "_of")
    found = audits.withColumnRenamed("conv_id", "_conv")
    out = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    empty = hashlib.sha256().hexdigest()
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op13_conversations: all of `conversations`, damaged and repaired."""
    return repaired(table(spark, sf_dir, "conversations"))
