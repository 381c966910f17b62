"""Repair of conversations: the cheapest edits that give legal turns, found as a lightest derivation.

An item (rows read, state) is derived from another by one edit of a row or by an inserted turn. Knuth's agenda pops items by
(cost, audit): every edit adds to the cost or appends to the audit, so an item is final when it is popped, and two derivations
of one item with one cost never have one audit begin with the other (the rest would be inserted turns, which cost), so an
edit after them keeps their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import materialize, short_batches, table

#: A conversation with more rows or bytes is solved in blocks of so many rows.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
#: States: nothing yet, after a system turn, after a user's, after an assistant's. Turns may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
GOALS = (START, ASSISTANT)
#: The turn that may be inserted, or that a row may become, after each state, and the state it leads to.
TURN = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
LEGAL = ("su", "ua", "au")
#: The first fault of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: What stands in no word.
WHITE = " \t\n\x0b\x0c\r"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def lightest(rows: list[tuple[str, int]], start: int = START, goals: tuple[int, ...] = GOALS, every: bool = False) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) from `start` over all rows (initial, fault) to a state of `goals`: of the first goal that is
    final, or of each goal."""
    agenda, final, out = [(0, "", 0, start)], set(), {}
    while agenda:
        cost, audit, i, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(rows) and state in goals:
            out[state] = (cost, audit)
            if not every or len(out) == len(goals):
                break
        heappush(agenda, (cost + INSERT, audit + "I", i, TURN[state][0]))
        if i < len(rows):
            initial, fault = rows[i]
            heappush(agenda, (cost + DELETE, audit + "D", i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                more = CUT if fault == TRUNCATED else 0
                heappush(agenda, (cost + more + REROLE, audit + "R", i + 1, TURN[state][0]))
                if initial in NEXT[state]:
                    heappush(agenda, (cost + more, audit + "K", i + 1, NEXT[state][initial]))
    return out


class Replay:
    """The turns that an audit makes of a conversation's rows, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.state, role = TURN[self.state]
            self.at += 1
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[self.state][role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state, role = TURN[self.state]
            yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


class Digest:
    """Turns as one SHA-256 of `role:text`, joined by newlines."""

    made = "repaired_sha256 string"

    def __init__(self, key, counts, audit: str):
        self.key, self.counts, self.audit, self.hash, self.first = key, counts, audit, hashlib.sha256(), True

    def add(self, turns) -> Iterator[tuple]:
        for _, role, text in turns:
            self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
            self.first = False
        return iter(())

    def close(self) -> Iterator[tuple]:
        yield (self.key, *self.counts, self.audit, self.hash.hexdigest())


class Turns:
    """Turns as rows."""

    def __init__(self, key, counts, audit: str):
        self.key, self.n = key, 0

    def add(self, turns) -> Iterator[tuple]:
        for edit, role, text in turns:
            yield self.key, self.n, role, text, edit
            self.n += 1

    def close(self) -> Iterator[tuple]:
        return iter(())


def damage(conversations: DataFrame) -> DataFrame:
    """Faults for tests and queries, by crc32 of `conv_id:turn` modulo 20 (nulls: one space): 0 drops a row (it stays with
    gone = true), 1 empties its text, 2 takes `.!?` out of it, 3 repeats the row, 4 makes its role user."""
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    k = F.crc32(key) % 20
    made = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), k.alias("k"))
    k = F.col("k")
    hurt = F.when(k <= 1, "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return made.select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), (k == 0).alias("gone"), F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_")).drop("_")


def _ordered(df: DataFrame, *first: str) -> DataFrame:
    """By conversation, turn (nulls first), role and a digest of the text, which ends ties between rows of one turn."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *first, "turn", "role", "_text")]
    return df.repartition("conv_id").sortWithinPartitions(*order)


def _records(rows: Iterator[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind, held, size = to_arrow_schema(schema), [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x, strict=True)) for x in held], kind)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x, strict=True)) for x in held], kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _whole(rows: Iterator[tuple], sink) -> Iterator[tuple]:
    """Short conversations (conv_id, turn, role, text, fault, gone), in order: each is held, solved and told."""

    def solve(key, held):
        seen, faults = set(), []
        for _, role, text, fault in held:
            faults.append(DUPLICATE if fault != BLANK and (role, text) in seen else fault)
            seen.add((role, text))
        turns = {t for t, *_ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [role[:1] for _, role, _, _ in held]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        ((cost, audit),) = lightest(list(zip(initials, faults, strict=True))).values()
        out = sink(key, (gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost), audit)
        replay = Replay(audit)
        for _, role, text, _ in held:
            yield from out.add(replay.row(role, text))
        yield from out.add(replay.end())
        yield from out.close()

    now, held, some = None, [], False
    for key, turn, role, text, fault, gone in rows:
        if some and key != now:
            yield from solve(now, held)
            held = []
        now, some = key, True
        if not gone:
            held.append((turn, role, text, fault))
    if some:
        yield from solve(now, held)


def _blocks(rows: Iterator[tuple], part: int, size: int) -> Iterator[tuple]:
    """Long conversations (conv_id, turn, role, fault), in order, a block at a time: its counts, and the lightest edits from
    each state before it to each state after it."""

    def block(key, n, held):
        turns = [t for t, _, _ in held if t is not None]
        faults, initials = [f for *_, f in held], [i for _, i, _ in held]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        ways = [(a, b, *way) for a in range(4) for b, way in lightest(list(zip(initials, faults, strict=True)), a, (0, 1, 2, 3), True).items()]
        yield key, part, n, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, initials[0], initials[-1], [dict(zip(("a", "b", "cost", "audit"), w, strict=True)) for w in ways]

    now, held, n = None, [], 0
    for key, turn, role, fault in rows:
        if held and (key != now or len(held) == size):
            yield from block(now, n, held)
            n, held = n + 1, []
        now = key
        held.append((turn, role[:1], fault))
    if held:
        yield from block(now, n, held)


_WAY = "array<struct<a:int,b:int,cost:long,audit:string>>"
_BLOCK = f"part long, n long, first long, last long, turns long, blank long, duplicate long, truncated long, illegal long, begins string, ends string, ways {_WAY}"


def _joined(rows: Iterator[tuple]) -> Iterator[tuple]:
    """A conversation's blocks in order, as its counts and audit."""
    for key, blocks in rows:
        best, total, low, high, turns, before = {START: (0, "")}, [0, 0, 0, 0], None, None, 0, None
        for b in blocks:
            new: dict[int, tuple[int, str]] = {}
            for w in b["ways"]:
                if w["a"] in best:
                    cost, audit = best[w["a"]]
                    way = (cost + w["cost"], audit + w["audit"])
                    new[w["b"]] = min(way, new.get(w["b"], way))
            best = new
            for k, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
                total[k] += b[c]
            if before is not None and before + b["begins"] not in LEGAL:
                total[3] += 1
            before = b["ends"]
            if b["first"] is not None:
                low = b["first"] if low is None else low
                turns += b["turns"] - (high == b["first"])
                high = b["last"]
        cost, audit = min(best[g] for g in GOALS if g in best)
        yield key, high - low + 1 - turns if turns else 0, *total, cost, audit


def _long(turns: DataFrame, sink, schema: StructType, key: StructField) -> DataFrame:
    """Conversations of any length. Faults and edits are found in blocks of rows, wherever they lie; then each conversation's
    rows pass through one task in order, as its digest asks for, and none of them is held."""
    held = turns.where("NOT gone")
    # of equal rows all but the first are duplicates; they are counted, so that none of their groups is in one task
    copies = held.groupBy("conv_id", "turn", "role", "_text", "fault").agg(F.count("*").alias("c"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    first = held.groupBy("conv_id", "role", "_text").agg(F.min(place).alias("_first")).select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_text").alias("_t"), "_first")
    marked = copies.join(first, copies["conv_id"].eqNullSafe(F.col("_c")) & (copies["role"] == F.col("_r")) & (copies["_text"] == F.col("_t")))
    rows = marked.select("conv_id", "turn", "role", "_text", "fault", place.eqNullSafe(F.col("_first")).alias("_is_first"), F.explode(F.sequence(F.lit(1).cast("long"), "c")).alias("_nth"))
    again = (F.col("fault") != BLANK) & (~F.col("_is_first") | (F.col("_nth") > 1))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "_text", "_nth")]
    ranged = rows.withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault"))).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "fault")
    kind = StructType([key, *StructType.fromDDL(_BLOCK).fields])
    size = BLOCK
    blocks = materialize(ranged.mapInArrow(lambda batches: _records(_blocks(_rows(batches), TaskContext.get().partitionId(), size), kind), kind))
    columns = [f.name for f in kind.fields[1:]]
    gathered = blocks.groupBy("conv_id").agg(F.collect_list(F.struct(*columns)).alias("blocks"))
    gathered = gathered.withColumn("blocks", F.array_sort("blocks", lambda a, b: F.when(a["part"] == b["part"], a["n"] - b["n"]).otherwise(a["part"] - b["part"]).cast("int")))
    found = StructType([key, *StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS) + ", audit string").fields])
    audits = gathered.mapInArrow(lambda batches: _records(_joined(_rows(batches)), found), found)

    def replay(batches):
        def told():
            out = None
            for key, heads, role, text, *counts, audit in _rows(batches):
                if heads == 0:
                    if out:
                        yield from out.add(again.end())
                        yield from out.close()
                    out, again = sink(key, counts, audit), Replay(audit)
                else:
                    yield from out.add(again.row(role, text))
            if out:
                yield from out.add(again.end())
                yield from out.close()

        return _records(told(), schema)

    # a conversation's audit comes first, then its rows
    heads = audits.withColumns({"_row": F.lit(0), "turn": F.lit(None).cast(dict(held.dtypes)["turn"]), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "_text": F.lit(None).cast("string")})
    both = heads.unionByName(held.withColumn("_row", F.lit(1)), allowMissingColumns=True)
    return _ordered(both, "_row").select("conv_id", "_row", "role", "text", *COUNTS, "audit").mapInArrow(replay, schema)


def _run(turns: DataFrame, gone: Column | None, sink, made: str) -> DataFrame:
    short_batches(turns.sparkSession)
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.lit(False) if gone is None else gone).alias("gone"))
    rows = rows.withColumns({"fault": fault, "_text": F.sha2("text", 256)})
    key = rows.schema["conv_id"]
    schema = StructType([StructField("conv_id", key.dataType), *StructType.fromDDL(made).fields])
    sizes = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.count_if(~F.col("gone")).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = materialize(sizes.where((F.col("n") > BLOCK) | (F.col("b") > BLOCK_BYTES)).select("_c"))
    any_long = not long.isEmpty()
    same = rows["conv_id"].eqNullSafe(F.col("_c"))
    short = rows.join(long, same, "left_anti") if any_long else rows
    out = _ordered(short).select("conv_id", "turn", "role", "text", "fault", "gone").mapInArrow(lambda batches: _records(_whole(_rows(batches), sink), schema), schema)
    return out.unionByName(_long(rows.join(long, same, "left_semi"), sink, schema, key)) if any_long else out


def repair(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row for each conv_id (null is one): counts of what is wrong, the lightest edits (cost and audit), and a digest of
    the repaired turns.

    turns: conv_id, turn, role, text; other columns are not read. Rows are taken by turn, nulls first; rows of one turn by role
    and digest of the text. A null role or text is one space. Rows where `gone` holds count for the list of conversations
    only; a conversation without other rows has zeros, an empty audit and the digest of nothing. A role that begins with none
    of s, u and a (an empty one too) has to be changed or deleted. Repeated rows are duplicates. Long conversations (BLOCK) are
    solved in blocks, with the same result; an empty table gives an empty table.
    """
    return _run(turns, gone, Digest, ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired conversations as rows: conv_id, position (from 0), role, text, edit (K, R or I)."""
    return _run(turns, gone, Turns, "position long, role string, text string, edit string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired."""
    return repair(damage(table(spark, sf_dir, "conversations")), F.col("gone"))
