"""Conversation structure repair: faults of the turns, and the cheapest edits that give roles ``(s?(ua)+)?``.

A conversation's rows come by turn (NULL first); rows of one turn by role, then by the SHA-256 of their text. A row's first
fault counts: blank (no character but ASCII white space), duplicate (its role and text seen earlier), truncated (the last other
character is not one of ``.!?``). Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant row
2; blank and duplicate rows must go; a truncated row that stays adds 1. A role counts by its first character, that of an empty
role is none of s, u, a. Of equally cheap edits the one whose letters are least in ASCII order is taken.

Four Russians: the cost of the rest of a conversation is a vector over the four states of the pattern (start, after s, after u,
after a). Less their least entry, only a few vectors occur, so a row is a step from one vector number to another, and tables
hold the steps of every block of ``BLOCK`` symbols. A conversation is cut into chunks of range partitions of narrow rows; each
chunk looks up, block by block from its end, where every vector number leads. One short pass a conversation chains the chunks
backward, which gives the vector at the end of each; then every chunk on its own expands its blocks backward to a vector per
row and traces forward with the least letter that keeps the cost. So no task holds a whole conversation's rows, however long.
Only the repaired texts of one conversation pass through one task in order, an Arrow batch at a time (a digest over them is
sequential), beside its audit, which is a value of the result.

Edge cases: NULL roles and texts count as one blank, so such a text is blank and such a role none of s, u, a; rows with a
NULL conversation are one conversation; repeated rows are duplicates of the first; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import ship

BLANKS = " \t\n\x0b\x0c\r"
#: states of the pattern, and where an inserted or reroled row leads
START, SYSTEM, USER, ASSISTANT = range(4)
FILLED = (USER, USER, ASSISTANT, USER)
#: initials by number, the last for all others; bits of a row's byte
INITIALS = "sua"
CUT, GONE = 4, 8
#: classes of a byte for the costs: initial and truncation, or must be deleted
CLASSES = 9
BLOCK = 4
#: rows of a chunk at most
CHUNK = 1 << 20
LEGAL_PAIRS = ((0, 1), (1, 2), (2, 1))


def kept_state(state: int, initial: int) -> int | None:
    """State after keeping a row, None where the pattern forbids it."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return None if state == USER else USER
    return ASSISTANT if initial == 2 and state == USER else None


class Tables:
    """Vectors that occur, steps between them per class and per block, and the letters to write per (vector after, class, state)."""

    def __init__(self):
        end = self.with_inserts([0, 99, 99, 0])
        self.vectors, numbers, steps, costs = [end], {end: 0}, [], []
        for vector in self.vectors:  # grows while new vectors are found
            row = []
            for kind in range(CLASSES):
                before = self.with_inserts([min(c for _, c, _ in self.choices(vector, kind, q)) for q in range(4)])
                least = min(before)
                reduced = tuple(c - least for c in before)
                if reduced not in numbers:
                    numbers[reduced] = len(self.vectors)
                    self.vectors.append(reduced)
                row.append((numbers[reduced], least))
            steps.append([n for n, _ in row])
            costs.append([c for _, c in row])
        self.step, self.cost = np.array(steps, np.int16), np.array(costs, np.int64)
        # a block's code has its last symbol in the lowest digit; blocks are read backward
        self.block_step, self.block_cost = self.step, self.cost
        for _ in range(BLOCK - 1):
            nxt = self.step[self.block_step]
            total = self.block_cost[:, :, None] + self.cost[self.block_step]
            self.block_step = nxt.transpose(0, 2, 1).reshape(len(steps), -1)
            self.block_cost = total.transpose(0, 2, 1).reshape(len(steps), -1)
        self.letters = [[[self.written(v, k, q) for q in range(4)] for k in range(CLASSES)] for v in self.vectors]
        self.ending = [self.closing(q) for q in range(4)]
        self.kinds = np.array([CLASSES - 1 if b & GONE else 2 * (b & 3) + (b & CUT) // CUT for b in range(16)], np.int64)

    @staticmethod
    def with_inserts(costs: list[int]) -> tuple[int, ...]:
        for _ in range(4):
            costs = [min(c, 2 + costs[FILLED[q]]) for q, c in enumerate(costs)]
        return tuple(costs)

    @staticmethod
    def choices(after: tuple[int, ...], kind: int, state: int) -> list[tuple[str, int, int]]:
        """(letter, cost of the rest, next state) of the edits that use up a row, letters ascending."""
        found = [("D", 3 + after[state], state)]
        if kind < CLASSES - 1:
            initial, cut = divmod(kind, 2)
            kept = kept_state(state, initial)
            if kept is not None:
                found.append(("K", cut + after[kept], kept))
            found.append(("R", 2 + cut + after[FILLED[state]], FILLED[state]))
        return found

    def written(self, after: tuple[int, ...], kind: int, state: int) -> tuple[str, int]:
        """Letters up to the one that uses up the row, and the state then."""
        best = self.with_inserts([min(c for _, c, _ in self.choices(after, kind, q)) for q in range(4)])
        letters = ""
        while True:
            letter, state_after, found = "", state, self.choices(after, kind, state)
            if 2 + best[FILLED[state]] == best[state]:
                found.append(("I", best[state], FILLED[state]))
            letter, _, state_after = min(x for x in found if x[1] == best[state])
            letters, state = letters + letter, state_after
            if letter != "I":
                return letters, state

    @staticmethod
    def closing(state: int) -> str:
        letters = ""
        while state not in (START, ASSISTANT):
            letters, state = letters + "I", FILLED[state]
        return letters

    def blocks(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes in front that fill no block, and the codes of the blocks behind them."""
        front = kinds.size % BLOCK
        codes = np.zeros((kinds.size - front) // BLOCK, np.int64)
        for i in range(BLOCK):
            codes = codes * CLASSES + kinds[front + i::BLOCK]
        return kinds[:front], codes

    def leads(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vector number and cost before a chunk, for every vector number after it."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        front, codes = self.blocks(kinds)
        for code in codes[::-1]:
            cost += self.block_cost[at, code]
            at = self.block_step[at, code]
        for kind in front[::-1]:
            cost += self.cost[at, kind]
            at = self.step[at, kind]
        return at, cost

    def after_each(self, kinds: np.ndarray, after: int) -> list[int]:
        """Vector number after every row of a chunk: block ends by lookup, then each block expanded backward, all at once."""
        front, codes = self.blocks(kinds)
        ends = np.empty(codes.size, np.int64)
        for i in range(codes.size - 1, -1, -1):
            ends[i] = after
            after = int(self.block_step[after, codes[i]])
        inside = np.empty((codes.size, BLOCK), np.int64)
        symbols = kinds[front.size:].reshape(-1, BLOCK)
        for i in range(BLOCK - 1, -1, -1):
            inside[:, i] = ends
            ends = self.step[ends, symbols[:, i]]
        lead = []
        for kind in front[::-1]:
            lead.append(after)
            after = int(self.step[after, kind])
        return lead[::-1] + inside.ravel().tolist()

    def trace(self, kinds: np.ndarray, after: int, state: int) -> tuple[str, int]:
        """Letters of a chunk entered in ``state``, and the state behind it."""
        written, letters = [], self.letters
        for vector, kind in zip(self.after_each(kinds, after), kinds.tolist(), strict=True):
            more, state = letters[vector][kind][state]
            written.append(more)
        return "".join(written), state


@dataclass(frozen=True)
class Repair:
    """``report``: a row per conversation (conv, gaps, blank, duplicate, truncated, illegal, cost, audit). ``rows``: the repaired
    turns (conv, position, role, text), those of a conversation behind each other in one partition, by position."""

    report: DataFrame
    rows: DataFrame


def seated(rows: DataFrame) -> DataFrame:
    """Narrow distinct rows in order: ``seat`` ascends by conversation, turn, role and text digest over the whole table."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut = F.when(F.substring(end, -1, 1).isin(".", "!", "?"), 0).otherwise(CUT)
    narrow = rows.select("conv", "turn", "role", "digest", (end == "").alias("blank"), (code + cut).cast("int").alias("code"))
    order = ["conv", "turn", "role", "digest"]
    counted = narrow.groupBy(*order, "blank", "code").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("seat", F.monotonically_increasing_id()), "conversation-seats")


def stored_chunks(seats: DataFrame, chunk: int) -> DataFrame:
    """A row per chunk: its symbols, what its tables lead to, and the counts that add up over a conversation."""
    # the first row of a role and text is found on the key, and told to the rows by their seats, which are distinct
    firsts = seats.groupBy("conv", "role", "digest").agg(F.min("seat").alias("seat")).select("seat", F.lit(True).alias("first"))
    rows = (seats.join(firsts, "seat", "left").withColumn("part", F.shiftright("seat", 33))
            .select("part", "seat", "conv", "turn", "n", "code", "blank", F.coalesce("first", F.lit(False)).alias("first"))
            .repartition("part").sortWithinPartitions("seat"))
    conv = seats.schema["conv"].dataType
    turn = seats.schema["turn"].dataType
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("conv", conv), T.StructField("at", long), T.StructField("symbols", T.BinaryType()),
                           T.StructField("leads", longs), T.StructField("costs", longs), T.StructField("low", turn), T.StructField("high", turn),
                           *[T.StructField(n, long) for n in ("turns", "blank", "duplicate", "truncated", "illegal")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, found, names = Tables(), [], [f.name for f in schema.fields]
        legal = np.zeros((4, 4), bool)
        legal[tuple(zip(*LEGAL_PAIRS, strict=True))] = True
        now: dict = {}

        def close() -> None:
            symbols = np.concatenate(now["bytes"])
            leads, costs = tables.leads(tables.kinds[symbols])
            codes = symbols & 3
            illegal = int((~legal[codes[:-1], codes[1:]]).sum())
            found.append((now["conv"], now["at"], symbols.tobytes(), leads.tolist(), costs.tolist(), now["low"], now["high"], now["turns"],
                          now["blank"], now["duplicate"], now["truncated"], illegal))

        def flush() -> Iterator[pa.RecordBatch]:
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(names, f, strict=True)) for f in found], schema=arrow)
                found.clear()

        arrow = arrow_schema(schema)
        for batch in batches:
            for part, seat, conv_id, turn_no, n, code, blank, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not now or now["size"] >= chunk or now["part"] != part or now["conv"] != conv_id:
                    if now:
                        close()
                    now = {"part": part, "conv": conv_id, "at": seat, "bytes": [], "size": 0, "low": None, "high": None, "turns": 0,
                           "blank": 0, "duplicate": 0, "truncated": 0}
                gone = blank or not first
                run_of = np.full(n, (code & 3) | GONE, np.uint8)
                if not gone:
                    run_of[0] = code
                now["bytes"].append(run_of)
                now["size"] += n
                if turn_no is not None and turn_no != now["high"]:
                    now["low"] = turn_no if now["low"] is None else now["low"]
                    now["high"], now["turns"] = turn_no, now["turns"] + 1
                now["blank"] += n if blank else 0
                now["duplicate"] += 0 if blank else n - first
                now["truncated"] += bool(code & CUT) and not gone
            yield from flush()
        if now:
            close()
        yield from flush()

    return materialize(rows.mapInArrow(run, schema), "conversation-chunks")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def with_ends(chunks: DataFrame) -> DataFrame:
    """(at, after, leading, cost): the vector number behind each chunk, whether it is its conversation's first, and there the cost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, last, out = Tables(), None, []
        for batch in batches:
            for conv, at, leads, costs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if last is None or last[0] != conv:
                    if last:
                        out.append((last[1], last[2], True, last[4] + tables.vectors[last[3]][START]))
                    after, spent = 0, 0
                else:
                    out.append((last[1], last[2], False, None))
                    after, spent = last[3], last[4]
                last = conv, at, after, leads[after], spent + costs[after]
            yield rows(out)
            out = []
        if last:
            yield rows([(last[1], last[2], True, last[4] + tables.vectors[last[3]][START])])

    def rows(out: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["at", "after", "leading", "cost"])

    narrow = chunks.select("conv", "at", "leads", "costs").repartition("conv").sortWithinPartitions("conv", F.desc("at"))
    return narrow.mapInArrow(run, "at long, after int, leading boolean, cost long")


def traced(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """Chunks with the letters and the state behind them, for each state they may be entered in."""
    rows = chunks.drop("leads", "costs").join(ends, "at")
    schema = T.StructType([*rows.schema.fields, T.StructField("letters", T.ArrayType(T.StringType())),
                           T.StructField("states", T.ArrayType(T.IntegerType()))])
    symbols, after, leading = (rows.columns.index(n) for n in ("symbols", "after", "leading"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            letters, states = [], []
            for content, end, first in zip(*[batch.column(i).to_pylist() for i in (symbols, after, leading)], strict=True):
                kinds = tables.kinds[np.frombuffer(content, np.uint8)]
                found = [tables.trace(kinds, end, q) for q in range(1 if first else 4)]
                letters.append([f[0] for f in found])
                states.append([f[1] for f in found])
            columns = [*batch.columns, pa.array(letters, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    edge = F.conv(F.hex(F.substring(F.col("symbols"), -1, 1)), 16, 10).cast("int").bitwiseAND(F.lit(3))
    head = F.conv(F.hex(F.substring(F.col("symbols"), 1, 1)), 16, 10).cast("int").bitwiseAND(F.lit(3))
    return rows.mapInArrow(run, schema).withColumns({"head": head, "tail": edge}).drop("symbols", "after", "leading")


def reported(parts: DataFrame, conv_type: T.DataType) -> DataFrame:
    """One row per conversation from its traced chunks, in order."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([T.StructField("conv", conv_type), *[T.StructField(n, T.LongType()) for n in counts], T.StructField("audit", T.StringType())])
    order = ["conv", "at", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "letters", "states", "head", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, now, out, arrow = Tables(), None, [], arrow_schema(schema)

        def close() -> None:
            gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
            audit = "".join(now["audit"]) + tables.ending[now["state"]]
            out.append({"conv": now["conv"], "gaps": gaps, "audit": audit, **{n: now[n] for n in counts[1:]}})

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now["conv"] != row["conv"]:
                    if now:
                        close()
                    now = row | {"audit": [], "state": START}
                else:
                    if now["high"] is not None and row["low"] == now["high"]:
                        now["turns"] -= 1
                    now["low"] = row["low"] if now["low"] is None else now["low"]
                    now["high"] = now["high"] if row["high"] is None else row["high"]
                    for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
                        now[name] += row[name]
                    now["illegal"] += (now["tail"], row["head"]) not in LEGAL_PAIRS
                    now["tail"] = row["tail"]
                now["audit"].append(row["letters"][now["state"]])
                now["state"] = row["states"][now["state"]]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if now:
            close()
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return parts.select(*order).repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(run, schema)


def edited(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired turns: rows stream by in the order of the seats, behind the audit of their conversation."""
    order = ["conv", "kind", "turn", "role", "digest"]
    texts = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    audits = report.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
                           F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"))
    schema = T.StructType([rows.schema["conv"], T.StructField("position", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, conv, audit, at, state, position = arrow_schema(schema), None, "", 0, START, 0
        out: list[tuple] = []

        def put(role: str, text: str, after: int) -> None:
            nonlocal state, position
            out.append((conv, position, role, text))
            position, state = position + 1, after

        def fill(text: str) -> None:
            put("assistant" if state == USER else "user", text, FILLED[state])

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                fill("")
                at += 1

        for batch in batches:
            for own, kind, role, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 5)], strict=True):
                if kind == 0:
                    inserts()
                    conv, audit, at, state, position = own, text, 0, START, 0
                    continue
                inserts()
                letter, at = audit[at], at + 1
                if letter == "K":
                    put(role, text, kept_state(state, INITIALS.index(role[0])))
                elif letter == "R":
                    fill(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)], schema=arrow)
                out.clear()
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return texts.unionByName(audits).repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> Repair:
    blank = F.lit(" ")
    plain = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), blank).alias("role"),
                         F.coalesce(F.col(text), blank).alias("text"))
    rows = plain.withColumn("digest", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    chunks = stored_chunks(seated(rows), chunk)
    report = materialize(reported(traced(chunks, with_ends(chunks)), rows.schema["conv"].dataType), "conversation-report")
    return Repair(report, edited(rows, report))


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256): SHA-256 of ``role:text`` of the rows of ``Repair.rows``, joined by line feeds. They are hashed as they stream by."""
    schema = T.StructType([rows.schema["conv"], T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, conv, total, out = arrow_schema(schema), None, None, []
        for batch in batches:
            for own, position, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if position == 0:
                    if total:
                        out.append((conv, total.hexdigest()))
                    conv, total = own, hashlib.sha256()
                else:
                    total.update(b"\n")
                total.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)], schema=arrow)
                out.clear()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow[0].type), pa.array([total.hexdigest()], arrow[1].type)], schema=arrow)

    return rows.mapInArrow(run, schema)


ship(__name__)
