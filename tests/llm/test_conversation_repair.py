"""Conversation repair against all edits tried one row after another, in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import contracts, conversation_repair
from patronage.llm.common import prepare
from tests.llm.conftest import DATA, ODD

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
FILL = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_damage(rows):
    damaged = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return damaged


def plain_cheapest(rows):
    """(cost, letters, repaired) by keeping, per state, the least (cost, letters) of all edits so far."""
    def inserted(best):
        for _ in range(3):
            for state, (cost, letters, out) in list(best.items()):
                offer = cost + 2, letters + "I", [*out, ("user" if FILL[state] == "u" else "assistant", "")]
                if FILL[state] not in best or offer[:2] < best[FILL[state]][:2]:
                    best[FILL[state]] = offer
        return best

    best = inserted({"": (0, "", [])})
    for role, text, gone, cut in rows:
        offers = []
        for state, (cost, letters, out) in best.items():
            offers.append((state, (cost + 3, letters + "D", out)))
            if not gone:
                if (state, role[:1]) in NEXT:
                    offers.append((NEXT[state, role[:1]], (cost + cut, letters + "K", [*out, (role, text)])))
                offers.append((FILL[state], (cost + 2 + cut, letters + "R", [*out, ("user" if FILL[state] == "u" else "assistant", text)])))
        best = {}
        for state, offer in offers:
            if state not in best or offer[:2] < best[state][:2]:
                best[state] = offer
        best = inserted(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def plain_report(rows):
    """Per conversation what the query returns, from rows already damaged."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, kinds, faulty = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            blank, duplicate = not end, (role, text) in seen
            cut = bool(end) and end[-1] not in ".!?"
            seen.add((role, text))
            for i, fault in enumerate((blank, not blank and duplicate, not blank and not duplicate and cut)):
                faulty[i] += fault
            kinds.append((role, text, blank or duplicate, int(cut)))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, out = plain_cheapest(kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (gaps, *faulty, illegal, cost, audit, digest)
    return found


def found_rows(turns, **settings):
    repair = conversation_repair.repair(turns, **settings)
    rows = {r["conv"]: r for r in conversation_repair.digests(repair.rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                        rows[r["conv"]]["sha256"] if r["conv"] in rows else empty) for r in repair.report.collect()}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = plain_report(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = {r["conv_id"]: tuple(r)[1:] for r in contracts.op11(spark, DATA).collect()}
    assert found == {conv: wanted.get(conv, nothing) for conv in {r[0] for r in rows}}


def odd_turns(draw, conversations=60):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " ", None, "superuser"]
    texts = ["yes.", "no!", "why?", "cut", "", " \t", None, "x\x0b", "é.", "dots...  ", "\x85", "a\nb", "日本"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(draw.randint(1, 12)):
            row = (conv, draw.choice([turn, turn, turn, None, turn // 2, -turn]), draw.choice(roles), draw.choice(texts))
            rows += [row] * draw.choice([1, 1, 1, 2, 3])
    return rows


def test_odd_rows_and_chunks(spark):
    prepare(spark)
    rows = odd_turns(random.Random(5))
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    turns = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "conv_id long, turn long, role string, text string, kind string, audit double")
    wanted = plain_report(plain)
    for chunk in (1, 3, 1 << 20):
        assert found_rows(turns.repartition(5), chunk=chunk) == wanted, chunk
    assert conversation_repair.repair(turns.limit(0)).report.count() == 0


def test_damage_is_that_of_the_plain_rule(spark):
    rows = odd_turns(random.Random(6))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(map(tuple, contracts.damaged(turns).collect()), key=key) == sorted(plain_damage(rows), key=key)


def test_one_conversation_holds_a_third_of_all_rows(spark):
    prepare(spark)
    draw = random.Random(7)
    rows = [(7, t, draw.choice(["user", "assistant"]), f"{draw.randrange(4000)}.") for t in range(5000)]
    rows += [(8, t, "user", "the same.") for t in range(300)] + [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(100, 1100) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found_rows(turns.repartition(16), chunk=64) == plain_report(rows)


@pytest.mark.parametrize("text", ["word " * 400_000 + "end", "x" * 2_000_000])
def test_very_long_text(spark, text):
    prepare(spark)
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "."), (1, 2, "user", text)]
    assert found_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) == plain_report(rows)


def test_block_tables_are_the_steps_of_their_symbols():
    tables, rng = conversation_repair.Tables(), np.random.default_rng(3)
    for size in range(12):
        kinds = rng.integers(0, conversation_repair.CLASSES, size)
        at, cost = tables.leads(kinds)
        for vector in range(len(tables.vectors)):
            now, spent = vector, 0
            after = []
            for kind in kinds[::-1]:
                after.append(now)
                spent += tables.cost[now, kind]
                now = tables.step[now, kind]
            assert (now, spent) == (at[vector], cost[vector]) and tables.after_each(kinds, vector) == after[::-1]


def test_odd_texts_of_the_other_operators(spark, odd):
    turns = odd.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("user").alias("role"), "text")
    rows = [(1, r["turn"], r["role"], " " if r["text"] is None else r["text"]) for r in turns.collect()]
    assert len(rows) == len(ODD) + 3 and found_rows(turns) == plain_report(rows)
