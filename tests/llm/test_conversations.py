"""Conversation repair against an exhaustive search, on odd rows, and across segments."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from candlewick.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"


def judged(rows):
    """(role, text, fault) of rows (turn, role, text) in order."""
    found, seen = [], set()
    for _, role, text in rows:
        solid = text.strip(conv.SPACE)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def cheapest(rows):
    """Cost, audit and repaired lines by trying all edits up to two insertions before each row."""
    best = None
    options = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for _, _, f in rows]
    for edits in itertools.product(*options):
        for inserts in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for at in range(len(rows) + 1):
                for i in inserts[at]:
                    cost, audit, lines = cost + 5, audit + "I", [*lines, conv.TITLES[i] + ":"]
                if at == len(rows):
                    break
                (role, text, fault), edit = rows[at], edits[at]
                audit += edit[0]
                cost += {"D": 2, "K": 0, "R": 1}[edit[0]] + (5 if fault == "truncated" and edit != "D" else 0)
                if edit != "D":
                    lines.append(f"{role if edit == 'K' else conv.TITLES[edit[1]]}:{text}")
            if (best is None or (cost, audit) < best[:2]) and re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines)):
                best = (cost, audit, "\n".join(lines))
    return best


def expected(rows):
    faults = judged(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _, _ in faults]
    cost, audit, lines = cheapest(faults)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: sum(f == name for _, _, f in faults) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest(),
    }


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def as_dicts(report):
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in report.collect()}


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_all_edits(spark, bits):
    rng, rows = random.Random(bits), {}
    for c in range(60):
        texts = ["ok.", "cut", " \n", "Yes!", "other?", "more"]
        rows[c] = [(rng.choice([None, *range(6)]), rng.choice(["system", "user", "assistant", "tool", " "]), rng.choice(texts)) for _ in range(rng.randint(1, 3))]
    frame = spark.createDataFrame([(c, *r) for c, found in rows.items() for r in found], SCHEMA)
    found = as_dicts(conv.report(conv.edits(frame, bits=bits)))
    assert found == {c: expected(in_order(r)) for c, r in rows.items()}


def test_damage(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t}! done.") for c in range(40) for t in range(3)]
    left = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        left.setdefault(c, []).extend([(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    found = as_dicts(conv.repair(spark.createDataFrame(rows, SCHEMA)))
    assert found == {c: expected(r) for c, r in left.items() if len(r) < 4} | {c: found[c] for c, r in left.items() if len(r) > 3}


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", None), (2, 0, "", "x."), (2, 0, "", "x.")]
    rows += [(3, 2**63 - 1, "user", "q?"), (3, -(2**63), "user", "q?"), (4, 1, "user", "é" * 300_000 + "."), (4, 2, "assistant", "▁.")]
    frame = spark.createDataFrame([(*r, "k", 1, r[0]) for r in rows], SCHEMA + ", pos string, kind int, n_rows long")
    found = as_dicts(conv.report(conv.edits(frame)))
    assert (found[None]["blank"], found[None]["audit"], found[None]["cost"]) == (1, "DD", 4)
    assert (found[1]["blank"], found[1]["gaps"], found[1]["cost"]) == (1, 0, 2)
    assert (found[2]["duplicate"], found[2]["illegal"], found[2]["audit"]) == (1, 1, "DD")
    assert found[3]["gaps"] == 2**63 - 1 and found[3]["duplicate"] == 1
    assert found[4]["audit"] == "KK"
    kept = conv.repaired(conv.edits(frame)).filter("conv_id = 4").orderBy("position").collect()
    assert [(r.role, len(r.text)) for r in kept] == [("user", 300_001), ("assistant", 2)]
    nothing = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    ids = spark.createDataFrame([(9,), (None,)], "conv_id long")
    assert as_dicts(conv.report(conv.edits(frame.limit(0), ids))) == {9: nothing, None: nothing}
    assert as_dicts(conv.repair(frame.limit(0))) == {}


def test_one_conversation_of_many_rows(spark):
    """A third of the rows are copies; the rest alternate, in an order that only turns give."""
    rows = spark.range(9000).select(
        F.lit(7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END").alias("role"),
        F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    copies = spark.range(4500).select(F.lit(7).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("again!").alias("text"))
    found = as_dicts(conv.report(conv.edits(rows.unionByName(copies), bits=6)))[7]
    # The first copy takes the place of the first user's turn, or goes; either costs two.
    assert found["cost"] == 2 * 4500 and found["duplicate"] == 4499 and found["audit"] == "D" * 4500 + "K" * 9000
    assert found["repaired_sha256"] == hashlib.sha256("\n".join(f"{'assistant' if i % 2 else 'user'}:{i}." for i in range(9000)).encode()).hexdigest()


def test_runs_in_blocks_equal_single_rows(monkeypatch):
    powers, rng = conv.Powers(), random.Random(1)
    for _ in range(200):
        runs = conv.collapse((conv.symbol(rng.choice(["s", "u", "a", "t", ""]), rng.randrange(4)), rng.randint(1, 9)) for _ in range(rng.randint(1, 6)))
        whole = "".join(conv.unroll_segment(powers, runs, conv.START, conv.END))
        with monkeypatch.context() as patch:
            patch.setattr(conv, "BLOCK", 2)
            assert "".join(conv.unroll_segment(powers, runs, conv.START, conv.END)) == whole
        single = [(code, 1) for code, n in runs for _ in range(n)]
        assert powers.segment(runs) == powers.segment(single)
        assert "".join(conv.unroll_segment(powers, single, conv.START, conv.END)) == whole
