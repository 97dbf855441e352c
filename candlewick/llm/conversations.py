"""Structure repair of conversations: a min-plus dynamic program over runs of equal symbols.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its rows are kept, given another role
or deleted, and empty messages are inserted, at the least total cost. Of equal costs the audit (the
edits' initials in order) that is least in ASCII order wins; an audit determines the repaired rows.

A conversation may hold any share of all rows. Its rows are ordered by range partitions and cut into
segments. Every segment's runs give a 4 x 4 min-plus matrix, with cached binary powers for long runs.
A pass from the last segment to the first turns the matrices into the cost left after each segment,
and a pass from the first to the last unrolls the edits, a block of rows at a time. These two passes
stream through one task per conversation, the first over one row per segment; the second is bound
to the order of the rows by the checksum and the audit, which are one value per conversation.

Rows of one turn are ordered by role, the text's first 64 characters and its digest. Null roles and
texts are one space; null turns come first; null ids are one conversation. Repeated rows are
duplicates of the first. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.text import scratch, store

RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
#: Rows of a segment are 2 ** SEGMENT at most; a longer run is unrolled in blocks of BLOCK rows.
SEGMENT, BLOCK = 12, 4096
#: An output batch ends beyond so many rows or characters.
BATCH_ROWS, BATCH_CHARS = 4096, 4_000_000

FAULTS = ("", "truncated", "blank", "duplicate")
INITIALS = "sua"
FAR = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a message, by its initial and the state before.
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: What may be inserted, or what a row may be retitled to, by the state before.
TURN = ("u", "u", "a", "u")
TITLES = {"u": "user", "a": "assistant"}

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *[row[k] + b[k][j] for k in range(4)]) for j in range(4)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, row[0] + v[0], row[1] + v[1], row[2] + v[2], row[3] + v[3]) for row in a)


def _insertions() -> Matrix:
    """Costs of any number of insertions."""
    costs = [[0 if p == q else FAR for q in range(4)] for p in range(4)]
    for p in range(4):
        q, cost = p, 0
        for _ in range(2):
            q, cost = AFTER[TURN[q]][q], cost + INSERT
            costs[p][q] = min(costs[p][q], cost)
    return tuple(map(tuple, costs))


INSERTIONS = _insertions()
#: The cost left after the last row.
END: Vector = tuple(min(row[START], row[ASSISTANT]) for row in INSERTIONS)


def symbol(initial: str, fault: int) -> int:
    """One number for a role's initial and a fault."""
    return 4 * (INITIALS.find(initial) if initial else -1) + 4 + fault


@cache
def choices(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state: the edit's initial, its cost and the next state."""
    initial, fault = code // 4 - 1, code % 4
    found = [("D", DELETE, state)]
    if FAULTS[fault] in ("", "truncated"):
        penalty = TRUNCATED if fault else 0
        kept = AFTER[INITIALS[initial]][state] if initial >= 0 else None
        if kept is not None:
            found.append(("K", penalty, kept))
        found.append(("R", RETITLE + penalty, AFTER[TURN[state]][state]))
    return found


class Powers:
    """Transition matrices of symbols, insertions before the row included, and their binary powers."""

    def __init__(self):
        self.known: dict[tuple[int, int], Matrix] = {}

    def of(self, code: int, bit: int = 0) -> Matrix:
        """The matrix of 2 ** bit equal symbols."""
        if (code, bit) not in self.known:
            if bit:
                half = self.of(code, bit - 1)
                self.known[code, bit] = _product(half, half)
            else:
                step = [[FAR] * 4 for _ in range(4)]
                for state in range(4):
                    for _, cost, after in choices(code, state):
                        step[state][after] = min(step[state][after], cost)
                self.known[code, bit] = _product(INSERTIONS, tuple(map(tuple, step)))
        return self.known[code, bit]

    def run(self, code: int, count: int) -> Iterator[Matrix]:
        """Matrices whose product in any order is that of ``count`` equal symbols."""
        for bit in range(count.bit_length()):
            if count >> bit & 1:
                yield self.of(code, bit)

    def before(self, code: int, count: int, left: Vector) -> Vector:
        """The cost left before a run, from that after it."""
        for matrix in self.run(code, count):
            left = _apply(matrix, left)
        return left

    def segment(self, runs: list[tuple[int, int]]) -> Matrix:
        total = None
        for code, count in runs:
            for matrix in self.run(code, count):
                total = matrix if total is None else _product(total, matrix)
        return total


def collapse(symbols: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (symbol, count) of equal consecutive symbols."""
    runs: list[tuple[int, int]] = []
    for code, count in symbols:
        if runs and runs[-1][0] == code:
            runs[-1] = (code, runs[-1][1] + count)
        else:
            runs.append((code, count))
    return runs


def unroll(powers: Powers, code: int, count: int, state: int, left: Vector):
    """The edits of each row of a run, insertions before it included; returns the state after the run."""
    if count > BLOCK:
        half = count // 2
        state = yield from unroll(powers, code, half, state, powers.before(code, count - half, left))
        return (yield from unroll(powers, code, count - half, state, left))
    vectors = [left]
    for _ in range(count):
        vectors.append(_apply(powers.of(code), vectors[-1]))
    for at in range(count, 0, -1):
        edits, here, after = "", vectors[at], vectors[at - 1]
        while True:
            cheapest = here[state]
            found = [(edit, to) for edit, cost, to in choices(code, state) if cost + after[to] == cheapest]
            deleted = [x for x in found if x[0] == "D"]
            inserted = AFTER[TURN[state]][state]
            if not deleted and INSERT + here[inserted] == cheapest:
                edits, state = edits + "I", inserted
                continue
            edit, state = min(deleted or found)
            break
        yield edits + edit
    return state


def unroll_segment(powers: Powers, runs: list[tuple[int, int]], state: int, left: Vector):
    """The edits of each row of a segment, given the cost left after it; returns the state after it."""
    lefts = [left]
    for code, count in reversed(runs[1:]):
        lefts.append(powers.before(code, count, lefts[-1]))
    for code, count in runs:
        state = yield from unroll(powers, code, count, state, lefts.pop())
    return state


def ending(state: int) -> str:
    """Insertions after the last row."""
    return "" if state in (START, ASSISTANT) else "I" if state == USER else "II"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and n (how often in a row) after the damage that crc32 of ``conv_id:turn`` decides."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
        kind.alias("kind"),
    ).filter("kind <> 0").drop("kind")


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with n, the first one's fault and ``digest``."""
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    one = one.withColumn("digest", F.unhex(F.sha2("text", 256)))
    age = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    first = one.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(age).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    return one.join(first, same).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "n",
        "digest",
        F.when(end == "", 2)
        .when(~F.col("turn").eqNullSafe(F.col("first.turn")), 3)
        .when(~end.isin(".", "!", "?"), 1)
        .otherwise(0)
        .alias("fault"),
    )


def _put_in_order(rows: DataFrame, folder: str) -> DataFrame:
    """The rows with ``pos``, which rises with conversation and turn; segments are runs of ``pos``."""
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64), "digest"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return store(ordered.withColumn("pos", F.monotonically_increasing_id()).drop("digest"), f"{folder}/rows")


def _matrices(rows: DataFrame, bits: int) -> DataFrame:
    """conv_id, pos (of the segment's first row), runs and matrix of every segment."""
    segments = rows.groupBy("conv_id", F.shiftright("pos", bits).alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.substring("role", 1, 1).alias("initial"), "fault", "n"))).alias("rows")
    )
    kinds = T.StructType([rows.schema["conv_id"], *T.DataType.fromDDL("pos long, runs binary, matrix array<long>").fields])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out = []
            for rows in batch["rows"].to_pylist():
                runs = collapse(
                    (symbol(r["initial"], fault), count)
                    for r in rows
                    for fault, count in ((r["fault"], 1), (r["fault"] if r["fault"] == 2 else 3, r["n"] - 1))
                    if count
                )
                out.append((rows[0]["pos"], np.array(runs, np.int64).tobytes(), [x for row in powers.segment(runs) for x in row]))
            pos, runs, matrix = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch["conv_id"], pa.array(pos, pa.int64()), pa.array(runs, pa.binary()), pa.array(matrix, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "pos", "runs", "matrix"])

    return segments.select("conv_id", "rows").mapInArrow(reduce, kinds)


def _costs_left(segments: DataFrame) -> DataFrame:
    """conv_id, pos, runs and ``costs``, those left after each segment; reads segments from the last to the first."""
    kinds = T.StructType([segments.schema["conv_id"], *T.DataType.fromDDL("pos long, runs binary, costs array<long>").fields])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = (), END
        for batch in batches:
            costs = []
            for conv, matrix in zip(batch["conv_id"].to_pylist(), batch["matrix"].to_pylist(), strict=True):
                if held != (conv,):
                    held, left = (conv,), END
                costs.append(left)
                left = _apply(tuple(tuple(matrix[i : i + 4]) for i in range(0, 16, 4)), left)
            columns = [batch["conv_id"], batch["pos"], batch["runs"], pa.array(costs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "pos", "runs", "costs"])

    backwards = segments.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc("pos"))
    return backwards.mapInArrow(back, kinds)


_EDITS = "position long, edit string, cost long, turn long, fault string, old_role string, role string, text string"


def _edited(records: Iterator[dict]) -> Iterator[tuple]:
    """Edits, from records by conversation and pos: its id first, then each segment before its rows."""
    powers, conv, position, state, segment = Powers(), None, 0, START, iter(())

    def inserted() -> tuple:
        nonlocal state, position
        initial = TURN[state]
        state, position = AFTER[initial][state], position + 1
        return (conv, position - 1, "I", INSERT, None, "", None, TITLES[initial], "")

    def end() -> Iterator[tuple]:
        for _ in ending(state):
            yield inserted()

    begun = False
    for r in records:
        if r["kind"] == 0:  # another conversation
            if begun:
                yield from end()
            begun, conv, position, state = True, r["conv_id"], 0, START
            yield (conv, -1, "", 0, None, "", None, None, None)
        elif r["kind"] == 1:
            runs = np.frombuffer(r["runs"], np.int64).reshape(-1, 2).tolist()
            segment = unroll_segment(powers, runs, state, tuple(r["costs"]))
        else:
            for copy in range(r["n"]):
                fault = FAULTS[r["fault"] if not copy or r["fault"] == 2 else 3]
                edits = next(segment)
                for _ in edits[:-1]:
                    yield inserted()
                edit, role = edits[-1], r["role"]
                initial = TURN[state] if edit == "R" else role[:1]
                cost = {"D": DELETE, "K": 0, "R": RETITLE}[edit] + (TRUNCATED if edit != "D" and fault == "truncated" else 0)
                if edit != "D":
                    role, state = TITLES[initial] if edit == "R" else role, AFTER[initial][state]
                yield (conv, position, edit, cost, r["turn"], fault, r["role"], None if edit == "D" else role, r["text"])
                position += 1
    if begun:
        yield from end()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from batch.slice(at, 1000).to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema, wide: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches bounded by rows and by the characters of column ``wide``."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[wide] or "")
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def edits(rows: DataFrame, ids: DataFrame | None = None, bits: int = SEGMENT) -> DataFrame:
    """All edits of all conversations, by conversation and position in every partition.

    ``rows``: conv_id, turn, role, text, and n where a row stands several times in a row. ``ids``:
    a column conv_id of the conversations to list, those without rows included (default: those with rows).
    Columns: conv_id, position, edit (K, R, D or I), cost, turn, fault, old_role, role (null: deleted)
    and text. A row with position -1 and an empty edit opens each conversation.
    """
    folder = scratch(rows.sparkSession)
    rows = rows if "n" in rows.columns else rows.withColumn("n", F.lit(1).cast("long"))
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    rows = rows.select("conv_id", "turn", "role", "text", "n").withColumns(space)
    ids = (rows if ids is None else ids).select("conv_id").distinct()
    rows = _put_in_order(judged(rows), folder)
    segments = _costs_left(_matrices(rows, bits))
    records = (
        rows.withColumn("kind", F.lit(2))
        .unionByName(segments.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(ids.withColumns({"kind": F.lit(0), "pos": F.lit(-1).cast("long")}), allowMissingColumns=True)
    )
    kinds = T.StructType([rows.schema["conv_id"], *T.DataType.fromDDL(_EDITS).fields])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        yield from _batches(_edited(_records(batches)), to_arrow_schema(kinds), 8)

    return records.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "pos", "kind").mapInArrow(walk, kinds)


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, role and text."""
    return edits.filter("role IS NOT NULL").select("conv_id", "position", "role", "text")


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Tally:
    def __init__(self, conv):
        self.conv, self.faults, self.illegal, self.cost, self.audit = conv, dict.fromkeys(FAULTS, 0), 0, 0, []
        self.turns, self.low, self.high, self.before = 0, None, None, None
        self.hash, self.joint = hashlib.sha256(), ""

    def add(self, r: dict) -> None:
        self.cost += r["cost"]
        self.audit.append(r["edit"])
        if r["edit"] != "I":
            self.faults[r["fault"]] += 1
            initial = r["old_role"][:1]
            if self.before is not None:
                self.illegal += self.before + initial not in ("su", "ua", "au")
            self.before = initial
            if r["turn"] is not None:  # turns rise
                self.turns += r["turn"] != self.high
                self.low, self.high = r["turn"] if self.low is None else self.low, r["turn"]
        if r["role"] is not None:
            self.hash.update(f"{self.joint}{r['role']}:{r['text']}".encode("utf-8", "surrogatepass"))
            self.joint = "\n"

    def row(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        faults = [self.faults[name] for name in ("blank", "duplicate", "truncated")]
        return (self.conv, gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def report(edits: DataFrame) -> DataFrame:
    """A row per conversation, from edits in the order that ``edits`` gives them.

    gaps: turns missing between the least and the largest (at most 2 ** 63 - 1); blank, duplicate and
    truncated: rows by fault; illegal: neighbours whose initials are not su, ua or au; cost; audit;
    repaired_sha256: checksum of the repaired ``role:text`` lines. Without rows: zeros, an empty audit
    and the checksum of nothing.
    """
    kinds = T.StructType([edits.schema["conv_id"], *T.DataType.fromDDL(_REPORT).fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        def tallies() -> Iterator[tuple]:
            tally = None
            for r in _records(batches):
                if r["position"] < 0:
                    if tally:
                        yield tally.row()
                    tally = _Tally(r["conv_id"])
                else:
                    tally.add(r)
            if tally:
                yield tally.row()

        yield from _batches(tallies(), to_arrow_schema(kinds), 7)

    return edits.mapInArrow(count, kinds)


def repair(conversations: DataFrame) -> DataFrame:
    """``report`` on the damaged conversations."""
    return report(edits(damage(conversations), conversations))
