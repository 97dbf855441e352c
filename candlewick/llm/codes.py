"""Compression of vectors to codes of four bytes: product codebooks by dual-tree Lloyd rounds.

Components become integers floor(1024 * x) and vectors are cut into four equal consecutive parts. Each
task keeps its vectors in blocks. A block has a tree for every part: a node knows its box, its count
and its sum. In each round a second tree is built over the codebook's entries, and pairs of nodes are
followed down both trees: a pair goes when its least distance exceeds the largest distance of another
pair of the same node of parts, and an entry goes when another is nearer in the whole box. A node left
with one entry is assigned as a whole, with its stored sum; leaves left with several compare integer
distances. All arithmetic is of integers, so results do not depend on blocks or partitions.

Blocks are written once and every round reads them; what leaves a task is at most one sum per entry
and component. The codebook is 4 x 256 entries and the only thing the driver holds.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.text import scratch, store

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_ROWS, LEAF_ROWS = 8192, 32
#: Components are below this as integers, so that squared distances of up to 512 components fit 64 bits.
LIMIT = 1 << 26
#: Whole numbers below this are exact as doubles.
EXACT = 1 << 53


@dataclass
class Tree:
    """Nodes of points: rows order[start:end], box, sum; children follow later, 0 for leaves; node 0 is the root."""

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray

    def pack(self) -> bytes:
        data = io.BytesIO()
        np.savez(data, **{name: array if name == "total" else array.astype(np.int32) for name, array in self.__dict__.items()})
        return data.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{name: arrays[name].astype(np.int64) for name in arrays.files})


def build(points: np.ndarray, leaf: int) -> Tree:
    """A tree halved along the widest component; nodes of one distinct point stay leaves."""
    order = np.arange(len(points))
    start, end, left, right, boxes, totals = [0], [len(points)], [0], [0], [], []
    at = 0
    while at < len(start):
        rows = order[start[at] : end[at]]
        own = points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        boxes.append((low, high))
        totals.append(own.sum(axis=0, dtype=np.int64))
        wide = high - low
        if len(rows) > leaf and wide.size and wide.max():
            half = len(rows) // 2
            split = np.argpartition(own[:, int(wide.argmax())], half)
            order[start[at] : end[at]] = rows[split]
            left[at], right[at] = len(start), len(start) + 1
            start += [start[at], start[at] + half]
            end += [start[at] + half, end[at]]
            left += [0, 0]
            right += [0, 0]
        at += 1
    low, high = (np.array(side) for side in zip(*boxes, strict=True))
    return Tree(points[order], order, *map(np.array, (start, end, left, right)), low, high, np.array(totals))


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry, exact; through doubles where all parts of the sum are exact there."""
    a, b = points.astype(np.int64), entries.astype(np.int64)
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * max(a.shape[1], 1) < EXACT:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    found = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        found += (a[:, k, None] - b[None, :, k]) ** 2
    return found


class Codebook:
    """Entries of one part, and a tree over the distinct ones; equal entries never win over the first of them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        _, first = np.unique(entries, axis=0, return_index=True) if entries.size else (None, np.array([0]))
        self.index = np.sort(first)
        self.tree = build(entries[self.index], 1)

    def assign(self, tree: Tree) -> tuple[list[tuple[int, int]], list[tuple[int, np.ndarray]]]:
        """(node, entry) of nodes assigned as a whole, and (leaf, entry of each of its rows)."""
        own, whole, leaves = self.tree, [], []
        parts, books = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(parts):
            parts, books = self._near(tree, parts, books)
            # One entry left: the node goes as a whole.
            nodes, first, count = np.unique(parts, return_index=True, return_counts=True)
            single = own.left[books] == 0
            done = (count == 1) & single[first]
            whole += zip(nodes[done].tolist(), self._entry(books[first[done]]).tolist(), strict=True)
            # Entries only, and a leaf: integers decide.
            settled = np.minimum.reduceat(single, first) & (tree.left[nodes] == 0) & ~done
            for node, at, n in zip(nodes[settled].tolist(), first[settled].tolist(), count[settled].tolist(), strict=True):
                entries = np.sort(self._entry(books[at : at + n]))
                rows = tree.points[tree.start[node] : tree.end[node]]
                leaves.append((node, entries[squares(rows, self.entries[entries]).argmin(axis=1)]))
            open_ = np.repeat(~(done | settled), count)
            parts, books = self._children(tree, parts[open_], books[open_])
        return whole, leaves

    def _entry(self, nodes: np.ndarray) -> np.ndarray:
        return self.index[self.tree.order[self.tree.start[nodes]]]

    def _children(self, tree: Tree, parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the children of both sides; leaves and entries stand for themselves. Ordered by the first."""
        for side, other in ((0, 1), (1, 0)):
            pair, nodes = (parts, books), (tree, self.tree)[side]
            leaf = nodes.left[pair[side]] == 0
            kids = np.concatenate([np.where(leaf, pair[side], nodes.left[pair[side]]), nodes.right[pair[side][~leaf]]])
            rest = np.concatenate([pair[other], pair[other][~leaf]])
            parts, books = (kids, rest) if side == 0 else (rest, kids)
        order = np.lexsort((books, parts))
        return parts[order], books[order]

    def _near(self, tree: Tree, parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that may hold a nearest entry of a row; ties stay."""
        low, high = tree.low[parts], tree.high[parts]
        below, above = self.tree.low[books], self.tree.high[books]
        gap = np.maximum(0, np.maximum(below - high, low - above))
        reach = np.maximum(above - low, high - below)
        least, most = (gap * gap).sum(1), (reach * reach).sum(1)
        first = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
        count = np.diff(np.r_[first, len(parts)])
        keep = least <= np.repeat(np.minimum.reduceat(most, first), count)
        # The entry with the least largest distance beats those that are farther in the whole box.
        best = np.repeat(np.lexsort((most, parts))[first], count)
        single = (self.tree.left[books] == 0) & (self.tree.left[books[best]] == 0)
        rival = self.tree.low[books[best]]
        apart = below - rival
        farthest = np.where(apart > 0, high, low)
        margin = (2 * farthest * apart).sum(1) + (rival * rival).sum(1) - (below * below).sum(1)
        keep &= ~(single & (margin < 0))
        return parts[keep], books[keep]


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and ``parts``: integer components, of rows whose vector is whole.

    Vectors that are null or hold a component that is null, not finite or of 65,536 and more in size go,
    and so do those of another length than the vector of the least vec_id.
    """
    value = F.col("embedding")
    fits = F.forall(value, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(LIMIT // SCALE), F.lit(False)))
    whole = embeddings.select("vec_id", "label", "embedding").filter(F.coalesce(fits, F.lit(False)))
    return whole.select("vec_id", "label", F.transform(value, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("parts"))


def _padded(vectors: np.ndarray) -> np.ndarray:
    """Components as (row, part, position); zeros fill up a length that four does not divide."""
    width = -(-vectors.shape[1] // PARTS)
    return np.pad(vectors, ((0, 0), (0, PARTS * width - vectors.shape[1]))).reshape(len(vectors), PARTS, width)


def _blocks(rows: DataFrame, length: int, folder: str) -> DataFrame:
    """Blocks of up to BLOCK_ROWS rows: vec_id, label (arrays) and a packed tree per part."""
    kinds = T.StructType(
        [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ("vec_id", "label")]
        + [T.StructField("trees", T.ArrayType(T.BinaryType()))]
    )

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            flat = pa.concat_arrays(table["parts"].chunks).flatten().to_numpy(zero_copy_only=False)
            parts = _padded(flat.reshape(table.num_rows, length))
            trees = [build(parts[:, p].astype(np.int64), LEAF_ROWS).pack() for p in range(PARTS)]
            whole = np.array([0, table.num_rows], np.int32)
            ids = [pa.ListArray.from_arrays(whole, pa.concat_arrays(table[c].chunks)) for c in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays([*ids, pa.array([trees], pa.list_(pa.binary()))], names=["vec_id", "label", "trees"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                if held and sum(b.num_rows for b in held) + piece.num_rows > BLOCK_ROWS:
                    yield block()
                    held = []
                held.append(piece)
        if held:
            yield block()

    return store(rows.filter(F.size("parts") == length).mapInArrow(plant, kinds), f"{folder}/blocks")


def _first_entries(rows: DataFrame) -> np.ndarray | None:
    """The vectors of the least vec_ids, nulls last and ties by vector: at most ENTRIES, of one length."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "parts")
    least = first.select(F.size("parts").alias("length")).limit(1).collect()
    if not least:
        return None
    found = first.filter(F.size("parts") == least[0].length).select("parts").limit(ENTRIES).collect()
    return np.array([r.parts for r in found], np.int64).reshape(len(found), least[0].length)


def _sums(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """part, entry, position (-1: the count) and total over all parts assigned to an entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(entries) for entries in books]
        totals = np.zeros((PARTS, len(books[0]), books[0].shape[1] + 1), np.int64)
        for batch in batches:
            for packed in batch["trees"]:
                for part, (book, data) in enumerate(zip(trees, packed, strict=True)):
                    tree = Tree.unpack(data.as_py())
                    whole, leaves = book.assign(tree)
                    for node, entry in whole:
                        totals[part, entry, 0] += tree.end[node] - tree.start[node]
                        totals[part, entry, 1:] += tree.total[node]
                    for node, entries in leaves:
                        np.add.at(totals[part, :, 0], entries, 1)
                        np.add.at(totals[part, :, 1:], entries, tree.points[tree.start[node] : tree.end[node]])
        used = np.argwhere((totals[:, :, :1] > 0) & np.ones_like(totals, bool))
        columns = [used[:, 0], used[:, 1], used[:, 2] - 1, totals[tuple(used.T)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "position", "total"])

    sums = blocks.select("trees").mapInArrow(count, "part long, entry long, position long, total long")
    return sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"))


def train(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The four codebooks after all rounds; an entry without parts stays."""
    books = [np.ascontiguousarray(part) for part in _padded(first).transpose(1, 0, 2)]
    for _ in range(rounds):
        totals = np.zeros((PARTS, *books[0].shape), np.int64)
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        for part, entry, position, total in _sums(blocks, books).collect():  # at most one per entry and component
            if position < 0:
                counts[part, entry] = total
            else:
                totals[part, entry, position] = total
        used = counts > 0
        for part, book in enumerate(books):
            book[used[part]] = totals[part][used[part]] // counts[part][used[part], None]
    return books


def encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (the squared distances' sum)."""
    kinds = T.StructType(
        [T.StructField(c, blocks.schema[c].dataType.elementType) for c in ("vec_id", "label")]
        + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(entries) for entries in books]
        for batch in batches:
            for at in range(batch.num_rows):
                vec_id, label = batch["vec_id"][at].values, batch["label"][at].values
                code, error = np.zeros((len(vec_id), PARTS), np.uint8), np.zeros(len(vec_id), np.int64)
                for part, (book, data) in enumerate(zip(trees, batch["trees"][at], strict=True)):
                    tree = Tree.unpack(data.as_py())
                    whole, leaves = book.assign(tree)
                    own = np.empty(len(vec_id), np.int64)
                    for node, entry in (*whole, *leaves):
                        own[tree.start[node] : tree.end[node]] = entry
                    apart = tree.points - book.entries[own]
                    code[tree.order, part] = own
                    error[tree.order] += (apart * apart).sum(1)
                codes = pa.array([c.tobytes().hex() for c in code], pa.string())
                yield pa.RecordBatch.from_arrays([vec_id, label, codes, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(assign, kinds)


def checksum(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def decode(codes: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    """``codes`` with ``embedding``, the vector that the code stands for."""
    tables = F.array(*[F.lit(book.tolist()) if book.size else F.array().cast("array<array<long>>") for book in books])
    entry = lambda part: F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int") + 1
    parts = [F.element_at(F.element_at(tables, part + 1), entry(part)) for part in range(PARTS)]
    middle = F.transform(F.slice(F.concat(*parts), 1, length), lambda x: (x + 0.5) / SCALE)
    return codes.withColumn("embedding", middle)


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every whole vector.

    Codebooks start as the parts of the 256 least vec_ids (nulls last, ties by vector); with fewer rows
    they have fewer entries. Equal distances go to the lower entry. label_error is the error summed over
    equal labels, nulls together. Rows whose vector is not whole (see ``whole_numbers``) are not in the
    result; repeated rows are. Lengths that four does not divide are filled up with zeros. Other columns
    are ignored, and an empty table gives no rows.
    """
    folder = scratch(embeddings.sparkSession)
    rows = whole_numbers(embeddings)
    first = _first_entries(rows)
    if first is None:
        return embeddings.sparkSession.createDataFrame([], T.StructType([rows.schema["vec_id"], *T.DataType.fromDDL(_RESULT).fields]))
    blocks = _blocks(rows, first.shape[1], folder)
    books = train(blocks, first)
    codes = store(encode(blocks, books), f"{folder}/codes")
    label = codes.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(label, F.col("label").eqNullSafe(F.col("same_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(checksum(books)).alias("codebooks_sha256")
    )


_RESULT = "code string, error long, label_error long, codebooks_sha256 string"
