"""Vector codes against plain Lloyd rounds, and what the trees prune."""

import math
import random

import numpy as np
import pytest

from candlewick.llm import codes
from candlewick.llm.text import scratch

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int"


def lloyd(vectors):
    """Codebooks and codes of integer vectors in order of vec_id, by trying every entry."""
    width = vectors.shape[1] // 4
    books, found, errors = [], [], np.zeros(len(vectors), int)
    for part in range(4):
        own = vectors[:, part * width : (part + 1) * width]
        book = own[:256].copy()
        for last in (*[False] * 4, True):
            apart = ((own[:, None, :] - book[None]) ** 2).sum(2)
            near = apart.argmin(1)
            for entry in set(near.tolist()) if not last else ():
                rows = own[near == entry]
                book[entry] = [math.floor(int(x) / len(rows)) for x in rows.sum(0)]
        books.append(book)
        found.append(near)
        errors += apart.min(1)
    return books, ["".join("%02x" % c for c in row) for row in np.array(found).T.tolist()], errors.tolist()


def test_against_plain_rounds(spark):
    rng = random.Random(4)
    centres = [[rng.uniform(-2, 2) for _ in range(8)] for _ in range(12)]
    rows = []
    for i in range(700):
        near = [x + rng.gauss(0, 0.05 if i % 3 else 0.001) for x in centres[i % 12]]
        rows.append((3 * i, near if i % 5 else centres[i % 12], [None, 1, 2][i % 3], "x", 1))
    for i in range(300):  # one very common vector
        rows.append((3 * i + 1, centres[0], 7, None, None))
    rows += [rows[0], rows[0]]  # repeated rows
    bad = [None, [None] * 8, [float("nan")] * 8, [float("inf")] * 8, [1e6] * 8, [0.0] * 4, []]
    rows += [(10_000 + i, v, 1, "x", 1) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = sorted((r for r in rows if r[0] < 10_000), key=lambda r: r[0])
    vectors = np.array([[math.floor(float(np.float32(x)) * 1024) for x in r[1]] for r in whole])
    books, wanted, errors = lloyd(vectors)
    by_label = {}
    for r, error in zip(whole, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + error
    found = codes.compress(frame).collect()
    expected = sorted((r[0], code, error, by_label[r[2]], codes.checksum(books)) for r, code, error in zip(whole, wanted, errors, strict=True))
    assert sorted(tuple(r) for r in found) == expected
    blocks = codes._blocks(codes.whole_numbers(frame), 8, scratch(spark))
    decoded = codes.decode(codes.encode(blocks, books), books, 8).collect()
    assert all(len(r.embedding) == 8 for r in decoded) and len(decoded) == len(found)
    error = {r.vec_id: r.error for r in found}
    exact = {r[0]: r[1] for r in rows if r[0] < 10_000}
    for r in decoded:
        assert math.dist(exact[r.vec_id], r.embedding) <= (math.sqrt(error[r.vec_id]) + math.sqrt(8)) / 1024


def test_trees_prune_and_assign_whole_nodes():
    rng = np.random.default_rng(3)
    centres = rng.integers(-50_000, 50_000, (64, 4))
    points = np.repeat(centres, 50, axis=0) + rng.integers(-200, 200, (3200, 4))
    whole, leaves = codes.Codebook(centres).assign(codes.build(points, 32))
    assert len(whole) > 50 and len(leaves) < 30


@pytest.mark.parametrize("spread", [3, 1000, codes.LIMIT - 1])
def test_assignment_is_the_lowest_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    for width in (1, 2, 5):
        points, entries = (rng.integers(-spread, spread + 1, (n, width)) for n in (500, 90))
        tree, book = codes.Tree.unpack(codes.build(points, 8).pack()), codes.Codebook(entries)
        apart = sum((points[:, k, None].astype(object) - entries[None, :, k]) ** 2 for k in range(width))
        own = np.empty(500, int)
        for node, entry in (lambda whole, leaves: [*whole, *leaves])(*book.assign(tree)):
            own[tree.order[tree.start[node] : tree.end[node]]] = entry
        assert own.tolist() == apart.argmin(1).tolist()
        assert (codes.squares(points, entries) == apart).all()


def test_small_tables(spark):
    frame = spark.createDataFrame([(None, [1.0], None, None, None), (2, [0.5], None, None, None)], SCHEMA)
    found = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.compress(frame).collect()}
    assert found == {2: ("00000000", 0, 0), None: ("01000000", 0, 0)}
    assert codes.compress(frame.limit(0)).collect() == []
    empty = spark.createDataFrame([(1, [], 1, None, None), (2, None, 1, None, None)], SCHEMA)
    assert [(r.vec_id, r.code, r.error) for r in codes.compress(empty).collect()] == [(1, "00000000", 0)]
