"""Best-fit packing of documents into token sequences by a grouping genetic algorithm on islands.

Documents of one length are interchangeable, so a solution is a list of groups: bins of the same
contents (how many pieces of which length) and how often they occur. The histogram of lengths, at
most ``capacity`` rows however large the corpus is, is all that an island needs; the number of
groups is bounded by the number of lengths as well. Each island is one Spark task that evolves its
population; elites migrate around a ring between epochs. Spark then deals the groups' places to
the pieces by their rank among pieces of the same length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.text import scratch, store
from candlewick.llm.tokens import word_tokenizer

CAPACITY = 4096
ISLANDS = 6
POPULATION = 4
GENERATIONS = 6
EPOCHS = 3
#: Pieces of one length that are ranked together.
RANKED_TOGETHER = 2_000_000


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and ids).

    A null text is empty: it has the end id only. Only longer documents are cut.
    """
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = word_tokenizer(tokenizer).encode_all
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode_all(batch["text"]), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4").astype("i4")) if with_ids else row)
            kind = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*out, strict=True)) or [()] * (5 + with_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kind, strict=False)], names[: len(columns)]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, kinds)


class Groups:
    """Bins by contents. A group is (how many bins, room left in each, {length: pieces of it})."""

    def __init__(self, capacity: int, groups: list[tuple[int, int, dict[int, int]]] = ()):
        self.capacity, self.by_room, self.mask = capacity, {}, 0
        for group in groups:
            self.add(*group)

    def add(self, count: int, room: int, held: dict[int, int]) -> None:
        if count:
            self.by_room.setdefault(room, []).append((count, held))
            self.mask |= 1 << room

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces into the bins with the least room that takes them, then into new ones."""
        while count:
            fits = self.mask >> length
            room = length + (fits & -fits).bit_length() - 1 if fits else self.capacity
            if fits:
                bins, held = self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.by_room[room]
                    self.mask &= ~(1 << room)
            else:
                bins, held = -(-count // (room // length)), {}
            each = room // length
            full, rest = divmod(min(count, each * bins), each)
            self.add(full, room - each * length, held | {length: held.get(length, 0) + each})
            if rest:
                self.add(1, room - rest * length, held | {length: held.get(length, 0) + rest})
            self.add(bins - full - bool(rest), room, held)
            count -= full * each + rest

    def groups(self) -> list[tuple[int, int, dict[int, int]]]:
        return [(count, room, held) for room, some in self.by_room.items() for count, held in some]


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: large pieces that cannot share, and what the room beside them leaves over."""
    many = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        many[length] = count
    size = np.arange(capacity + 1) * many
    least = -(-int(size.sum()) // capacity)
    for small in range(1, capacity // 2 + 1):
        alone = int(many[capacity - small + 1 :].sum())
        paired = slice(capacity // 2 + 1, capacity - small + 1)
        beside = int(many[paired].sum()) * capacity - int(size[paired].sum())
        over = int(size[small : capacity // 2 + 1].sum()) - beside
        least = max(least, alone + int(many[paired].sum()) + max(0, -(-over // capacity)))
    return least


def fitness(groups, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then bins filled unevenly, which leave room where it can still be used."""
    bins = sum(count for count, _, _ in groups)
    return -bins, sum(count * (1 - room / capacity) ** 2 for count, room, _ in groups) / max(1, bins)


def fresh(histogram: dict[int, int], capacity: int, noise: float, rng) -> list:
    """Best fit, the longest first; with noise, in an order that differs a little."""
    bins = Groups(capacity)
    lengths = np.array(sorted(histogram, reverse=True))
    for length in lengths[np.argsort(-lengths * (1 + noise * rng.random(len(lengths))), kind="stable")]:
        bins.best_fit(int(length), histogram[int(length)])
    return bins.groups()


def crossover(mother: list, father: list, histogram: dict[int, int], capacity: int, rng) -> list:
    """Inject some of the father's well-filled bins, drop what the mother then holds twice, best-fit the rest."""
    left = dict(histogram)
    child = []

    def take(groups, keep) -> None:
        for count, room, held in groups:
            count = min(keep(count), *(left[length] // n for length, n in held.items()))
            if count > 0:
                child.append((count, room, held))
                for length, n in held.items():
                    left[length] -= count * n

    filled = [g for g in father if g[1] <= capacity // 100]
    share = rng.uniform(0.2, 0.8)
    picked = [filled[i] for i in rng.permutation(len(filled))[: int(share * len(filled))]]
    take(picked, lambda count: count)
    worst = rng.uniform(0.0, 0.02) * capacity
    take([g for g in sorted(mother, key=lambda g: g[1]) if g[1] <= worst], lambda count: count)
    bins = Groups(capacity, child)
    for length in sorted(left, reverse=True):
        bins.best_fit(length, left[length])
    return bins.groups()


def evolve(histogram, population: list[list], capacity: int, seed: int, size: int, generations: int) -> list[list]:
    """The best ``size`` of the population after some generations; the best one is never lost."""
    rng = np.random.default_rng(seed)
    while len(population) < size:
        population.append(fresh(histogram, capacity, 0.05 * len(population), rng))
    rank = lambda groups: fitness(groups, capacity)
    least = lower_bound(histogram, capacity)
    for _ in range(generations):
        population.sort(key=rank, reverse=True)
        if -rank(population[0])[0] <= least:
            break
        mother, father = rng.choice(len(population), 2, replace=False)
        population.append(crossover(population[mother], population[father], histogram, capacity, rng))
        population = sorted(population, key=rank, reverse=True)[:size]
    return sorted(population, key=rank, reverse=True)[:size]


_GENOME = "island int, member int, bins long, least long, count long, room int, lengths array<int>, held array<int>"


def solve(
    histogram: DataFrame, folder: str, capacity: int, islands: int, size: int, generations: int, epochs: int
) -> DataFrame:
    """Places by length: of the pieces of ``length`` ranked from ``first`` to before ``last``, ``each`` go to a
    bin, from bin ``bin`` on, at ``offset``."""
    spark = histogram.sparkSession
    dealt = histogram.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))

    def epoch(number: int):
        def run(key, lengths: pd.DataFrame, genomes: pd.DataFrame) -> pd.DataFrame:
            island = int(key[0])
            many = dict(zip(lengths["length"].tolist(), lengths["count"].tolist(), strict=True))
            if not many:
                return pd.DataFrame(columns=[c.split()[0] for c in _GENOME.split(", ")])
            population = [
                [
                    (int(c), int(r), dict(zip(map(int, ls), map(int, hs), strict=True)))
                    for c, r, ls, hs in zip(g["count"], g["room"], g["lengths"], g["held"], strict=True)
                ]
                for _, g in sorted(genomes.groupby("member"))
            ]
            best = evolve(many, population, capacity, 1000 * number + island, size, generations)
            least = lower_bound(many, capacity)
            bins = [-fitness(groups, capacity)[0] for groups in best]
            return pd.DataFrame(
                [
                    (island, member, bins[member], least, count, room, list(held), list(held.values()))
                    for member, groups in enumerate(best)
                    for count, room, held in groups
                ],
                columns=[c.split()[0] for c in _GENOME.split(", ")],
            )

        return run

    state = spark.createDataFrame([], _GENOME)
    for number in range(epochs):
        moved = state.filter("member = 0").withColumns(
            {"island": ((F.col("island") + 1) % islands).cast("int"), "member": F.lit(size)}
        )
        state = store(
            dealt.groupBy("island")
            .cogroup(state.unionByName(moved).groupBy("island"))
            .applyInPandas(epoch(number), _GENOME),
            f"{folder}/epoch{number}",
        )
        best = state.select("bins", "least", "island", "member").orderBy("bins", "island", "member").first()
        if best is None or best["bins"] <= best["least"]:
            break

    def places(batches):
        # One task: the groups of the best solution, whose number is bounded by that of the lengths.
        table = pd.concat([*batches, pd.DataFrame({"count": [], "lengths": [], "held": []})])
        first: dict[int, int] = {}
        out, number = [], 0
        for count, lengths, held in zip(table["count"], table["lengths"], table["held"], strict=True):
            offset = 0
            for length, each in zip(map(int, lengths), map(int, held), strict=True):
                at = first.get(length, 0)
                first[length] = at + int(count) * each
                out.append((length, at, first[length], each, number, offset))
                offset += length * each
            number += int(count)
        yield pd.DataFrame(out, columns=["length", "first", "last", "each", "bin", "offset"])

    chosen = state.filter((F.col("island") == best["island"]) & (F.col("member") == best["member"])) if best else state
    return store(
        chosen.select("count", "lengths", "held")
        .coalesce(1)
        .mapInPandas(places, "length long, first long, last long, each long, bin long, offset long"),
        f"{folder}/places",
    )


def pack(
    rows: DataFrame,
    capacity: int = CAPACITY,
    islands: int = ISLANDS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Each row of ``length`` 1 to ``capacity`` with sequence_id and offset; sequences have no gaps.

    Rows without a length, or with one outside that range, get null for both. Rows of one length
    are ranked by a hash of all columns, so repeated rows are interchangeable. Other columns stay,
    but for ones named sequence_id or offset, which are replaced.
    """
    spark = rows.sparkSession
    folder = scratch(spark)
    rows = store(rows.drop("sequence_id", "offset"), f"{folder}/rows")
    fits = F.col("length").between(1, capacity)
    histogram = store(
        rows.filter(fits).groupBy(F.col("length").cast("long").alias("length")).count(), f"{folder}/histogram"
    )
    total = histogram.agg(F.sum("count")).first()[0] or 0
    places = solve(histogram, folder, capacity, islands, population, generations, epochs)
    names = rows.columns
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    inner = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.when(fits, F.col("length").cast("long")).alias("length"),
        hashed.alias("hash"),
        F.pmod(hashed, F.lit(64 + total // RANKED_TOGETHER)).alias("chunk"),
    )
    before = (
        inner.groupBy("length", "chunk")
        .count()
        .select(
            "length",
            "chunk",
            (F.sum("count").over(Window.partitionBy("length").orderBy("chunk")) - F.col("count")).alias("before"),
        )
    )
    ranked = inner.withColumn(
        "rank", F.row_number().over(Window.partitionBy("length", "chunk").orderBy("hash")) - 1
    ).join(before, ["length", "chunk"], "left")
    rank = F.col("rank") + F.col("before")
    return (
        ranked.withColumn("rank", rank)
        # At most a few rows a length and group: bounded by the capacity, whatever the corpus.
        .join(
            F.broadcast(places.withColumnRenamed("length", "of")),
            (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
            "left",
        )
        .withColumns(
            {
                "sequence_id": F.col("bin") + F.floor((F.col("rank") - F.col("first")) / F.col("each")),
                "at": F.col("offset") + ((F.col("rank") - F.col("first")) % F.col("each")) * F.col("length"),
            }
        )
        .select(*[F.col(f"row.`{c}`").alias(c) for c in names], "sequence_id", F.col("at").alias("offset"))
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id and ids, from packed pieces with their ids."""
    return (
        packed.filter("sequence_id IS NOT NULL")
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    )
