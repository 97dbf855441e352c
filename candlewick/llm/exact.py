"""Exact deduplication by a minimal perfect hash over the digests of a history.

The history's distinct digests are dealt to shards by their leading bits. Each shard maps its n
digests to n slots without gaps or collisions; a slot holds the full digest, the locator of the
winner (its doc_id) and the number of copies. A lookup computes a digest's slot and compares all
its bytes, so no digest is taken for another. Digests the history lacks are grouped separately.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import mix, scratch, store

#: Digests in a shard; a shard's slots are one row of the index.
SHARD_KEYS = 100_000
_INDEX = "shard long, seed long, pilots binary, digests binary, winners binary, copies binary"
_NONE = np.iinfo(np.int64).min


def text_digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """digest, winner (largest doc_id) and copies; combined map-side, so a digest may fill a third of the rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("copies"))


def _shard(count: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(max(1, -(-count // SHARD_KEYS))))


def _halves(digests: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each digest, from bytes the shards don't use."""
    words = np.frombuffer(digests.tobytes(), "<u8").reshape(-1, 4)
    return mix(words[:, 1] + np.uint64(seed)), mix(words[:, 2] + words[:, 3] + np.uint64(seed))


def _slots(digests: np.ndarray, seed: int, pilots: np.ndarray, count: int) -> np.ndarray:
    """A bucket's pilot is a seed for its keys, or, below zero, the slot of its only key."""
    first, second = _halves(digests, seed)
    pilot = pilots[(first % np.uint64(len(pilots))).astype(np.int64)]
    hashed = mix(second ^ (pilot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(count)
    return np.where(pilot < 0, -1 - pilot, hashed.astype(np.int64))


def perfect_hash(digests: np.ndarray) -> tuple[int, np.ndarray]:
    """Seed and pilots for n distinct digests, n rows of 32 bytes, so that slots are a permutation of 0 to n-1."""
    count = len(digests)
    for seed in range(1, 100):
        first, second = _halves(digests, seed)
        bucket = (first % np.uint64(max(1, count // 3))).astype(np.int64)
        pilots = np.zeros(max(1, count // 3), np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
        sizes = np.diff(np.r_[starts, count])
        taken = np.zeros(count, bool)
        free = None
        for at in np.argsort(-sizes, kind="stable"):
            keys = order[starts[at] : starts[at] + sizes[at]]
            if len(keys) == 1:
                free = iter(np.flatnonzero(~taken)) if free is None else free
                pilots[bucket[keys[0]]] = -1 - next(free)
                continue
            found = False
            for low in range(0, 1 << 22, 64):
                tried = np.arange(low, low + 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                slots = (mix(second[keys][:, None] ^ tried) % np.uint64(count)).astype(np.int64)
                good = ~taken[slots].any(axis=0)
                if good.any():
                    rows = np.sort(slots[:, good], axis=0)
                    good[good] = (rows[1:] != rows[:-1]).all(axis=0)
                if good.any():
                    one = int(np.argmax(good))
                    taken[slots[:, one]] = True
                    pilots[bucket[keys[0]]] = low + one
                    found = True
                    break
            if not found:
                break
        else:
            return seed, pilots
    raise ValueError("two digests agree in all bytes that the hash uses")


def _matrix(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)


def _longs(values: pd.Series) -> np.ndarray:
    """Longs in which the least value stands for null."""
    return values.astype("Int64").fillna(_NONE).to_numpy(np.int64)


def build_index(history: DataFrame, folder: str, incoming: int = 0) -> DataFrame:
    """The index of a history of distinct digests (digest, winner, copies): a row per shard.

    There are enough shards for the digests of the history, and for ``incoming`` others that will be
    looked up, to meet in groups of SHARD_KEYS or so.
    """
    history = store(history.select("digest", "winner", "copies"), f"{folder}/history")
    count = max(history.count(), incoming)

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(rows["digest"])
        seed, pilots = perfect_hash(digests)
        slots = _slots(digests, seed, pilots, len(digests))
        held = np.empty_like(digests)
        held[slots] = digests
        winners, copies = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        winners[slots], copies[slots] = _longs(rows["winner"]), rows["copies"]
        return pd.DataFrame(
            [(key[0], seed, *(a.tobytes() for a in (pilots, held, winners, copies)))],
            columns=[c.split()[0] for c in _INDEX.split(", ")],
        )

    index = history.withColumn("shard", _shard(count)).groupBy("shard").applyInPandas(build, _INDEX)
    return store(index, f"{folder}/index").withColumn("keys", F.lit(count))


def merge(index: DataFrame, keys: int, incoming: DataFrame) -> DataFrame:
    """Every digest of the index or of the incoming distinct digests, once.

    digest, winner (the largest doc_id of both), copies (of both), member (whether the index has it).
    """

    def look(key, shards: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(rows["digest"])
        winners, copies = _longs(rows["winner"]), rows["copies"].to_numpy(np.int64)
        member = np.zeros(len(rows), bool)
        parts = []
        if len(shards):
            shard = shards.iloc[0]
            pilots, own_winners, own_copies = (np.frombuffer(shard[c], np.int64).copy() for c in ("pilots", "winners", "copies"))
            held = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32)
            if len(rows):
                slots = _slots(digests, int(shard["seed"]), pilots, len(held))
                member = (held[slots] == digests).all(axis=1)  # every byte
                np.maximum.at(own_winners, slots[member], winners[member])
                np.add.at(own_copies, slots[member], copies[member])
            parts.append((held, own_winners, own_copies, np.ones(len(held), bool)))
        parts.append((digests[~member], winners[~member], copies[~member], np.zeros((~member).sum(), bool)))
        held, winners, copies, member = (np.concatenate(p) for p in zip(*parts, strict=True))
        winner = pd.array(winners, "Int64")
        winner[winners == _NONE] = pd.NA
        return pd.DataFrame(
            {"digest": [row.tobytes() for row in held], "winner": winner, "copies": copies, "member": member}
        )

    return (
        index.groupBy("shard")
        .cogroup(incoming.withColumn("shard", _shard(keys)).groupBy("shard"))
        .applyInPandas(look, "digest binary, winner long, copies long, member boolean")
    )


def exact_duplicates(docs: DataFrame, history: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and known for each row of ``docs``.

    ``history`` says which rows were there before the others (by default those with a doc_id up to
    the mean); they make the index, the others are looked up in it. Of equal texts the row with the
    largest doc_id stays. A null text equals an empty one. Rows without doc_id lose to any others;
    a group with none but such has a null keep_id and keeps them all. Rows repeated under the
    winning doc_id are one document and stay together. Other columns are not looked at; those named
    by ``also`` are passed through.
    ``known`` tells whether the history has the text. An empty table gives no rows.
    """
    folder = scratch(docs.sparkSession)
    if history is None:
        middle = docs.agg(F.avg("doc_id")).first()[0]
        history = F.col("doc_id") <= F.lit(middle or 0)
    rows = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_digest(F.col("text")).alias("digest"),
            F.coalesce(history, F.lit(False)).alias("old"),
            *also,
        ),
        f"{folder}/digests",
    )
    incoming = store(distinct_digests(rows.filter("NOT old")), f"{folder}/incoming")
    count = incoming.count()
    index = build_index(distinct_digests(rows.filter("old")), folder, count)
    keys = index.select("keys").first()
    groups = store(merge(index.drop("keys"), keys[0] if keys else count, incoming), f"{folder}/groups")
    # A digest may have a third of all rows: adaptive execution splits its side of this join.
    return rows.join(groups, "digest").select(
        "doc_id",
        F.col("winner").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("member").alias("known"),
        *also,
    )
