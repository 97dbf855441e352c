"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A signature is ``HASHES`` symbols of ``BITS`` bits: the low bits of the smallest hash value of a
document's shingles under as many hash functions. It is split into ``CHUNKS`` chunks. Of two
signatures that differ in at most ``RADIUS`` symbols, some chunk differs in at most
``RADIUS // CHUNKS`` = 1 symbol (pigeonhole), so each chunk is indexed under every way of leaving
one of its symbols out: equal keys find every pair within the radius. A pair with a similarity of
0.8 exceeds the radius with a probability of about one in a million. Links are confirmed on the
full shingle sets.

Only components are wanted, so a bucket needs no pairs between documents known to be connected.
Each round links every document with one hub of a bucket that spans several components, and stops
once that finds nothing new. Documents that are alike but not linked (pages of one template) still
share buckets then, and their pairs are as many as the square of the bucket. Of these the pairs that
can be linked share a rare shingle: sets in the order of how many documents have a shingle must
meet in their first few, or they cannot meet in enough. So only pairs within the radius that share
such a shingle are compared, which loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.text import mix, scratch, shingles, split_words, store, word_hashes

HASHES, CHUNKS, BITS = 48, 12, 16
RADIUS = 2 * CHUNKS - 1
WORDS, SIMILARITY = 5, 80
#: Rounds of hubs at most; the comparison of what still can be linked makes the result whole after any number.
ROUNDS = 3
#: Hubs that a node is compared with in a round but the first.
HUBS = 4

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes."""
    return np.unique(shingles(word_hashes(split_words(text)), words))


def signature(found: np.ndarray) -> np.ndarray:
    """The low bits of the least value under each hash function, in stretches that fit the cache."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 8192):
        part = found[at : at + 8192]
        for i in range(HASHES):
            # The multiplier is odd, so high bits of the product depend on all bits; rotate them down.
            product = part * _SEEDS[i]
            least[i] = min(least[i], (product ^ (product >> np.uint64(29))).min())
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """n_shingles and symbols (bytes) in place of the text of (doc_id, digest, text, and any strings)."""
    also = rows.columns[3:]
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("digest", pa.string()), ("n_shingles", pa.int64()), ("symbols", pa.binary())]
        + [(c, pa.string()) for c in also]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, symbols = [], []
            for text in batch["text"]:
                found = shingle_set(text.as_py(), words)
                sizes.append(len(found))
                symbols.append(signature(found).tobytes())
            columns = [batch["doc_id"], batch["digest"], pa.array(sizes, pa.int64()), pa.array(symbols, pa.binary())]
            columns += [batch[c] for c in also]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    strings = "".join(f", {c} string" for c in also)
    return rows.mapInArrow(sign, "doc_id long, digest string, n_shingles long, symbols binary" + strings)


def chunk_keys(symbols: str) -> Column:
    """A key for every chunk and every one of its symbols left out."""
    size, width = HASHES // CHUNKS, BITS // 8
    return F.array(
        *[
            F.xxhash64(
                F.lit(chunk * size + left_out),
                *[F.substring(symbols, width * (chunk * size + i) + 1, width) for i in range(size) if i != left_out],
            )
            for chunk in range(CHUNKS)
            for left_out in range(size)
        ]
    )


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets meet 100 * intersection >= similarity * union."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for a, first, second in zip(batch["a"].to_pylist(), batch["first"], batch["second"], strict=True):
                if known[0] != a:  # rows come sorted by the hub
                    known = (a, shingle_set(first.as_py(), words))
                other = shingle_set(second.as_py(), words)
                same = len(np.intersect1d(known[1], other, assume_unique=True))
                keep.append(100 * same >= similarity * (len(known[1]) + len(other) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("second"))
    hubs = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("first"))
    return pairs.select("a", "b").join(own, "b").join(hubs, "a").mapInArrow(confirm, "a long, b long")


def _mixed(keyed: DataFrame) -> DataFrame:
    """Rows (key, node, component, ...) of keys that span several components."""
    spans = keyed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return keyed.join(spans.filter("low <> high").select("key"), "key")


def link_components(signed: DataFrame, texts: DataFrame, words: int, similarity: int, folder: str, links: DataFrame) -> DataFrame:
    """node and component for every document that has a link.

    ``signed``: node, n_shingles and symbols of distinct texts; ``texts``: doc_id and text;
    ``links``: what is linked anyway.
    """
    spark = signed.sparkSession
    keys = signed.select("node", F.explode(chunk_keys("symbols")).alias("key"))
    shared = keys.groupBy("key").count().filter("count > 1").select("key")
    keys = store(keys.join(shared, "key"), f"{folder}/keys")
    facts = store(signed.select("node", "n_shingles", "symbols"), f"{folder}/facts")
    nodes = keys.select(F.col("node").alias("doc_id")).distinct()
    texts = store(texts.join(nodes, "doc_id", "left_semi"), f"{folder}/texts")
    # What is linked, and what has been compared, gather in a folder each; a round adds to them.
    gathered = lambda kind: spark.read.schema("a long, b long").parquet(f"{folder}/{kind}")
    store(links, f"{folder}/links/round=0")
    tried = store(links.limit(0), f"{folder}/tried/round=0")
    labels = components(gathered("links"), f"{folder}/known")
    labelled = lambda: keys.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    for number in range(ROUNDS):
        mixed = store(_mixed(labelled()), f"{folder}/mixed{number}")
        # What can still be linked is mostly linked with the largest component of a bucket, and not with every node of
        # it: its hub differs between buckets and rounds, and a node is compared with a few that share most keys.
        order = F.xxhash64("node", "key", F.lit(number)) if number else F.col("component")
        hubs = mixed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order.alias("order"), "node")).alias("first"))
        hubs = hubs.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("n"), "first.order", "first.node", "component")).alias("hub"))
        likely = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("same")).alias("same"), F.xxhash64("a", F.lit(number)), "a"))), 1, HUBS if number else 1)
        pairs = (
            mixed.join(hubs, "key")
            .filter(F.col("component") != F.col("hub.component"))
            .groupBy("node", F.col("hub.node").alias("a"))
            .agg(F.count(F.lit(1)).alias("same"))
            .groupBy("node")
            .agg(likely.alias("likely"))
            .select(F.explode("likely.a").alias("a"), F.col("node").alias("b"))
        )
        pairs = _sized(pairs, facts, similarity).join(tried, ["a", "b"], "left_anti")
        pairs = store(pairs, f"{folder}/tried/round={number + 1}")
        found = store(verified(pairs, texts, words, similarity), f"{folder}/links/round={number + 1}")
        tried = gathered("tried")
        if found.isEmpty():
            break
        labels = components(gathered("links"), f"{folder}/components{number}")
    mixed = store(_mixed(labelled()).select("node", "component").distinct(), f"{folder}/mixed")
    rest = _meeting(mixed, texts, words, similarity, f"{folder}/sets")
    for side in "ab":
        rest = rest.join(facts.select(F.col("node").alias(side), F.col("symbols").alias(f"symbols_{side}")), side)
    rest = rest.filter(_distance("symbols_a", "symbols_b") <= RADIUS).select("a", "b")
    rest = rest.join(tried, ["a", "b"], "left_anti").join(
        tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"
    )
    found = verified(store(rest, f"{folder}/rest"), texts, words, similarity)
    found = store(found, f"{folder}/links/round={ROUNDS + 1}")
    return labels if found.isEmpty() else components(gathered("links"), f"{folder}/components")


def _meeting(nodes: DataFrame, texts: DataFrame, words: int, similarity: int, folder: str) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, component) in different components whose sets can meet the similarity.

    Of sets x and y, not larger, with n and m shingles that are linked, at least similarity * (n + m) / (100 +
    similarity) are shared. So in any one order of all shingles the first few of x and of y share one, and
    neither has too few shingles left from there on. In the order of rarity few others share them.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text.as_py(), words).view(np.int64) for text in batch["text"]]
            columns = [batch["node"], batch["text_key"], pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "text_key", "shingles"])

    # Rows of one doc_id may have several texts, of which each has a set.
    named = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id")
    named = named.groupBy(F.col("doc_id").alias("node"), F.xxhash64("text").alias("text_key")).agg(F.min("text").alias("text"))
    sets = store(named.mapInArrow(listed, "node long, text_key long, shingles array<long>"), folder)
    each = sets.select("node", "text_key", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    size, at = F.col("n_shingles"), F.col("at")
    ordered = each.join(common, "shingle").groupBy("node", "text_key").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("all"))
    first = ordered.withColumn("n_shingles", F.size("all").cast("long")).select(
        "node", "n_shingles", F.posexplode(F.slice("all", F.lit(1), (size - _ceil(similarity * size, 100) + 1).cast("int"))).alias("at", "x")
    )
    first = first.filter("x.n > 1").select("node", "n_shingles", "at", F.col("x.shingle").alias("shingle")).join(nodes, "node")
    small = first.filter(at <= size - _ceil(2 * similarity * size, 100 + similarity))
    side = lambda rows, name: rows.select("shingle", *[F.col(c).alias(f"{name}_{c}") for c in ("node", "component", "n_shingles", "at")])
    n, m = F.col("a_n_shingles"), F.col("b_n_shingles")
    needed = _ceil(similarity * (n + m), 100 + similarity)
    meets = (
        (F.struct("a_n_shingles", "a_node") < F.struct("b_n_shingles", "b_node"))
        & (F.col("a_component") != F.col("b_component"))
        & (100 * n >= similarity * m)
        & (n - F.col("a_at") >= needed)
        & (m - F.col("b_at") >= needed)
    )
    return side(small, "a").join(side(first, "b"), "shingle").filter(meets).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _ceil(value: Column, by: int) -> Column:
    """Whole quotient, rounded up."""
    return F.floor((value + by - 1) / by)


def _sized(pairs: DataFrame, facts: DataFrame, similarity: int) -> DataFrame:
    """Without pairs whose sets differ too much in size."""
    size = facts.select("node", "n_shingles")
    return (
        pairs.join(size.select(F.col("node").alias("a"), F.col("n_shingles").alias("size_a")), "a")
        .join(size.select(F.col("node").alias("b"), F.col("n_shingles").alias("size_b")), "b")
        .filter(f"100 * least(size_a, size_b) >= {similarity} * greatest(size_a, size_b)")
        .select("a", "b")
    )


def _distance(a: str, b: str):
    """Symbols in which two signatures differ."""
    width = BITS // 8
    same = [
        (F.substring(a, width * i + 1, width) == F.substring(b, width * i + 1, width)).cast("int") for i in range(HASHES)
    ]
    return F.lit(HASHES) - sum(same[1:], same[0])


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, also: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Two documents are linked when 100 * shared shingles >= ``similarity`` * all their shingles.
    component_id is the smallest doc_id reachable over links, kept marks the row that bears it.
    Words are whatever white space separates, with A-Z in lower case; fewer words than a shingle
    has are one shingle. Null, empty and blank texts have no shingles and no links. Equal texts
    are compared once. Rows repeated under one doc_id stay together; if they differ in text, the
    doc_id links whatever its texts link. Rows without doc_id are linked with nothing and have a
    null component_id, and are kept. Other columns are not looked at; strings named by ``also`` are
    passed through. No rows give no rows.
    """
    folder = scratch(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    digest = F.sha2(text.cast("binary"), 256)
    signing = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"), text.alias("text"), *also)
    rows = store(signatures(signing, words), f"{folder}/signed")
    groups = store(
        rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("symbols").alias("symbols")),
        f"{folder}/groups",
    )
    # Rows of one doc_id with several texts connect the groups of those texts.
    tied = (
        rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .join(groups.select("digest", "node"), "digest")
        .groupBy("doc_id")
        .agg(F.min("node").alias("a"), F.max("node").alias("b"))
        .filter("a <> b")
        .select("a", "b")
    )
    labels = link_components(groups, texts, words, similarity, folder, store(tied, f"{folder}/tied"))
    classes = groups.join(labels, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class")
    )
    # A text may have a third of all rows: adaptive execution splits its side of this join.
    return rows.join(classes, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.coalesce("class", "doc_id") == F.col("doc_id"))).alias("kept"),
        *also,
    )
