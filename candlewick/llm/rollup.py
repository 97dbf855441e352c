"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes is turned into the documents' new state and into the signed sums that it adds
to the totals. Both are written first and become visible together by a marker, so a batch that
broke off can be committed again, and one that was committed is not applied twice. Totals are sums
over the last snapshot and the visible batches after it, whose rows are few.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.text import ship, store
from candlewick.llm.tokens import word_tokenizer
from candlewick.storage import exists, folders_in

KEYS = ["source", "lang", "version"]
#: Batches that a snapshot takes the place of.
COMPACT_EVERY = 16
_STATE = "doc_id long, source string, lang string, version string, n_tokens long, batch long"


def token_counts(docs: DataFrame, version: str, path: str) -> DataFrame:
    """doc_id, source, lang, version and n_tokens of every whole text; a null text has no tokens.

    Versions named ``word`` and so on use the word tokenizer's file, others a file of ranked byte pairs.
    """
    ship(docs.sparkSession)
    kinds = "doc_id long, source string, lang string, version string, n_tokens long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (lambda t: len(word_tokenizer(path).encode(t)) // 4) if path.endswith(".json") else byte_counter(path)
        for batch in batches:
            sizes = pa.array([size(t.as_py() or "") for t in batch["text"]], pa.int64())
            names = pa.array([version] * len(batch), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["source"], batch["lang"], names, sizes], [c.split()[0] for c in kinds.split(", ")]
            )

    columns = [F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("source", "lang", "text")]]
    return docs.select(*columns).mapInArrow(count, kinds)


_counters: dict = {}


def byte_counter(path: str):
    """Counts tokens by a file of ranked byte pairs."""
    if path not in _counters:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _counters[path] = lambda text: len(own.encode_ordinary(text))
    return _counters[path]


class TokenLedger:
    """Counts of documents under ``folder``, changed by numbered batches.

    ``documents/<batch>`` holds the rows of a batch, ``deltas/<batch>`` what it adds to the totals and
    ``commits/<batch>`` its marker. Every COMPACT_EVERY batches a snapshot takes their place: the last
    row of each document and the totals, with the numbers that are in it as ranges; its marker is
    ``snapshots/<n>/done``. So a commit reads one snapshot and few batches, however many there were.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _snapshot(self) -> tuple[str | None, list[tuple[int, int]]]:
        """Folder of the last whole snapshot, and the ranges of batches in it."""
        names = sorted((n for n in folders_in(self.spark, f"{self.folder}/snapshots") if n.isdigit()), key=int, reverse=True)
        for name in names:
            done = f"{self.folder}/snapshots/{name}/done"
            if exists(self.spark, f"{done}/_SUCCESS"):
                return f"{self.folder}/snapshots/{name}", [(r.low, r.high) for r in self.spark.read.parquet(done).collect()]
        return None, []

    def _batches(self) -> list[int]:
        """Committed batches that are in no snapshot."""
        within = self._snapshot()[1]
        found = (int(n) for n in folders_in(self.spark, f"{self.folder}/commits") if n.lstrip("-").isdigit())
        return sorted(n for n in found if not any(low <= n <= high for low, high in within) and self._visible(n))

    def _visible(self, batch: int) -> bool:
        return exists(self.spark, f"{self.folder}/commits/{batch}/_SUCCESS")

    def _committed(self, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self._snapshot()[1]) or self._visible(batch)

    def _read(self, kind: str, schema: str) -> DataFrame:
        snapshot, _ = self._snapshot()
        paths = [f"{snapshot}/{kind}"] * bool(snapshot) + [f"{self.folder}/{kind}/{batch}" for batch in self._batches()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _last(self, log: DataFrame) -> DataFrame:
        """The last row of each document, deletions included; rows without doc_id all stay."""
        last = log.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("batch", *KEYS, "n_tokens")).alias("last"))
        rows = last.select("doc_id", *[F.col(f"last.{c}").alias(c) for c in (*KEYS, "n_tokens", "batch")])
        return rows.unionByName(log.filter("doc_id IS NULL").select(rows.columns))

    def documents(self, among: DataFrame | None = None) -> DataFrame:
        """The state after the last batch: a row per document that is there; ``among``: of those doc_ids only."""
        log = self._read("documents", _STATE)
        if among is not None:
            log = log.join(among.select("doc_id").distinct(), "doc_id", "left_semi")
        return self._last(log).filter("n_tokens IS NOT NULL").select("doc_id", *KEYS, "n_tokens")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch once: False, and nothing happens, if its number was committed before.

        ``changes`` has doc_id, the keys and n_tokens. A row without n_tokens deletes its document;
        others insert it or put its revised count in place. Of several rows for a doc_id the one
        that is greatest in order of n_tokens (null first), source, lang and version counts, so
        repeated rows count once. Deleting what isn't there does nothing. Each row without doc_id is
        a document of its own, which nothing can change; such a row without n_tokens does nothing.
        Numbers order the batches, not the time of their commit: of a batch that comes late, only the
        documents that no batch with a larger number has touched change the totals.
        """
        if self._committed(batch):
            return False
        # Counting the tokens is the work, so it is written down before the rows are looked at.
        rows = changes.select("doc_id", *KEYS, "n_tokens", F.lit(batch).cast("long").alias("batch"))
        rows = store(rows, f"{self.folder}/incoming/{batch}")
        last = F.max(F.struct("n_tokens", *KEYS)).alias("new")
        new = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "batch").agg(last)
        new = new.select("doc_id", *[F.col(f"new.{c}").alias(c) for c in KEYS], "new.n_tokens", "batch")
        new = new.unionByName(rows.filter("doc_id IS NULL AND n_tokens IS NOT NULL"))
        new.repartition(F.xxhash64("doc_id", "n_tokens")).write.mode("overwrite").parquet(f"{self.folder}/documents/{batch}")
        new = self.spark.read.schema(_STATE).parquet(f"{self.folder}/documents/{batch}")
        known = self._last(self._read("documents", _STATE).join(new.select("doc_id").distinct(), "doc_id", "left_semi"))
        later = known.filter(F.col("batch") > batch).select("doc_id")
        sign = lambda rows, n: rows.filter("n_tokens IS NOT NULL").select(
            *KEYS, F.lit(n).alias("documents"), (n * F.col("n_tokens")).alias("tokens")
        )
        signed = sign(new.join(later, "doc_id", "left_anti"), 1).unionByName(sign(known.filter(F.col("batch") < batch), -1))
        sums = signed.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        marker = self.spark.range(1).select(F.lit(batch).cast("long").alias("batch")).coalesce(1)
        marker.write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")
        if len(self._batches()) >= COMPACT_EVERY:
            self.compact()
        return True

    def compact(self) -> None:
        """Write a snapshot of all that is committed. One that breaks off is not looked at."""
        before, within = self._snapshot()
        numbers = self._batches()
        folder = f"{self.folder}/snapshots/{1 + int((before or '/0').rsplit('/', 1)[1])}"
        self._last(self._read("documents", _STATE)).write.mode("overwrite").parquet(f"{folder}/documents")
        self.totals().write.mode("overwrite").parquet(f"{folder}/deltas")
        ranges = []
        for low, high in sorted([*within, *((n, n) for n in numbers)]):
            if ranges and low <= ranges[-1][1] + 1:
                ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
            else:
                ranges.append((low, high))
        done = self.spark.createDataFrame(ranges, "low long, high long").coalesce(1)
        done.write.mode("overwrite").parquet(f"{folder}/done")

    def totals(self) -> DataFrame:
        """source, lang, version, documents and tokens, of keys that have documents."""
        schema = "source string, lang string, version string, documents long, tokens long"
        sums = self._read("deltas", schema).groupBy(*KEYS)
        rows = sums.agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return rows.filter("documents <> 0 OR tokens <> 0")
