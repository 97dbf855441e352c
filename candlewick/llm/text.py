"""Words, shingles and hashes of whole texts, and intermediate tables in the shared folder."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from candlewick.storage import scratch_folder

#: A worker's caches of words start afresh beyond this many entries: an executor has several workers.
CACHE_WORDS = 150_000
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 with A-Z lower-cased; a null text has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in order; shorter texts are one shingle, empty ones none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total + hashes[i : len(hashes) - size + 1 + i] * _MULTIPLIERS[i % len(_MULTIPLIERS)])
    return total


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(frame: DataFrame, folder: str, tidy: bool = False) -> DataFrame:
    """The same rows, written as Parquet and read again: lineage ends here, and lost executors cost nothing.

    With ``tidy`` the shuffle files of this write go when it ends, not when the driver's memory is next swept.
    """
    spark = frame.sparkSession
    before = spark.conf.get(_TIDY, "false")
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        frame.write.mode("overwrite").parquet(folder)
    finally:
        if tidy:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(frame.schema).parquet(folder)


def scratch(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; the package also goes to the Python workers."""
    ship(spark)
    return scratch_folder(spark)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed; once a session."""
    context = spark.sparkContext
    if getattr(context, "_candlewick_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="candlewick-")) / "candlewick.zip"
    target.write_bytes(data.getvalue())
    context.addPyFile(str(target))
    context._candlewick_sent = True
