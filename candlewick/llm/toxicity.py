"""Severity of toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): all thresholds share the weights w, and the expected
severity is the sum over k of P(grade > k). Features are the distinct words of a text, hashed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import split_words, ship, word_hashes

FEATURES = 1 << 20
#: The model is fitted on this many labelled documents at most, those with the least hash of their doc_id.
SAMPLE = 10_000
#: A word is a feature if this many documents of the sample have it, toxic ones so much likelier than others.
LEAST_DOCUMENTS, LEAST_LOG_ODDS = 5, 1.5
#: The log odds must also be this many standard deviations above zero.
DEVIATIONS = 2.5
#: A text is called toxic if a grade above 0 is likelier than this.
CUT = 0.4
_EDGES = np.frombuffer(b".,;:!?\"'()[]{}*#$%&|<>-", np.uint8).tobytes()


def features(text: str | None) -> np.ndarray:
    """The distinct words of a whole text, A-Z in lower case and without punctuation at their ends."""
    words = {word.strip(_EDGES) for word in split_words(text)}
    return np.unique((word_hashes(list(words - {b""})) >> np.uint64(44)).astype(np.int64))


def fit(rows: list[np.ndarray], grades: np.ndarray, penalty: float = 2e-5, steps: int = 2000):
    """Weights and ascending thresholds by gradient descent on the likelihood, without features that tell nothing."""
    levels = int(grades.max()) if len(grades) else 0
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate([*rows, np.empty(0, np.int64)])
    toxic = grades > 0
    seen = np.bincount(index, minlength=FEATURES)
    seen_toxic = np.bincount(index, weights=toxic[owner], minlength=FEATURES)
    n_toxic = max(1, int(toxic.sum()))
    odds = np.log((seen_toxic + 0.5) / n_toxic) - np.log((seen - seen_toxic + 0.5) / max(1, len(rows) - n_toxic))
    chance = np.sqrt(1 / (seen_toxic + 0.5) + 1 / (seen - seen_toxic + 0.5))
    # Long texts hold many words, so words that look toxic by chance must not count.
    chosen = (seen >= LEAST_DOCUMENTS) & (odds >= np.maximum(LEAST_LOG_ODDS, DEVIATIONS * chance))
    used = chosen[index]
    owner, index = owner[used], (np.cumsum(chosen) - 1)[index[used]]
    weights = np.zeros(int(chosen.sum()))
    share = [np.clip((grades > k).mean(), 1e-3, 1 - 1e-3) for k in range(levels)]
    thresholds = np.array([np.log((1 - s) / s) for s in share])
    first_w = second_w = first_t = second_t = 0.0
    for step in range(1, steps + 1):
        score = np.bincount(owner, weights=weights[index], minlength=len(rows))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -30, 30)))  # P(grade > k)
        # The likelihood of a grade is a difference of neighbouring cumulative probabilities.
        upper = np.hstack([np.ones((len(rows), 1)), above])
        lower = np.hstack([above, np.zeros((len(rows), 1))])
        at = np.arange(len(rows))
        u, v = upper[at, grades], lower[at, grades]
        like = np.maximum(u - v, 1e-9)
        slope = (u * (1 - u) - v * (1 - v)) / like
        grad_w = np.bincount(index, weights=slope[owner], minlength=len(weights)) / len(rows) - penalty * weights
        grad_t = np.zeros(levels)
        np.add.at(grad_t, grades[grades < levels], (v * (1 - v) / like)[grades < levels])
        np.add.at(grad_t, grades[grades > 0] - 1, -(u * (1 - u) / like)[grades > 0])
        grad_t /= len(rows)
        first_w, second_w = 0.9 * first_w + 0.1 * grad_w, 0.999 * second_w + 0.001 * grad_w**2
        first_t, second_t = 0.9 * first_t + 0.1 * grad_t, 0.999 * second_t + 0.001 * grad_t**2
        scale = 0.05 / (1 - 0.9**step)
        weights += scale * first_w / (np.sqrt(second_w / (1 - 0.999**step)) + 1e-6)
        thresholds += scale * first_t / (np.sqrt(second_t / (1 - 0.999**step)) + 1e-6)
        thresholds = np.maximum.accumulate(thresholds)
    held = np.zeros(FEATURES, np.float32)
    held[chosen] = weights
    return held, thresholds


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1 and 2 where labels only say whether a text is toxic.

    Toxic texts with more of the words that mark toxic texts than the median of them get grade 2.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate([*rows, np.empty(0, np.int64)])
    seen = np.bincount(index, minlength=FEATURES)
    share = np.bincount(index, weights=toxic[owner], minlength=FEATURES) / np.maximum(seen, 1)
    marks = (seen >= LEAST_DOCUMENTS) & (share > 0.5)
    many = np.bincount(owner, weights=marks[index], minlength=len(rows))
    grades = toxic.astype(np.int64)
    if toxic.any():
        grades[toxic & (many > np.median(many[toxic]))] = 2
    return grades


def train(docs: DataFrame, labels: DataFrame, grade: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from a bounded sample of labelled documents, fitted in one task.

    ``grade`` names a column of whole grades from 0 on; with grades 0 and 1 only, grade 1 is divided
    by severity_grades(). Null grades are no labels.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.filter(F.col(grade).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(grade).cast("int").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    kinds = "doc_id long, grade int, found array<long>"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(text) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "grade": batch["grade"], "found": found})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*batches, pd.DataFrame({"doc_id": [], "grade": [], "found": []})]).sort_values("doc_id")
        found, grades = [np.asarray(f, np.int64) for f in rows["found"]], rows["grade"].to_numpy(np.int64)
        if len(grades) and grades.max() <= 1:
            grades = severity_grades(found, grades > 0)
        weights, thresholds = fit(found, grades) if len(grades) else (np.zeros(FEATURES, np.float32), np.zeros(0))
        yield pd.DataFrame({"weights": [weights.tobytes()], "thresholds": [list(thresholds)]})

    sampled = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    model = (
        sampled.mapInPandas(find, kinds)
        .repartition(1)  # the sample alone meets in one task, after an exchange
        .mapInPandas(learn, "weights binary, thresholds array<double>")
        .first()
    )
    return np.frombuffer(model["weights"], np.float32), np.array(model["thresholds"])


def score(docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray) -> DataFrame:
    """doc_id, exceeds (P(grade > k) for each k), expected_severity, grade (the likeliest) and toxic of every row.

    ``toxic`` says that a grade above 0 is likelier than ``CUT``. Null and empty texts have no features
    and get what the thresholds alone say. Repeated rows get equal results; a null doc_id stays
    null. Other columns are not looked at. No rows give no rows.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "exceeds", "expected_severity", "grade", "toxic"]
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            scores = np.array([own[features(text.as_py())].sum() for text in batch["text"]], np.float64)
            above = 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds, -30, 30)))
            steps = np.hstack([np.ones((len(scores), 1)), above, np.zeros((len(scores), 1))])
            grade = (steps[:, :-1] - steps[:, 1:]).argmax(axis=1)
            toxic = above[:, 0] > CUT if len(thresholds) else np.zeros(len(scores), bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(list(above), pa.list_(pa.float64())),
                    pa.array(above.sum(axis=1)),
                    pa.array(grade, pa.int32()),
                    pa.array(toxic),
                ],
                names,
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        run, "doc_id long, exceeds array<double>, expected_severity double, grade int, toxic boolean"
    )


def toxicity(docs: DataFrame, labels: DataFrame, grade: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Every row of ``docs`` scored by a model trained on its labelled rows."""
    return score(docs, *train(docs, labels, grade, sample))
