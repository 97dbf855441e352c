"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histograms of character classes and of its language's common words are compared with
those of the whole language by Jensen-Shannon distance. Every language of ``LEAST_DOCS`` documents
or more has a reference, of at most 1 / ``common_share`` common words. References are joined without a forced broadcast, so there may be any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import scratch, store

SPACE = "[\\x20\\x09-\\x0D]+"
#: A word is common if it is at least this share of its language's words.
COMMON_SHARE = 0.005
#: Distances are judged from these lengths on; below, chance alone makes histograms diverge.
MIN_CHARS, MIN_WORDS = 300, 50
#: Larger distances reject a document.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.42
#: Base rule: too few words, or too large a percentage of them in repeated windows.
LEAST_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
#: A language needs this many documents to be judged by, however large the table.
LEAST_DOCS = 100
_BUCKETS = 1 << 16


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _adjacent(values: Column, step: int, together) -> Column:
    """``together`` of each element and the one ``step`` further on."""
    many = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), many), F.slice(values, F.lit(step + 1), many), together)


def _lines_repeated(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")
    return F.size(lines) - F.size(F.array_distinct(lines))


def measures(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, group, ``also``, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes of every text."""
    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "group",
        *also,
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("trimmed", F.btrim("text", F.lit(" \t\n\x0b\f\r")))
    rows = rows.withColumns(
        {
            "words": F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
                F.split("trimmed", SPACE)
            ),
            "n_chars": F.length(text),
            "n_symbols": _without(text, "[^#*$%&|<>]+"),
            "n_dup_lines": _lines_repeated(text),
            "lower": _without(text, "[^a-z]+"),
            "upper": _without(text, "[^A-Z]+"),
            "digits": _without(text, "[^0-9]+"),
            "ascii": _without(text, "[^\\x00-\\x7F]+"),
        }
    ).drop("text", "trimmed")
    rows = rows.withColumns(
        {
            "n_words": F.size("words"),
            "word_chars": F.aggregate("words", F.lit(0), lambda a, word: a + F.length(word)),
            "h1": F.transform("words", lambda word: F.xxhash64(word)),
        }
    )
    # Hashes of 2, 4 and 8 words in a row.
    for source, target, step in (("h1", "h2", 1), ("h2", "h4", 2), ("h4", "h8", 4)):
        rows = rows.withColumn(target, _adjacent(F.col(source), step, lambda a, b: F.xxhash64(a, b))).drop(source)
    rows = rows.withColumn("repeats", F.size("h8") > F.size(F.array_distinct("h8")))
    rows = rows.withColumn(
        "sorted", F.when(F.col("repeats"), F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("h8")
    rows = rows.withColumn(
        "found",
        F.array_sort(
            F.array_distinct(
                F.flatten(
                    _adjacent(
                        F.col("sorted"),
                        1,
                        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
                            F.array().cast("array<int>")
                        ),
                    )
                )
            )
        ),
    ).drop("sorted")
    covered = F.lit(WINDOW) + F.aggregate(
        _adjacent(F.col("found"), 1, lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda a, b: a + b
    )
    white = F.col("n_chars") - F.col("word_chars")
    other = F.col("ascii") - F.col("lower") - F.col("upper") - F.col("digits") - white
    return rows.select(
        "doc_id",
        "group",
        *also,
        "words",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.when(F.col("repeats"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.array(
            *[
                c.cast("long")
                for c in (F.col("lower"), F.col("upper"), F.col("digits"), white, other, F.col("n_chars") - F.col("ascii"))
            ]
        ).alias("classes"),
    )


def grouped(docs: DataFrame, large: DataFrame) -> DataFrame:
    """``docs`` with group: the language if it is large enough to judge by, else null."""
    known = large.select(F.col("name").alias("group"))
    return docs.join(known, F.col("lang").cast("string") == F.col("group"), "left")


def large_languages(docs: DataFrame) -> DataFrame:
    """name of the languages that ``LEAST_DOCS`` documents or more have."""
    counts = docs.groupBy(F.col("lang").cast("string").alias("name")).count()
    return counts.filter((F.col("count") >= LEAST_DOCS) & (F.col("name") != "")).select("name")


def common_words(docs: DataFrame, folder: str, common_share: float = COMMON_SHARE) -> DataFrame:
    """name (of the group), common (words) and ref_words (their counts, then that of all others), of documents with a group."""
    text = F.btrim(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    words = docs.filter(F.col("group").isNotNull()).select("group", F.explode(F.split(text, SPACE)).alias("word")).filter("word <> ''")
    bucket = F.pmod(F.xxhash64("word"), F.lit(_BUCKETS))
    # First by bucket, of which there are few; then only words of buckets as large as a common word.
    buckets = store(words.groupBy("group", bucket.alias("bucket")).count(), f"{folder}/buckets")
    totals = buckets.groupBy("group").agg(F.sum("count").alias("total"))
    heavy = buckets.join(totals, "group").filter(F.col("count") >= common_share * F.col("total"))
    heavy = store(heavy.select("group", "bucket", "total"), f"{folder}/heavy")
    listed = (
        words.withColumn("bucket", bucket)
        .join(heavy, ["group", "bucket"])
        .groupBy("group", "word")
        .agg(F.count("*").alias("n"), F.max("total").alias("total"))
        .filter(F.col("n") >= common_share * F.col("total"))
        .groupBy("group")
        .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("listed"))
    )
    none = F.array().cast("array<struct<word:string,n:bigint>>")
    rest = F.expr("total - aggregate(listed, 0L, (a, b) -> a + b.n)")
    return store(
        totals.join(listed, "group", "left")
        .withColumn("listed", F.coalesce("listed", none))
        .select(
            F.col("group").alias("name"),
            F.col("listed.word").alias("common"),
            F.concat(F.col("listed.n"), F.array(rest)).alias("ref_words"),
        ),
        f"{folder}/common",
    )


def jensen_shannon(counts: Column, reference: Column) -> Column:
    """Distance (base 2, 0 to 1) of two histograms; null if either is empty."""
    total = lambda h: F.aggregate(h, F.lit(0).cast("long"), lambda a, b: a + b).cast("double")
    shares = lambda h: F.transform(h, lambda n: n / total(h))
    part = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
    parts = F.zip_with(shares(counts), shares(reference), lambda p, q: part(p, q) + part(q, p))
    divergence = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2
    return F.when(
        (total(counts) > 0) & (total(reference) > 0), F.round(F.sqrt(F.greatest(divergence, F.lit(0.0))), 6)
    )


def quality(
    docs: DataFrame,
    common_share: float = COMMON_SHARE,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """The measures of every row of ``docs`` with base_failed, class_distance, word_distance and kept.

    Words are what white space separates. The base rule fails documents with fewer than 20 words or
    with over 30 % of their words in 8-word windows that the text repeats. Other documents are
    rejected if they are long enough to be judged and a distance exceeds its limit. Null and
    blank texts have no words, fail the base rule, and their distances are null. So are those of rows
    without a language (null or empty) or whose language has too few documents to judge by: the base
    rule alone decides on them. Every row is judged on its own, repeated rows alike. Columns other
    than doc_id, text and lang are not looked at; those named by ``also`` are passed through. No rows
    give no rows.
    """
    folder = scratch(docs.sparkSession)
    docs = grouped(docs.select("doc_id", "text", "lang", *also), store(large_languages(docs), f"{folder}/languages"))
    common = common_words(docs, folder, common_share)
    rows = measures(docs, also).join(common, F.col("group") == F.col("name"), "left")
    rows = rows.withColumn("hits", F.expr("filter(words, word -> array_contains(common, word))"))
    counts = "transform(common, c -> cast(size(filter(hits, h -> h = c)) AS BIGINT))"
    rows = rows.withColumn("counts", F.expr(f"concat({counts}, array(n_words - size(hits)))")).drop("words", "hits", "common")
    # Written down: filters on the verdict must not compute the measures again.
    rows = store(rows, f"{folder}/measured")
    sums = F.array(*[F.sum(F.col("classes")[i]) for i in range(6)]).alias("ref_classes")
    judged = rows.filter(F.col("group").isNotNull())
    references = store(judged.groupBy(F.col("group").alias("known")).agg(sums), f"{folder}/classes")
    rows = rows.join(references, F.col("group") == F.col("known"), "left").withColumns(
        {
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
            "class_distance": jensen_shannon(F.col("classes"), F.col("ref_classes")),
            "word_distance": jensen_shannon(F.col("counts"), F.col("ref_words")),
        }
    )
    odd = ((F.col("n_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    )
    verdicts = rows.select(
        "doc_id",
        *also,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "class_distance",
        "word_distance",
        (~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))).alias("kept"),
    )
    return store(verdicts, f"{folder}/verdicts")
