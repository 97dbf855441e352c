"""A query per operator over the benchmark tables, with production parameters, and its SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import codes, conversations, exact, licenses, lines, near, packing, passages, quality, rollup, sql, subwords, toxicity, warc
from candlewick.llm.text import scratch

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark, sf_dir):
    """All documents come in; copies (by their newest doc_id) go; German is counted anew by another version."""
    docs = table(spark, sf_dir, "documents")
    ledger = rollup.TokenLedger(spark, f"{scratch(spark)}/ledger")
    ledger.commit(1, rollup.token_counts(docs, "word_bpe_49k", tokenizer_path("word_bpe_49k.json")))
    none = [F.lit(None).cast("string").alias(c) for c in rollup.KEYS] + [F.lit(None).cast("long").alias("n_tokens")]
    gone = exact.exact_duplicates(docs).filter("NOT kept").select("doc_id", *none)
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    german = rollup.token_counts(docs.filter("lang = 'de'"), "byte_bpe_50k", path).join(gone, "doc_id", "left_anti")
    for _ in range(2):  # the second time is none
        ledger.commit(2, gone.unionByName(german))
    return ledger.totals()


def op3_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    return lines.drop_boilerplate(table(spark, sf_dir, "pages"))


def op5_warc(spark, sf_dir):
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_near_dedup(spark, sf_dir):
    """Shingles of four words, as the query's contract has it."""
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op7_substring_dedup(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    model = tokenizer_path("piece_bpe_32k.model")
    return subwords.digests(subwords.decode(subwords.encode(table(spark, sf_dir, "documents"), model), model))


def op9_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, tokenizer_path("word_bpe_49k.json")))


def op11_license_scan(spark, sf_dir):
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark, sf_dir):
    return conversations.repair(table(spark, sf_dir, "conversations"))


_EXACT = """
WITH digests AS (
  SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
         doc_id <= (SELECT avg(doc_id) FROM documents) AS old
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256, bool_or(old) OVER same AS known
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

# Twenty bits of the hexadecimal digest at a time make four letters.
_BASE32 = """list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda b:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 5 * i::INT + 1, 5))::BIGINT >> b) % 32)::INT, 1)),
  'string_agg', '')), 'string_agg', '')"""

_WARC = f"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM hashed)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

_LINES = f"""
WITH rows AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{lines.HOST}', 1)), '') AS host,
         list_filter(list_transform(
           string_split(regexp_replace(coalesce(html, ''), '{lines.MARKUP}', chr(10), 'g'), chr(10)),
           lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '') AS lines
  FROM pages),
counted AS (
  SELECT host, line, count(*) AS pages
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM rows WHERE host IS NOT NULL) GROUP BY ALL),
dropped AS (
  SELECT host, list(line) AS dropped
  FROM counted JOIN (SELECT host, count(*) AS total FROM rows GROUP BY host) USING (host)
  WHERE pages >= {lines.LEAST_PAGES} AND pages > {lines.RATIO} * total GROUP BY host),
kept AS (
  SELECT page_id, host, lines,
         list_filter(lines, lambda x: NOT coalesce(list_contains(dropped, x), false)) AS kept
  FROM rows LEFT JOIN dropped USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped,
       coalesce(array_to_string(kept, chr(10)), '') AS text
FROM kept
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts, in SQL."""
    share = lambda h: f"list_transform({h}, lambda n: n / list_sum({h})::DOUBLE)"
    part = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0.0 END"
    return (
        f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN round(sqrt(greatest(list_sum(list_transform("
        f"list_zip({share(p)}, {share(q)}), lambda z: {part('z[1]', 'z[2]')} + {part('z[2]', 'z[1]')})) / 2, 0.0)), 6) END"
    )


_CLASSES = (
    "len(regexp_replace(text, '[^a-z]+', '', 'g')) AS c1, len(regexp_replace(text, '[^A-Z]+', '', 'g')) AS c2, "
    "len(regexp_replace(text, '[^0-9]+', '', 'g')) AS c3, len(text) - len(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS c4, "
    "len(regexp_replace(text, '[^\\x00-\\x7F]+', '', 'g')) AS a, len(text) AS n_chars"
)

_QUALITY = f"""
WITH large AS (
  SELECT lang AS name FROM documents GROUP BY 1 HAVING count(*) >= {quality.LEAST_DOCS} AND name <> ''),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, name AS lang
  FROM documents LEFT JOIN large ON lang = name),
split AS (
  SELECT r, doc_id, lang, text, {_CLASSES},
         CASE WHEN trim(text, {_SPACE}) = '' THEN [] ELSE string_split_regex(trim(text, {_SPACE}), '[\\x20\\x09-\\x0D]+') END AS words
  FROM docs),
classed AS (SELECT *, [c1, c2, c3, c4, a - c1 - c2 - c3 - c4, n_chars - a] AS classes FROM split),
counted AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM split) GROUP BY ALL),
common AS (
  SELECT lang, list(word ORDER BY encode(word)) AS common, list(n ORDER BY encode(word)) AS n, any_value(total) AS total
  FROM counted JOIN (SELECT lang, sum(n) AS total FROM counted GROUP BY lang) USING (lang)
  WHERE n >= {quality.COMMON_SHARE} * total GROUP BY lang),
ref AS (
  SELECT lang, ref_classes, coalesce(common, []) AS common,
         list_append(coalesce(n, []), coalesce(total, 0) - coalesce(list_sum(n), 0)) AS ref_words
  FROM (SELECT lang, [sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]), sum(classes[5]), sum(classes[6])] AS ref_classes
        FROM classed GROUP BY lang) LEFT JOIN common USING (lang)),
windows AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS i, words FROM split WHERE len(words) >= 8),
placed AS (SELECT r, i, words[i : i + 7] AS w FROM windows),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM placed) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM repeated, range(8) AS t(k) GROUP BY r),
judged AS (
  SELECT doc_id, len(words) AS n_words, list_sum(list_transform(words, lambda w: len(w))) AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda l: trim(l, {_SPACE}) <> '') AS lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_chars, classes, ref_classes, ref_words,
         list_append(list_transform(common, lambda c: len(list_filter(words, lambda w: w = c))),
                     len(list_filter(words, lambda w: NOT list_contains(common, w)))) AS counts
  FROM classed LEFT JOIN covered USING (r) LEFT JOIN ref USING (lang)),
measured AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
         {_distance("classes", "ref_classes")} AS class_distance, {_distance("counts", "ref_words")} AS word_distance
  FROM judged)
SELECT doc_id, n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols,
       len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance,
       NOT base_failed AND NOT coalesce(n_chars >= {quality.MIN_CHARS} AND class_distance > {quality.MAX_CLASS_DISTANCE}
         OR n_words >= {quality.MIN_WORDS} AND word_distance > {quality.MAX_WORD_DISTANCE}, false) AS kept
FROM measured
"""


def queries() -> dict[str, Query]:
    found = {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": _EXACT,
        "op4_line_dedup": _LINES,
        "op5_warc": _WARC,
        "op9_quality": _QUALITY,
        "op12_vector_codes": sql.VECTORS,
        "op13_conversation_repair": sql.CONVERSATIONS,
    }
