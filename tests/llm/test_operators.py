"""Brute force, round trips and odd input for the operators that SQL cannot express."""

import hashlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import exact, lines, near, packing, passages, quality, rollup, toxicity, warc
from candlewick.llm.components import components
from candlewick.llm.queries import tokenizer_path
from candlewick.llm.text import scratch
from candlewick.llm.tokens import WordTokenizer

WORD = tokenizer_path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, keep_id string, size int"


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(count))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows and clashing column names."""
    long = prose(1, 5000)
    texts = [None, "", " \n\t", "one", long, long, long + " end", prose(2, 60), prose(2, 60) + " x", "a " * 300]
    rows = [(i, t, "en", "s", "k", 1) for i, t in enumerate(texts)]
    rows += [(None, "one", None, None, None, None), (None, None, None, None, None, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_exact(odd, none):
    rows = exact.exact_duplicates(odd).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert len(rows) == len(texts)
    for r in rows:
        same = [i for i, t in texts if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        keep = max((i for i in same if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(same), r.doc_id == keep)
    assert exact.exact_duplicates(none).collect() == []


def test_incoming_digests_without_a_history_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact, "SHARD_KEYS", 50)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 500).alias("text"))
    seen = []
    shard = exact._shard
    monkeypatch.setattr(exact, "_shard", lambda count: (seen.append(count), shard(count))[1])
    rows = exact.exact_duplicates(docs, history=F.col("doc_id") < 0).collect()
    assert seen and set(seen) == {500}
    assert all(r.keep_id == 500 + r.doc_id % 500 and not r.known for r in rows) and len(rows) == 1000


def test_the_model_is_fitted_on_what_an_exchange_brings_together(spark, monkeypatch):
    """The scan and the features run in many tasks; three grades and the slope of the likelihood are right."""
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for i in range(600):
        grade = i % 3
        marks = rng.choice(np.arange(100 * grade, 100 * grade + 6), 3, replace=False) if grade else np.empty(0, np.int64)
        rows.append(np.unique(np.r_[rng.integers(1000, 1400, 8), marks]))
        grades.append(grade)
    weights, thresholds = toxicity.fit(rows, np.array(grades))
    assert len(thresholds) == 2 and thresholds[0] < thresholds[1]
    scores = np.array([weights[r].sum() for r in rows])
    above = 1 / (1 + np.exp(-(scores[:, None] - thresholds)))
    severity = above.sum(1)
    means = [severity[np.array(grades) == g].mean() for g in range(3)]
    assert means[0] < 0.2 < 0.8 < means[1] < means[2]

    def likelihood(w, t):
        above = 1 / (1 + np.exp(-(np.array([w[r].sum() for r in rows])[:, None] - t)))
        steps = np.hstack([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))])
        at = np.arange(len(rows))
        return np.log(np.maximum(steps[at, grades] - steps[at, np.array(grades) + 1], 1e-9)).mean()

    # At the maximum no small step of a threshold or of all weights helps by more than the penalty allows.
    best = likelihood(weights, thresholds)
    for step in (0.05, -0.05):
        for k in range(2):
            moved = thresholds.copy()
            moved[k] += step
            assert likelihood(weights, moved) < best + 1e-4
    found = {}
    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 7).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    first = type(docs).first
    monkeypatch.setattr(type(docs), "first", lambda self: (found.setdefault("plan", self._jdf.queryExecution().executedPlan().toString()), first(self))[1])
    toxicity.train(docs, labels)
    learn, _, find = found["plan"].partition("Exchange")
    assert "MapInPandas learn" in learn and "MapInPandas find" in find and "Coalesce" not in found["plan"]


def test_perfect_hash_has_no_gaps():
    digests = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(3000)), np.uint8).reshape(-1, 32)
    for count in (1, 2, 7, 3000):
        seed, pilots = exact.perfect_hash(digests[:count])
        assert sorted(exact._slots(digests[:count], seed, pilots, count).tolist()) == list(range(count))


def test_components(spark):
    links = [(random.Random(i).randint(0, 300), random.Random(-i - 1).randint(0, 300)) for i in range(150)]
    links += [(i, i + 1) for i in range(400, 480)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long"), scratch(spark)).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in list(parent)}


def test_near_against_all_pairs(spark, odd, none):
    rng, rows = random.Random(3), []
    for group in range(12):
        words = prose(100 + group, 90).split()
        for _ in range(6):
            changed = list(words)
            for _ in range(rng.randint(0, 4)):
                changed[rng.randrange(len(changed))] = "new%d" % rng.randrange(1000)
            rows.append((len(rows), " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: set(near.shingle_set(t, 4).tolist()) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert {r.doc_id: r.component_id for r in near.near_duplicates(docs, words=4).collect()} == label
    found = near.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r.component_id for r in found}
    assert (by_id[None], by_id[0], by_id[1], by_id[2], by_id[3]) == (None, 0, 1, 2, 3)
    assert (by_id[4], by_id[5], by_id[6], by_id[7], by_id[8]) == (4, 4, 4, 7, 7)
    assert near.near_duplicates(none).collect() == []


def test_near_with_templates_just_below_the_threshold(spark, monkeypatch):
    """200 pages of one template that are not linked, some linked pairs among them: no link is lost, few pairs compared."""
    template, rng, rows = prose(4000, 170).split(), random.Random(6), []
    for i in range(200):
        own = prose(4100 + i, 26).split()  # shingles of four: about 0.74 of the union are shared
        rows.append((i, " ".join(template + own)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join(template + own[:-1] + ["other"])))
    compared = []
    confirm = near.verified
    monkeypatch.setattr(near, "verified", lambda pairs, *a: (compared.append(pairs.count()), confirm(pairs, *a))[1])
    found = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    sets = {i: set(near.shingle_set(t, 4).tolist()) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked == {(i, 1000 + i) for i in range(0, 200, 10)}
    assert found == {i: i - 1000 if i >= 1000 else i for i in sets}
    assert sum(compared) <= 3000 and compared[-1] <= 100  # of 24,090 pairs


def test_pairs_that_meet_lose_no_link(spark):
    """All links of random sets are among the pairs, whatever their sizes."""
    rng, rows = random.Random(12), []
    for _ in range(25):
        base = rng.sample(range(300), rng.randint(1, 60))
        for _ in range(4):
            kept = [w for w in base if rng.random() > 0.1] or base
            rows.append((len(rows), " ".join(f"w{w}" for w in dict.fromkeys(kept + rng.sample(range(300), rng.randint(0, 4))))))
    sets = {i: set(t.split()) for i, t in rows}
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = texts.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component"))
    for similarity in (50, 80, 100):
        links = {frozenset((a, b)) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}
        pairs = {frozenset((r.a, r.b)) for r in near._meeting(nodes, texts, 1, similarity, f"{scratch(spark)}/sets").collect()}
        assert links <= pairs and (links or similarity == 100)


def test_near_copies_of_which_half_are_linked(spark, monkeypatch):
    """Copies of a text of which 3 or 4 words are changed, so that a part of the pairs is linked: few are compared."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(260)]
    rows = []
    for i in range(400):
        own = list(words)
        for at in rng.choice(260, 3 + i % 2, replace=False):
            own[at] = f"own{i}x{at}"
        rows.append((i, " ".join(own)))
    tried = []
    confirm = near.verified

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return confirm(pairs, *rest)

    monkeypatch.setattr(near, "verified", counted)
    found = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: set(near.shingle_set(t, 5).tolist()) for i, t in rows}
    label = {i: i for i, _ in rows}
    for a in label:
        for b in range(a + 1, len(rows)):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if c == high else c for i, c in label.items()}
    assert found == label
    assert tried[-1] < 40_000, tried  # 45,710 when a node had one hub a round, any of its bucket


def test_passages(spark, odd, none):
    shared, other = prose(50, 70), prose(51, 55).split()
    edited = [*other[:27], "edited", *other[28:]]
    rows = [(1, f"{prose(60, 80)} {shared} {prose(61, 30)}"), (2, f"{prose(62, 9)} {shared}"), (3, prose(63, 200)),
            (4, f"{' '.join(other)} {prose(64, 40)}"), (5, f"{prose(65, 30)} {' '.join(edited)}"), (6, prose(66, 20) + " " + " ".join(shared.split()[:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = passages.repeated_passages(docs)
    found = {r.doc_id: r for r in spans.collect()}
    text = dict(rows)
    assert found[2].of_doc_id == 1 and text[2].encode()[found[2].start : found[2].end].decode() == shared
    assert set(found) == {2, 5}
    kept = {r.doc_id: r.text for r in passages.cut_repeats(docs, spans).collect()}
    assert kept[1] == text[1] and kept[3] == text[3] and kept[6] == text[6] and kept[2].split() == prose(62, 9).split()
    spans = passages.repeated_passages(odd)
    assert {r.doc_id for r in spans.collect()} == {5, 6, 8}
    cut = passages.cut_repeats(odd, spans)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert passages.repeated_passages(none).collect() == []


def test_windows_are_those_of_the_whole_tree():
    """Against a plain recursion, with equal keys and stretches of any length."""
    rng = np.random.default_rng(7)

    def split(keys, lo, hi, least):
        if hi - lo < least:
            return []
        c = lo + int(np.argmin(keys[lo:hi]))
        return [(lo, c, hi), *split(keys, lo, c, least), *split(keys, c + 1, hi, least)]

    for trial in range(60):
        stops = np.cumsum(rng.integers(0, 150, rng.integers(1, 9)))
        starts = np.r_[0, stops[:-1]]
        keys = rng.integers(0, 9 if trial % 3 else 1 << 60, stops[-1]).astype(np.uint64)
        least = int(rng.integers(1, 60))
        found = zip(*(x.tolist() for x in passages.compact_windows(keys, starts, stops, least)), strict=True)
        assert sorted(found) == sorted(w for lo, hi in zip(starts.tolist(), stops.tolist(), strict=True) for w in split(keys, lo, hi, least))


def test_words_are_hashed_alike_wherever_they_stand():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcXYZ019éß", k=rng.randint(1, 9))) for _ in range(60_000)] + ["q" * 300_000, "Q" * 299_999, "end"]
    text = " ".join(words).encode()
    begin, end = passages.word_spans(text)
    hashes = passages.hashed_words(np.frombuffer(text, np.uint8), begin, end).tolist()
    plain = [w.encode().lower() for w in words]
    assert len(hashes) == len(words) and len(set(zip(plain, hashes, strict=True))) == len(set(plain)) == len(set(hashes))


def test_passages_are_cut_out_of_their_own_rows(spark):
    """Several texts under one doc_id, rows without one, and columns with the names the operator might use."""
    shared, clean = prose(5000, 70), prose(5001, 91)
    texts = [(1, f"{prose(5002, 20)} {shared}"), (7, clean), (7, f"{prose(5003, 9)} {shared} é"), (7, prose(5004, 60)), (None, f"ß {shared}"), (None, prose(5005, 80)), (None, None), (8, clean)]
    schema = "doc_id long, text string, whole string, cuts int, cut_doc_id long, row string, sha string, `of` long, number int, _row_key string"
    rows = [(*t, f"w{i}", i, i, "r", "s", 1, 2, "mine") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    spans = passages.repeated_passages(docs)
    found = {(r.doc_id, r.of_doc_id, r.text_sha256): (r.start, r.end) for r in spans.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc_id, of, text in ((7, 1, texts[2][1]), (None, 1, texts[4][1])):
        start, end = found.pop((doc_id, of, sha(text)))
        assert text.encode()[start:end].decode() == shared
    assert {(k[0], k[2]) for k in found} == {(8, sha(clean))} or {k[0] for k in found} == {7}  # whose text comes first
    cut = {r.cuts: r for r in passages.cut_repeats(docs, spans).collect()}
    for i, row in enumerate(rows):
        changed = i in (2, 4) or i in ((7,) if found and next(iter(found))[0] == 8 else (1,))
        assert (cut[i].text != row[1]) == changed
        assert tuple(cut[i])[2:] == row[2:] and cut[i].doc_id == row[0]
    assert cut[2].text.split() == [*prose(5003, 9).split(), "é"]


def test_passages_of_which_most_is_common(spark):
    """45 words that 60 documents share, each followed by 10 words of a pair; and a run between two hubs."""
    common, rows = prose(500, 45), []
    for i in range(30):
        rows.append((i, f"{prose(600 + i, 30)} {common} {prose(700 + i, 60)}"))
    for pair in range(15):
        tail = prose(800 + pair, 10)
        rows += [(100 + 2 * pair + i, f"{prose(900 + 2 * pair + i, 40)} {common} {tail} {prose(1000 + 2 * pair + i, 40)}") for i in (0, 1)]
    x, y, z = prose(1100, 30), prose(1101, 30), prose(1102, 30)
    rows += [(200, f"{x} {y}"), (201, f"{x} {y} {z}"), (202, f"{prose(1103, 20)} {y} {z}")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    exact = {(r.doc_id, r.of_doc_id): text[r.doc_id].encode()[r.start : r.end].decode() for r in found}
    wanted = {(101 + 2 * p, 100 + 2 * p): f"{common} {prose(800 + p, 10)}" for p in range(15)}
    wanted |= {(201, 200): f"{x} {y}", (202, 201): f"{y} {z}"}
    assert exact == wanted


def test_edited_passages_of_which_most_is_common(spark):
    """45 words that 60 documents share, each followed by 10 words of a pair, of which one has a word changed."""
    common, rows = prose(500, 45), []
    for i in range(30):
        rows.append((i, f"{prose(600 + i, 30)} {common} {prose(700 + i, 60)}"))
    for pair in range(15):
        # No more than 44 shared words in a row: no equal stretch of 50.
        tail, at = prose(800 + pair, 10), 10 + 2 * pair
        words = common.split()
        edited = " ".join([*words[:at], "edited", *words[at + 1 :]])
        for i, part in enumerate((common, edited)):
            n = 100 + 2 * pair + i
            rows.append((n, f"{prose(900 + n, 40)} {part} {tail} {prose(1300 + n, 40)}"))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(101 + 2 * p, 100 + 2 * p) for p in range(15)} <= {(r.doc_id, r.of_doc_id) for r in found}
    text = dict(rows)
    for r in found:
        one, other = (set(zip(*(w[i:] for i in range(5)), strict=False)) for w in (text[r.doc_id].encode()[r.start : r.end].split(), text[r.of_doc_id].encode()[r.of_start : r.of_end].split()))
        assert r.n_words >= 50 and 100 * len(one & other) >= 80 * len(one | other)


def test_passages_of_common_shingles_only(spark, monkeypatch):
    """Texts of one phrase and of two phrases with a word between them, all of which are common."""
    monkeypatch.setattr(passages, "FEW", 2)
    one, two = prose(1500, 31), prose(1501, 31)
    rows = [(n, f"{prose(1600 + n, 30)} {one} {prose(1700 + n, 60)} {two} {prose(1800 + n, 30)}") for n in range(6)]
    rows += [(10 + n, f"{prose(1900 + n, 30)} {one} between{n} {two} {prose(2000 + n, 30)}") for n in range(6)]
    docs, folder = spark.createDataFrame(rows, "doc_id long, text string"), scratch(spark)
    docs = docs.withColumn("text", F.col("text").cast("binary"))
    none = spark.createDataFrame([], "doc_id long, start long, end long")
    matches = passages._seeded(none, docs, 5, 50, 80, folder)
    found = passages._compared(matches, docs, 5, 50, 80, f"{folder}/seeded", agree=1).collect()
    assert {r.doc_id for r in found} == set(range(11, 16)) and {r.of_doc_id for r in found} <= set(range(10, 15))


def test_passages_may_overlap():
    """Two words changed: the run between them is in a passage with the run before it and in one with the run after it."""
    words = prose(2100, 88).split()
    edited = [*words[:26], "x", *words[27:57], "y", *words[58:]]
    every = passages.Shingled([" ".join(words).encode(), " ".join(edited).encode()], 5)
    found = [" ".join(edited).encode()[s:e].decode().split() for s, e, *_ in passages.common_passages(every.of(0), every.of(1), 5, 50, 80)]
    assert found == [edited[:57], edited[27:]]


def test_areas_keep_every_byte_in_its_place(spark):
    """Areas that touch, among them; all else is blank."""
    pieces = [prose(2200 + n, 40) for n in range(6)]
    texts = [(n, " ".join(x for m in range(6) for x in (pieces[(n + m) % 6], prose(2300 + 10 * n + m, 155 + 3 * n + 7 * m)))) for n in range(8)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("text", F.col("text").cast("binary"))
    rows = passages.areas(docs, 5, 50, 19, scratch(spark)).filter("text IS NOT NULL").collect()
    assert {r.doc_id for r in rows} == set(range(8))
    for r in rows:
        whole, kept = texts[r.doc_id][1].encode(), bytes(r.text)
        assert all(x in (y, 32) for x, y in zip(kept, whole, strict=False)) and {*kept.split()} <= {*whole.split()}
        assert all(piece.encode() in kept for piece in pieces)


def test_copies_are_not_all_compared_with_each_other(spark, monkeypatch):
    """Texts with two words changed each: a few partners of each are compared, and find nearly all that all would."""
    tried, plain, words, rng = {}, passages.store, prose(2400, 120).split(), random.Random(5)

    def counted(frame, folder):
        stored = plain(frame, folder)
        if folder.endswith("/stretches"):
            tried[folder] = stored.count()
        return stored

    monkeypatch.setattr(passages, "store", counted)
    rows = []
    for n in range(60):
        own = list(words)
        for at in rng.sample(range(120), 2):
            own[at] = f"own{n}x{at}"
        rows.append((n, " ".join(own)))
    every = passages.Shingled([text.encode() for _, text in rows], 5)
    wanted = {}
    for b in range(60):
        spans = (span for a in range(b) for span in passages.common_passages(every.of(a), every.of(b), 5, 50, 80))
        wanted[b] = {at for start, end, *_ in spans for at in range(start, end)}
    for most, few in ((2048, 16), (20, 4)):
        monkeypatch.setattr(passages, "ALL", most)
        monkeypatch.setattr(passages, "FEW", few)
        tried.clear()
        found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sum(tried.values()) < 900, tried  # of 1,770 pairs
        covered = {b: set() for b in range(60)}
        for r in found:
            covered[r.doc_id] |= set(range(r.start, r.end))
        assert sum(len(covered[b] & wanted[b]) for b in range(60)) >= 0.98 * sum(map(len, wanted.values()))


def test_crowded_seeds_find_what_others_find(spark, monkeypatch):
    """Texts of one phrase and of two phrases with a word between them; a class holds no more than four."""
    monkeypatch.setattr(passages, "ALL", 4)
    monkeypatch.setattr(passages, "FEW", 2)
    one, two = prose(2500, 31), prose(2501, 31)
    rows = [(n, f"{prose(2600 + n, 30)} {one} {prose(2700 + n, 60)} {two} {prose(2800 + n, 30)}") for n in range(6)]
    rows += [(10 + n, f"{prose(2900 + n, 30)} {one} between{n} {two} {prose(3900 + n, 30)}") for n in range(6)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(11, 16)) and {r.of_doc_id for r in found} <= set(range(10, 15))


def test_similar_passages_share_a_run():
    """Against passages with words changed, left out and added at random."""
    rng = random.Random(11)
    for similarity in (60, 80, 95):
        run = passages.sure_run(5, 46, similarity)
        for _ in range(400):
            words = list(range(rng.randint(50, 140)))
            edited = list(words)
            for i in range(rng.randint(1, 6)):
                at = rng.randrange(len(edited))
                edited[at : at + rng.randint(0, 1)] = [1000 + i] * rng.randint(0, 1)
            one, other = ([tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (words, edited))
            if len(other) < 46 or 100 * len({*one} & {*other}) < similarity * len({*one} | {*other}):
                continue
            longest = now = 0
            for shingle in other:
                now = now + 1 if shingle in {*one} else 0
                longest = max(longest, now)
            assert longest >= run


def test_words_looked_up_together_have_the_same_ids(monkeypatch):
    """Of a batch's words each is looked up once, and the ids are those of the library."""
    import pyarrow as pa

    from candlewick.llm import tokens

    own = tokens.WordTokenizer(WORD)
    texts = ["Hello, hello world.", None, "", "  a\tb\n\nc\rD!  ", "naïve ÉTÉ don't 's x<|y 123 4.5 漢字 \x0b\x0c", "world. " * 50, prose(77, 300)]
    rows = pa.array(["skipped", *texts]).slice(1)
    looked_up = []
    find, own.words.find = own.words.find, lambda word: looked_up.append(word) or find(word)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    for together in (8_000_000, 100, 1):
        looked_up.clear()
        monkeypatch.setattr(tokens, "_TOGETHER", together)
        found = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(rows)]
        assert found == [own.whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert together < 8_000_000 or len(looked_up) == len(set(looked_up))


def test_packing(spark, odd, none):
    pieces = packing.pieces(odd, WORD)
    packed = packing.pack(pieces).collect()
    assert len(packed) == pieces.count()
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert len(sequences) == packing.lower_bound({n: sum(r.length == n for r in packed) for n in {r.length for r in packed}}, 4096)
    assert packing.pack(packing.pieces(none, WORD)).collect() == []


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(5)
    lengths, counts = np.unique(rng.integers(1, 100, 900), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    mother, father = (packing.fresh(histogram, 100, noise, rng) for noise in (0.1, 0.3))
    for groups in (mother, father, packing.crossover(mother, father, histogram, 100, rng)):
        total = {}
        for count, room, held in groups:
            assert room >= 0 and room + sum(n * k for n, k in held.items()) == 100
            for length, n in held.items():
                total[length] = total.get(length, 0) + count * n
        assert total == histogram


def test_word_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(WORD), WordTokenizer(WORD)
    for text in ["", "it's DON'T <|endoftext|>x", "ß Straße É é ΑΣ ΑΣ. İ ﬁ ª 中文 😀 12a1''s", "\x1c a\x1cb  z\x0b", prose(9, 50)]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_word_tokenizer_equals_the_library_on_fuzz_and_a_table(spark):
    from tokenizers import Tokenizer

    whole, words, rng = Tokenizer.from_file(WORD), WordTokenizer(WORD), random.Random(11)
    letters = [chr(c) for c in range(0x100)] + list("ßß.-'<st ") * 6
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(8000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_pieces_equal_the_library(spark):
    import zlib

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for capacity in (64, 4096):
        wanted = []
        for doc_id, text in docs.collect():
            ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = np.array(ids[at : at + capacity], "<u4")
                wanted.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
        assert sorted(map(tuple, packing.pieces(docs, WORD, capacity).collect())) == sorted(wanted)


def test_evolution_beats_best_fit():
    """Where best fit misses the bound, islands that inject whole bins reach fewer sequences."""
    better = 0
    for seed in range(6):
        rng = np.random.default_rng(seed)
        lengths, counts = np.unique(rng.integers(20, 61, 120), return_counts=True)
        histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        first = packing.fresh(histogram, 150, 0.0, rng)
        bins = sum(count for count, _, _ in first)
        population = [packing.fresh(histogram, 150, noise, rng) for noise in (0.0, 0.1, 0.2, 0.3)]
        for _ in range(60):
            mother, father = (population[i] for i in rng.choice(len(population), 2, replace=False))
            population.append(packing.crossover(mother, father, histogram, 150, rng))
            population = sorted(population, key=lambda g: packing.fitness(g, 150), reverse=True)[:4]
        least = sum(count for count, _, _ in population[0])
        assert packing.lower_bound(histogram, 150) <= least <= bins
        better += least < bins
    assert better


def test_rollup(spark, odd, none):
    ledger = rollup.TokenLedger(spark, f"{scratch(spark)}/ledger")
    docs = odd.filter("doc_id IS NOT NULL")
    counts = rollup.token_counts(docs, "word", WORD)
    assert ledger.commit(1, counts)
    gone = counts.filter("doc_id = 4").withColumn("n_tokens", F.lit(None).cast("long"))
    revised = counts.filter("doc_id = 7").withColumns({"version": F.lit("new"), "n_tokens": F.lit(5).cast("long")})
    assert ledger.commit(2, gone.unionByName(revised)) and not ledger.commit(2, counts)
    left = {r.doc_id: r.n_tokens for r in counts.collect() if r.doc_id not in (4, 7)}
    totals = {r.version: (r.documents, r.tokens) for r in ledger.totals().collect()}
    assert totals == {"word": (len(left), sum(left.values())), "new": (1, 5)}
    assert ledger.commit(3, rollup.token_counts(none, "word", WORD)) and ledger.totals().count() == 2
    # Rows without doc_id are documents of their own; the null one has no tokens, the other has those of "one".
    nulls = rollup.token_counts(odd.filter("doc_id IS NULL"), "null", WORD)
    assert ledger.commit(4, nulls.unionByName(gone.withColumn("doc_id", F.lit(None).cast("long"))))
    added = [(r.documents, r.tokens) for r in ledger.totals().filter("version = 'null'").collect()]
    assert added == [(2, left[3])] and ledger.documents().filter("doc_id IS NULL").count() == 2


def test_random_batches_in_any_order(spark, monkeypatch):
    """Inserts, deletes and revisions, committed out of order, repeated and compacted, against a plain dict."""
    monkeypatch.setattr(rollup, "COMPACT_EVERY", 3)
    rng = random.Random(8)
    schema = "doc_id long, source string, lang string, version string, n_tokens long"
    batches = {}
    for number in range(1, 9):
        ids = rng.sample(range(12), 5)
        batches[number] = [(i, rng.choice("st"), rng.choice(["en", None]), "v", rng.choice([None, *range(9)])) for i in ids]
    ledger, done = rollup.TokenLedger(spark, f"{scratch(spark)}/ledger"), []
    for number in (2, 1, 3, 5, 3, 8, 4, 1, 7, 6):
        assert ledger.commit(number, spark.createDataFrame(batches[number], schema)) == (number not in done)
        done = sorted({*done, number})
        state = {}
        for n in done:
            state.update({row[0]: row for row in batches[n]})
        wanted = {}
        for _, *key, tokens in state.values():
            if tokens is not None:
                count, total = wanted.get(tuple(key), (0, 0))
                wanted[tuple(key)] = (count + 1, total + tokens)
        totals = {(r.source, r.lang, r.version): (r.documents, r.tokens) for r in ledger.totals().collect()}
        assert totals == wanted
        assert sorted(map(tuple, ledger.documents().collect())) == sorted(r for r in state.values() if r[4] is not None)
    assert len(ledger._batches()) < 3


def test_counts_equal_the_library(spark):
    import base64

    import public_tokenizers
    import tiktoken

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r.n_tokens for r in rollup.token_counts(docs, "byte", path).collect()}
    assert found == {r.doc_id: len(own.encode_ordinary(r.text or "")) for r in docs.collect()}


def test_warc(spark):
    rows = [(1, "http://a/", "x" * 50_000), (2, None, "x" * 50_000), (3, "b\nc", None), (4, "", ""), (None, "n", "x" * 50_000)]
    rows += [(10 + i, "u", prose(i, 200)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, scratch(spark))
    for split in (300, 1 << 20):
        found = warc.read_archives(manifest, split).collect()
        assert len(found) == len(rows)
        assert sorted(r.payload.decode() for r in found if r.record_type == "response") == sorted({t or "" for _, _, t in rows})
    refers = {r.page_id: r.refers_to for r in warc.archive_round_trip(pages).collect() if r.record_type == "revisit"}
    assert refers == {2: 1, None: 1, 4: 3}
    assert warc.archive_round_trip(pages.limit(0)).collect() == []


def test_false_magic_is_passed_over():
    good = [warc.record(i, "u", b"page %d" % i, None, False) for i in range(3)]
    data = b"\x1f\x8b\x08junk" + good[0] + good[1] + b"\x1f\x8b" + good[2]
    whole = [at for at, _ in warc.records(io.BytesIO(data), 0, len(data))]
    parts = [at for start in range(0, len(data), 7) for at, _ in warc.records(io.BytesIO(data), start, start + 7)]
    assert whole == parts and len(whole) == 3


def test_toxicity(spark, odd, none):
    bad = ["idiot", "scum", "moron"]
    rows = [(i, prose(i, 40) + (" " + " ".join(random.Random(i).sample(bad, 2)) if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    weights, thresholds = toxicity.train(docs, labels.filter("doc_id < 200"))
    found = toxicity.score(docs.filter("doc_id >= 200"), weights, thresholds).collect()
    assert all(r.toxic == (r.doc_id % 4 == 0) for r in found)
    assert list(thresholds) == sorted(thresholds)
    scored = toxicity.score(odd, weights, thresholds).collect()
    assert len(scored) == odd.count() and not any(r.toxic for r in scored)
    assert toxicity.toxicity(none, labels.limit(0)).collect() == []


def test_quality_of_odd_rows(odd, none):
    rows = quality.quality(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (0, 1, 2, 3, 9))
    assert quality.quality(none).collect() == []


def test_quality_judges_by_a_language_from_the_same_count_on_at_any_size(spark):
    """One document is never its own reference: below the floor the base rule alone decides, in small tables as in large."""
    digits = " ".join(map(str, range(10**6, 10**6 + 90)))
    schema = "doc_id long, text string, lang string"
    for others in (50, quality.LEAST_DOCS, 3000):
        rows = [(i, prose(3000 + i % 200, 80), "en") for i in range(others)] + [(9000, digits, "xx"), (9001, digits, "en")]
        by_id = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, schema)).filter("doc_id >= 9000").collect()}
        assert by_id[9000].class_distance is None and by_id[9000].kept
        judged = others >= quality.LEAST_DOCS
        assert (by_id[9001].class_distance is not None) == judged and by_id[9001].kept != judged


def test_lines_go_by_their_share_on_small_hosts_too(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [(i, f"http://small.example/{i}", page("menu", f"own {i}")) for i in range(4)]
    rows += [(10 + i, f"http://two.example/{i}", page(*["both"], *(["one"] * (i == 0)))) for i in range(2)]
    rows += [(20, "http://alone.example/", page("single", "single"))]
    rows += [(100 + i, f"http://Large.example:80/{i}", page(*["rare"] * (i < 3), *["often"] * (i < 4), f"own {i}")) for i in range(30)]
    found = {r.page_id: r.text for r in lines.drop_boilerplate(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert (found[10], found[11], found[20]) == ("one", "", "single\nsingle")
    assert found[100] == "rare\nown 0" and found[103] == "own 3" and found[129] == "own 29"  # 3 of 30 is not above a tenth


def test_lines_of_odd_pages(spark):
    """Nulls in any column, blank and very long pages, repeated rows, clashing names, no rows."""
    schema = "page_id long, url string, html string, host string, lines int, boilerplate string, hash long, total long"
    long = "\n".join(prose(7000 + i, 6) for i in range(20_000))
    pages = [(1, None, "a"), (2, "http://h.example/a", None), (3, "http://h.example/b", " \n\t"), (None, "http://h.example/c", "a\nb"),
             (4, "http://h.example/d", "a\nc"), (5, "no url", "a"), (6, "http://long.example/", long), (7, "http://r.example/", "x\ny"), (7, "http://r.example/", "x\ny"), (None, None, None)]
    frame = spark.createDataFrame([(*p, "mine", 1, "b", 2, 3) for p in pages], schema)
    rows = lines.drop_boilerplate(frame).collect()
    assert len(rows) == len(pages)
    found = sorted(((r.page_id, r.host, r.n_lines, r.n_dropped, r.text) for r in rows if r.page_id != 6), key=str)
    wanted = [(1, None, 1, 0, "a"), (2, "h.example", 0, 0, ""), (3, "h.example", 0, 0, ""), (None, "h.example", 2, 1, "b"), (4, "h.example", 2, 1, "c"),
              (5, None, 1, 0, "a"), (7, "r.example", 2, 2, ""), (7, "r.example", 2, 2, ""), (None, None, 0, 0, "")]
    assert found == sorted(wanted, key=str)
    assert next(r.text for r in rows if r.page_id == 6) == long
    assert lines.drop_boilerplate(frame.limit(0)).collect() == []


def test_quality_of_rare_languages(spark):
    """Two languages of different scripts below a thousandth of the documents, and rows without one."""
    latin = [prose(2000 + i, 80) for i in range(115)]
    cyrillic = [t.translate(str.maketrans("abcdefgh", "абвгдежз")) for t in latin]
    rows = [(i, t, "xa") for i, t in enumerate(latin)] + [(1000 + i, t, "xb") for i, t in enumerate(cyrillic)]
    rows += [(2000, cyrillic[0], None), (2001, latin[0], ""), (2002, cyrillic[1], "xc"), (2003, latin[1], "xc")]
    rows += [(2004, "7 " * 9 + " ".join(map(str, range(10**6, 10**6 + 80))), "xa")]
    many = spark.range(10_000, 130_000).select("id", F.lit("a b c").alias("text"), F.lit("en").alias("lang"))
    found = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(many.withColumnRenamed("id", "doc_id")))
    by_id = {r.doc_id: r for r in found.filter("doc_id < 10000").collect()}
    assert [i for i, r in by_id.items() if not r.kept] == [2004] and len(by_id) == len(rows)
    assert all(by_id[i].class_distance is None and by_id[i].word_distance is None for i in range(2000, 2004))
    assert by_id[0].class_distance < 0.1 > by_id[1000].class_distance
