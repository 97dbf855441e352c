"""Licence scans against brute force: matching statistics, places of phrases, chains and odd rows."""

import random
import re

from candlewick.llm import licenses
from candlewick.llm.licenses import Automaton, Scanner, scan, summary, words_of
from candlewick.llm.queries import op11_license_scan

SF_DIR = "/root/testdata/sf0.001"


def test_matching_statistics_of_random_words():
    rng = random.Random(7)
    for _ in range(150):
        letters = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        texts = [rng.choices(letters, k=rng.randint(1, 9)) for _ in range(rng.randint(1, 4))]
        auto = Automaton(texts)
        stream = rng.choices([*letters, b"?"], k=30)
        found = auto.statistics([auto.words.get(w, 0) for w in stream])
        for at, (state, length) in enumerate(found):
            runs = [stream[at - n + 1 : at + 1] for n in range(1, at + 2)]
            places = {len(r): {(t, e) for t, x in enumerate(texts) for e in range(len(r) - 1, len(x)) if x[e - len(r) + 1 : e + 1] == r} for r in runs}
            assert length == max((n for n, where in places.items() if where), default=0)
            if length:
                assert set(auto.ends[state]) == places[length] and len(auto.ends[state]) == len(places[length])


def brute(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    places = [(label, at) for phrase, label in licenses.PHRASES.items() for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_phrases_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op11_license_scan(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n_words, places = brute(texts[r.doc_id])
        starts = [at for _, at in places]
        base = sorted({label for label, _ in places})
        assert (r.n_words, r.n_base, r.base_labels) == (n_words, len(places), ",".join(base))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert set(base) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_phrases_in_a_jumble():
    rng, scanner = random.Random(2), Scanner()
    words = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "the", "gnu", "x", "É", "4"]
    for _ in range(300):
        text = rng.choice([" ", "-", "\x1c", "_ "]).join(rng.choices(words, k=40)).swapcase()
        n_words, places, _ = scanner.scan(text.encode())
        assert (n_words, sorted((label, at) for label, at, _ in places)) == brute(text)


def best_cover(template, words):
    """Most template words covered by anchors in the same order, by trying all chains."""
    anchors = []
    for i in range(len(words)):
        for j in range(len(template)):
            n = 0
            while i + n < len(words) and j + n < len(template) and words[i + n] == template[j + n]:
                n += 1
            if n >= licenses.ANCHOR and (not i or not j or words[i - 1] != template[j - 1]):
                anchors.append((i, j, n))
    best = {}
    for i, j, n in sorted(anchors):
        best[i, j] = n + max((c - max(0, a + m - i, b + m - j) for (a, b), (c, m) in best.items() if a < i and b < j and a + m < i + n and b + m < j + n), default=0), n
    return max((c for c, _ in best.values()), default=0)


def test_chains_cover_as_much_as_any():
    rng = random.Random(5)
    template = [b"w%d" % i for i in range(40)]
    scanner = Scanner([("x", " ".join(w.decode() for w in template))], {})
    for _ in range(200):
        words = list(template)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 2)] = [b"new"] * rng.randint(0, 3)
        _, _, spans = scanner.scan(b" ".join([b"before"] * 5 + words + [b"after"] * 5))
        most = best_cover(template, words)
        assert [s.covered for s in spans] == ([most] if most >= licenses.COVER * 40 else [])
        for s in spans:
            assert 5 <= s.first < s.last < 5 + len(words)


def test_templates_in_texts():
    scanner = Scanner()
    for label, text in licenses.TEMPLATES:
        found = scanner.scan(f"Ut enim. {text} Et cetera.".encode())[2]
        assert [(s.label, s.share, s.first) for s in found] == [(label, 1.0, 2)]
        again = scanner.scan(f"{text}\n{text}".encode())[2]
        assert [(s.label, s.first) for s in again] == [(label, 0), (label, len(words_of(text.encode())))]
    shorter = dict(licenses.TEMPLATES)["isc"].replace("copy", "clone").replace("THE SOFTWARE", "IT")
    assert [(s.label, s.share < 1) for s in scanner.scan(shorter.encode())[2]] == [("isc", True)]
    assert scanner.scan(b"permission is hereby granted free of charge to any person")[2] == []


def test_odd_rows(spark):
    long = "the quick licence of " * 200_000 + "All rights reserved"
    rows = [(None, None), (1, ""), (1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, "ß cc-by \x00CC\nBY"), (3, long)]
    frame = spark.createDataFrame([(*r, "mit", 1) for r in rows], "doc_id long, text string, labels string, n_words int")
    found = {(r.doc_id, r.n_words): (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in summary(scan(frame)).collect()}
    assert summary(scan(frame)).count() == len(rows)
    assert found[None, 0] == found[1, 0] == (0, None, None, "", "", 0.0)
    assert found[1, 5] == (0, None, None, "", "mit", 1.0)
    assert found[2, 5] == (2, 1, 3, "cc-by", "cc-by", 1.0)
    assert found[3, 800_003] == (1, 800_000, 800_000, "reserved", "reserved", 1.0)
    assert summary(scan(frame.limit(0))).collect() == []
