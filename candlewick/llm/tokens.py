"""Token ids of whole texts by a public tokenizer, word by word with a cache."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from candlewick.llm.text import CACHE_WORDS

#: Bytes of texts whose words are looked up together.
_TOGETHER = 8_000_000

# Characters whose normal form, case and class are the same in any library: visible ASCII and Latin-1 letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The runs into which the tokenizer's own pattern divides plain lower-case words.
_RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabets show printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class _WordIds(dict):
    """Ids of words, looked up once each; starts afresh beyond CACHE_WORDS."""

    def __init__(self, find):
        super().__init__({"": b""})
        self.find = find

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self[""] = b""
        ids = self[word] = self.find(word)
        return ids


class WordTokenizer:
    """Ids of the tokenizer file ``word_bpe_49k.json``, equal to ``encode(text, add_special_tokens=False)``.

    That tokenizer never joins characters across white space, so ids of a text are the ids of its
    words in a row. Plain words go straight to the model; any others through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words = _WordIds(self._word)
        self.runs: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            if len(self.runs) >= CACHE_WORDS:
                self.runs.clear()
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
            ids = self.runs[run] = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        # Letters alone, or with one mark after them, are one run or two.
        if word.isascii():
            if word.isalpha():
                return self._run(word.lower())
            if word[-1] in ",.!?;:" and word[:-1].isalpha():
                return self._run(word[:-1].lower()) + self._run(word[-1])
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self._run(run) for run in _RUNS.findall(word.lower())])
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.words.__getitem__, words))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text; the words of many texts are told apart first, so each is looked up once."""
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        ends = np.cumsum(sizes)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + _TOGETHER, "right")))
            if sizes[start] > _TOGETHER:
                yield self.encode(texts[start].as_py())
            else:
                yield from self._together(texts.slice(start, stop - start))
            start = stop

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        texts = pc.fill_null(texts, "")
        for white in "\t\n\r":
            texts = pc.replace_substring(texts, white, " ")
        split = pc.split_pattern(texts, " ")
        known = split.flatten().dictionary_encode()
        ids = list(map(self.words.__getitem__, known.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        values = np.frombuffer(b"".join(ids), "<u4")
        words = np.asarray(known.indices)
        many = sizes[words]
        ends = np.r_[0, np.cumsum(many)]
        found = values[np.repeat(first[words] - ends[:-1], many) + np.arange(ends[-1])].tobytes()
        # An empty text has one empty word.
        edges = 4 * ends[np.r_[0, np.cumsum(np.asarray(pc.list_value_length(split)))]]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield found[a:b]


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a worker and file."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]
