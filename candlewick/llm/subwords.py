"""Encoding and decoding with a SentencePiece vocabulary by a max-plus parallel scan.

A text's encoding is the segmentation with the greatest sum of piece scores (of equal ones that
whose last piece is the longest, and so on from the end). Giant documents are cut into chunks. A
chunk's transfer matrix says, for every number of characters by which the piece before may reach
into the chunk and every number by which its own last piece may reach beyond, the best score in
between. Matrices are combined associatively, by blocks of chunks and then over the blocks, which
gives the best scores at every chunk's start; from those each chunk finds its own way back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import scratch, store

#: Characters of a chunk, and chunks whose matrices are combined together.
CHUNK, BLOCK = 32_768, 256
#: Words that a worker keeps, of up to so many characters: an executor has several workers.
KNOWN_WORDS, LONG_WORD = 150_000, 100
#: New words looked up at a time.
_TOGETHER = 4_096
_SPACE = "▁"
#: Stands for a text's own _SPACE: a noncharacter, which texts do not have.
_OWN = "\U0010ffff"
_NEVER = float("-inf")
_UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces and scores of a model file; texts are taken as they are, with a space put before them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.names = [model.id_to_piece(i) for i in ids]
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        self.unknown_score = min(score for _, score in self.pieces.values()) - _UNKNOWN_PENALTY
        self.prefixes = {piece[:n] for piece in self.pieces for n in range(1, len(piece) + 1)}
        self.longest = max(map(len, self.pieces))
        # Where a space follows another character no piece goes on, so every segmentation ends one there.
        self.splits = not any(_SPACE in piece.lstrip(_SPACE) for piece in self.pieces)
        self.words = _Words(self)
        self.search, self.numbers, self.costs = self._search()
        self.said = [self.byte_of.get(i, name.replace(_SPACE, " ").encode()) for i, name in enumerate(self.names)]

    def _search(self):
        """The same search over whole words by a library, and the id and score of each of its pieces.

        Its sums are of 64 bits too, and of equal ones it also keeps the first found. Unknown characters become
        the ids of their bytes, of which the first has the score; None where there are no such ids.
        """
        if not self.bytes:
            return None, None, None
        from tokenizers import Tokenizer, models

        least = min(score for _, score in self.pieces.values())
        pieces = [("<unk>", self.unknown, least, self.unknown_score)]
        pieces += [(piece, i, score, score) for piece, (i, score) in self.pieces.items()]
        pieces += [(f"<0x{b:02X}>", i, least, 0.0 if 0x80 <= b < 0xC0 else self.unknown_score) for b, i in self.bytes.items()]
        search = Tokenizer(models.Unigram([(piece, score) for piece, _, score, _ in pieces], 0, True))
        return search, np.array([i for _, i, _, _ in pieces], "<u4"), np.array([cost for *_, cost in pieces])

    def learn(self, words: list[str]) -> None:
        """Look up many stretches at once, as far as they are not known; long ones are known until the next time."""
        if self.search is None:
            return
        # A "<" may begin the name of a piece that no text has, and _OWN stands for another character.
        new = [w for w in dict.fromkeys(words) if w not in self.words and "<" not in w and _OWN not in w]
        if len(self.words) + len(new) > KNOWN_WORDS:
            self.words.clear()
            new = [w for w in dict.fromkeys(words) if "<" not in w and _OWN not in w]
        self.words.long = {}
        for at in range(0, len(new), _TOGETHER):
            part = new[at : at + _TOGETHER]
            found = self.search.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.int64)
            edges = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(part) + 1))
            scores = np.add.reduceat(self.costs[ids], edges[:-1]).tolist()
            data, edges = self.numbers[ids].tobytes(), (4 * edges).tolist()
            for word, score, start, stop in zip(part, scores, edges, edges[1:], strict=False):
                (self.words if len(word) <= LONG_WORD else self.words.long)[word] = score, data[start:stop]

    def forward(self, text: str, best: list[float]) -> tuple[list[float], list[int]]:
        """Best scores of, and starts of the last pieces to, each place; ``best`` has those at the first places."""
        size = len(text)
        best = best + [_NEVER] * (size + 1 - len(best))
        back = [-1] * (size + 1)
        for start in range(size):
            score = best[start]
            if score == _NEVER:
                continue
            single = False
            for end in range(start + 1, min(size, start + self.longest) + 1):
                part = text[start:end]
                if part not in self.prefixes:
                    break
                piece = self.pieces.get(part)
                if piece is not None:
                    single = single or end == start + 1
                    if score + piece[1] > best[end]:
                        best[end], back[end] = score + piece[1], start
            if not single and score + self.unknown_score > best[start + 1]:
                best[start + 1], back[start + 1] = score + self.unknown_score, start
        return best, back

    def ids(self, text: str) -> list[int]:
        """Of one piece's text."""
        piece = self.pieces.get(text)
        if piece is not None:
            return [piece[0]]
        return [self.bytes[b] for b in text.replace(_OWN, _SPACE).encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def path(self, text: str, back: list[int], end: int, stop: int = 0) -> tuple[list[int], int]:
        """Ids of the way that ends at ``end``, and the place at or before ``stop`` where it starts."""
        places = [end]
        while back[places[-1]] >= 0:
            places.append(back[places[-1]])
        places.reverse()
        return [i for a, b in zip(places, places[1:], strict=False) for i in self.ids(text[a:b])], places[0]

    def word(self, word: str) -> tuple[float, bytes]:
        """Score and ids of a stretch that begins and ends where pieces do."""
        return self.words[word]

    def stretches(self, text: str) -> list[str]:
        """The text cut where a space follows another character."""
        if not self.splits:
            return [text]
        if text[:1] == _SPACE and text[-1:] != _SPACE and _SPACE * 2 not in text:
            return [_SPACE + part for part in text[1:].split(_SPACE)]
        out, lead = [], ""
        for part in text.split(_SPACE):
            if part:
                out.append(lead + part)
                lead = ""
            lead += _SPACE
        lead = lead[:-1]  # one more than there are
        return [*out, lead] if lead else out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        known, parts = self.words, [self.stretches(text) for text in texts]
        self.learn([w for part in parts for w in part])
        return [b"".join([known[w][1] for w in part]) for part in parts]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of a run of ids; the space before a text is still there."""
        return b"".join(map(self.said.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Words(dict):
    """Score and ids of stretches, found once each; starts afresh beyond KNOWN_WORDS."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.long = vocabulary, {}

    def __missing__(self, word: str) -> tuple[float, bytes]:
        if word in self.long:
            return self.long[word]
        if len(self) >= KNOWN_WORDS:
            self.clear()
        best, back = self.vocabulary.forward(word, [0.0])
        ids, _ = self.vocabulary.path(word, back, len(word))
        found = (best[-1], np.array(ids, "<u4").tobytes())
        if len(word) <= LONG_WORD:
            self[word] = found
        return found


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def spaced(text: str | None) -> str:
    """A text that isn't empty with a space before it."""
    return " " + text if text else ""


def normal(text: str) -> str:
    """Spaces as the vocabulary writes them; a text's own such characters, which no piece stands for, in another way."""
    return text.replace(_SPACE, _OWN).replace(" ", _SPACE)


class Chunk:
    """A chunk of ``size`` characters with up to ``longest`` - 1 more to look at, which pieces may reach into."""

    def __init__(self, words: Vocabulary, text: str, size: int):
        self.words, self.text, self.size, self.states = words, text, size, words.longest
        parts = words.stretches(text)
        ends = np.cumsum([len(p) for p in parts]) if words.splits else np.empty(0, np.int64)
        # Where pieces must end: the first such place that no earlier piece can pass, and the last in the chunk.
        good = np.flatnonzero((ends >= self.states - 1) & (ends <= size) & (ends < len(text)))
        self.cuts = (int(ends[good[0]]), int(ends[good[-1]])) if len(good) else None
        self.middle = parts[good[0] + 1 : good[-1] + 1] if len(good) else []
        words.learn(self.middle)

    def matrix(self) -> np.ndarray:
        """Best scores from each number of characters reached into it to each reached beyond it."""
        if self.cuts is None:
            return np.array([self._beyond(self.text, 0, [_NEVER] * i + [0.0]) for i in range(self.states)])
        first, last = self.cuts
        head = [self.words.forward(self.text[i:first], [0.0])[0][-1] for i in range(self.states)]
        tail = self._beyond(self.text[last:], last, [0.0])
        return np.add.outer(np.array(head) + sum(self.words.word(w)[0] for w in self.middle), np.array(tail))

    def _beyond(self, text: str, at: int, best: list[float]) -> list[float]:
        scores = self.words.forward(text, best)[0][max(0, self.size - at) :]
        return (scores + [_NEVER] * self.states)[: self.states]

    def ways(self, scores: list[float]) -> tuple:
        """Prepared for the best scores at its first places: function from characters beyond to (ids, characters into)."""
        words = self.words
        if self.cuts is None:
            back = words.forward(self.text, list(scores))[1]
            return lambda beyond: self._way(self.text, back, self.size + beyond)
        first, last = self.cuts
        back = words.forward(self.text[:first], list(scores))[1]
        tail = words.forward(self.text[last:], [0.0])[1]
        head, into = self._way(self.text, back, first)
        middle = b"".join(words.word(w)[1] for w in self.middle)
        return lambda beyond: (head + middle + self._way(self.text[last:], tail, self.size + beyond - last)[0], into)

    def _way(self, text: str, back: list[int], end: int) -> tuple[bytes, int]:
        ids, start = self.words.path(text, back, end)
        return np.array(ids, "<u4").tobytes(), start


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[..., :, None] + b[None, :, :]).max(axis=-2) if a.ndim > 1 else (a[:, None] + b).max(axis=0)


def _few(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Few chunks at a time, so that what is made of them leaves the worker soon."""
    for batch in batches:
        for at in range(0, len(batch), 64):
            yield batch.iloc[at : at + 64]


_CHUNKS = "doc_id long, row long, chunk long, size long, last boolean, text string"
_IDS = "doc_id long, chunk long, start long, ids binary, text binary"


def encode(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, chunk, start, ids (little-endian unsigned 32-bit) and text (the document's UTF-8 that they stand for).

    A row per chunk of every document, in whose order its ids are the document's; ``start`` counts
    characters of the text with a space before it. Null and empty texts have one chunk without
    ids. Repeated rows are documents of their own, and a null doc_id stays null. Other columns are
    not looked at. No rows give no rows.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text"), F.lit(0)) >= chunk
    kinds = pa.schema([("doc_id", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("text", pa.binary())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            texts = [spaced(t.as_py()) for t in batch["text"]]
            none = pa.array([0] * len(texts), pa.int64())
            groups = (texts[at : at + 64] for at in range(0, len(texts), 64))
            ids = pa.array([i for group in groups for i in words.encode_all(list(map(normal, group)))], pa.binary())
            plain = pa.array([t.encode() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], none, none, ids, plain], schema=kinds)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        beyond = vocabulary(model).longest - 1
        for batch in batches:
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                text = spaced(text)
                starts = range(0, len(text), chunk)
                yield pd.DataFrame(
                    [
                        (doc_id, row, at // chunk, min(chunk, len(text) - at), at + chunk >= len(text), text[at : at + chunk + beyond])
                        for at in starts
                    ],
                    columns=[c.split()[0] for c in _CHUNKS.split(", ")],
                ).astype({"doc_id": "Int64"})

    # Rows that repeat each other are told apart by a number that is written down once.
    giants = store(rows.filter(giant).withColumn("row", F.monotonically_increasing_id()), f"{folder}/giants")
    chunks = store(giants.mapInPandas(split, _CHUNKS), f"{folder}/chunks")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in _few(batches):
            found = [Chunk(words, normal(t), n).matrix().astype("<f8").tobytes() for t, n in zip(batch["text"], batch["size"], strict=True)]
            yield batch[["row", "chunk"]].assign(matrix=found)

    transfers = store(chunks.mapInPandas(matrices, "row long, chunk long, matrix binary"), f"{folder}/matrices")
    transfers = transfers.withColumn("block", F.floor(F.col("chunk") / BLOCK))
    as_matrix = lambda data: np.frombuffer(data, "<f8").reshape(int((len(data) // 8) ** 0.5), -1)

    def combine(key, part: pd.DataFrame) -> pd.DataFrame:
        product = None
        for data in part.sort_values("chunk")["matrix"]:
            product = as_matrix(data) if product is None else _times(product, as_matrix(data))
        return pd.DataFrame({"row": [key[0]], "block": [key[1]], "matrix": [product.tobytes()]})

    def scan(key, part: pd.DataFrame) -> pd.DataFrame:
        """Scores at the start of each block (or chunk) from those at the start of the first."""
        part = part.sort_values("chunk" if "chunk" in part else "block")
        scores = np.array(part["first"].iloc[0]) if "first" in part else None
        out = []
        for data in part["matrix"]:
            step = as_matrix(data)
            if scores is None:
                scores = np.array([0.0] + [_NEVER] * (len(step) - 1))
            out.append(scores)
            scores = _times(scores, step)
        column = "chunk" if "chunk" in part else "block"
        return pd.DataFrame({"row": key[0], column: part[column].to_numpy(), "first": [list(s) for s in out]})

    blocks = transfers.groupBy("row", "block").applyInPandas(combine, "row long, block long, matrix binary")
    at_blocks = blocks.groupBy("row").applyInPandas(scan, "row long, block long, first array<double>")
    at_chunks = transfers.join(at_blocks, ["row", "block"]).groupBy("row", "block").applyInPandas(scan, "row long, chunk long, first array<double>")
    known = store(chunks.join(at_chunks, ["row", "chunk"]), f"{folder}/known")

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each number of characters beyond: the number of characters into the chunk on its way."""
        words = vocabulary(model)
        for batch in _few(batches):
            found = []
            for text, size, last, first in zip(batch["text"], batch["size"], batch["last"], batch["first"], strict=True):
                way = Chunk(words, normal(text), size).ways(list(first))
                found.append([way(b)[1] if size + b <= len(text) else 0 for b in range(1 if last else words.longest)])
            yield batch[["row", "chunk"]].assign(into=found)

    def back_blocks(key, part: pd.DataFrame) -> pd.DataFrame:
        """The maps of a block's chunks in one."""
        total = None
        for into in part.sort_values("chunk")["into"][::-1]:
            total = np.array(into) if total is None else np.array(into)[total]
        return pd.DataFrame({"row": [key[0]], "block": [key[1]], "into": [list(total)]})

    def back(key, part: pd.DataFrame) -> pd.DataFrame:
        """Characters beyond each block (or chunk), from those beyond the last."""
        column = "chunk" if "chunk" in part else "block"
        part = part.sort_values(column, ascending=False)
        beyond, out = (int(part["end"].iloc[0]) if "end" in part else 0), []
        for into in part["into"]:
            out.append(beyond)
            beyond = int(into[beyond])
        return pd.DataFrame({"row": key[0], column: part[column].to_numpy(), "end": out})

    ways = store(known.mapInPandas(maps, "row long, chunk long, into array<int>"), f"{folder}/maps")
    ways = ways.withColumn("block", F.floor(F.col("chunk") / BLOCK))
    per_block = ways.groupBy("row", "block").applyInPandas(back_blocks, "row long, block long, into array<int>")
    ends = per_block.groupBy("row").applyInPandas(back, "row long, block long, end int")
    ends = ways.join(ends, ["row", "block"]).groupBy("row", "block").applyInPandas(back, "row long, chunk long, end int")

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in _few(batches):
            out = []
            for doc_id, number, text, size, first, end in zip(
                *(batch[c] for c in ("doc_id", "chunk", "text", "size", "first", "end")), strict=True
            ):
                ids, into = Chunk(words, normal(text), size).ways(list(first))(int(end))
                plain = text[into : size + int(end)].encode()
                out.append((doc_id, number, number * chunk + into, ids, plain))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _IDS.split(", ")]).astype({"doc_id": "Int64"})

    traced = known.join(ends, ["row", "chunk"]).mapInPandas(trace, _IDS)
    return rows.filter(~giant).mapInArrow(whole, _IDS).unionByName(traced)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with decoded: the UTF-8 that each chunk's ids stand for."""
    kinds = [f"{name} {kind}" for name, kind in encoded.dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            found = pa.array([words.decode(ids.as_py()) for ids in batch["ids"]], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, ", ".join([*kinds, "decoded binary"]))


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, chunk, start, n_ids, ids_crc32 and round_trip of encoded and decoded chunks."""
    return decoded.select(
        "doc_id",
        "chunk",
        "start",
        F.floor(F.length("ids") / 4).alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
