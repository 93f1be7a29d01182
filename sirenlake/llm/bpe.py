"""BPE encoding and decoding: merges by rank from a priority queue over a doubly linked list of symbols.

A text falls into chunks at white space; a chunk into special tokens and words (contractions, runs of letters,
single digits, runs of other characters) of its composed, lower-cased characters; a word into its bytes, the
last one marked as the end. The queue holds every neighbouring pair that may merge, by rank and position. A
popped entry whose pair has changed since it was queued is stale and skipped; a merge links the new symbol to its
neighbours and queues the two new pairs, so a word of n bytes takes n log n steps. Decoding joins the vocabulary's
strings, with blanks between them as no decoder is named in the file.

Letters and their cases are those of the Unicode version of Python and of the ``regex`` package.
Workers remember the chunks and words they have solved (MEMORY of each, none longer than SHORT); this saves time only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMORY = 1 << 18
SHORT = 64
STEP = 256  # texts handled at once inside a task
SHIFT = 20
MASK = (1 << SHIFT) - 1

# The pattern of the words and the white space between them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
CONTROL = re.compile("[\x1c-\x1f]")  # white space for ``str.split`` only


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    letter = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


def _remember(memory: dict, key: str, value: list[int] | bytes) -> None:
    if len(key) <= SHORT:
        if len(memory) >= MEMORY:
            memory.clear()
        memory[key] = value


class Bpe:
    """Vocabulary and merges of a byte-level BPE file with marked word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for string, i in (vocab | self.special).items():
            self.strings[i] = string
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + suffix] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {vocab[a] << SHIFT | vocab[b]: rank << SHIFT | vocab[a + b] for rank, (a, b) in enumerate(pairs)}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _ready(self) -> None:
        if not hasattr(self, "_solved"):
            self._solved: dict[str, bytes] = {}
            self._merged: dict[str, list[int]] = {}
            self._words = regex.compile(WORDS.replace(r"\s", WHITE[1:-2]))
            self._white = re.compile(WHITE)
            self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Numbers of the symbols that the merges leave of a word."""
        n = len(word)
        symbol = [self.inner[b] for b in word]
        symbol[-1] = self.final[word[-1]]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges, queue = self.merges, []
        for i in range(n - 1):
            pair = symbol[i] << SHIFT | symbol[i + 1]
            if pair in merges:
                queue.append((merges[pair], i, pair))
        heapq.heapify(queue)
        while queue:
            found, i, pair = heapq.heappop(queue)
            j = after[i]
            if j >= n or symbol[i] << SHIFT | symbol[j] != pair:
                continue
            symbol[i], symbol[j] = found & MASK, -1  # a dead symbol makes no pair
            k, p = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                pair = symbol[i] << SHIFT | symbol[k]
                if pair in merges:
                    heapq.heappush(queue, (merges[pair], i, pair))
            if p >= 0:
                pair = symbol[p] << SHIFT | symbol[i]
                if pair in merges:
                    heapq.heappush(queue, (merges[pair], p, pair))
        return [s for s in symbol if s >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """Packed numbers of a chunk without white space."""
        ids: list[int] = []
        for part in self._special.split(chunk) if self._special else (chunk,):
            if part in self.special:
                ids.append(self.special[part])
                continue
            # characters are lower-cased one by one, so a sigma at the end of a word is like any other
            for word in self._words.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()):
                if (merged := self._merged.get(word)) is None:
                    merged = self.merge(word.encode())
                    _remember(self._merged, word, merged)
                ids += merged
        packed = np.array(ids, "<u4").tobytes()
        _remember(self._solved, chunk, packed)
        return packed

    def encode(self, text: str) -> bytes:
        """Numbers of a whole text as little-endian unsigned 32-bit integers."""
        self._ready()
        chunks = self._white.split(text) if CONTROL.search(text) else text.split()
        solved = self._solved.get
        return b"".join([self._chunk(c) if (p := solved(c)) is None else p for c in chunks])

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return " ".join([strings[i] for i in ids.tolist()])


def load_bpe(path: str) -> Bpe:
    """The BPE model of a tokenizer file, read on the driver and sent to the tasks with the function that uses it."""
    return Bpe(path)


def _added(docs: DataFrame, column: str, fields: list[pa.Field], types: str, work: Callable[[list], list[list]]) -> DataFrame:
    """``docs`` with new columns that ``work`` gives for the values of ``column``."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                new = work(part.column(part.schema.get_field_index(column)).to_pylist())
                arrays = [pa.array(values, f.type) for values, f in zip(new, fields)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema=pa.schema([*part.schema, *fields]))

    names = {f.name for f in fields}
    if clash := names & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(clash)}")
    known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(batches, f"{known}, {types}")


def encode_documents(docs: DataFrame, bpe: Bpe, column: str = "text") -> DataFrame:
    """``docs`` with ``_ids``, the token numbers of the whole text. NULL texts are empty; no row is left out.

    Special tokens written in a text become their numbers; none is added. All other columns are handed on; one
    called ``_ids`` is an error.
    """
    field = pa.field("_ids", pa.list_(pa.int32()))
    return _added(docs, column, [field], "_ids array<int>", lambda texts: [[np.frombuffer(bpe.encode(t or ""), "<i4") for t in texts]])


def decode_documents(docs: DataFrame, bpe: Bpe, column: str = "_ids") -> DataFrame:
    """``docs`` with ``_decoded``, the vocabulary strings of the numbers with blanks between them, specials included."""
    field = pa.field("_decoded", pa.string())
    return _added(docs, column, [field], "_decoded string", lambda ids: [[bpe.decode(np.array(i or [], np.int64)) for i in ids]])


def token_digests(docs: DataFrame, bpe: Bpe) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, encoded and decoded in one pass over the texts.

    One row per row of ``docs``, whatever its id; NULL and empty texts have no tokens and decode to nothing.
    """

    def work(texts: list[str | None]) -> list[list]:
        packed = [bpe.encode(t or "") for t in texts]
        decoded = (bpe.decode(np.frombuffer(p, "<u4")).encode() for p in packed)
        return [[len(p) // 4 for p in packed], [hashlib.sha256(p).hexdigest() for p in packed], [hashlib.sha256(d).hexdigest() for d in decoded]]

    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    types = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _added(docs.select("doc_id", "text"), "text", fields, types, work).drop("text")
