"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text's encoding is the path of pieces with the largest sum of scores. No piece reaches over the start of a
run of blanks after other characters, so ordinary texts fall apart into short segments; distinct segments
are solved together, array operation by array operation. Giant texts are cut into chunks of equal size at
any place. The state at a boundary is how many bytes the piece over it reaches into the next chunk. Every
chunk yields a matrix of best scores from entry to exit state; products of matrices (max for sum, + for
product) are associative, so groups of chunks combine level by level, the boundary states follow from the
top down, and each chunk is backtraced on its own.

Texts are used as they are: a blank in front, blanks stand for the model's blank sign, characters without a
piece become byte pieces. Decoding gives back the exact text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sirenlake.functions.session import cut_lineage

from .common import Words, pieces

CHUNK = 1 << 16  # bytes; longer texts are cut
GROUP = 64  # matrices combined at once
NONE = -np.inf
SLOTS = 1 << 18
TEXT_BYTES = 1 << 18  # text encoded at once
MEMORY = 1 << 17  # segments whose paths a task remembers
SEGMENT = 48  # bytes up to which segments are solved together


def hashes_of(parts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    return Words(data, np.concatenate([[0], ends]), lower=False).spans(ends - [len(p) for p in parts], ends)


class Solved:
    """Paths of the short segments met so far, by the hash of their bytes: at most MEMORY and those of one piece of text."""

    def __init__(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and their places."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return (self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)), at

    def add(self, keys: np.ndarray, numbers: np.ndarray, count: np.ndarray) -> None:
        keys, first = np.concatenate([self.keys, keys]), np.concatenate([self.first, len(self.numbers) + np.cumsum(count) - count])
        count, order = np.concatenate([self.count, count]), np.argsort(keys)
        self.keys, self.first, self.count = keys[order], first[order], count[order]
        self.numbers = np.concatenate([self.numbers, numbers])


@dataclass
class Vocabulary:
    """Pieces as bytes (blank for the blank sign), scores, byte pieces; lookup by hash."""

    pieces: dict[bytes, int]
    scores: np.ndarray
    byte_ids: np.ndarray
    surfaces: list[bytes]
    longest: int = 0
    unknown: float = 0.0
    cuts: bool = True
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    reach: np.ndarray = field(default_factory=lambda: np.full(1 << 16, 4, np.int8))  # longest piece by its first two bytes
    solved: Solved = field(default_factory=Solved)

    def __post_init__(self) -> None:
        self.longest = max(len(p) for p in self.pieces)
        self.unknown = float(min(self.scores[i] for i in self.pieces.values() if self.scores[i] > -1e8)) - 10
        self.cuts = not any(b != 32 and c == 32 for p in self.pieces for b, c in zip(p, p[1:]))
        for piece in self.pieces:
            pairs = [piece[0] << 8 | piece[1]] if len(piece) > 1 else []
            self.reach[pairs] = np.maximum(self.reach[pairs], len(piece))
        self.keys, self.ids = np.zeros((2, SLOTS), np.uint64), np.full((2, SLOTS), -1, np.int32)
        for (piece, number), key in zip(self.pieces.items(), hashes_of(list(self.pieces))):
            # two tables with different places; a piece that finds both taken moves the holder on
            for turn in range(100):
                for side in (0, 1):
                    at = self._slot(key, side)
                    if self.ids[side, at] < 0:
                        self.keys[side, at], self.ids[side, at] = key, number
                        break
                else:
                    side = turn & 1
                    at = self._slot(key, side)
                    (self.keys[side, at], key), (self.ids[side, at], number) = (key, self.keys[side, at]), (number, self.ids[side, at])
                    continue
                break
            else:
                raise ValueError("pieces do not fit the table")

    @staticmethod
    def _slot(key: np.ndarray, side: int) -> np.ndarray:
        return ((key >> np.uint64(20 if side else 40)) % np.uint64(SLOTS)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Piece number of every hash, -1 if none."""
        a, b = self._slot(key, 0), self._slot(key, 1)
        second = np.where(self.keys[1, b] == key, self.ids[1, b], -1)
        return np.where(self.keys[0, a] == key, np.where(self.ids[0, a] >= 0, self.ids[0, a], second), second)


def load_vocabulary(model_file: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file; control and unknown pieces are never used."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    numbers = range(model.get_piece_size())
    usual = [i for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    surfaces = {i: model.id_to_piece(i).replace("▁", " ").encode() for i in usual}
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    all_surfaces = [surfaces.get(i, b"") for i in numbers]
    for b, i in enumerate(byte_ids):
        all_surfaces[i] = bytes([b])
    return Vocabulary({surfaces[i]: i for i in usual}, np.array([model.get_score(i) for i in numbers], float), byte_ids, all_surfaces)


def char_starts(data: np.ndarray) -> np.ndarray:
    """For every byte the place where its UTF-8 character starts."""
    return np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)


def best_arrivals(vocab: Vocabulary, data: bytes, length: int, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best scores per place and lane, and for lane 0 the piece and its start by which a place is reached.

    ``lanes`` gives each lane's score at the first places. Pieces start before ``length`` and may end behind
    it. Among equal scores the piece with the earliest start wins.
    """
    size = len(data)
    best = np.full((size + 1, lanes.shape[1]), NONE)
    best[: len(lanes)] = lanes[: size + 1]
    piece, start = np.full(size + 1, -1, np.int32), np.full(size + 1, -1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    begins = char_starts(raw)
    for end in range(1, size + 1):
        if end < size and (raw[end] & 0xC0) == 0x80:
            continue
        low, char = max(0, end - vocab.longest), int(begins[end - 1])
        for at in range(low, min(end, length)):
            number = vocab.pieces.get(data[at:end])
            if number is None:
                if at != char:
                    continue
                number, score = -1, vocab.unknown
            else:
                score = vocab.scores[number]
            total = best[at] + score
            if total[0] > best[end, 0]:
                piece[end], start[end] = number, at
            best[end] = np.maximum(best[end], total)
    return best, piece, start


def backtrace(vocab: Vocabulary, data: bytes, piece: np.ndarray, start: np.ndarray, end: int, entry: int) -> list[int]:
    """Piece numbers of the path from ``entry`` to ``end``."""
    out: list[int] = []
    while end > entry:
        at = int(start[end])
        out += [int(vocab.byte_ids[b]) for b in reversed(data[at:end])] if piece[end] < 0 else [int(piece[end])]
        end = at
    return out[::-1]


def encode_segment(vocab: Vocabulary, data: bytes) -> list[int]:
    """The sequential method for one text that starts with its blank."""
    _, piece, start = best_arrivals(vocab, data, len(data), np.zeros((1, 1)))
    return backtrace(vocab, data, piece, start, len(data), 0)


def encode_together(vocab: Vocabulary, words: Words, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers of many short segments, one after another, and the number of pieces of each."""
    order = np.argsort(begin - end, kind="stable")
    first, size = begin[order], (end - begin)[order]
    n, longest = len(first), int(size.max(initial=0))
    best = np.full((n, longest + 1), NONE)
    best[:, 0] = 0
    piece, back = np.full((n, longest + 1), -1, np.int32), np.zeros((n, longest + 1), np.int16)
    data, begins = words.data, char_starts(words.data)
    pair = words.data.astype(np.int64) << 8
    pair[:-1] |= words.data[1:]
    reach = vocab.reach[pair]
    for r in range(1, longest + 1):
        k = int(np.searchsorted(-size, -r, "right"))
        at = first[:k] + r
        own = begins[at - 1] - first[:k]  # where the last character starts
        for step in range(min(r, vocab.longest), 0, -1):
            rows = np.flatnonzero((reach[at - step] >= step) & (best[:k, r - step] > NONE))
            if not len(rows):
                continue
            stop = at[rows]
            number = vocab.find(words.spans(stop - step, stop))
            whole = (stop >= len(data)) | (begins[np.minimum(stop, len(data) - 1)] == stop)
            score = np.where(number >= 0, vocab.scores[number], np.where((own[rows] == r - step) & whole, vocab.unknown, NONE))
            total = best[rows, r - step] + score
            better = total > best[rows, r]
            rows = rows[better]
            best[rows, r], piece[rows, r], back[rows, r] = total[better], number[better], step
    row, place = np.arange(n), size.copy()
    rows_out, numbers_out = [], []
    while len(row):
        step, number = back[row, place].astype(np.int64), piece[row, place]
        known = number >= 0
        rows_out.append(row[known])
        numbers_out.append(number[known])
        lost = np.flatnonzero(~known)
        for b in range(1, 5):  # bytes of characters without a piece, last byte first
            has = lost[step[lost] >= b]
            rows_out.append(row[has])
            numbers_out.append(vocab.byte_ids[data[first[row[has]] + place[has] - b]])
        place = place - step
        row, place = row[place > 0], place[place > 0]
    rows_all, numbers = np.concatenate([*rows_out, np.zeros(0, np.int64)]), np.concatenate([*numbers_out, np.zeros(0, np.int32)])
    back_order = np.arange(len(rows_all))[::-1]
    rows_all, numbers = order[rows_all[back_order]], numbers[back_order]
    sort = np.argsort(rows_all, kind="stable")
    return numbers[sort].astype(np.int32), np.bincount(rows_all, minlength=n)


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices first[i], first[i] + 1, ... for every i, ``count[i]`` of them."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)


def encode_piece(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers of some texts one after another, and the number of pieces of each text."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    spaced = np.insert(data, offsets[full], 32)
    lengths = np.diff(offsets) + (np.diff(offsets) > 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if not len(spaced):
        return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
    words = Words(spaced, offsets, lower=False)
    blank = spaced == 32
    fresh = np.zeros(len(spaced) + 1, bool)
    fresh[1:-1] = blank[1:] & ~blank[:-1] if vocab.cuts else False
    fresh[offsets] = True
    begin = np.flatnonzero(fresh[:-1])
    end = np.append(begin[1:], len(spaced))
    key = words.spans(begin, end)
    distinct, one, which = np.unique(key, return_index=True, return_inverse=True)
    brief = end[one] - begin[one] <= SEGMENT
    known, _ = vocab.solved.find(distinct)
    if len(vocab.solved.keys) + np.count_nonzero(brief & ~known) > MEMORY:
        vocab.solved, known = Solved(), np.zeros(len(one), bool)
    new = np.flatnonzero(brief & ~known)
    numbers, count = encode_together(vocab, words, begin[one[new]], end[one[new]])
    vocab.solved.add(distinct[new], numbers, count)
    at = vocab.solved.find(distinct[brief])[1]
    counts, firsts, numbers = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64), vocab.solved.numbers
    counts[brief], firsts[brief] = vocab.solved.count[at], vocab.solved.first[at]
    extra = [np.array(encode_segment(vocab, spaced[begin[i] : end[i]].tobytes()), np.int32) for i in one[~brief]]
    counts[~brief] = [len(e) for e in extra]
    firsts[~brief] = len(numbers) + np.cumsum([0, *map(len, extra)])[:-1] if extra else 0
    numbers = np.concatenate([numbers, *extra])
    out = numbers[ragged(firsts[which], counts[which])]
    doc = np.searchsorted(offsets, begin, "right") - 1
    return out, np.bincount(doc, counts[which], len(lengths)).astype(np.int64)


def transfer_matrix(vocab: Vocabulary, data: bytes, length: int) -> np.ndarray:
    """Best score from entering at byte i of a chunk to leaving j bytes behind its end.

    Behind the first cut that all entries pass, one lane is enough: scores only add up.
    """
    states = vocab.longest
    lanes = np.full((states, states), NONE)
    np.fill_diagonal(lanes, 0.0)
    raw = np.frombuffer(data, np.uint8)
    cut = np.flatnonzero((raw[1:length] == 32) & (raw[: length - 1] != 32)) + 1 if vocab.cuts else np.zeros(0, np.int64)
    cut = cut[cut >= states - 1]
    if len(cut):
        head, tail = int(cut[0]), int(cut[-1])
        to_head = best_arrivals(vocab, data[:head], head, lanes)[0][head]
        middle = segment_score(vocab, raw[head:tail]) if tail > head else 0.0
        beyond = best_arrivals(vocab, data[tail:], length - tail, np.zeros((1, 1)))[0][length - tail :, 0]
        leave = np.full(states, NONE)
        leave[: min(len(beyond), states)] = beyond[:states]
        return to_head[:, None] + middle + leave[None, :]
    best = best_arrivals(vocab, data, length, lanes)[0][length:]
    out = np.full((states, states), NONE)
    out[: min(len(best), states)] = best[:states]
    return out.T


def segment_score(vocab: Vocabulary, raw: np.ndarray) -> float:
    """Score of the best path over whole segments."""
    numbers, begins = path_numbers(vocab, raw), char_starts(raw)
    byte_set = np.isin(numbers, vocab.byte_ids)
    return float(vocab.scores[numbers[~byte_set]].sum()) + vocab.unknown * lost_characters(vocab, numbers) if len(begins) else 0.0


def lost_characters(vocab: Vocabulary, numbers: np.ndarray) -> int:
    """Characters that are spelled in byte pieces."""
    value = np.full(len(vocab.scores), -1)
    value[vocab.byte_ids] = np.arange(256)
    spelled = value[numbers]
    return int(((spelled >= 0) & ((spelled & 0xC0) != 0x80)).sum())


def path_numbers(vocab: Vocabulary, raw: np.ndarray) -> np.ndarray:
    """Piece numbers of whole segments that begin with a blank (which is part of the data)."""
    return encode_piece(vocab, raw[1:], np.array([0, len(raw) - 1]))[0] if len(raw) > 1 else np.array(encode_segment(vocab, raw.tobytes()), np.int32)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def chunk_path(vocab: Vocabulary, data: bytes, length: int, entry: int, leave: int) -> np.ndarray:
    """Pieces of one chunk between known boundary states."""
    raw = np.frombuffer(data, np.uint8)
    inner = np.arange(max(entry, 1), length)
    cut = inner[(raw[inner] == 32) & (raw[inner - 1] != 32)] if vocab.cuts else inner[:0]
    head, tail = (int(cut[0]), int(cut[-1])) if len(cut) else (entry, entry)

    def between(low: int, high: int, stop: int) -> list[int]:
        _, piece, start = best_arrivals(vocab, data[low:stop], high - low, np.zeros((1, 1)))
        return backtrace(vocab, data[low:stop], piece, start, stop - low, 0)

    middle = path_numbers(vocab, raw[head:tail]) if tail > head else np.zeros(0, np.int32)
    parts = [between(entry, head, head) if head > entry else [], middle, between(tail, length, length + leave)]
    return np.concatenate([np.asarray(p, np.int32) for p in parts])


def boundary_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """States at all boundaries of consecutive chunks, ``entry`` and ``leave`` included."""
    ahead = [np.where(np.arange(len(matrices[0])) == entry, 0.0, NONE)]
    for m in matrices[:-1]:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    states = [leave]
    for f, m in zip(reversed(ahead), reversed(matrices)):
        states.append(int(np.argmax(f + m[:, states[-1]])))
    return states[::-1]


def _square(values: bytes) -> np.ndarray:
    flat = np.frombuffer(values, np.float64)
    side = int(round(len(flat) ** 0.5))
    return flat.reshape(side, side)


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("no")
    total = _square(group["matrix"].iloc[0])
    for m in group["matrix"].iloc[1:]:
        total = product(total, _square(m))
    return pd.DataFrame({"_row": group["_row"].iloc[:1], "no": group["up"].iloc[:1], "matrix": [total.tobytes()]})


def _resolve(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("no")
    states = boundary_states([_square(m) for m in group["matrix"]], int(group["entry"].iloc[0]), int(group["leave"].iloc[0]))
    return pd.DataFrame({"_row": group["_row"], "no": group["no"], "entry": states[:-1], "leave": states[1:]})


def _lists(numbers: np.ndarray, count: np.ndarray, valid: np.ndarray) -> pa.Array:
    places = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
    return pa.ListArray.from_arrays(places, pa.array(numbers, pa.int32()), mask=pa.array(~valid))


def chunks_of(text: str, chunk: int, longest: int) -> list[tuple[bytes, int]]:
    """Chunks of about ``chunk`` bytes, cut between characters, each with the bytes behind it that a piece may reach."""
    data = b" " + text.encode()
    cuts = [0]
    while cuts[-1] + chunk < len(data):
        at = cuts[-1] + chunk
        while (data[at] & 0xC0) == 0x80:
            at -= 1
        cuts.append(at)
    if len(cuts) > 1 and len(data) - cuts[-1] < longest:
        cuts.pop()
    return [(data[a : b + longest - 1], b - a) for a, b in zip(cuts, [*cuts[1:], len(data)])]


def encode_documents(docs: DataFrame, vocab: Vocabulary, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """``docs`` with ``_ids``, the piece numbers of the whole ``text``.

    NULL texts get NULL, empty ones an empty array. Repeated rows stay; other columns are handed on and may
    not be called ``_ids`` or ``_row``; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # as large as the model file, whatever the data
    names = docs.columns
    giant = F.coalesce(F.octet_length("text") > chunk, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch, limit=TEXT_BYTES):
                numbers, count = encode_piece(shared.value, data, offsets)
                rows = batch.slice(row, end - row)
                valid = np.asarray(rows.column("text").is_valid())
                yield pa.RecordBatch.from_arrays([*rows.columns, _lists(numbers, count, valid)], [*names, "_ids"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("_row", pa.int64()), ("no", pa.int64()), ("length", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            for key, text in zip(batch.column("_row"), batch.column("text")):
                for no, (part, length) in enumerate(chunks_of(text.as_py(), chunk, shared.value.longest)):
                    yield pa.RecordBatch.from_pylist([{"_row": key.as_py(), "no": no, "length": length, "data": part}], schema=schema)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [transfer_matrix(shared.value, d.as_py(), n.as_py()).tobytes() for d, n in zip(batch.column("data"), batch.column("length"))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("no"), pa.array(out, pa.binary())], ["_row", "no", "matrix"])

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [chunk_path(shared.value, r["data"], r["length"], r["entry"], r["leave"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("no"), pa.array(out, pa.list_(pa.int32()))], ["_row", "no", "ids"])

    schema = T.StructType([*docs.schema.fields]).add("_ids", T.ArrayType(T.IntegerType()))
    encoded = docs.where(~giant).mapInArrow(short, schema)
    large = cut_lineage(docs.where(giant).withColumn("_row", F.monotonically_increasing_id()))
    if large.isEmpty():
        return encoded
    chunks = large.select("_row", "text").mapInArrow(split, "_row long, no long, length long, data binary")
    dealt = chunks.repartition("_row", "no")
    levels = [cut_lineage(dealt.mapInArrow(matrices, "_row long, no long, matrix binary"))]
    while levels[-1].agg(F.max("no")).first()[0] > 0:
        above = levels[-1].withColumn("up", F.floor(F.col("no") / group).cast("long")).groupBy("_row", "up")
        levels.append(cut_lineage(above.applyInPandas(_combine, "_row long, no long, matrix binary")))
    states = levels.pop().select("_row", "no", F.lit(0).alias("entry"), F.lit(0).alias("leave"))
    while levels:
        above = states.withColumnRenamed("no", "up")
        within = levels.pop().withColumn("up", F.floor(F.col("no") / group).cast("long")).join(above, ["_row", "up"])
        states = cut_lineage(within.groupBy("_row", "up").applyInPandas(_resolve, "_row long, no long, entry int, leave int"))
    found = chunks.join(states, ["_row", "no"]).select("_row", "no", "length", "data", "entry", "leave").mapInArrow(paths, "_row long, no long, ids array<int>")
    of_doc = found.groupBy("_row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda c: c["ids"])).alias("_ids"))
    return encoded.unionByName(large.join(of_doc, "_row").drop("_row"))


def decode_documents(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``encoded`` with ``_decoded``, the text its ``_ids`` stand for (NULL for NULL)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)
    names = encoded.columns

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = np.frombuffer(b"".join(shared.value.surfaces), np.uint8)
        size = np.array([len(s) for s in shared.value.surfaces], np.int64)
        first = np.cumsum(size) - size
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                lists = batch.column("_ids")
                numbers = lists.flatten().to_numpy(zero_copy_only=False)
                count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(count)), count)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, size[numbers], len(count)).astype(np.int64))])
                data = surfaces[ragged(first[numbers], size[numbers])].tobytes()
                out = [data[a + 1 : b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, "_decoded"])

    return encoded.mapInArrow(texts, T.StructType([*encoded.schema.fields]).add("_decoded", "string"))
