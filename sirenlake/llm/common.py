"""Helpers shared by the operators of this package: hashed words, connected components, salted joins.

Words are the runs of characters other than blank, tab and U+000A to U+000D, with A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

PIECE_BYTES = 1 << 20  # text handled at once inside a task, unless a single document is longer
BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NO_LETTER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])  # ASCII other than letters and digits
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _DOWN = np.ones(1, np.uint64)


class Words:
    """The words of some documents whose bytes lie one after another.

    ``start`` and ``end`` are byte positions, ``doc`` the document of each word and ``count`` the
    words of each document; ``hashes`` has one 64-bit number per word that depends on its bytes only.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, gaps: np.ndarray = SPACE):
        global _UP, _DOWN
        n = len(data)
        self.data = LOWER[data] if lower else data
        solid = ~gaps[data]
        fresh = np.ones(n + 1, bool)  # no word reaches over the place before this byte
        fresh[1:n] = ~solid[:-1]
        fresh[offsets] = True
        self.start = np.flatnonzero(solid & fresh[:n])
        fresh[:n] |= ~solid
        self.end = np.flatnonzero(solid & fresh[1:]) + 1
        self.offsets = offsets
        first = np.searchsorted(self.start, offsets)
        self.count = np.diff(first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        if n >= len(_UP):
            _UP, _DOWN = _powers(BASE, 2 * n + 2), _powers(BASE_INVERSE, 2 * n + 2)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=self._sums[1:])
        self.hashes = self.spans(self.start, self.end)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of any byte spans; equal bytes give equal hashes."""
        raw = (self._sums[end] - self._sums[start]) * _DOWN[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about ``limit`` bytes of text: first row, end row, bytes, offsets."""
    texts = batch.column(column)
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shingle_hashes(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``width`` words; shorter documents give their whole sequence."""
    h, doc = words.hashes, words.doc
    full, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(h) >= width:
        m = len(h) - width + 1
        full = h[:m]
        for j in range(1, width):
            full = mix(full * BASE + h[j : j + m])
        same = doc[:m] == doc[width - 1 :]
        full, of = full[same], doc[:m][same]
    brief = np.flatnonzero((words.count > 0) & (words.count < width))
    if len(brief):
        first = np.concatenate([[0], np.cumsum(words.count)])[brief]
        value = words.count[brief].astype(np.uint64)
        for j in range(width - 1):
            has = words.count[brief] > j
            value[has] = mix(value[has] * BASE + h[first[has] + j])
        full, of = np.concatenate([full, value]), np.concatenate([of, brief])
        order = np.argsort(of, kind="stable")
        full, of = full[order], of[order]
    return full, of


def word_count(text: Column) -> Column:
    """Number of words (0 for NULL)."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.coalesce(F.length(F.regexp_replace(inner, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")), F.lit(0)).cast("long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component_id`` (smallest id) of every id in the edges.

    Each round hooks every root to its smallest neighbour, jumps once, and contracts the edges; the
    maps of the rounds are composed at the end. Only aggregates with map-side combination and
    equi-joins of written tables are used, so hot ids are split by adaptive execution.
    """
    left = cut_lineage(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct())
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("up")))
        jump = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        maps.append(cut_lineage(up.join(jump, "up").select("id", F.col("top").alias("up"))))
        to_a, to_b = (maps[-1].select(F.col("id").alias(c), F.col("up").alias(f"new_{c}")) for c in "ab")
        moved = left.join(to_a, "a").join(to_b, "b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        left = cut_lineage(moved.where("a < b").distinct())
    if not maps:
        return left.select(F.col("a").alias("id"), F.col("a").alias("component_id"))
    found = maps.pop().withColumnRenamed("up", "component_id")
    while maps:
        top = found.select(F.col("id").alias("up"), "component_id")
        found = cut_lineage(maps.pop().join(top, "up", "left").select("id", F.coalesce("component_id", "up").alias("component_id")))
    return found
